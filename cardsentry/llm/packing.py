"""Sum-of-squares packing of documents into fixed-length sequences.

Documents longer than a sequence are cut into full pieces, the first piece taking the remainder; every document has
at most one piece that is not full. Such pieces are dealt into groups of about GROUP pieces by a hash, so that
groups grow in number and not in size. Within a group, pieces go by falling length to where the squared counts of
open bins per residual gap become smallest: a change of the bin counts N at gap g to g - s costs
2 (N[g - s] - N[g]) + 2, closing a bin 1 - 2 N[g]. A new bin is opened only where no open one has room, which keeps
the waste at a few tenths of a percent. The result of a group depends on its pieces only, not on how they arrive.

Defined cases: null text is empty; an empty document is its end token alone; repeated rows (also of one doc_id) are
packed each for themselves; null ids are kept; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import json
import math
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.byte_bpe import WORDS
from cardsentry.llm.common import Remembered, saved

GROUP = 1 << 16  # pieces packed by one task
REMEMBERED = 96 << 20  # bytes of remembered words per worker


class JsonTokenizer:
    """Ids of a byte-level BPE file of the `tokenizers` library, special strings inside texts as its default.

    Where the file's ids rise in merge order and it has no other steps, words are merged by their ranks (the ids
    are the same, in a fraction of the time); any other file is left to the library, text by text.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, before = given["model"], given["pre_tokenizer"] or {}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
        plain = (model["type"] == "BPE" and given["normalizer"] is None and merged == sorted(merged) and not model.get("ignore_merges")
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
                 and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in given["added_tokens"]))
        self.ranks = None
        if plain:
            special = {t["content"]: t["id"] for t in given["added_tokens"]}
            back = {c: b for b, c in _printable_bytes().items()}
            ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
            self.ranks = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.special = {t: struct.pack("<I", i) for t, i in special.items()}
            self.parts = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
            self.words = Remembered(self._word, REMEMBERED)

    def _word(self, word: str) -> bytes:
        ids = self.ranks.encode_ordinary(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, without added special tokens."""
        if self.ranks is None:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.parts is None or not any(t in text for t in self.special):
            return b"".join(map(self.words.__getitem__, WORDS.findall(text)))
        return b"".join(self.special.get(x) or b"".join(map(self.words.__getitem__, WORDS.findall(x))) for x in self.parts.split(text))


#: Fixed value: the split pattern that the library's byte-level step uses.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _printable_bytes() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


@functools.cache
def json_tokenizer(path: str) -> JsonTokenizer:
    return JsonTokenizer(path)


def cut(docs: DataFrame, path: str, capacity: int, end_id: int, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of tokenized documents: id, piece, start, length, token_ids (binary, little-endian unsigned 32-bit)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, end = json_tokenizer(path), struct.pack("<I", end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                source, piece, start, length, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    all_ids = to.encode(text or "") + end
                    n = len(all_ids) // 4
                    border = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(border, border[1:])):
                        source.append(i), piece.append(k), start.append(a), length.append(b - a), ids.append(all_ids[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], ["id", "piece", "start", "length", "token_ids"])

    out = docs.select(id_column, text_column).mapInArrow(run, f"id {kind}, piece int, start long, length long, token_ids binary")
    return out.withColumnRenamed("id", id_column)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to capacity): the longest first, each where the sum of squares becomes smallest
    (ties: the smallest gap, the bin that came to it last), a new bin where no open one has room."""
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        there = count[s:capacity]
        cost = np.where(there > 0, 2 * (count[: max(0, capacity - s)] - there) + 2, _NO_ROOM)
        if len(there) and there[0] > 0:
            cost[0] = 1 - 2 * there[0]
        at = int(cost.argmin()) if len(there) else 0
        if len(there) and cost[at] < _NO_ROOM:
            gap = at + s
            b = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, bins
            bins += 1
        bin_of[i], offset[i] = b, capacity - gap
        if gap > s:
            open_at[gap - s].append(b)
            count[gap - s] += 1
    return bin_of, offset


_NO_ROOM = 1 << 62


def pack(pieces: DataFrame, capacity: int, *, length_column: str = "length") -> DataFrame:
    """Adds sequence_id and offset to saved rows with a unique `row` and a length of 1 to `capacity`.

    Full pieces are sequences of their own; the others are packed in groups. `pieces` is read twice.
    """
    part = pieces.filter(F.col(length_column) < capacity).select("row", F.col(length_column).alias("length"))
    groups = max(1, math.ceil(part.count() / GROUP))
    part = part.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        bin_of, offset = place(rows["length"].to_numpy(), capacity)
        return pd.DataFrame({"row": rows["row"], "sequence_id": (int(key[0]) * (GROUP * 4) + bin_of) * 2 + 1, "offset": offset})

    placed = part.groupBy("group").applyInPandas(run, "row long, sequence_id long, offset long")
    joined = pieces.filter(F.col(length_column) < capacity).join(placed, "row")
    full = pieces.filter(F.col(length_column) >= capacity).withColumns({"sequence_id": F.col("row") * 2, "offset": F.lit(0).cast("long")})
    return joined.unionByName(full)


def pack_documents(docs: DataFrame, path: str, *, capacity: int = 1024, end_id: int = 2, payload: Sequence[Column] | None = None,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, sequence_id, offset and `payload` (default: the piece's token_ids).

    The payload is computed from the pieces before they are written once; a digest there keeps the ids off the disk.
    """
    payload = [F.col("token_ids")] if payload is None else list(payload)
    pieces = cut(docs, path, capacity, end_id, id_column=id_column, text_column=text_column)
    pieces = saved(pieces.select(F.monotonically_increasing_id().alias("row"), id_column, "piece", "start", "length", *payload), "pieces")
    return pack(pieces, capacity).drop("row")

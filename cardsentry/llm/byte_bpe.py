"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token (one match of the split pattern) that is a vocabulary entry is resolved by a minimal perfect hash;
any other goes through merges of a heap over linked bytes. Results of either tier are remembered per worker in a
table of bounded size, since texts repeat their pre-tokens.

Defined cases: null text encodes like the empty text, to no ids; texts are encoded whole, whatever their length;
rows are encoded one by one (ties and repeated rows each give a row); an empty table gives an empty result; only
the id and text columns are read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from cardsentry.llm.common import Remembered

REMEMBERED = 64 << 20  # bytes of remembered pre-tokens per worker, and as many of words

#: The characters with Unicode's White_Space property.
_WHITE = r"\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: bucket displacements, then one slot and one check each.

    Keys fall into buckets by their hash's low half; buckets, largest first, try displacements until all their
    keys land in free slots; a bucket of one key stores its slot itself (as -1 - slot). A lookup computes one hash
    and compares the stored key.
    """

    def __init__(self, keys: Sequence[bytes], load: int = 3):
        self.n = max(1, len(keys))
        self.n_buckets = max(1, -(-len(keys) // load))
        self.seeds = [0] * self.n_buckets
        self.slots: list[int] = [-1] * self.n
        self.keys = list(keys)
        buckets: list[list[tuple[int, int]]] = [[] for _ in range(self.n_buckets)]
        for i, key in enumerate(self.keys):
            h = xxhash.xxh3_64_intdigest(key)
            buckets[(h & 0xFFFFFFFF) % self.n_buckets].append((h >> 32, i))
        free = bytearray(b"\1") * self.n
        sizes = sorted(range(self.n_buckets), key=lambda b: -len(buckets[b]))
        many = [b for b in sizes if len(buckets[b]) > 1]
        for b in many:
            highs, seed = [h for h, _ in buckets[b]], 0
            while True:
                at = [self._place(h, seed) for h in highs]
                if all(free[a] for a in at) and len(set(at)) == len(at):
                    break
                seed += 1
            self.seeds[b] = seed
            for a, (_, i) in zip(at, buckets[b]):
                free[a] = 0
                self.slots[a] = i
        left = (a for a in range(self.n) if free[a])
        for b in sizes[len(many) :]:
            if buckets[b]:
                a = next(left)
                self.seeds[b], self.slots[a] = -1 - a, buckets[b][0][1]

    def _place(self, high: int, seed: int) -> int:
        x = (high + seed * 0x9E3779B1) * 0x85EBCA6B & 0xFFFFFFFFFFFF
        return (x ^ x >> 17) % self.n

    def find(self, key: bytes) -> int:
        """Index of `key` among the keys, -1 if it is none of them."""
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[(h & 0xFFFFFFFF) % self.n_buckets]
        i = self.slots[-1 - seed if seed < 0 else self._place(h >> 32, seed)]
        return i if i >= 0 and self.keys[i] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of `piece`: the pair of lowest rank (leftmost on ties) is merged until no pair has a rank.

    Parts are linked by where they end and by the part before; the heap holds rank, start and stop of pairs, packed
    into one number each.
    """
    n, get = len(piece), ranks.get
    bits = n.bit_length()
    mask = (1 << bits) - 1
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it has been merged into another
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            heap.append((r << bits | i) << bits | i + 2)
    heapq.heapify(heap)
    while heap:
        pair = heapq.heappop(heap)
        stop, i = pair & mask, pair >> bits & mask
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            r = get(piece[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r << bits | i) << bits | end[stop])
        k = before[i]
        if k >= 0:
            r = get(piece[k:stop])
            if r is not None:
                heapq.heappush(heap, (r << bits | k) << bits | stop)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one rank file and split pattern.

    Texts are first parted at white space the way the pattern parts them (a word takes the one space before it);
    each word is then split by the pattern. This needs a pattern whose matches inside a word, or inside a run of
    white space, do not depend on what lies beyond; `whole_text` must be set for any other.
    """

    def __init__(self, path: str, pattern: str, whole_text: bool = False):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.whole = PerfectHash(list(self.ranks))
        self.ids = list(self.ranks.values())
        self.bytes_of = {i: token for token, i in self.ranks.items()}
        self.findall = regex.compile(pattern).findall
        self.pieces = Remembered(self._piece, REMEMBERED)
        self.words = Remembered(self._word, REMEMBERED)
        self.part = self.findall if whole_text else WORDS.findall
        self.known = self.pieces if whole_text else self.words

    def _piece(self, text: str) -> bytes:
        """Ids of one pre-token."""
        raw = text.encode()
        at = self.whole.find(raw)
        ids = [self.ids[at]] if at >= 0 else merge_bytes(raw, self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self.part(text)))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    """The codec of this worker process, built once."""
    return Codec(path, pattern)


Batches = Iterator[pa.RecordBatch]


def _parts(batches: Batches) -> Batches:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def _encoded(batches: Batches, path: str, pattern: str) -> Batches:
    """(id, text) to (id, token_ids)."""
    to = codec(path, pattern)
    for part in _parts(batches):
        ids = [to.encode(t) if t else b"" for t in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "token_ids"])


def _decoded(batches: Batches, path: str, pattern: str) -> Batches:
    """(id, token_ids) to (id, token_ids, decoded)."""
    to = codec(path, pattern)
    for part in _parts(batches):
        texts = [to.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())], ["id", "token_ids", "decoded"])


def _digested(batches: Batches) -> Batches:
    """(id, token_ids, decoded) to (id, n_tokens, ids_sha256, decoded_sha256)."""
    names: dict[int, str] = {}
    for part in _parts(batches):
        counts, hashes, back = [], [], []
        for raw, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            ids = np.frombuffer(raw, "<u4").tolist()
            counts.append(len(ids))
            hashes.append(hashlib.sha256(" ".join([names.get(i) or names.setdefault(i, str(i)) for i in ids]).encode()).hexdigest())
            back.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(back)],
                                         ["id", "n_tokens", "ids_sha256", "decoded_sha256"])


_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _mapped(rows: DataFrame, run, id_column: str, shape: str) -> DataFrame:
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {shape}").withColumnRenamed("id", id_column)


def encode(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id_column` and `token_ids` (binary, little-endian unsigned 32-bit) for every row."""
    return _mapped(docs.select(id_column, text_column), lambda b: _encoded(b, path, pattern), id_column, "token_ids binary")


def decode(tokens: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id") -> DataFrame:
    """Adds `decoded` (binary): the bytes of each row's token ids; unknown ids raise."""
    return _mapped(tokens.select(id_column, "token_ids"), lambda b: _decoded(b, path, pattern), id_column, "token_ids binary, decoded binary")


def id_digest(rows: DataFrame, *, id_column: str = "doc_id") -> DataFrame:
    """n_tokens, ids_sha256 (of decimal ids joined by one space) and decoded_sha256 of encoded and decoded rows."""
    return _mapped(rows.select(id_column, "token_ids", "decoded"), _digested, id_column, _DIGEST)


def round_trip_digest(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id_digest` of `decode` of `encode`, in one worker a task: ids and decoded bytes do not pass through the JVM."""
    run = lambda b: _digested(_decoded(_encoded(b, path, pattern), path, pattern))
    return _mapped(docs.select(id_column, text_column), run, id_column, _DIGEST)

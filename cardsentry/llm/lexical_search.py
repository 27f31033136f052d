"""Ranked lexical search, reversed: the items are indexed, and the documents are streamed through their index.

1. Items are dealt to blocks by a hash until no block holds more than BLOCK_BYTES of item text (or holds one item).
   A block becomes an inverted index (term -> items and how often each holds it), built on the driver from the one
   block it reads and broadcast: its size is bounded by BLOCK_BYTES, whatever the number of items.
2. Tasks read each whole document once: its number of terms, and its counts of the terms that any item of the block
   holds. These counts are written; the corpus figures (documents, terms, documents per term) are sums over them.
3. A second pass streams the counts through the postings, adds up each item's score and keeps a heap of the `k` best
   documents per item and task; then the heaps of all tasks are merged.

Blocks follow one another; usually there is one. Figures are exact: 64-bit integers, and sums below 2^53 in doubles.

A term is a maximal run of letters and digits of ASCII and of any other characters, A-Z lower-cased. A term's weight
is w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's score adds w * ((10^9 tf) div (1000 tf + 8 m)) over the
item's terms, repeats included, with m = 100 - b + ((b n N) div L) and b = 75 as the length normalization.

Defined cases: null and empty texts of documents have no terms and do not count in N; null items or items without
terms give no rows; rows that repeat an item's id and text are one item, rows with the same id and another text are
ranked each for themselves; rows that repeat a document are candidates each; null ids go last among equal scores;
equal scores go to the smaller id; fewer than `k` documents with a score above 0 give fewer rows; empty tables give
no rows; only the id and text columns are read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cardsentry.llm.common import discard, saved

BLOCK_BYTES = 4 << 20  # item text indexed and broadcast at a time
ITEM_BYTES = 400  # that an item counts besides its text, for its heaps
_ROWS = 256  # documents scored together, at most
_CELLS = 1 << 20  # scores held together
_CHUNK = 1 << 22  # bytes of a text cut into terms at a time
_LAST = (1 << 63) - 1  # stands for a null id

_TERMS = bytes.maketrans(
    bytes(range(0x80)),
    bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(0x80)))


def count_terms(data: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text; long texts are cut at blanks, a part at a time."""
    clean = data.translate(_TERMS)
    if len(clean) <= _CHUNK:
        return Counter(clean.split())
    out, at = Counter(), 0
    while at < len(clean):
        to = clean.find(b" ", at + _CHUNK)
        to = len(clean) if to < 0 else to
        out.update(clean[at:to].split())
        at = to
    return out


class Index:
    """Inverted index over the terms of items: postings by term number, in one array."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for i, text in enumerate(texts):
            for term, times in count_terms(text).items():
                at = self.number.setdefault(term, len(postings))
                if at == len(postings):
                    postings.append([])
                postings[at].append((i, times))
        self.n_items = len(texts)
        self.start = np.concatenate([[0], np.cumsum([len(p) for p in postings])]).astype(np.int64)
        flat = [x for p in postings for x in p]
        self.item = np.array([i for i, _ in flat], np.int64)
        self.times = np.array([t for _, t in flat], np.float64)


def term_counts(docs: DataFrame, index, id_column: str, text_column: str) -> DataFrame:
    """Per document with a term: id, n (its terms) and at, tf (term numbers and counts of terms that items hold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                ids, n, at, tf = [], [], [], []
                for doc, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = count_terms(data)
                    if not found:
                        continue
                    held = [(number[t], c) for t, c in found.items() if t in number]
                    ids.append(doc), n.append(found.total()), at.append([t for t, _ in held]), tf.append([c for _, c in held])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                                                  pa.array(tf, pa.list_(pa.int32()))], ["id", "n", "at", "tf"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("data"))
    return rows.filter("data IS NOT NULL").mapInArrow(run, "id long, n long, at array<int>, tf array<int>")


def weights(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of every term; as many rows reach the driver as the index has terms."""
    n_docs, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(n_terms, np.int64)
    for r in counts.select(F.explode("at").alias("at")).groupBy("at").count().collect():
        df[r["at"]] = r["count"]
    return n_docs, total, np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class Heaps:
    """The `k` best (score, smaller id) per item."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items)  # a score to reach

    def add(self, scores: np.ndarray, ids: list[int]) -> None:
        """scores: by document and item."""
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= self.least))):
            heap, entry = self.heaps[item], (int(scores[row, item]), -ids[row])
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for item, heap in enumerate(self.heaps):
            for score, minus in heap:
                yield item, -minus, score


def best_documents(counts: DataFrame, index, n_docs: int, total: int, weight: np.ndarray, k: int, b: int) -> DataFrame:
    """(item, doc, score): the `k` best of every item and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to: Index = index.value
        heaps = Heaps(to.n_items, k)
        size, together = np.diff(to.start), max(1, min(_ROWS, _CELLS // to.n_items))
        for batch in batches:
            for begin in range(0, batch.num_rows, together):
                part = batch.slice(begin, together)
                lists, ids = part.column(2), part.column(0).fill_null(_LAST).to_pylist()
                rows = part.num_rows
                doc = np.repeat(np.arange(rows), np.diff(lists.offsets.to_numpy()))
                at, tf = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                # a document's length in doubles would lose digits: Python's integers divide it exactly
                m = np.array([100 - b + b * n * n_docs // total for n in part.column(1).to_pylist()], np.int64)
                gain = weight[at] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                some = gain > 0
                doc, at, gain = doc[some], at[some], gain[some]
                n = size[at]
                # the places of all postings of these terms
                place = np.repeat(to.start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                cell = np.repeat(doc * to.n_items, n) + to.item[place]
                scores = np.bincount(cell, np.repeat(gain, n) * to.times[place], rows * to.n_items)
                heaps.add(scores.reshape(rows, to.n_items), ids)
        found = list(zip(*heaps.rows())) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["item", "doc", "score"])

    return counts.mapInArrow(run, "item long, doc long, score long")


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """Items with their block: as many blocks as it takes that none holds more than BLOCK_BYTES, or more than one item."""
    n = 1
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        most = dealt.groupBy("block").agg(F.sum(F.octet_length("text") + ITEM_BYTES).alias("size"), F.count("*").alias("n")).filter(
            (F.col("size") > BLOCK_BYTES) & (F.col("n") > 1)).agg(F.max("size")).first()[0]
        if most is None:
            return dealt, n
        n *= max(2, -(-most // BLOCK_BYTES))


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, b: int = 75, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The `k` best documents of every item: the item's column, rank (from 1), the document's column, score."""
    spark = docs.sparkSession
    kind = items.schema[item_column].dataType.simpleString()
    asked = saved(items.select(F.col(item_column).alias("item_id"), F.col(item_text_column).alias("text")).filter("text IS NOT NULL").distinct(), "items")
    dealt, n_blocks = _blocks(asked)
    out = []
    for block in range(n_blocks):
        here = [(r["item_id"], r["text"]) for r in dealt.filter(F.col("block") == block).select("item_id", "text").collect()]
        if not here:
            continue
        index = spark.sparkContext.broadcast(Index([text.encode() for _, text in here]))
        counts = saved(term_counts(docs, index, id_column, text_column), "term-counts")
        n_docs, total, weight = weights(counts, len(index.value.number))
        if not total:
            discard(counts)
            continue
        best = saved(best_documents(counts, index, n_docs, total, weight, k, b), "heaps")
        discard(counts)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc"))
        # the items of a block, with their numbers in its index
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(here)], f"item long, item_id {kind}")
        merged = best.withColumn("rank", rank).filter(F.col("rank") <= k).join(F.broadcast(names), "item")
        doc = F.when(F.col("doc") != _LAST, F.col("doc"))
        out.append(merged.select(F.col("item_id").alias(item_column), F.col("rank").cast("int").alias("rank"), doc.alias(id_column), "score"))
    discard(asked)
    if not out:
        return spark.createDataFrame([], f"{item_column} {kind}, rank int, {id_column} long, score long")
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found

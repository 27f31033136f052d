"""Filter interaction audit: what every filter removes in every order, by decision diagrams.

Each document gets a mask of the filters it fails (tasks read whole texts). Masks are counted per part; a part's at
most 2^n counts become a decision diagram: one level per filter, a fail and a pass edge per node, and on each node
the weights (documents, good ones, toxic ones) of all masks below it; equal nodes are one node. Another order of the
filters is the same diagram with levels reordered. All orders are visited by swaps of two adjacent levels, each
order from the one before (plain changes), and a swap rebuilds only the two levels it touches. The path that passes
every filter gives an order's steps: the weights of its nodes are kept, those off its fail edges are removed.

Which copies of a text come first is counted without moving the copies: all failing and passing documents are
counted per part as if every copy came later, and the first ones of each text (one row per text, from partial
aggregates) are taken off these counts and added to the passing ones. A text that a third of the table repeats is
one row per task.

Defined cases: null text is empty (no words, so A fails and B, C, D do not); a null part is the empty string; a null
id is never a smaller id, and no id is smaller than it; rows that repeat id and text do not make each other fail;
of several labels of an id, any 1 counts; null labels and ids without labels are neither good nor toxic; an empty
table gives no rows; only the id, text, part and label columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import saved

FILTERS = "ABCDE"  # E, identical to the text of a smaller id, is the only one that needs more than the text
COPY = FILTERS.index("E")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_INNER = bytes(range(0x80, 0xC0))  # bytes that go on a code point
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_CHUNK = 1 << 22  # bytes of a text cut into words at a time


def word_counts(data: bytes) -> tuple[int, int]:
    """Words, and different words, of a UTF-8 text; long texts are cut at blanks, a part at a time."""
    if len(data) <= _CHUNK:
        words = data.split()  # at space and the controls 9 to 13
        return len(words), len(set(words))
    n, known, at = 0, set(), 0
    while at < len(data):
        blank = _BLANK.search(data, at + _CHUNK)
        to = blank.start() if blank else len(data)
        words = data[at:to].split()
        n += len(words)
        known.update(words)
        at = to
    return n, len(known)


def failures(data: bytes) -> int:
    """Mask of the filters A to D that a UTF-8 text fails (bit 0: A)."""
    n, different = word_counts(data)
    size = len(data)
    few = n < 200
    repeated = 100 * different < 50 * n
    points = size - len(data.translate(None, _INNER)) if not data.isascii() else 0
    loud = 100 * (size - len(data.translate(None, _CAPITALS))) > 2 * (size - points)
    signs = len(data.translate(None, _SIGNS)) < size
    return few | repeated << 1 | loud << 2 | signs << 3


def masks(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """Per row: id, part, mask (A to D) and h, a 16-byte digest of the whole text."""
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), text.alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([failures(x) for x in texts], pa.int32()),
                     pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in texts], pa.binary())], ["id", "part", "mask", "h"])

    return rows.mapInArrow(run, f"id {kind}, part string, mask int, h binary")


def mask_counts(rows: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) over all filters, from saved rows: id, part, mask (A to D), h, good, toxic."""
    own = ["part", "mask", "good", "toxic"]
    counted = rows.groupBy(*own).agg(F.count("*").alias("n"), F.count("id").alias("later"))
    # the first rows of each text: those of its least id, nearly always one
    by_id = rows.filter("id IS NOT NULL").groupBy("h", "id", *own).agg(F.count("*").alias("n"))
    by_id = by_id.groupBy("h", "id").agg(F.sort_array(F.collect_list(F.struct(*own, "n"))).alias("firsts"))
    first = by_id.groupBy("h").agg(F.min(F.struct("id", "firsts")).alias("least")).select(F.explode("least.firsts").alias("f")).select("f.*")
    first = first.groupBy(*own).agg(F.sum("n").alias("n"))
    fails = F.col("mask").bitwiseOR(1 << COPY)
    copies = counted.select("part", fails.alias("mask"), "good", "toxic", F.col("later").alias("n"))
    nameless = counted.select(*own, (F.col("n") - F.col("later")).alias("n"))
    less = first.select("part", fails.alias("mask"), "good", "toxic", (-F.col("n")).alias("n"))
    every = copies.union(less).union(nameless).union(first.select(*own, "n"))
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                             F.sum(F.col("n") * F.col("toxic")).alias("toxic")).filter("n > 0")


Weight = tuple[int, ...]


class Diagram:
    """Decision diagram of failure masks with weights, ordered and without equal nodes; levels can be swapped."""

    def __init__(self, n: int, weights: dict[int, Weight]):
        """weights: by mask over n filters (bit i: filter i fails); filters are the levels, in their order."""
        self.order = list(range(n))
        width = len(next(iter(weights.values()), (0,)))
        self.zero = (0,) * width
        self.nodes: list[tuple[int, int, Weight]] = []  # pass edge, fail edge, weight below
        self.known: dict[tuple, int] = {}
        self.root = self._grown(0, 0, weights)

    def _node(self, level: int, passed: int, failed: int) -> int:
        key = (level, passed, failed)
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.nodes)
            self.nodes.append((passed, failed, tuple(map(sum, zip(self.nodes[passed][2], self.nodes[failed][2])))))
        return at

    def _leaf(self, weight: Weight) -> int:
        key = (-1, weight)
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.nodes)
            self.nodes.append((-1, -1, weight))
        return at

    def _grown(self, level: int, mask: int, weights: dict[int, Weight]) -> int:
        if level == len(self.order):
            return self._leaf(weights.get(mask, self.zero))
        return self._node(level, self._grown(level + 1, mask, weights), self._grown(level + 1, mask | 1 << level, weights))

    def swap(self, level: int) -> None:
        """Exchanges the filters of `level` and the next one. Nodes below stay as they are, those above get new edges."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        done: dict[int, int] = {}

        def moved(at: int, depth: int) -> int:
            new = done.get(at)
            if new is None:
                passed, failed, _ = self.nodes[at]
                if depth < level:
                    new = self._node(depth, moved(passed, depth + 1), moved(failed, depth + 1))
                else:
                    (pp, pf, _), (fp, ff, _) = self.nodes[passed], self.nodes[failed]
                    new = self._node(level, self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
                done[at] = new
            return new

        self.root = moved(self.root, 0)

    def steps(self) -> list[tuple[int, Weight, Weight]]:
        """(filter, kept, removed) along the path that passes every filter."""
        out, at = [], self.root
        for one in self.order:
            passed, failed, _ = self.nodes[at]
            out.append((one, self.nodes[passed][2], self.nodes[failed][2]))
            at = passed
        return out


def plain_changes(n: int) -> list[int]:
    """Levels to swap, one after the other, that lead through all orders of n filters."""
    if n < 2:
        return []
    inner, out = plain_changes(n - 1), []
    for i in range(len(inner) + 1):
        down = i % 2 == 0  # the last filter walks to the front, and back again
        out.extend(range(n - 2, -1, -1) if down else range(n - 1))
        if i < len(inner):
            out.append(inner[i] + down)
    return out


def audit_part(weights: dict[int, Weight], filters: Sequence[str]) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    n = len(filters)
    diagram = Diagram(n, weights)
    fails = [sum(w[0] for m, w in weights.items() if m >> i & 1) for i in range(n)]
    alone = [weights.get(1 << i, (0,))[0] for i in range(n)]
    shapley, told = [0] * n, []
    for level in [None, *plain_changes(n)]:
        if level is not None:
            diagram.swap(level)
        steps = diagram.steps()
        told.append(("".join(filters[one] for one in diagram.order), steps))
        for one, _, removed in steps:
            shapley[one] += removed[0]
    for order, steps in told:
        for step, (one, kept, removed) in enumerate(steps, 1):
            yield order, step, kept[0], removed[0], fails[one] - removed[0], alone[one], removed[1], removed[2], shapley[one]


def audit(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """One row per part, order of the filters and step; see `audit_part` for the columns."""
    told = labels.select(F.col(id_column).alias("id"), "quality", "toxic").filter("id IS NOT NULL").groupBy("id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = masks(docs, id_column=id_column, text_column=text_column, part_column=part_column).join(told, "id", "left")
    rows = saved(rows.select("id", "part", "mask", "h", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")), "masks")
    # at most 2^5 masks a part
    parts = mask_counts(rows).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                weights = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts}
                columns = zip(*((part, *row) for row in audit_part(weights, FILTERS)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return parts.mapInArrow(run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
                                 "good_lost long, toxic_lost long, shapley long")

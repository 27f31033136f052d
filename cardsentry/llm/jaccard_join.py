"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. Every text becomes its set of word shingles (five words); texts with equal sets form one node, so copies are
   counted and never paired.
2. Nodes get a MinHash signature. Nodes that agree on all values of a band meet in a bucket; a pair at the
   threshold shares no band with probability (1 - 0.8^ROWS)^BANDS, below 1e-7.
3. Pairs inside a bucket are compared a few MinHash values at a time. A pair is dropped as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold falls below TOLERANCE. From the survivors
   only a spanning forest per bucket is kept: fewer edges than members. Buckets of more than BLOCK members are dealt
   as pairs of blocks.
4. Components of these edges are candidate groups. Each group's members come together once with their shingle sets,
   large groups again as pairs of blocks; all their pairs pass the same pruning, and the rest is verified exactly on
   the sets. A task gives each node's number of links and a spanning forest, never the pairs.
5. Components of the verified edges are the classes.

Words are runs of characters other than space and the controls 9 to 13. Shingles are compared as 64-bit hashes.

Defined cases: null and empty texts have no shingles, link to nothing and are classes of their own; a text of one to
four words is one shingle, so only its copies link to it; repeated rows link to each other like any copies; null ids
are kept (a class whose ids are all null has class id null); an empty table gives no rows; only the id and text
columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import discard, mixed, saved, shingles, sieved, word_hashes
from cardsentry.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 4
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-6
BLOCK = 512  # members of a block
_HASHES = BANDS * ROWS

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 1 << 32, _HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, _HASHES, dtype=np.uint32)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingles(word_hashes(text.encode()), WORDS))


def signature(members: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of a non-empty set."""
    low = mixed(members).astype(np.uint32)
    least = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        least = np.minimum(least, (low[at : at + 512, None] * _FACTORS + _SHIFTS).min(axis=0))
    return (least >> np.uint32(16)).astype(np.uint16)


@functools.cache
def least_matches(threshold: float, tolerance: float) -> tuple[tuple[int, int], ...]:
    """(n, m) by rising n: a pair with fewer than m equal values among its first n is dropped.

    With a uniform prior, P(similarity >= t | m of n equal) is the chance of at most m successes in n + 1 trials
    of probability t.
    """
    out = []
    for n in range(STEP, _HASHES + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return tuple(out)


def surviving(signs: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Indices into the pairs (a, b) of rows of `signs` that incremental comparison does not drop."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int16)
    at = 0
    for n, m in least_matches(threshold, tolerance):
        equal += (signs[a[alive], at:n] == signs[b[alive], at:n]).sum(axis=1, dtype=np.int16)
        keep = equal >= m
        alive, equal, at = alive[keep], equal[keep], n
        if not len(alive):
            break
    return alive


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the edges (a, b) over 0 to n - 1."""
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = top(i), top(j)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((i, j))
            if len(out) == n - 1:
                break
    return out


def _pairs(n: int, left: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of n rows, or those across the first `left` rows and the others."""
    if left is None:
        return np.triu_indices(n, 1)
    a, b = np.meshgrid(np.arange(left), np.arange(left, n), indexing="ij")
    return a.ravel(), b.ravel()


def _whole_runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs (rows with equal first columns, of rows sorted by them) and the runs' borders."""
    held: list[pa.RecordBatch] = []

    def borders(table: pa.Table) -> np.ndarray:
        edge = np.ones(table.num_rows + 1, bool)
        edge[1:-1] = False
        for i in range(n_keys):
            column = table.column(i)
            v = np.array(column.to_pylist(), dtype=object) if pa.types.is_binary(column.type) else column.to_numpy()
            edge[1:-1] |= v[1:] != v[:-1]
        return np.flatnonzero(edge)

    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            table = pa.Table.from_batches([*held, batch.slice(at, 2048)])
            border = borders(table)
            last = int(border[-2])  # the last run may go on in the next rows
            held = table.slice(last).to_batches()
            if last:
                yield table.slice(0, last), border[:-1]
    if held:
        table = pa.Table.from_batches(held)
        yield table, borders(table)


def _pairs_of_runs(border: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs inside runs (across sides where lo != hi), about `most` pairs at a time."""
    start, size = border[:-1], np.diff(border)
    inner = lo[start] == hi[start]
    for n in np.unique(size[inner]).tolist():
        if n < 2:
            continue
        a, b = np.triu_indices(n, 1)
        own = start[inner & (size == n)]
        for at in range(0, len(own), max(1, most // len(a))):
            some = own[at : at + max(1, most // len(a)), None]
            yield (some + a).ravel(), (some + b).ravel()
    for at, n in zip(start[~inner].tolist(), size[~inner].tolist()):
        left = int((side[at : at + n] == 0).sum())
        a, b = _pairs(n, left)
        yield a + at, b + at


def nodes_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, th (hash of the text), node (16 bytes, null without shingles), size and signature."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                node, size, signs = [], [], []
                for text in part.column(2).to_pylist():
                    members = shingle_set(text or "")
                    size.append(len(members))
                    node.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None)
                    signs.append(signature(members).tobytes() if len(members) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                                                  pa.array(signs, pa.binary())], ["id", "th", "node", "size", "signs"])

    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("th"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, th long, node binary, size long, signs binary")


def _blocked(rows: DataFrame, keys: list[str], sizes: DataFrame, member: str) -> DataFrame:
    """Rows dealt to pairs of blocks of their group: adds lo, hi (blocks) and side (0: block lo, 1: block hi).

    A group of n members has ceil(n / BLOCK) blocks by a hash of `member`; a row goes to every pair that its block
    is part of, and to (block, block) once.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    out = rows.join(sizes.withColumn("blocks", blocks).drop("members"), keys)
    own = F.pmod(F.xxhash64(member), F.col("blocks").cast("long")).cast("int")
    out = out.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).drop("own", "other", "blocks")


def candidate_edges(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Spanning edges (a, b) of the surviving pairs of every bucket; nodes: node, signs."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring("signs", i * width + 1, F.lit(width)), i))
    rows = nodes.select("node", F.explode(keys).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    met = _blocked(rows, ["bucket"], sizes, "node").join(nodes.select("node", "signs"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])
            out_a.clear(), out_b.clear()
            return made

        for table, border in _whole_runs(batches, 3):
            ids = table.column("node").to_pylist()
            signs = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint16).reshape(len(ids), _HASHES)
            lo, hi, side = (table.column(c).to_numpy() for c in ("lo", "hi", "side"))
            found = [(a[k], b[k]) for a, b in _pairs_of_runs(border, lo, hi, side) if len(k := surviving(signs, a, b, threshold, tolerance))]
            if not found:
                continue
            # runs share no rows, so that one forest over all of them is a forest of each
            for i, j in forest(len(ids), *map(np.concatenate, zip(*found))):
                out_a.append(ids[i]), out_b.append(ids[j])
            if len(out_a) >= 4096:
                yield flush()
        yield flush()

    dealt = met.select("bucket", "lo", "hi", "side", "node", "signs").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "side")
    return dealt.mapInArrow(run, "a binary, b binary")


def verify(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Per node and block pair: node, links (verified, weighted by copies) and up, a node it is linked to or null.

    members: grp, node, signs, copies, members_of (binary: sorted 64-bit shingle hashes).
    """
    sizes = members.groupBy("grp").agg(F.count("*").alias("members"))
    dealt = _blocked(members, ["grp"], sizes, "node")
    dealt = dealt.select("grp", "lo", "hi", "side", "node", "signs", "copies", "members_of").repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
                                              ["node", "links", "up"])

        for tables, border in _whole_runs(batches, 3):
            for at, to in zip(border[:-1].tolist(), border[1:].tolist()):
                if to - at > 1:
                    out.extend(_verified(tables.slice(at, to - at), threshold, tolerance))
            if len(out) >= 4096:
                yield flush()
        yield flush()

    return dealt.mapInArrow(run, "node binary, links long, up binary")


def _verified(table: pa.Table, threshold: float, tolerance: float) -> Iterator[tuple[bytes, int, bytes | None]]:
    """(node, links, up) of one group or pair of its blocks."""
    ids, copies = table.column("node").to_pylist(), table.column("copies").to_numpy()
    signs = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint16).reshape(len(ids), _HASHES)
    a, b = _pairs(len(ids), None if table.column("lo")[0] == table.column("hi")[0] else table.column("side").to_pylist().count(0))
    alive = surviving(signs, a, b, threshold, tolerance)
    a, b = a[alive], b[alive]
    linked = similar([np.frombuffer(x, np.uint64) for x in table.column("members_of").to_pylist()], a, b, threshold)
    a, b = a[linked], b[linked]
    links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    up: dict[int, list[int | None]] = {}
    for i, j in forest(len(ids), a, b):
        up.setdefault(i, []).append(j)
    for i in np.flatnonzero(links).tolist():
        for k, j in enumerate(up.get(i, [None])):
            yield ids[i], int(links[i]) if k == 0 else 0, None if j is None else ids[j]


def similar(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair's Jaccard similarity reaches the threshold, exactly."""
    if not len(a):
        return np.zeros(0, bool)
    sizes = np.array([len(s) for s in sets])
    if len(a) <= 2 * len(sets):
        shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())])
    else:
        # intersections as products of membership matrices, a bounded number of shingles at a time
        every, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, len(every), 4096):
            x, y = np.searchsorted(column, [at, at + 4096])
            block = np.zeros((len(sets), 4096), np.float32)
            block[row[x:y], column[x:y] - at] = 1
            total += block @ block.T
        shared = total[a, b].astype(np.int64)
    # |A and B| / |A or B| >= threshold, in whole thousandths to stay exact
    return shared * 1000 >= round(threshold * 1000) * (sizes[a] + sizes[b] - shared)


def join(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, class_id (least id of its class), n_links (rows it is similar to), node, th
    (hash of the text) and chosen (whether it is the row that stands for its class).

    A class is a connected component of the links; rows without shingles have node null and their own id as class.
    """
    rows = saved(nodes_of(docs, id_column, text_column), "nodes")
    given = rows.filter("node IS NOT NULL")
    # one row stands for a node; its id and text hash find its text again
    nodes = saved(given.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct("id", "th")).alias("one"), F.any_value("signs").alias("signs")), "distinct")
    edges = saved(candidate_edges(nodes, threshold, tolerance), "candidates")
    groups = components(edges, "a", "b").select(F.col("vertex").alias("node"), F.col("component").alias("grp"))
    wanted = saved(nodes.join(groups, "node").select("node", "grp", "copies", "signs", "one.id", "one.th"), "wanted")
    discard(edges)
    texts = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("th"), F.col(text_column).alias("text"))
    texts = sieved(texts, wanted, ["id", "th"])     # only texts of candidates need to be moved
    found = texts.alias("t").join(wanted.alias("w"), F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.th") == F.col("w.th")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [shingle_set(x or "").tobytes() for x in part.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), pa.array(made, pa.binary())],
                                                 ["node", "grp", "copies", "signs", "members_of"])

    members = found.select("w.node", "w.grp", "w.copies", "w.signs", "t.text").mapInArrow(
        sets, "node binary, grp binary, copies long, signs binary, members_of binary")
    # rows repeated with their id and text stand for one node
    members = saved(members.dropDuplicates(["node"]), "members")
    verified = saved(verify(members, threshold, tolerance), "verified")
    discard(wanted, members)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.filter("up IS NOT NULL"), "node", "up").select(F.col("vertex").alias("node"), F.col("component").alias("class"))
    told = nodes.select("node", "copies", "one").join(links, "node", "left").join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    first = told.groupBy("class").agg(F.min("one").alias("first"))
    told = told.join(first, "class").select("node", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("id", "th", "node").join(told, "node", "left")
    bare = F.col("node").isNull()
    return out.select(F.col("id").alias(id_column), F.when(bare, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "node", "th",
                      (bare | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")))).alias("chosen"))


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with one row of each class: that of the least id (of equal ids, of the least text hash).

    Rows without shingles are all kept; of rows repeated with their id and text one stays.
    """
    joined = saved(join(docs, id_column=id_column, text_column=text_column), "joined")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("row_id"), F.xxhash64(text_column).alias("row_th"))

    def matching(these: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(id_column, "th").distinct()
        return these.join(keys, F.col("row_id").eqNullSafe(keys[id_column]) & (F.col("row_th") == keys["th"]), how)

    # most rows are surely not among the dropped ones and stay where they are; the rest is looked up exactly
    dropped = joined.filter("NOT chosen").select(F.col(id_column).alias("row_id"), F.col("th").alias("row_th"))
    kept = matching(sieved(rows, dropped, ["row_id", "row_th"]), joined.filter("chosen"), "left_semi")
    kept = kept.union(sieved(rows, dropped, ["row_id", "row_th"], keep=False))
    repeated = saved(joined.filter("chosen AND node IS NOT NULL").groupBy(id_column, "th").count().filter("count > 1"), "repeated")
    if not repeated.isEmpty():
        kept = matching(kept, repeated, "left_anti").union(matching(kept, repeated, "left_semi").dropDuplicates(["row_id", "row_th"]))
    return kept.select("row.*")

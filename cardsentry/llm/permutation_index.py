"""Approximate nearest neighbours by a permutation index.

Pivots are vectors of a bounded sample; their number grows with the square root of the table's (`pivots_for`), so that
clusters of any size hold several. Every vector is represented by its PREFIX nearest pivots in order of distance, and
posted in the inverted files of its POSTED nearest ones. A query probes the files of its PROBED nearest pivots; the
vectors found there are ranked by the footrule distance between the two prefixes (the sum, over the pivots of either,
of how far a pivot's place differs; one that is missing counts as the place after the last), and the best of a query
(`reranked_for`, growing like the pivots) are ranked again by their exact distance. All vectors are indexed. A vector
met in several files counts in the one that the query probes first; of the i-th file probed, a task tells its best
i-th part of the vectors to rerank, or PER_FILE. Every pivot is posted in its own file, so a query meets at least
PROBED vectors (its own may be one), or all where there are fewer pivots.

Copies are one vector: each distinct vector is posted, ranked and reranked once, with its k + 1 least ids, and ids
are told apart only after scoring. No result needs more: k of those ids are not the query's own.

An inverted file of more than FILE_BLOCK entries is dealt to several tasks by a hash of the entry, the queries of a
pivot likewise (QUERY_BLOCK); a task holds one block of each.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do
vectors of another dimension than most of the sample; null ids take no part; rows that repeat id and vector count
once, rows with the same id and another vector are each a candidate for all other ids and, as a query,
gives ranks of its own; ties go to the smaller id; pivots and
sample are of distinct vectors; an empty table gives no rows; only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cardsentry.llm.common import saved

SAMPLE = 4096  # vectors, those with the least hash of their id, that pivots come from
PIVOTS = 256  # at least, if there are as many vectors
PREFIX = 128
POSTED = 32
PROBED = 32
RERANKED = 1000  # at least
PER_FILE = 64  # vectors that a task tells of one file for a query, at least, the best by footrule
FILE_BLOCK = 4096
QUERY_BLOCK = 256
COPY_PARTS = 16  # groups of copies are dealt to so many tasks before they meet


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """row (unique), id and vec (array<double>) of the vectors that take part."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return rows.distinct().withColumn("row", F.monotonically_increasing_id())


def distinct_vectors(rows: DataFrame, n: int) -> DataFrame:
    """row (unique), vec, ids (its `n` least, rising), id (the least) and second (the next, or else the least)."""
    nth = F.row_number().over(Window.partitionBy("vec", "part").orderBy("id"))
    few = rows.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(COPY_PARTS)).alias("part")).withColumn("n", nth).filter(F.col("n") <= n)
    # at most COPY_PARTS * n ids a vector
    out = few.groupBy("vec").agg(F.slice(F.sort_array(F.collect_list("id")), 1, n).alias("ids"))
    second = F.coalesce(F.get("ids", 1), F.get("ids", 0))
    return out.select("vec", "ids", F.get("ids", 0).alias("id"), second.alias("second")).withColumn("row", F.monotonically_increasing_id())


def pivots_for(n: int) -> int:
    """Pivots of `n` vectors: eight times the square root, within PIVOTS and SAMPLE."""
    return min(SAMPLE, max(PIVOTS, 8 * math.isqrt(n)))


def reranked_for(n: int) -> int:
    """Candidates of a query that are ranked by exact distance: six times the square root of `n`, at least RERANKED."""
    return max(RERANKED, 6 * math.isqrt(n))


def choose_pivots(rows: DataFrame, n: int) -> np.ndarray:
    """Up to `n` different vectors, in double precision, from the SAMPLE rows with the least hash of their id."""
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(SAMPLE).select("vec").collect()
    if not sample:
        return np.zeros((0, 0))
    size = Counter(len(r.vec) for r in sample).most_common(1)[0][0]
    different = dict.fromkeys(tuple(r.vec) for r in sample if len(r.vec) == size)
    return np.array(list(different)[:n])


def permute(rows: DataFrame, pivots: np.ndarray, carry: list[str], prefix: int = PREFIX) -> DataFrame:
    """`carry` and order (binary: the numbers of the nearest pivots, nearest first, two bytes each)."""
    norms, n = (pivots**2).sum(axis=1), min(prefix, len(pivots))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.array(part.column(len(carry)).to_pylist(), dtype=float).reshape(part.num_rows, -1)
                order = np.argsort(norms - 2 * (x @ pivots.T), axis=1, kind="stable")[:, :n].astype(">u2")
                columns = [part.column(i) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([o.tobytes() for o in order], pa.binary())], [*carry, "order"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.filter(F.size("vec") == pivots.shape[1]).select(*carry, "vec").mapInArrow(run, f"{kinds}, order binary")


def _pivot(column: str, i: Column) -> Column:
    return F.conv(F.hex(F.substring(column, 2 * i + 1, F.lit(2))), 16, 10).cast("int")


def _posted(permuted: DataFrame, n: int, n_pivots: int) -> DataFrame:
    nearest = F.transform(F.sequence(F.lit(0), F.lit(min(n, n_pivots) - 1)), lambda i: _pivot("order", i))
    return permuted.withColumn("pivot", F.explode(nearest))


def _dealt(rows: DataFrame, own: str, own_blocks: str, other_blocks: str, key: str) -> DataFrame:
    """Rows in their block (`own`) and repeated for every block of the other side."""
    out = rows.withColumn(own, F.pmod(F.xxhash64(key), F.col(own_blocks)))
    other = "qblock" if own == "vblock" else "vblock"
    return out.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_blocks) - 1)))


def search(vectors: DataFrame, queries: Column, k: int = 10, *, id_column: str = "vec_id", vector_column: str = "embedding",
           posted: int = POSTED, probed: int = PROBED, prefix: int = PREFIX, reranked: int | None = None) -> DataFrame:
    """The `k` nearest found of every query: query_id, rank (from 1), the id column's name, score (Euclidean).

    `queries` is a condition on the column `id`; candidates are all rows with another id.
    """
    given = saved(usable(vectors, id_column, vector_column), "given")
    rows = saved(distinct_vectors(given, k + 1), "vectors")
    n_rows = rows.count()
    pivots, reranked = choose_pivots(rows, pivots_for(n_rows)), reranked or reranked_for(n_rows)
    if not len(pivots):
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_column), F.lit(0.0).alias("score")).limit(0)
    n_pivots = len(pivots)
    posted, probed, prefix = (min(x, n_pivots) for x in (posted, probed, max(prefix, posted, probed)))
    permuted = saved(permute(rows, pivots, ["row", "id", "second"], prefix), "permutations")
    entries = _posted(permuted, posted, n_pivots).select("pivot", "row", "id", "second", "order")
    asked = given.filter(queries)
    probes = _posted(saved(permute(asked, pivots, ["row", "id"], prefix), "queries"), probed, n_pivots).select("pivot", F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("order").alias("q_order"))
    blocks = lambda rows, name, most: rows.groupBy("pivot").agg(F.ceil(F.count("*") / most).cast("long").alias(name))
    # at most SAMPLE rows
    sizes = F.broadcast(saved(blocks(entries, "vblocks", FILE_BLOCK).join(blocks(probes, "qblocks", QUERY_BLOCK), "pivot"), "files"))
    left = _dealt(entries.join(sizes, "pivot"), "vblock", "vblocks", "qblocks", "row").select("pivot", "vblock", "qblock", "row", "id", "second", "order")
    right = _dealt(probes.join(sizes, "pivot"), "qblock", "qblocks", "vblocks", "query").select("pivot", "vblock", "qblock", "query", "query_id", "q_order")

    def ranked(key, files: pa.Table, asking: pa.Table) -> pa.Table:
        pivot = key[0].as_py()
        out = {"query": [], "query_id": [], "row": [], "id": [], "footrule": []}
        if files.num_rows:
            orders = np.frombuffer(b"".join(files.column("order").to_pylist()), ">u2").reshape(files.num_rows, prefix).astype(np.int32)
            own, first, second = (files.column(c).to_numpy() for c in ("row", "id", "second"))
            places, absent = np.arange(prefix, dtype=np.int32), prefix * (prefix + 1) // 2
            for query, query_id, order in zip(*(asking.column(c).to_pylist() for c in ("query", "query_id", "q_order"))):
                place = np.full(n_pivots, prefix, np.int32)  # of each pivot in the query's order
                place[np.frombuffer(order, ">u2")] = places
                ids = np.where(first == query_id, second, first)  # the least that is not the query's, if there is one
                here = np.flatnonzero((ids != query_id) & ~(place[orders[:, :posted]] < place[pivot]).any(axis=1))
                there = place[orders[here]]
                # pivots of the query that the vector misses, too: all of the query's less those they share
                far = np.abs(there - places).sum(axis=1) + absent - (prefix - there).sum(axis=1)
                best = np.lexsort((own[here], ids[here], far))[: max(PER_FILE, k, reranked // (1 + int(place[pivot])))]
                out["query"].append(np.full(len(best), query)), out["query_id"].append(np.full(len(best), query_id))
                out["row"].append(own[here][best]), out["id"].append(ids[here][best]), out["footrule"].append(far[best])
        kinds = {"query": pa.int64(), "query_id": pa.int64(), "row": pa.int64(), "id": pa.int64(), "footrule": pa.int32()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in out.items()})

    met = left.groupBy("pivot", "vblock", "qblock").cogroup(right.groupBy("pivot", "vblock", "qblock")).applyInArrow(
        ranked, "query long, query_id long, row long, id long, footrule int")
    order = F.row_number().over(Window.partitionBy("query").orderBy("footrule", "id", "row"))
    chosen = met.withColumn("n", order).filter(F.col("n") <= reranked).select("query", "query_id", "row", F.col("id").alias("least"))
    pairs = chosen.join(rows.select("row", "vec", "ids"), "row").join(asked.select(F.col("row").alias("query"), F.col("vec").alias("q_vec")), "query")
    squares = F.zip_with("vec", "q_vec", lambda a, b: (a - b) * (a - b))
    scored = pairs.select("query", "query_id", "least", "ids", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)).alias("score"))
    # each of the first k vectors holds an id that goes before all ids of later ones
    nearest = scored.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "least"))).filter(F.col("n") <= k)
    told = nearest.withColumn("id", F.explode("ids")).filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return told.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_column), "score")

"""Connected components of an edge table, in rounds of stars that grow and shrink.

Each round points every vertex's larger neighbours to its least one (large star), then every vertex and its smaller
neighbours to the least of them (small star); the edges end up as stars around each component's least vertex. Rounds
grow with the logarithm of the longest chain. Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import discard, saved


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with m, the least of u and all its v.

    The null-safe join shuffles both sides anew, apart from the aggregation's shuffle (where a vertex of many
    edges is one row per task): only then can a vertex with very many edges be split among tasks.
    """
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return pairs.join(least, F.col("u").eqNullSafe(F.col("w"))).select("u", "v", F.least("m", "u").alias("m"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) for every vertex of an edge; the component is its least vertex.

    Self-edges keep their vertex as a component of its own; null ends are left out; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    vertices = pairs.select("u").union(pairs.select("v")).distinct()
    state = saved(pairs.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least_neighbour(large.distinct())
        shrunk = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        before_this, state = state, saved(shrunk.filter("u != v").distinct(), "edges")
        discard(before_this)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = state.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return vertices.withColumnRenamed("u", "vertex").join(stars, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))

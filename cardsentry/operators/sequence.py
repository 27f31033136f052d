"""Exact per-key lags over a total order, without one task per key.

``lag(c, k) OVER (PARTITION BY key ORDER BY t, tie)`` puts every row of a key into one window group; a key holding
a large share of the rows becomes one task. Here the order is cut into buckets of time and every bucket is handed the
rows that precede it:

* ``near_lags`` serves rules with a time limit (R4, R4b): a row also stands as context in the next bucket.
* ``sequence_lags`` gives all lags, however old, by a prefix scan. A bucket's summary is its last n rows; the summary
  of several buckets in a row is the last n rows of them together, which is associative. Summaries are put together
  ``fan`` at a time up to one per key, and handed down again: a bucket gets the last n rows before its parent, and
  those of its elder sisters. A window over (key, bucket) then holds the bucket and at most n rows of context.

No group holds more than the rows of a key in one bucket and n more (windows) or ``fan`` summaries (scan), whatever
the key holds, and no step is keyed by the key alone but the last, of at most ``fan`` summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.session import checkpoint_root


def floor_div(c: Column, n: int) -> Column:
    """Exact floor(c / n) for bigint c (also for negative c), in integer arithmetic."""
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def lag_name(col: str, k: int) -> str:
    return f"_lag{k}_{col}"


def sequence_lags(df: DataFrame, key, order_us: str, tie: str, cols, n: int,
                  bucket_us: int, fan: int = 32) -> DataFrame:
    """``df`` plus ``_lag{k}_{c}`` = lag(c, k) per key in (order_us, tie) order, k = 1..n.

    Rows without a time come first, as in a plain window; null keys are one key; (order_us, tie) should tell a key's
    rows apart, as in a plain window. The bounds of time and the summaries (n rows a bucket) are computed when this is
    called; the summaries are kept by ``checkpoint()`` in the shared folder.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(dict.fromkeys(cols))
    told = list(dict.fromkeys(c for c in (order_us, tie, *cols) if c not in keys))
    levels, depth = floor_div(F.col(order_us), bucket_us), 0
    lo, hi = df.agg(F.min(levels), F.max(levels)).first()
    placed = df.withColumn("_sb", F.lit(0).cast("long") if lo is None else F.coalesce(levels - lo + 1, F.lit(0)))
    span = 1 if lo is None else hi - lo + 2
    while fan**depth < span:
        depth += 1

    own = placed.withColumn("_own", F.lit(True))
    if depth:
        context = _carried(placed.select(*keys, *told, "_sb"), keys, told, order_us, tie, n, fan, depth)
        context = context.select(*keys, "_sb", F.explode("_carry").alias("_row")).select(*keys, "_sb", *[F.col("_row")[c].alias(c) for c in told])
        own = own.unionByName(context.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_sb").orderBy(order_us, tie)
    out = own.withColumns({lag_name(c, k): F.lag(c, k).over(w) for k in range(1, n + 1) for c in cols})
    return out.where(F.col("_own")).drop("_sb", "_own")


def _carried(rows: DataFrame, keys: list[str], told: list[str], order_us: str, tie: str, n: int, fan: int, depth: int) -> DataFrame:
    """(keys, _sb, _carry): for every bucket of a key, the last n rows before it, the latest first."""
    checkpoint_root(rows.sparkSession)
    latest = Window.partitionBy(*keys, "_sb").orderBy(F.desc(order_us), F.desc(tie))
    # only n rows of a bucket leave a map task: the row number is limited before the shuffle
    tails = rows.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= n)
    ranked = F.array_sort(F.collect_list(F.struct("_r", F.struct(*told).alias("row"))))
    nodes = tails.groupBy(*keys, "_sb").agg(F.transform(ranked, lambda x: x["row"]).alias("_last"))
    ups = []
    for _ in range(depth):
        parts = F.array_sort(F.collect_list(F.struct("_sb", "_last")), lambda a, b: F.signum(a["_sb"] - b["_sb"]).cast("int"))
        up = nodes.groupBy(*keys, floor_div(F.col("_sb"), fan).alias("_up")).agg(parts.alias("_parts")).checkpoint()
        ups.append(up)
        nodes = up.select(*keys, F.col("_up").alias("_sb"), _latest(F.col("_parts"), n).alias("_last"))
    carry = nodes.select(*keys, "_sb", F.slice("_last", 1, 0).alias("_carry"))
    for up in reversed(ups):
        above = carry.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_sb").alias("_at"), "_carry")
        same = F.col("_up") == F.col("_at")
        for i, k in enumerate(keys):
            same = same & up[k].eqNullSafe(above[f"_k{i}"])
        held = up.join(above, same)
        child = F.transform("_parts", lambda p, i: F.struct(p["_sb"].alias("_sb"), F.slice(
            F.concat(_latest(F.slice("_parts", F.greatest(i - n, F.lit(0)) + 1, F.least(i, F.lit(n))), n), F.col("_carry")), 1, n).alias("_carry")))
        carry = held.select(*keys, F.explode(child).alias("_c")).select(*keys, "_c._sb", "_c._carry")
    return carry


def _latest(parts: Column, n: int) -> Column:
    """Last n rows, the latest first, of summaries in order of time."""
    return F.slice(F.flatten(F.reverse(F.transform(parts, lambda p: p["_last"]))), 1, n)


def near_lags(df: DataFrame, key, order_us: str, tie: str, cols, n: int, within_us: int,
              bucket_us: int = 0) -> DataFrame:
    """``df`` plus ``_lag{k}_{c}`` for rules that only look back less than ``within_us``.

    The order is cut into buckets of ``max(within_us, bucket_us)``; every row also stands, without the
    columns that are not needed, as context in the next bucket. One window over (key, bucket): a group holds
    two buckets of one key at most, however many rows the key has. A lag whose row is less than ``within_us``
    older is exact; an older one may be missing (NULL) or exact. One shuffle, no second pass.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(dict.fromkeys(cols))
    width = max(within_us, bucket_us)
    needed = {*keys, order_us, tie, *cols}
    bucket = floor_div(F.col(order_us), width)
    spread = df.withColumn("_sb", F.explode(F.array(bucket, bucket + 1))).withColumn("_own", F.col("_sb") == bucket)
    spread = spread.withColumns({c: F.when(F.col("_own"), F.col(c)) for c in df.columns if c not in needed})
    w = Window.partitionBy(*keys, "_sb").orderBy(order_us, tie)
    out = spread.withColumns({lag_name(c, k): F.lag(c, k).over(w) for k in range(1, n + 1) for c in cols})
    return out.where(F.col("_own")).drop("_sb", "_own")

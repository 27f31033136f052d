"""Broadcast only behind a measured size bound.

A side is broadcast when one aggregation over it proves its in-memory size
below the limit; otherwise it is left to the planner (sort-merge join with
AQE skew splitting, or AQE's runtime broadcast from measured shuffle sizes). Used only for dimension-scale inputs: the check is a
full pass over them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.session import checkpoint_root
from cardsentry.sources import files

_FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
          T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)

_SUFFIX = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
           "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"cannot read size {text!r}")
    return int(m.group(1)) * _SUFFIX.get(m.group(2).lower() or "b", 1)


DEFAULT_LIMIT = "10MB"


def broadcast_limit(df: DataFrame) -> int:
    """Size limit in bytes for a checked broadcast (-1 = never broadcast).

    ``spark.cardsentry.broadcastMaxBytes`` (default 10MB). Independent of
    ``spark.sql.autoBroadcastJoinThreshold``, which the session turns off so
    that the planner never broadcasts on file-size estimates.
    """
    spark = df.sparkSession
    return _bytes(spark.conf.get("spark.cardsentry.broadcastMaxBytes", None) or DEFAULT_LIMIT)


# Measured bounds, keyed by (application, plan, input files with length and
# modification time): a new or rewritten file changes the key, so a stale
# bound is never reused.
_MEASURED: dict[tuple, tuple[int, int, int]] = {}


def _key(df: DataFrame) -> tuple:
    """Application, plan, and each input folder with the number, total length and last modification of its files."""
    spark = df.sparkSession
    folders: dict[str, list[int]] = {}
    for path in df.inputFiles():
        stats = folders.setdefault(path.rsplit("/", 1)[0], [0, 0, 0])
        fs, p = files._fs(spark, path)
        status = fs.getFileStatus(p)
        stats[0] += 1
        stats[1] += int(status.getLen())
        stats[2] = max(stats[2], int(status.getModificationTime()))
    return (spark.sparkContext.applicationId, df.semanticHash(), tuple(sorted((k, *v) for k, v in folders.items())))


def size_bound(df: DataFrame) -> tuple[int, int]:
    """(rows, upper bound of the in-memory bytes as unsafe rows), in one pass."""
    return _measured(df)[:2]


def widest_row(df: DataFrame) -> int:
    """Upper bound of the bytes of any row (measured in the same pass)."""
    return _measured(df)[2]


def _measured(df: DataFrame) -> tuple[int, int, int]:
    key = _key(df)
    if key in _MEASURED:
        return _MEASURED[key]
    bound = _measure(df)
    if len(_MEASURED) > 4096:
        _MEASURED.clear()
    _MEASURED[key] = bound
    return bound


def _measure(df: DataFrame) -> tuple[int, int, int]:
    n_fields = len(df.schema.fields)
    var_exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _FIXED) or (isinstance(f.dataType, T.DecimalType)
                                               and f.dataType.precision <= 18):
            continue
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_exprs.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 7)
        else:  # nested / wide decimal: bound by its JSON text
            var_exprs.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))),
                                        F.lit(16)) + 16)
    width = (sum(var_exprs[1:], var_exprs[0]) if var_exprs else F.lit(0)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("v"), F.max(width).alias("w")).first()
    rows, var = int(row["n"]), int(row["v"] or 0)
    per_row = 8 * (n_fields + 1 + (n_fields // 64))
    return rows, rows * per_row + var, per_row + int(row["w"] or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Return ``broadcast(df)`` when its measured size is within the limit, else ``df``."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit < 0:
        return df
    _, size = size_bound(df)
    return F.broadcast(df) if size <= limit else df


def most_per_key(df: DataFrame, key: str) -> int:
    """The most rows that share a value of ``key`` (one aggregation, remembered like the size bounds)."""
    memo = ("most", key, *_key(df))
    if memo not in _MEASURED:
        _MEASURED[memo] = (int(df.groupBy(key).count().agg(F.max("count")).first()[0] or 0), 0, 0)
    return _MEASURED[memo][0]


def broadcast_if_bounded(df: DataFrame, inputs, keys=(), max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its ``inputs`` prove it small, without running ``df``.

    Its rows are at most those of the first input, times the most rows per join key (``keys``: key column, input) of
    the others; each is at most as wide as the widest rows of all inputs together.
    """
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit < 0:
        return df
    rows = size_bound(inputs[0])[0]
    for key, i in keys:
        rows *= most_per_key(i, key)
    return F.broadcast(df) if rows * sum(widest_row(i) for i in inputs) <= limit else df


HOT_ROWS = 1 << 16  # a key held by more rows is joined in several shares of about so many


def key_shares(rows: DataFrame, key: str, most: int | None = None) -> DataFrame | None:
    """(_key, _shares) of the keys that more than `most` rows hold, or None if there are none.

    Counted when this is called and kept by ``checkpoint()``; less than a row for every `most` rows of the table.
    """
    most = HOT_ROWS if most is None else most
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    checkpoint_root(rows.sparkSession)
    shares = counts.where(F.col("_n") > most).select("_key", F.ceil(F.col("_n") / most).cast("int").alias("_shares")).checkpoint()
    return None if shares.isEmpty() else shares


def join_in_shares(rows: DataFrame, dimension: DataFrame, key: str, dimension_key: str, shares: DataFrame | None) -> DataFrame:
    """Inner join of rows with a dimension; keys of `shares` (``key_shares``) are dealt by their rows' hash to as many tasks.

    The dimension's rows of these keys alone are repeated, one for each share. AQE splits by the compressed bytes of a
    shuffle partition, which for the alike rows of one key are a small part of what they hold in memory.
    """
    if shares is None:
        return rows.join(dimension, rows[key] == dimension[dimension_key])
    held = F.broadcast(shares) if broadcast_limit(rows) >= 0 else shares
    dealt = rows.join(held, rows[key] == held["_key"], "left")
    dealt = dealt.withColumn("_share", F.coalesce(F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.col("_shares")).cast("int"), F.lit(0))).drop("_key", "_shares")
    repeated = dimension.join(held, dimension[dimension_key] == held["_key"], "left")
    repeated = repeated.withColumn("_of", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares") - 1, F.lit(0))))).drop("_key", "_shares")
    return dealt.join(repeated, (dealt[key] == repeated[dimension_key]) & (dealt["_share"] == repeated["_of"])).drop("_share", "_of")

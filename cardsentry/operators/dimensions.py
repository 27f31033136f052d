"""Versioned dimensions with half-open validity [effective_from, effective_to).

* ``stamp``            D1/D2/D4: validity columns on a batch before it is written
                       (no UPDATE of stored rows; ``deleted_flg`` defaults to 0).
* ``history``          D5: version history from daily snapshots (window over each key's
                       snapshots: lag of the attributes -> change flag -> running
                       sum -> version; a key missing from a later snapshot gets a
                       deletion version with deleted_flg = 1).
* ``apply_snapshot``   D5, incremental: full outer join of the current versions with
                       one new snapshot.
* ``as_of``            D6: the version valid at each fact's time (equi-join on the key,
                       residual range condition; the dimension is broadcast only behind
                       a measured size bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.functions.constants import OPEN_END
from cardsentry.functions.timecols import ntz
from cardsentry.operators.sizing import broadcast_if_small



def _open() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    return ntz(v)


def stamp(df: DataFrame, effective_from, effective_to=None, deleted_flg: int = 0) -> DataFrame:
    """Add (or overwrite) effective_from / effective_to / deleted_flg on a batch."""
    eff_to = _open() if effective_to is None else _ts(effective_to)
    return df.withColumns({
        "effective_from": _ts(effective_from),
        "effective_to": eff_to,
        "deleted_flg": F.lit(int(deleted_flg)).cast("int"),
    })


def history(snapshots: DataFrame, key, attrs, load_col: str = "load_date") -> DataFrame:
    """Collapse daily snapshots into versions.

    Output: key cols, attrs, effective_from, effective_to, deleted_flg. The
    calendar of loads (distinct ``load_col``) decides whether a key was
    absent in between; it has one row per load day, so it is broadcast
    behind its size check.
    """
    keys = [key] if isinstance(key, str) else list(key)
    attrs = list(attrs)
    snap = snapshots.select(*keys, *attrs, F.col(load_col).alias("_ld")).distinct()

    cal_w = Window.orderBy("_ld")  # one row per load day: bounded by the calendar length
    cal = (snapshots.select(F.col(load_col).alias("_ld")).distinct()
           .withColumn("_prev_cal", F.lag("_ld").over(cal_w))
           .withColumn("_next_cal", F.lead("_ld").over(cal_w)))
    snap = snap.join(broadcast_if_small(cal), "_ld")

    kw = Window.partitionBy(*keys).orderBy("_ld")
    changed = F.lit(False)
    for a in attrs:                       # exact, NULL-safe comparison with the previous snapshot
        changed = changed | ~F.lag(a).over(kw).eqNullSafe(F.col(a))
    snap = (snap.withColumn("_new", (F.lag("_ld").over(kw).isNull()
                                     | (F.lag("_ld").over(kw) != F.col("_prev_cal"))
                                     | changed).cast("int"))
                .withColumn("_ver", F.sum("_new").over(kw.rowsBetween(Window.unboundedPreceding, 0))))

    # attributes are constant within a version, so they are grouping keys
    # (hash aggregation; no string aggregate buffers)
    vers = (snap.groupBy(*keys, "_ver", *attrs)
                .agg(F.min("_ld").alias("_from"), F.max("_ld").alias("_last"),
                     F.max_by("_next_cal", "_ld").alias("_after_last")))
    vw = Window.partitionBy(*keys).orderBy("_ver")
    vers = vers.withColumn("_next_from", F.lead("_from").over(vw))
    gone = F.col("_after_last").isNotNull() & (
        F.col("_next_from").isNull() | (F.col("_next_from") != F.col("_after_last")))
    vers = vers.withColumn("_deleted_at", F.when(gone, F.col("_after_last")))

    live = vers.select(*keys, *attrs,
                       F.col("_from").cast("timestamp_ntz").alias("effective_from"),
                       F.coalesce(F.col("_deleted_at").cast("timestamp_ntz"),
                                  F.col("_next_from").cast("timestamp_ntz"), _open()).alias("effective_to"),
                       F.lit(0).alias("deleted_flg"))
    dead = vers.where(F.col("_deleted_at").isNotNull()).select(
        *keys, *attrs,
        F.col("_deleted_at").cast("timestamp_ntz").alias("effective_from"),
        F.coalesce(F.col("_next_from").cast("timestamp_ntz"), _open()).alias("effective_to"),
        F.lit(1).alias("deleted_flg"))
    return live.unionByName(dead)


def apply_snapshot(current: DataFrame, snapshot: DataFrame, key, attrs, load_date) -> DataFrame:
    """One incremental SCD2 step: versions after loading ``snapshot`` on ``load_date``.

    ``current`` holds all versions (closed and open). Open versions
    (effective_to = open end) are compared with the snapshot by a full outer
    join on the key: unchanged -> kept; changed -> closed at load_date and a
    new version opened; missing -> closed and a deletion version opened;
    new key (or a deleted key coming back) -> opened.
    """
    keys = [key] if isinstance(key, str) else list(key)
    attrs = list(attrs)
    at = _ts(load_date)
    is_open = F.col("effective_to") == _open()
    closed = current.where(~is_open)
    open_ = current.where(is_open)

    o = open_.select(*keys, *[F.col(a).alias(f"_o_{a}") for a in attrs],
                     F.col("effective_from").alias("_o_from"), F.col("deleted_flg").alias("_o_del"),
                     F.lit(True).alias("_o"))
    s = snapshot.select(*keys, *[F.col(a).alias(f"_s_{a}") for a in attrs], F.lit(True).alias("_s"))
    j = o.join(s, keys, "full_outer")
    in_o, in_s = F.col("_o").isNotNull(), F.col("_s").isNotNull()
    was_live = in_o & (F.col("_o_del") == 0)
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(f"_o_{a}").eqNullSafe(F.col(f"_s_{a}"))

    keep_open = (in_o & in_s & was_live & same) | (in_o & ~in_s & ~was_live)
    close_old = in_o & ~keep_open
    open_new = in_s & ~(in_o & was_live & same)
    open_del = in_o & ~in_s & was_live

    def rows(cond, src, eff_from, eff_to, deleted):
        return j.where(cond).select(*keys, *[F.col(f"_{src}_{a}").alias(a) for a in attrs],
                                    eff_from.alias("effective_from"), eff_to.alias("effective_to"),
                                    F.lit(deleted).cast("int").alias("deleted_flg"))

    kept = j.where(keep_open).select(*keys, *[F.col(f"_o_{a}").alias(a) for a in attrs],
                                     F.col("_o_from").alias("effective_from"), _open().alias("effective_to"),
                                     F.col("_o_del").cast("int").alias("deleted_flg"))
    ended = j.where(close_old).select(*keys, *[F.col(f"_o_{a}").alias(a) for a in attrs],
                                      F.col("_o_from").alias("effective_from"), at.alias("effective_to"),
                                      F.col("_o_del").cast("int").alias("deleted_flg"))
    parts = [closed.select(*keys, *attrs, "effective_from", "effective_to",
                           F.col("deleted_flg").cast("int")),
             kept, ended,
             rows(open_new, "s", at, _open(), 0),
             rows(open_del, "o", at, _open(), 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def as_of(facts: DataFrame, versions: DataFrame, fact_key: str, dim_key: str, ts: str,
          columns=None, include_deleted: bool = False) -> DataFrame:
    """Attach the dimension version valid at ``facts[ts]`` (inner: facts without one drop)."""
    cols = list(columns) if columns is not None else [
        c for c in versions.columns if c not in (dim_key, "effective_from", "effective_to", "deleted_flg")]
    v = versions
    if not include_deleted and "deleted_flg" in v.columns:
        v = v.where(F.col("deleted_flg") == 0)
    v = v.select(F.col(dim_key).alias("_vk"), F.col("effective_from").alias("_vf"),
                 F.col("effective_to").alias("_vt"), *cols)
    v = broadcast_if_small(v)
    cond = ((facts[fact_key] == v["_vk"]) & (facts[ts] >= v["_vf"]) & (facts[ts] < v["_vt"]))
    return facts.join(v, cond).drop("_vk", "_vf", "_vt")

"""The five detections (R1A, R1B, R2, R3, R4) and the code-shaped R4b.

Every rule takes enriched operations (see ``enrich``) and returns rows of the
report mart: event_dt, passport, last_name, first_name, patronymic, phone,
event_type, report_dt.

``window``: None (all operations, as the reference's R1/R2), a day
('YYYY-MM-DD' / date) or a half-open (from, to) pair. ``lookback`` lets R3/R4
read operations before the window as context without reporting them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.functions.constants import (
    EVENT_CITIES, EVENT_CONTRACT, EVENT_LOCKED, EVENT_OVERDUE, EVENT_PROBING,
    RESULT_REJECT, RESULT_SUCCESS,
)
from cardsentry.functions.timecols import duration_us, epoch_us, ntz
from cardsentry.operators.enrich import blocked_from, with_city
from cardsentry.operators.sequence import floor_div as _floor_div
from cardsentry.operators.sequence import lag_name, near_lags
from cardsentry.operators.sizing import broadcast_if_small

TS = "transaction_date"


# ---------------------------------------------------------------- helpers --

def _as_dt(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def resolve_window(window) -> tuple[dt.datetime, dt.datetime] | None:
    """None | day | (from, to) -> half-open [from, to) as datetimes."""
    if window is None:
        return None
    if isinstance(window, (tuple, list)):
        lo, hi = window
        return _as_dt(lo), _as_dt(hi)
    lo = _as_dt(window)
    lo = dt.datetime(lo.year, lo.month, lo.day)
    return lo, lo + dt.timedelta(days=1)


def scope(df: DataFrame, window, lookback_us: int = 0, ts: str = TS) -> DataFrame:
    """Operations that a run over ``window`` may read (the window plus lookback)."""
    w = resolve_window(window)
    if w is None:
        return df
    lo, hi = w
    lo = lo - dt.timedelta(microseconds=lookback_us)
    return df.where((F.col(ts) >= ntz(lo)) & (F.col(ts) < ntz(hi)))


def in_window(window, ts: str | Column = TS) -> Column:
    w = resolve_window(window)
    c = F.col(ts) if isinstance(ts, str) else ts
    if w is None:
        return F.lit(True)
    return (c >= ntz(w[0])) & (c < ntz(w[1]))


def report_dt_col(report_dt) -> Column:
    if report_dt is None:
        return F.localtimestamp()          # run time, as the reference's datetime('now')
    if isinstance(report_dt, Column):
        return report_dt.cast("timestamp_ntz")
    return ntz(report_dt)


def report_rows(df: DataFrame, event_type, report_dt=None, event_col: str = TS,
                prefix: str = "") -> DataFrame:
    """Project to the mart row (``prefix`` selects lagged copies of the columns).

    Narrow operations (``enrich_narrow``) carry the client's id in place of the client's columns; so do their hits.
    """
    et = event_type if isinstance(event_type, Column) else F.lit(event_type)
    if "last_name" not in df.columns:
        return df.select(F.col(prefix + event_col).alias("event_dt"), F.col("client_id"), et.alias("event_type"),
                         report_dt_col(report_dt).alias("report_dt"))
    return df.select(
        F.col(prefix + event_col).alias("event_dt"),
        F.col(prefix + "passport_num").alias("passport"),
        F.col(prefix + "last_name").alias("last_name"),
        F.col(prefix + "first_name").alias("first_name"),
        F.col(prefix + "patronymic").alias("patronymic"),
        F.col(prefix + "phone").alias("phone"),
        et.alias("event_type"),
        report_dt_col(report_dt).alias("report_dt"),
    )


# ------------------------------------------------------------ R1A, R1B, R2 --

def _with_blocked_from(enriched: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    if "blocked_from" in enriched.columns and blacklist is None:
        return enriched
    if blacklist is None:
        raise ValueError("locked_passport needs a blacklist or enriched rows with blocked_from")
    bl = broadcast_if_small(blocked_from(blacklist))
    ev = enriched.drop("blocked_from") if "blocked_from" in enriched.columns else enriched
    return ev.join(bl, ev["passport_num"] == bl["passport"]).drop("passport")


def locked_passport(enriched: DataFrame, blacklist: DataFrame | None = None, window=None,
                    report_dt=None) -> DataFrame:
    """R1A: operation strictly after midnight of the passport's (first) block date."""
    ev = scope(_with_blocked_from(enriched, blacklist), window)
    hits = ev.where(F.col(TS) > F.col("blocked_from").cast("timestamp_ntz"))
    return report_rows(hits, EVENT_LOCKED, report_dt).distinct()


def overdue_passport(enriched: DataFrame, window=None, report_dt=None) -> DataFrame:
    """R1B: operation strictly after midnight of passport_valid_to (NULL never flagged)."""
    hits = scope(enriched, window).where(F.col(TS) > F.col("passport_valid_to").cast("timestamp_ntz"))
    return report_rows(hits, EVENT_OVERDUE, report_dt).distinct()


def invalid_contract(enriched: DataFrame, window=None, report_dt=None) -> DataFrame:
    """R2: operation strictly after midnight of the account's valid_to."""
    hits = scope(enriched, window).where(F.col(TS) > F.col("valid_to").cast("timestamp_ntz"))
    return report_rows(hits, EVENT_CONTRACT, report_dt).distinct()


def profile_rules(enriched: DataFrame, window=None, report_dt=None) -> DataFrame:
    """R1A + R1B + R2 in one pass over the operations (needs ``blocked_from``).

    Each operation yields one row per rule it breaks; the distinct of the
    reference is applied per rule (event_type is part of the row).
    """
    ts = F.col(TS)
    flags = F.array(
        F.when(ts > F.col("blocked_from").cast("timestamp_ntz"), F.lit(EVENT_LOCKED)),
        F.when(ts > F.col("passport_valid_to").cast("timestamp_ntz"), F.lit(EVENT_OVERDUE)),
        F.when(ts > F.col("valid_to").cast("timestamp_ntz"), F.lit(EVENT_CONTRACT)),
    )
    # explode + filter (not a higher-order filter) keeps the stage in whole-stage codegen
    ev = scope(enriched, window).withColumn("_rule", F.explode(flags)).where(F.col("_rule").isNotNull())
    return report_rows(ev, F.col("_rule"), report_dt).distinct()


# -------------------------------------------------------------------- R3 ----

def different_cities(enriched: DataFrame, terminals: DataFrame | None = None, window=None,
                     lookback=0, within="1 hour", key: str = "account", point_in_time: bool = True,
                     report_dt=None, day_horizon: bool = False) -> DataFrame:
    """An operation with another operation of the same ``key`` in another city
    strictly less than ``within`` away (both sides of a pair are reported).

    Plan (no self-join, no per-account task):
      1. bucket operations by (key, b = floor(us / L));
      2. summarise per (key, b, city): first and last time (map-side partial agg);
      3. copy each summary to buckets b-1, b, b+1;
      4. left-semi join operations to the summaries on (key, b) with
         ``city <> s_city AND s_max > us - L AND s_min < us + L``.
    Exact: partners lie in adjacent buckets, and within one bucket (width L)
    the span [s_min, s_max] is shorter than L, so some operation of that
    city lies in (us - L, us + L) iff the two bounds say so. The join is
    keyed by (key, hour), so AQE can split a hot account's hours.

    ``day_horizon``: only partners before the end of the operation's own day
    count (what a daily run sees; used by the accumulating mart).
    """
    L = duration_us(within)
    lb = duration_us(lookback)
    ev = enriched if terminals is None else with_city(enriched, terminals, point_in_time)
    ev = scope(ev.where(F.col("terminal_city").isNotNull()), window, lb)
    ev = ev.withColumn("_us", epoch_us(TS)).withColumn("_b", _floor_div(F.col("_us"), L))

    summ = (ev.groupBy(key, "_b", "terminal_city")
              .agg(F.min("_us").alias("_smin"), F.max("_us").alias("_smax"))
              .select(F.col(key).alias("_skey"), F.col("terminal_city").alias("_scity"),
                      "_smin", "_smax",
                      F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)).alias("_sb")))

    probe = ev.where(in_window(window)) if window is not None else ev
    horizon = F.col("_us") + F.lit(L)
    if day_horizon:
        horizon = F.least(horizon, epoch_us(F.date_add(F.to_date(TS), 1).cast("timestamp_ntz")))
    cond = ((probe[key] == summ["_skey"]) & (probe["_b"] == summ["_sb"])
            & (probe["terminal_city"] != summ["_scity"])
            & (summ["_smax"] > probe["_us"] - F.lit(L)) & (summ["_smin"] < horizon))
    hits = probe.join(summ, cond, "left_semi")
    return report_rows(hits, EVENT_CITIES, report_dt).distinct()


# -------------------------------------------------------------- R4, R4b ----

# Least bucket width of the lags; never less than the rule's own limit (see operators/sequence.py).
LAG_BUCKET = "1 minute"


def amount_probing(enriched: DataFrame, window=None, lookback=0, within="20 minutes",
                   min_ops: int = 4, key: str = "account", report_dt=None,
                   success: str = RESULT_SUCCESS, reject: str = RESULT_REJECT,
                   lag_bucket=LAG_BUCKET) -> DataFrame:
    """R4 (spec): ``min_ops`` consecutive operations of one ``key`` within ``within``,
    each smaller than the one before, all rejected except the last, which is
    successful; the last one is reported (no distinct, as the reference).

    Ordered per key by (time, transaction_id) -- a total order -- with exact
    lags from ``near_lags`` (a window group holds two time buckets of an account).
    """
    if min_ops < 2:
        raise ValueError("min_ops must be >= 2")
    L = duration_us(within)
    n = min_ops - 1
    ev = scope(enriched, window, duration_us(lookback)).withColumn("_us", epoch_us(TS))
    ev = near_lags(ev, key, "_us", "transaction_id", ["oper_result", "amount", "_us"], n, L,
                   duration_us(lag_bucket))
    r = lambda k: F.col(lag_name("oper_result", k))
    a = lambda k: F.col(lag_name("amount", k))
    conds = [F.col("oper_result") == F.lit(success), a(1) > F.col("amount"),
             F.col("_us") - F.col(lag_name("_us", n)) < F.lit(L)]
    conds += [r(k) == F.lit(reject) for k in range(1, n + 1)]
    conds += [a(k + 1) > a(k) for k in range(1, n)]
    if window is not None:
        conds.append(in_window(window))
    hits = ev.where(reduce(lambda x, y: x & y, conds))
    return report_rows(hits, EVENT_PROBING, report_dt)


_ROW_COLS = ["transaction_date", "passport_num", "last_name", "first_name", "patronymic", "phone"]


def amount_probing_three_step(enriched: DataFrame, window=None, lookback=0, within="20 minutes",
                              key: str = "account", report_dt=None, success: str = RESULT_SUCCESS,
                              lag_bucket=LAG_BUCKET) -> DataFrame:
    """R4b (the reference code's reading): three neighbouring operations with
    decreasing amounts, the third successful, the first and third less than
    ``within`` apart; the middle one is reported (results of the first two
    are not checked; no distinct).

    Detected on the third operation; the middle row's columns are lag 1.
    """
    L = duration_us(within)
    ev = scope(enriched, window, duration_us(lookback)).withColumn("_us", epoch_us(TS))
    ev = near_lags(ev, key, "_us", "transaction_id", ["amount", "_us"] + _ROW_COLS, 2, L,
                   duration_us(lag_bucket))
    cond = ((F.col("oper_result") == F.lit(success))
            & (F.col(lag_name("amount", 2)) > F.col(lag_name("amount", 1)))
            & (F.col(lag_name("amount", 1)) > F.col("amount"))
            & (F.col("_us") - F.col(lag_name("_us", 2)) < F.lit(L)))
    if window is not None:
        cond = cond & in_window(window, F.col(lag_name("transaction_date", 1)))
    hits = ev.where(cond)
    return report_rows(hits, EVENT_PROBING, report_dt, prefix="_lag1_")

"""The fraud report and the accumulating report mart.

``build_report`` is one report run (the reference's five detections in one
schema). ``daily_mart`` computes, in one distributed job, the report every
daily run would have produced for each day of the data (report_date = day
of the operation; R3/R4 see one rule window of the previous day and nothing
after the day's end). ``replace_days`` stores reports partitioned by
report_date with dynamic partition overwrite, so rebuilding a day replaces
it instead of duplicating it.
"""

from __future__ import annotations

import copy
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.functions.timecols import day_end, duration_us
from cardsentry.operators.enrich import attach_clients, client_shares, enrich_narrow, with_city
from cardsentry.operators.rules import (
    amount_probing, different_cities, profile_rules, resolve_window, scope,
)
from cardsentry.schemas import MART, REPORT_COLUMNS
from cardsentry.session import work_dir
from cardsentry.sources import files


def _enriched(tables, enriched: DataFrame | None) -> DataFrame:
    """The operations that all rules read: enriched narrowly and written once to the shared folder, so that
    a report scans and enriches them once, whatever the number of its branches."""
    if enriched is not None:
        return enriched
    narrow = enrich_narrow(tables.transactions, tables.cards, tables.accounts, tables.clients, blacklist=tables.blacklist)
    spark = narrow.sparkSession
    path = work_dir(spark, "operations")
    narrow.write.parquet(path)
    back = spark.read.schema(narrow.schema).parquet(path)
    back.scratch = path
    return back


def clear(report: DataFrame) -> None:
    """Deletes the operations that ``build_report`` or ``daily_mart`` has written for a report, once it is stored."""
    if getattr(report, "scratch", None):
        files.delete(report.sparkSession, report.scratch)


def _report(operations: DataFrame, profile: DataFrame, cities: DataFrame, probing: DataFrame, tables) -> DataFrame:
    """Hits of all rules on the operations as report rows. Narrow hits get their client's columns here; rows that are then equal
    stay one row for the rules that report distinct rows."""
    if "client_id" not in profile.columns:
        return reduce(DataFrame.unionByName, [profile, cities, probing]).select(*REPORT_COLUMNS)
    shares = client_shares(operations, tables.clients)
    once = attach_clients(profile.unionByName(cities), tables.clients, shares).select(*REPORT_COLUMNS).distinct()
    return once.unionByName(attach_clients(probing, tables.clients, shares).select(*REPORT_COLUMNS))


def build_report(tables, report_dt=None, window=None, cities_within="1 hour",
                 probing_within="20 minutes", lookback: bool | None = None,
                 point_in_time: bool = True, enriched: DataFrame | None = None) -> DataFrame:
    """Union of R1A, R1B, R2, R3, R4 for one run.

    ``window=None`` reproduces the reference's unbounded R1/R2 (and R3/R4
    over all data); with a window each rule reports only the window's
    operations and, when ``lookback`` (default: on with a window), R3/R4
    read one rule window before it as context.
    """
    use_lb = (window is not None) if lookback is None else lookback
    lb = max(duration_us(cities_within), duration_us(probing_within))
    if window is not None and enriched is None:
        tables = copy.copy(tables)
        tables.transactions = scope(tables.transactions, window, lookback_us=lb if use_lb else 0)
    ev = _enriched(tables, enriched)
    cities = with_city(ev, tables.terminals, point_in_time)
    out = _report(
        ev, profile_rules(ev, window, report_dt),
        different_cities(cities, None, window, cities_within if use_lb else 0,
                         within=cities_within, report_dt=report_dt),
        amount_probing(ev, window, probing_within if use_lb else 0, within=probing_within,
                       report_dt=report_dt), tables)
    out.scratch = getattr(ev, "scratch", None)
    return out


def daily_mart(tables, report_dt: Column | str | None = None, cities_within="1 hour",
               probing_within="20 minutes", enriched: DataFrame | None = None,
               window=None) -> DataFrame:
    """Every day's report at once (rows carry ``report_date``).

    ``report_dt`` defaults to the end of the reported day. ``window``
    restricts the reported days (operations before it are read only as the
    R3/R4 lookback).
    """
    if window is not None and enriched is None:
        tables = copy.copy(tables)
        tables.transactions = scope(tables.transactions, window, lookback_us=max(duration_us(cities_within), duration_us(probing_within)))
    ev = _enriched(tables, enriched)
    scratch = getattr(ev, "scratch", None)
    if window is not None:
        ev = scope(ev, window, lookback_us=max(duration_us(cities_within), duration_us(probing_within)))
    rdt = day_end("transaction_date") if report_dt is None else report_dt
    cities = with_city(ev, tables.terminals, True)
    out = _report(
        ev, profile_rules(ev, window, rdt),
        different_cities(cities, None, window, cities_within, within=cities_within, report_dt=rdt,
                         day_horizon=True),
        amount_probing(ev, window, probing_within, within=probing_within, report_dt=rdt), tables)
    out = out.withColumn("report_date", F.to_date("event_dt"))
    out.scratch = scratch
    return out


def replace_days(report: DataFrame, mart_dir: str, days) -> None:
    """Make ``report`` the mart's content for ``days``: staged, then swapped in day by day; a day
    without rows loses its earlier partition."""
    spark, root = report.sparkSession, mart_dir.rstrip("/")
    staged = f"{root}_stage-{uuid.uuid4().hex[:12]}"
    report.hint("rebalance", "report_date").write.partitionBy("report_date").parquet(staged)
    files.mkdirs(spark, root)
    for day in days:
        part = f"report_date={day.isoformat()}"
        files.delete(spark, f"{root}/{part}")
        if files.exists(spark, f"{staged}/{part}") and not files.rename(spark, f"{staged}/{part}", f"{root}/{part}"):
            raise OSError(f"cannot move {part} into {root}")
    files.delete(spark, staged)


def run_daily_report(tables, day, mart_dir: str, report_dt=None, **kw) -> None:
    """One daily run: report for ``day`` written into the mart (idempotent).

    Only the day's operations and their lookback are enriched, and that once.
    """
    lo, _ = resolve_window(day)
    day_tables = copy.copy(tables)
    day_tables.transactions = scope(tables.transactions, day, lookback_us=max_lookback(kw))
    rep = build_report(day_tables, report_dt=report_dt, window=day, **kw)
    replace_days(rep.withColumn("report_date", F.lit(lo.date())), mart_dir, [lo.date()])
    clear(rep)


def max_lookback(kw) -> int:
    return max(duration_us(kw.get("cities_within", "1 hour")),
               duration_us(kw.get("probing_within", "20 minutes")))


def read_mart(spark, mart_dir: str, report_date=None) -> DataFrame:
    """The mart, by its declared schema (empty before the first report)."""
    df = spark.read.schema(MART).parquet(mart_dir) if files.exists(spark, mart_dir) else spark.createDataFrame([], MART)
    if report_date is not None:
        df = df.where(F.col("report_date") == F.lit(str(report_date)).cast("date"))
    return df

"""The daily pipeline: drops -> tables -> versioned terminals -> report mart.

One call processes every drop file not yet loaded (a normal day: the day's
three files; after an outage: all pending days at once, in the same jobs),
then rebuilds the report of every affected day. What is to be done comes from
stored state, never from what this call happened to load: files loaded and not
yet reported (ledger against its ``_reported`` table), and snapshots newer
than those that the stored terminal versions include. A run that dies at any
point is finished by the next one.

Days to rebuild and partitions to read come from the operation times that the
ledger holds for every file, so an operation dated before or after its file's
day is reported on its own day. New sheets rebuild only the days on which an
operation is judged otherwise than when the mart was built (plans/changes.py).

Layout under one root folder (shared storage):
  drop/                 incoming transactions_*.txt, passport_blacklist_*.xlsx, terminals_*.xlsx
  archive/              loaded files, renamed <name>.backup
  seed/{cards,accounts,clients}
  transactions/         partitioned by load_date, src_file
  quarantine/           malformed transaction lines
  blacklist/            partitioned by load_date, src_file
  terminal_snapshots/   partitioned by load_date, src_file
  sheet_quarantine/     unknown sheets, unreadable rows, broken workbooks
  terminals/            terminal versions, closed and open ones apart (sources/version_store.py)
  mart/                 report rows partitioned by report_date
  mart_dims/            block dates and terminal versions that the mart was built with
  ledger/<kind>/        processed-files ledgers
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.operators import dimensions
from cardsentry.plans import changes
from cardsentry.plans import report as plan
from cardsentry.session import checkpoint_root
from cardsentry.sources import excel, files, seed
from cardsentry.sources import transactions as tx
from cardsentry.sources.ledger import Ledger, ingest_new
from cardsentry.sources.version_store import VersionStore

BLACKLIST_PATTERN = "passport_blacklist_*.xlsx"
TERMINALS_PATTERN = "terminals_*.xlsx"


@dataclass(frozen=True)
class Layout:
    root: str

    def __getattr__(self, name):
        if name in ("drop", "archive", "seed", "transactions", "quarantine", "blacklist",
                    "terminal_snapshots", "sheet_quarantine", "terminals", "mart", "mart_dims"):
            return f"{self.root.rstrip('/')}/{name}"
        raise AttributeError(name)

    def ledger(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/ledger/{kind}"


@dataclass
class Tables:
    transactions: DataFrame
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    blacklist: DataFrame
    terminals: DataFrame


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def version_store(spark: SparkSession, layout: Layout) -> VersionStore:
    return VersionStore(spark, layout.terminals, schemas.VERSIONS)


def rebuild_terminals(spark: SparkSession, layout: Layout) -> DataFrame:
    """Terminal versions from all loaded snapshots (first load; late, corrected or out-of-order snapshot files)."""
    return dimensions.history(snapshots(spark, layout), "terminal_id", ["terminal_city"])


def update_terminals(spark: SparkSession, layout: Layout, new_days: list[dt.date]) -> tuple[DataFrame, DataFrame]:
    """(closed, open) versions after snapshot days that follow every day the store includes: per day one incremental
    SCD2 step, a full outer join of the open versions with that day's snapshot. Only versions that these steps close
    are among the closed ones; those closed before are not read."""
    snaps, current, closed = snapshots(spark, layout), version_store(spark, layout).open(), []
    is_open = F.col("effective_to") == dimensions._open()
    for day in sorted(set(new_days)):
        snap = snaps.where(F.col("load_date") == F.lit(day.isoformat()).cast("date"))
        step = dimensions.apply_snapshot(current, snap.select("terminal_id", "terminal_city").distinct(),
                                         "terminal_id", ["terminal_city"], day.isoformat())
        step = step.checkpoint(eager=True)          # cut lineage per applied day
        closed.append(step.where(~is_open))
        current = step.where(is_open)
    return functools.reduce(DataFrame.unionByName, closed), current


def snapshots(spark: SparkSession, layout: Layout) -> DataFrame:
    return _stored(spark, layout.terminal_snapshots, schemas.SNAPSHOTS)


def refresh_terminals(spark: SparkSession, layout: Layout) -> None:
    """Brings the stored versions up to the loaded snapshots, if any are newer than the state says."""
    store = version_store(spark, layout)
    state, loads = store.state(), Ledger(spark, layout.ledger("sheets")).table()
    new = loads.where(F.col("loaded_at") > F.lit(state["applied_at"])) if state else loads
    # a corrected workbook may have lost its terminals sheet: loads of files that ever had one count
    ever = loads.where(F.col("tables").contains("terminals")).select("file_name").distinct()
    days = new.join(ever, "file_name", "left_semi").groupBy("business_date").agg(F.max("loaded_at").alias("at")).collect()
    days = {r["business_date"]: r["at"] for r in days if r["business_date"] is not None}
    if not days:
        return
    through, applied_at = max([*days, *([state["through"]] if state else [])]), max(days.values())
    if state and min(days) > state["through"]:
        store.advance(*update_terminals(spark, layout, list(days)), through, applied_at)
    else:
        store.rebuild(rebuild_terminals(spark, layout), F.col("effective_to") == dimensions._open(), through, applied_at)


def load_sheets(spark: SparkSession, layout: Layout, force: bool = False) -> list[str]:
    """Loads pending xlsx drops and brings the terminal versions up to them; returns the files loaded."""
    checkpoint_root(spark)
    names = ingest_new(spark, layout.drop, [BLACKLIST_PATTERN, TERMINALS_PATTERN], layout.ledger("sheets"),
                       lambda p: excel.load_files(spark, p, layout.blacklist, layout.terminal_snapshots, layout.sheet_quarantine),
                       archive_dir=layout.archive, force=force)
    refresh_terminals(spark, layout)
    return names


def tables(spark: SparkSession, layout: Layout, load_days: tuple | None = None) -> Tables:
    """The pipeline's tables, by their declared schemas; ``load_days=(first, last)`` prunes the transactions
    to those load_date partitions (the files of those business days)."""
    s = seed.read_seed(spark, layout.seed)
    bl = _stored(spark, layout.blacklist, schemas.LOADED_BLACKLIST).select("date", "passport")
    term = version_store(spark, layout).read().where(F.col("deleted_flg") == 0)
    trx = tx.read_table(spark, layout.transactions)
    if load_days is not None:
        trx = trx.where(F.col("load_date").between(F.lit(load_days[0].isoformat()).cast("date"),
                                                   F.lit(load_days[1].isoformat()).cast("date")))
    return Tables(transactions=trx, cards=s["cards"],
                  accounts=s["accounts"], clients=s["clients"], blacklist=bl, terminals=term)


def _day(v: dt.datetime) -> dt.date:
    return v.date() if isinstance(v, dt.datetime) else v


def run(spark: SparkSession, layout: Layout, report_dt=None, force: bool = False) -> list[dt.date]:
    """Load pending drops and rebuild the affected report days; returns those days."""
    checkpoint_root(spark)
    arch = layout.archive
    ops, sheets = Ledger(spark, layout.ledger("transactions")), Ledger(spark, layout.ledger("sheets"))
    tx.ingest(spark, layout.drop, layout.transactions, layout.quarantine, ops.path, archive_dir=arch, force=force)
    load_sheets(spark, layout, force)

    # loads without a report; their number is bounded by the files of the run
    new_ops, new_sheets = ops.pending().collect(), sheets.pending().collect()
    if not new_ops and not new_sheets:
        return []
    all_ops = ops.table()
    last = _day(all_ops.agg(F.max(F.coalesce("last_op", F.col("business_date").cast("timestamp_ntz")))).first()[0])
    names = [r["file_name"] for r in new_ops]
    # days of the operations of pending files, also of what they held before they were corrected
    span = all_ops.where(F.col("file_name").isin(names)).agg(F.min("first_op"), F.max("last_op")).first() if names else (None, None)
    dims_known = changes.known(spark, layout.mart_dims)
    touched: set[dt.date] = set()
    lookback = dt.timedelta(microseconds=plan.max_lookback({}))
    if new_sheets and dims_known:
        touched = changes.touched_days(spark, layout.mart_dims, tables(spark, layout), lookback)
    # without that knowledge a blacklist or terminal file may change its day and every later one
    sheet_days = [] if dims_known else [r["business_date"] for r in new_sheets]
    starts = [_day(d) for d in [span[0], *(r["business_date"] for r in new_ops), *sheet_days] if d is not None]
    days = set(touched)
    if starts:
        lo, hi = min(starts), max(starts)
        if span[1] is not None:     # the lookback of the next day's rules reaches into the last day
            hi = max(hi, min(_day(span[1]) + dt.timedelta(days=1), last or hi))
        if sheet_days and last is not None:
            hi = max(hi, last)
        days |= {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)}
    if days:
        days = sorted(days)
        window = (dt.datetime.combine(days[0], dt.time()), dt.datetime.combine(days[-1] + dt.timedelta(days=1), dt.time()))
        # the load days of all files with operations in the window or its lookback
        held = ops.latest().where((F.col("last_op") >= F.lit(window[0] - lookback)) & (F.col("first_op") < F.lit(window[1])))
        load_days = held.agg(F.min("business_date"), F.max("business_date")).first()
        t = tables(spark, layout, tuple(load_days) if load_days[0] is not None else None)
        t.transactions = changes.of_days(t.transactions, days, lookback)
        mart = plan.daily_mart(t, report_dt=report_dt, window=window)
        plan.replace_days(mart.where(F.col("report_date").isin([F.lit(d.isoformat()).cast("date") for d in days])), layout.mart, days)
        plan.clear(mart)
    if new_sheets or not dims_known:
        changes.store(spark, layout.mart_dims, tables(spark, layout))
    ops.mark_reported(new_ops)
    sheets.mark_reported(new_sheets)
    return list(days)

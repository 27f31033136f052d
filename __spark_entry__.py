"""

Queries run on proxy tables derived from the driver's `events`, `customer`
and `nation` (see tools/proxy.py and FIXTURES.md §2). The
oracle SQL (oracle_sql.py) re-derives the same proxies in DuckDB and states
each query in an independent form.
"""

from __future__ import annotations

import dataclasses
import datetime
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_sql as _oracle
from cardsentry import schemas
from cardsentry.functions.timecols import epoch_us
from cardsentry.operators import dimensions, rules, sequence
from cardsentry.operators.enrich import PROFILE_COLUMNS, TX_COLUMNS, card_profile, enrich, enrich_narrow, with_city, with_city_chunked
from cardsentry.plans import adhoc, daily
from cardsentry.plans import report as plan
from cardsentry.session import apply_required, work_dir
from cardsentry.sources import card_store, excel, files, seed
from cardsentry.sources import transactions as tx_files
from cardsentry.streaming import arrivals, file_ingest
from cardsentry.streaming import rules as stream_rules
from tools import fixtures, proxy

try:  # the training-data operators are optional: the rest works without them
    import corpus_pipeline as _corpus
    from cardsentry.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "cardsentry.llm", "cardsentry.llm.queries"):
        raise
    _corpus = _llm = None

REPORT_DT = _oracle.REPORT_DT
H72 = "72 hours"


_PROXIES: dict = {}


def _tables(spark: SparkSession, sf_dir: str) -> proxy.Tables:
    """Proxy tables of ``sf_dir`` (lazy plans: built once per session, read at execution)."""
    apply_required(spark)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _PROXIES:
        _PROXIES[key] = proxy.load(spark, sf_dir)
    return dataclasses.replace(_PROXIES[key])


def _enriched(spark, sf_dir, with_blacklist=False):
    t = _tables(spark, sf_dir)
    return t, enrich(t.transactions, t.cards, t.accounts, t.clients,
                     blacklist=t.blacklist if with_blacklist else None)


def q_enriched_transactions(spark, sf_dir):
    return _enriched(spark, sf_dir)[1]


def q_locked_passport(spark, sf_dir):
    t, ev = _enriched(spark, sf_dir)
    return rules.locked_passport(ev, t.blacklist, report_dt=REPORT_DT)


def q_overdue_passport(spark, sf_dir):
    return rules.overdue_passport(_enriched(spark, sf_dir)[1], report_dt=REPORT_DT)


def q_invalid_contract(spark, sf_dir):
    return rules.invalid_contract(_enriched(spark, sf_dir)[1], report_dt=REPORT_DT)


def q_point_in_time_city(spark, sf_dir):
    t = _tables(spark, sf_dir)
    tx = t.transactions.select("transaction_id", "transaction_date", "terminal")
    return with_city(tx, t.terminals, point_in_time=True)


def q_point_in_time_city_many_versions(spark, sf_dir):
    """Cities when one terminal has a tenth of all operations and a new version every five minutes."""
    t = _tables(spark, sf_dir)
    hot = F.col("transaction_id").cast("long") % 10 == 0
    tx = t.transactions.select("transaction_id", "transaction_date", F.when(hot, F.lit("hot")).otherwise(F.col("terminal")).alias("terminal"))
    first, last = proxy.event_days(spark, sf_dir)
    from_, to = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (first, last + datetime.timedelta(days=1)))
    five = F.expr("INTERVAL '5' MINUTE")
    # a version names the nation whose key is its number's remainder
    starts = F.filter(F.sequence(from_, to, five), lambda x, i: i % 25 == F.col("n_nationkey"))
    versions = proxy._read(spark, sf_dir, "nation").select(F.lit("hot").alias("terminal_id"), F.col("n_name").alias("terminal_city"), F.explode(starts).alias("effective_from"))
    versions = versions.withColumn("effective_to", F.col("effective_from") + five)
    return with_city_chunked(tx, t.terminals.unionByName(versions))


def q_different_cities(spark, sf_dir):
    t, ev = _enriched(spark, sf_dir)
    return rules.different_cities(ev, t.terminals, report_dt=REPORT_DT)


def q_different_cities_all_versions(spark, sf_dir):
    t, ev = _enriched(spark, sf_dir)
    return rules.different_cities(ev, t.terminals, point_in_time=False, report_dt=REPORT_DT)


def q_amount_probing(spark, sf_dir):
    return rules.amount_probing(_enriched(spark, sf_dir)[1], within=H72, report_dt=REPORT_DT)


def q_amount_probing_three_step(spark, sf_dir):
    return rules.amount_probing_three_step(_enriched(spark, sf_dir)[1], within=H72,
                                           report_dt=REPORT_DT)


def q_fraud_report(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return plan.build_report(t, report_dt=REPORT_DT)


def _hot_tables(spark, sf_dir):
    """The proxy tables when one card holds a third of all operations."""
    t = _tables(spark, sf_dir)
    hot = F.col("transaction_id").cast("long") % 3 == 0
    t.transactions = t.transactions.withColumn(
        "card_num", F.when(hot, F.lit(_oracle.HOT_CARD)).otherwise(F.col("card_num")))
    return t


def q_fraud_report_hot_account(spark, sf_dir):
    """The flagship report when one account holds a third of all operations."""
    return plan.build_report(_hot_tables(spark, sf_dir), report_dt=REPORT_DT)


def q_enriched_transactions_bucketed(spark, sf_dir):
    """J1-J3 over operations and profiles stored in buckets of the card, one card with a third of all operations."""
    t = _hot_tables(spark, sf_dir)
    folder = work_dir(spark, "card-store")
    store = card_store.CardStore(f"card_store_{folder.rsplit('-', 1)[-1]}", folder)
    store.write(t.transactions, card_profile(t.cards, t.accounts, t.clients), buckets=16)
    return store.enriched(spark, TX_COLUMNS + PROFILE_COLUMNS)


def q_operation_lags(spark, sf_dir):
    """Time, amount and result of an account's last three operations, however old; one account has a third of all."""
    t = _hot_tables(spark, sf_dir)
    ops = enrich_narrow(t.transactions, t.cards, t.accounts, t.clients).select("transaction_id", "account", "transaction_date", "amount", "oper_result")
    ops = ops.withColumn("_us", epoch_us(F.col("transaction_date")))
    cols = ["transaction_date", "amount", "oper_result"]
    out = sequence.sequence_lags(ops, "account", "_us", "transaction_id", cols, 3, bucket_us=3_600_000_000)
    return out.drop("_us").withColumnsRenamed({sequence.lag_name(c, k): f"{c}_{k}" for c in cols for k in (1, 2, 3)})


def q_fraud_report_day(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return plan.build_report(t, report_dt=REPORT_DT, window=_oracle.DAY_REPORT_DATE)


def q_daily_mart(spark, sf_dir):
    return plan.daily_mart(_tables(spark, sf_dir))


def q_fraud_report_probing(spark, sf_dir):
    """The report with amount probing within 72 hours, a span at which the given data has chains."""
    return plan.build_report(_tables(spark, sf_dir), report_dt=REPORT_DT, probing_within=H72)


def q_daily_mart_probing(spark, sf_dir):
    return plan.daily_mart(_tables(spark, sf_dir), probing_within=H72)


# ------------------------------------------------- sources and dimensions --

def _tx_out(df):
    return df.select(*tx_files.TRANSACTION_FIELDS, "load_date")


def q_ingest_transactions(spark, sf_dir):
    """Proxy operations written as daily ';' drops (odd ids with a decimal comma),
    loaded by the batch ingest with ledger and archive, read back."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "ingest-transactions")
    comma = F.col("transaction_id").cast("long") % 2 == 1
    fixtures.write_lines(spark, fixtures.to_lines(t.transactions, comma_amount=comma), f"{root}/drop")
    kw = dict(table_dir=f"{root}/transactions", quarantine_dir=f"{root}/quarantine",
              ledger_dir=f"{root}/ledger", archive_dir=f"{root}/archive")
    tx_files.ingest(spark, f"{root}/drop", **kw)
    return _tx_out(tx_files.read_table(spark, kw["table_dir"]))


def q_ingest_idempotent(spark, sf_dir):
    """Streaming ingest (availableNow) run, the same files delivered again, run
    again; then the batch path over the same drop into the same table."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "ingest-idempotent")
    drop = f"{root}/drop"
    lines = fixtures.to_lines(t.transactions)
    fixtures.write_lines(spark, lines, drop)
    kw = dict(table_dir=f"{root}/transactions", quarantine_dir=f"{root}/quarantine",
              checkpoint_dir=f"{root}/stream-checkpoint")
    file_ingest.run_available(spark, drop, **kw)
    fixtures.write_lines(spark, lines, drop)          # same names delivered again
    file_ingest.run_available(spark, drop, **kw)
    tx_files.ingest(spark, drop, kw["table_dir"], kw["quarantine_dir"], f"{root}/ledger")
    tx_files.ingest(spark, drop, kw["table_dir"], kw["quarantine_dir"], f"{root}/ledger")
    return _tx_out(tx_files.read_table(spark, kw["table_dir"]))


def q_quarantine_bad_lines(spark, sf_dir):
    """Operations of type 'error' written with six fields; they land in quarantine."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "quarantine")
    bad = F.col("oper_type") == "error"
    fixtures.write_lines(spark, fixtures.to_lines(t.transactions, drop_terminal=bad), f"{root}/drop")
    tx_files.ingest(spark, f"{root}/drop", f"{root}/transactions", f"{root}/quarantine", f"{root}/ledger")
    q = tx_files.read_quarantine(spark, f"{root}/quarantine")
    return q.select("transaction_id", "business_date", "n_fields", "reason")


def _excel_day(col):
    return F.date_format(col, "ddMMyyyy")


def q_ingest_excel_blacklist(spark, sf_dir):
    """Blacklist proxy as daily xlsx files (dates as Excel serials), read back by the S3 job."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "excel-blacklist")
    rows = t.blacklist.select(F.datediff("date", F.lit("1899-12-30").cast("date")).alias("date"),
                              "passport", _excel_day("date").alias("_day"))
    fixtures.write_workbooks(rows, f"{root}/drop", "passport_blacklist", "blacklist")
    return excel.blacklist_rows(excel.read_cells(spark, f"{root}/drop")).drop("src_file")


def _snapshots(spark, sf_dir):
    t = _tables(spark, sf_dir)
    d0, d1 = proxy.event_days(spark, sf_dir)
    return proxy.terminal_snapshots(t.terminals, d0, d1)


def q_ingest_excel_terminals(spark, sf_dir):
    """Daily terminal lists as xlsx files, read back by the S3 job."""
    root = work_dir(spark, "excel-terminals")
    snap = _snapshots(spark, sf_dir)
    fixtures.write_workbooks(snap.withColumn("_day", _excel_day("load_date")).drop("load_date"),
                     f"{root}/drop", "terminals", "terminals")
    return excel.terminal_rows(excel.read_cells(spark, f"{root}/drop")).drop("extra", "src_file")


def q_stamp_snapshot(spark, sf_dir):
    t = _tables(spark, sf_dir)
    day = F.col("transaction_date")
    return dimensions.stamp(t.transactions, F.to_date(day), F.date_add(F.to_date(day), 1))


def q_terminal_history(spark, sf_dir):
    """Version history (D5) collapsed from daily terminal snapshots."""
    return dimensions.history(_snapshots(spark, sf_dir), "terminal_id", ["terminal_city"])


def _sheet_drops(spark, sf_dir, layout):
    """Workbooks with a terminals, a blacklist and an unknown sheet; dates as serials, dd.MM.yyyy and unreadable."""
    t = _tables(spark, sf_dir)
    key = F.substring("passport", 2, 20).cast("long")
    serial = F.datediff("date", F.lit("1899-12-30").cast("date")).cast("string")
    cell = F.when(key % 10 == 1, "soon").when(key % 2 == 0, F.date_format("date", "dd.MM.yyyy")).otherwise(serial)
    none = F.lit(None).cast("string")
    black = t.blacklist.select(F.lit("blacklist").alias("_sheet"), _excel_day("date").alias("_day"), cell.alias("date"), "passport",
                               none.alias("terminal_id"), none.alias("terminal_city"), none.alias("note"))
    snap = _snapshots(spark, sf_dir).withColumn("_day", _excel_day("load_date"))
    term = snap.select(F.lit("terminals").alias("_sheet"), "_day", none.alias("date"), none.alias("passport"), "terminal_id", "terminal_city", none.alias("note"))
    notes = snap.where(F.col("terminal_id").cast("int") % 25 == 0).select(
        F.lit("notes").alias("_sheet"), "_day", none.alias("date"), none.alias("passport"), none.alias("terminal_id"), none.alias("terminal_city"),
        F.col("terminal_id").alias("note"))
    fixtures.write_workbooks(black.unionByName(term).unionByName(notes).repartition("_day"), layout.drop, "terminals")


def _sheet_rows(spark, layout):
    """Rows of the tables that sheets feed, and of their quarantine."""
    bl = daily._stored(spark, layout.blacklist, schemas.LOADED_BLACKLIST)
    sn = daily.snapshots(spark, layout)
    qu = daily._stored(spark, layout.sheet_quarantine, schemas.SHEET_QUARANTINE)
    return (bl.select(F.lit("blacklist").alias("table_name"), F.col("passport").alias("a"), F.col("date").cast("string").alias("b"), "load_date")
            .unionByName(sn.select(F.lit("terminals").alias("table_name"), F.col("terminal_id").alias("a"), F.col("terminal_city").alias("b"), "load_date"))
            .unionByName(qu.select(F.lit("quarantine").alias("table_name"), F.col("reason").alias("a"), F.col("sheet").alias("b"), "load_date")))


def q_ingest_excel_stream(spark, sf_dir):
    """Workbooks of several sheets and a broken one through the xlsx stream, with ledger and archive; the stream runs
    twice, and the batch path finds nothing left to load."""
    layout = daily.Layout(work_dir(spark, "excel-stream"))
    _sheet_drops(spark, sf_dir, layout)
    first, _ = proxy.event_days(spark, sf_dir)
    files.write_bytes(spark, f"{layout.drop}/terminals_{first:%d%m%Y}-broken.xlsx", b"not a workbook")
    for _ in range(2):
        stream_rules.finish(file_ingest.start_excel(spark, layout.drop, layout.blacklist, layout.terminal_snapshots, layout.sheet_quarantine,
                                                    layout.ledger("sheets"), f"{layout.root}/checkpoint", archive_dir=layout.archive))
    daily.load_sheets(spark, layout)
    return _sheet_rows(spark, layout)


def q_ingest_excel_sheets(spark, sf_dir):
    """Workbooks with a terminals, a blacklist and an unknown sheet, loaded by the batch path."""
    layout = daily.Layout(work_dir(spark, "excel-sheets"))
    _sheet_drops(spark, sf_dir, layout)
    daily.load_sheets(spark, layout)
    return _sheet_rows(spark, layout)


def q_terminal_history_incremental(spark, sf_dir):
    """D5 as daily runs build it: a first load of many snapshot days, then the last days one by one; some
    terminals vanish for two of these days and return."""
    layout = daily.Layout(work_dir(spark, "terminal-history"))
    d0, _ = proxy.event_days(spark, sf_dir)
    day = F.datediff("load_date", F.lit(d0))
    snap = _snapshots(spark, sf_dir).where(~((F.col("terminal_id").cast("int") % 7 == 3) & day.isin(26, 27)))
    for part in (day < 25, day >= 25):
        fixtures.write_workbooks(snap.where(part).withColumn("_day", _excel_day("load_date")).drop("load_date"), layout.drop, "terminals", "terminals")
        daily.load_sheets(spark, layout)
    return daily.version_store(spark, layout).read()


def q_seed_load(spark, sf_dir):
    """The client seed from delimited text with all columns, loaded twice and stamped."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "seed")
    key = F.col("client_id").cast("long")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (key % 9000).cast("int"))
    given = t.clients.withColumns({"date_of_birth": born, "create_dt": F.lit("1900-01-01").cast("date"),
                                   "update_dt": F.when(key % 3 == 0, F.lit("2024-01-02").cast("date"))})
    given.select("update_dt", *given.columns[:-1]).write.option("header", True).csv(f"{root}/from/clients.csv")
    for _ in range(2):
        seed.load_csv(spark, f"{root}/from", f"{root}/seed")
    return spark.read.schema(schemas.SEED_STORED["clients"]).parquet(f"{root}/seed/clients")


def q_seed_tables(spark, sf_dir):
    """Card and account seeds from delimited text, loaded twice and stamped."""
    t = _tables(spark, sf_dir)
    root = work_dir(spark, "seed-tables")
    dated = {"create_dt": F.lit("1900-01-01").cast("date"), "update_dt": F.lit(None).cast("date")}
    for name in ("cards", "accounts"):
        getattr(t, name).withColumns(dated).write.option("header", True).csv(f"{root}/from/{name}.csv")
    for _ in range(2):
        seed.load_csv(spark, f"{root}/from", f"{root}/seed")
    cards, accounts = (spark.read.schema(schemas.SEED_STORED[n]).parquet(f"{root}/seed/{n}") for n in ("cards", "accounts"))
    stamps = ["create_dt", "update_dt", "effective_from", "effective_to", "deleted_flg"]
    return (cards.select(F.lit("cards").alias("table_name"), F.col("card_num").alias("key"), F.col("account").alias("ref"), F.lit(None).cast("date").alias("valid_to"), *stamps)
            .unionByName(accounts.select(F.lit("accounts").alias("table_name"), F.col("account").alias("key"), F.col("client").alias("ref"), "valid_to", *stamps)))


def q_adhoc_sql(spark, sf_dir):
    t = _tables(spark, sf_dir)
    adhoc.register_views({"transactions": t.transactions, "cards": t.cards})
    return adhoc.run_sql(spark, _oracle.ADHOC_SQL.format(min_amount=":min_amount"),
                         args={"min_amount": 0})


def _views(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return {n: getattr(t, n) for n in ("transactions", "cards", "accounts", "clients", "blacklist", "terminals")}


def q_table_list(spark, sf_dir):
    """The registered tables with their row counts."""
    views = _views(spark, sf_dir)
    adhoc.register_views(views)
    counts = [adhoc.table(spark, n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("name"), "n_rows")
              for n in adhoc.list_tables(spark) if n in views]
    return functools.reduce(DataFrame.union, counts)


def q_positional_sql(spark, sf_dir):
    """Ad-hoc SQL with positional bindings."""
    adhoc.register_views(_views(spark, sf_dir))
    return adhoc.run_sql(spark, "SELECT oper_type, oper_result, count(*) AS n_ops FROM transactions "
                                "WHERE amount >= ? AND oper_result = ? GROUP BY oper_type, oper_result", args=[10, "REJECT"])


def q_table_by_name(spark, sf_dir):
    adhoc.register_views(_views(spark, sf_dir))
    return adhoc.table(spark, "cards")


def write_proxy_drops(spark, sf_dir, layout, day=None):
    """The proxy data as the reference's inputs: daily ';' transaction files,
    daily blacklist and terminal xlsx files, and the seed dimensions."""
    t = _tables(spark, sf_dir)
    fixtures.write_lines(spark, fixtures.to_lines(t.transactions, day=day), layout.drop)
    bl = t.blacklist.select(F.datediff("date", F.lit("1899-12-30").cast("date")).alias("date"),
                            "passport", _excel_day("date").alias("_day"))
    fixtures.write_workbooks(bl, layout.drop, "passport_blacklist", "blacklist")
    snap = _snapshots(spark, sf_dir)
    fixtures.write_workbooks(snap.withColumn("_day", _excel_day("load_date")).drop("load_date"),
                     layout.drop, "terminals", "terminals")
    seed.write_seed({"cards": t.cards, "accounts": t.accounts, "clients": t.clients}, layout.seed)


def q_daily_pipeline(spark, sf_dir):
    """End to end: all pending drops loaded in one catch-up run, terminal
    versions rebuilt, every day's report written to the mart; read back."""
    layout = daily.Layout(work_dir(spark, "daily-pipeline"))
    write_proxy_drops(spark, sf_dir, layout)
    daily.run(spark, layout)
    return plan.read_mart(spark, layout.mart)


def q_daily_pipeline_late(spark, sf_dir):
    """A tenth of the operations arrives in the next day's file, and the files in two deliveries."""
    layout = daily.Layout(work_dir(spark, "daily-late"))
    late = F.col("transaction_id").cast("long") % 10 == 3
    day = F.to_date("transaction_date")
    write_proxy_drops(spark, sf_dir, layout, F.when(late, F.date_add(day, 1)).otherwise(day))
    aside = f"{layout.root}/second"
    cut = datetime.date.fromisoformat(_oracle.DAY_REPORT_DATE)
    second = [f for f in files.list_files(spark, layout.drop) if files.business_date_of(f.name) >= cut]
    for f in second:
        files.rename(spark, f.path, f"{aside}/{f.name}")
    daily.run(spark, layout)
    for f in second:
        files.rename(spark, f"{aside}/{f.name}", f.path)
    daily.run(spark, layout)
    return plan.read_mart(spark, layout.mart)


# --------------------------------------------------- continuous queries --

STREAM_DELAY = "3 days"


def _delivery(first_day, more=0):
    """Which of four deliveries an operation comes in: by its time and up to two days more, so out of time order."""
    key = F.col("transaction_id").cast("long")
    arrives = F.col("transaction_date") + F.make_dt_interval(hours=(key * 7 % 48).cast("int"))
    return F.least(F.lit(3), F.floor(F.datediff(F.to_date(arrives), F.lit(first_day)) / 8).cast("int") + more)


def _stream_session(spark, sf_dir):
    return stream_rules.stream_session(spark, files.total_size(spark, f"{sf_dir.rstrip('/')}/events.parquet"))


def _fed(spark, sf_dir, name, start, span):
    """Feeds the operations in four deliveries and an end to a continuous query; returns the folder of its hits.

    start(session, tables, folder of operations, folder of hits, checkpoint) starts the query anew for each delivery.
    """
    own = _stream_session(spark, sf_dir)
    t, root = _tables(own, sf_dir), work_dir(spark, name)
    first, last = proxy.event_days(own, sf_dir)
    given = t.transactions.withColumn("_delivery", _delivery(first))
    for k in range(5):
        part = given.where(F.col("_delivery") == k).drop("_delivery") if k < 4 else stream_rules.end_of_feed(
            own, datetime.datetime.combine(last, datetime.time()) + datetime.timedelta(days=1), STREAM_DELAY, span)
        part.select(*schemas.TRANSACTION_FIELDS).write.mode("append").parquet(f"{root}/operations")
        stream_rules.finish(start(own, t, f"{root}/operations", f"{root}/hits", f"{root}/checkpoint"))
    return f"{root}/hits"


def q_stream_amount_probing(spark, sf_dir):
    """R4 as a stateful stream over out-of-order deliveries, restarted from its checkpoint for each."""
    def start(own, t, folder, out, checkpoint):
        ops = enrich_narrow(stream_rules.operations(own, folder, STREAM_DELAY), t.cards, t.accounts, t.clients)
        return stream_rules.append(stream_rules.amount_probing(ops, t.clients, within=H72, report_dt=REPORT_DT), out, checkpoint)
    return stream_rules.read_hits(spark, _fed(spark, sf_dir, "stream-probing", start, H72), distinct=False)


def q_stream_different_cities(spark, sf_dir):
    """R3 as an interval join of the stream with itself."""
    def start(own, t, folder, out, checkpoint):
        ops = enrich_narrow(stream_rules.operations(own, folder, STREAM_DELAY), t.cards, t.accounts, t.clients)
        return stream_rules.append(stream_rules.different_cities(ops, t.terminals, t.clients, report_dt=REPORT_DT), out, checkpoint)
    return stream_rules.read_hits(spark, _fed(spark, sf_dir, "stream-cities", start, "1 hour"))


def q_stream_profile_rules(spark, sf_dir):
    """R1A, R1B and R2 on the stream; passports of odd customers join the blacklist before the third delivery."""
    black = work_dir(spark, "stream-blacklist")
    turn = iter(range(5))

    def tables(session):
        return dataclasses.replace(_tables(session, sf_dir), blacklist=session.read.schema(schemas.BLACKLIST).parquet(black))

    def start(own, t, folder, out, checkpoint):
        k, odd = next(turn), F.substring("passport", 2, 20).cast("long") % 2 == 1
        if k in (0, 2):
            t.blacklist.where(odd if k else ~odd).write.mode("append").parquet(black)
        return stream_rules.profile_rules(stream_rules.operations(own, folder, STREAM_DELAY), tables, out, checkpoint, report_dt=REPORT_DT)
    return stream_rules.read_hits(spark, _fed(spark, sf_dir, "stream-profile", start, "1 hour"))


def q_stream_late_operations(spark, sf_dir):
    """Repeated and late lines of a feed, each accounted for: some operations come two deliveries late, some twice in
    one delivery and some again in the next, in files of other names."""
    own = _stream_session(spark, sf_dir)
    t, root = _tables(own, sf_dir), work_dir(spark, "stream-late")
    first, _ = proxy.event_days(own, sf_dir)
    key, drop = F.col("transaction_id").cast("long"), f"{root}/drop"
    given = t.transactions.withColumn("_delivery", _delivery(first, F.when(key % 20 == 7, 2).otherwise(0)))
    for k in range(4):
        here = F.col("_delivery") == k
        day = F.lit(first + datetime.timedelta(days=k)).cast("date")
        fixtures.write_lines(own, fixtures.to_lines(given.where(here), day=day), drop)
        fixtures.write_lines(own, fixtures.to_lines(given.where(here & (key % 10 == 3)), day=day), drop, prefix="transactions_twice")
        if k:
            fixtures.write_lines(own, fixtures.to_lines(given.where((F.col("_delivery") == k - 1) & (key % 10 == 5)), day=day), drop, prefix="transactions_again")
        arrivals.run_available(own, drop, f"{root}/feed", STREAM_DELAY)
    return arrivals.account_for(spark, f"{root}/feed")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the fraud report over the sf0.001 proxy tables."""
    return q_fraud_report(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | ({**_llm.queries(), "pipeline": _corpus.run} if _llm else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ingest_transactions": q_ingest_transactions,
        "ingest_idempotent": q_ingest_idempotent,
        "quarantine_bad_lines": q_quarantine_bad_lines,
        "ingest_excel_blacklist": q_ingest_excel_blacklist,
        "ingest_excel_terminals": q_ingest_excel_terminals,
        "stamp_snapshot": q_stamp_snapshot,
        "terminal_history": q_terminal_history,
        "adhoc_sql": q_adhoc_sql,
        "enriched_transactions": q_enriched_transactions,
        "locked_passport": q_locked_passport,
        "overdue_passport": q_overdue_passport,
        "invalid_contract": q_invalid_contract,
        "point_in_time_city": q_point_in_time_city,
        "point_in_time_city_many_versions": q_point_in_time_city_many_versions,
        "different_cities": q_different_cities,
        "different_cities_all_versions": q_different_cities_all_versions,
        "amount_probing": q_amount_probing,
        "amount_probing_three_step": q_amount_probing_three_step,
        "fraud_report": q_fraud_report,
        "fraud_report_day": q_fraud_report_day,
        "fraud_report_hot_account": q_fraud_report_hot_account,
        "daily_mart": q_daily_mart,
        "daily_pipeline": q_daily_pipeline,
        "daily_pipeline_late": q_daily_pipeline_late,
        "ingest_excel_stream": q_ingest_excel_stream,
        "ingest_excel_sheets": q_ingest_excel_sheets,
        "terminal_history_incremental": q_terminal_history_incremental,
        "seed_load": q_seed_load,
        "seed_tables": q_seed_tables,
        "fraud_report_probing": q_fraud_report_probing,
        "daily_mart_probing": q_daily_mart_probing,
        "table_list": q_table_list,
        "positional_sql": q_positional_sql,
        "table_by_name": q_table_by_name,
        "stream_amount_probing": q_stream_amount_probing,
        "stream_different_cities": q_stream_different_cities,
        "stream_profile_rules": q_stream_profile_rules,
        "stream_late_operations": q_stream_late_operations,
        "operation_lags": q_operation_lags,
        "enriched_transactions_bucketed": q_enriched_transactions_bucketed,
    }


def oracle_sql() -> dict[str, str]:
    more = {**_llm.oracle_sql(), "pipeline": _corpus.ORACLE_SQL} if _llm else {}
    return _oracle.oracle_sql() | {k: v for k, v in more.items() if v}

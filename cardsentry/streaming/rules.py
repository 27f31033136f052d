"""The detections as continuous queries over a stream of operations.

Operations arrive as files (``operations``), in any order within ``delay``; event time is the operation time and the
watermark trails the newest operation by ``delay``. Every rule gives the rows of its batch form:

* R4 (``amount_probing``): a stateful operator. Operations wait in keyed state until the watermark has passed their
  time bucket, are then put in their total order and judged, and the state is dropped. State is kept per share of the
  accounts and time bucket (each operation also waits, as context, in the bucket after its own), not per account: a
  hot account is spread over its buckets, no group outlives two spans of the rule, and many small accounts cost few
  calls to the state store.
* R3 (``different_cities``): an interval join of the stream with itself, as a semi join: an operation is reported once, in
  the trigger that brings the first of its partners or itself, whichever arrives last. Kept like R4 by share of the accounts
  and time bucket, with the operations of the neighbouring buckets that are less than the rule's span from the border; what
  is a span behind the watermark leaves the state when the group's next operations come, or with its timer.
* R1A, R1B, R2 (``profile_rules``): a join with the dimension tables, which are read anew in every trigger, so a
  blacklist row added between two triggers counts from the next one on.

A source that ends sends one more row, dated far enough ahead, to move the watermark past its last operations
(``end_of_feed``). Its texts are empty and not null, as filters on nulls go down to the scan, below the watermark;
rules never see it, as no card has an empty number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cardsentry import schemas
from cardsentry.functions.constants import EVENT_CITIES, EVENT_PROBING, RESULT_REJECT, RESULT_SUCCESS
from cardsentry.functions.timecols import duration_us, epoch_us
from cardsentry.operators import rules
from cardsentry.operators.enrich import attach_clients, enrich_narrow, with_city
from cardsentry.operators.sequence import floor_div
from cardsentry.session import apply_required

TS = "transaction_date"
FEED_BYTES = 32 << 20  # of a feed's files to one partition of keyed state
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_partitions(spark: SparkSession, feed_bytes: int = 0) -> int:
    """Partitions of keyed state for a feed of about `feed_bytes` (of Parquet): one for each core, or for each
    FEED_BYTES if these are more, and never more than the session shuffles into.

    A trigger opens and commits the state store of every partition, however few its rows, and a query keeps the number
    it began with, so batch settings (200 by default) would cost a small feed mostly commits.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, -(-feed_bytes // FEED_BYTES)))


def stream_session(spark: SparkSession, feed_bytes: int = 0) -> SparkSession:
    """A session beside `spark` with its settings, partitions for a feed of that size, and the state store that keyed state needs."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(key, None) is not None:
            own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions(spark, feed_bytes)))
    apply_required(own)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return own


def clocked(operations: DataFrame, delay: str) -> DataFrame:
    """Operations with their time as event time; those more than `delay` behind the newest are late."""
    return operations.withColumn(TS, F.col(TS).cast("timestamp")).withWatermark(TS, delay)


def operations(spark: SparkSession, folder: str, delay: str, files_per_trigger: int | None = None) -> DataFrame:
    """The stream of operation files (Parquet, ``schemas.TRANSACTIONS``) in a folder."""
    reader = spark.readStream.schema(schemas.TRANSACTIONS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return clocked(reader.parquet(folder), delay)


def end_of_feed(spark: SparkSession, last: dt.datetime, delay: str, span: str) -> DataFrame:
    """The closing row of a feed whose last operation is at `last`; `span`: the longest that a rule waits."""
    ahead = last + dt.timedelta(microseconds=duration_us(delay) + 2 * duration_us(span) + duration_us("1 hour"))
    return spark.createDataFrame([("", ahead, Decimal(0), "", "", "", "")], schemas.TRANSACTIONS)


def append(hits: DataFrame, out_dir: str, checkpoint_dir: str):
    """Starts the query that appends hits to a Parquet folder, over all files not yet seen; returns it."""
    return (hits.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
                .trigger(availableNow=True).start(out_dir))


def finish(query):
    """Waits for a query and raises what it failed with; returns it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def _told(hits: DataFrame, clients: DataFrame, event_type: str, report_dt) -> DataFrame:
    """Mart rows of hits (_us, client_id)."""
    rows = hits.select(F.timestamp_micros("_us").cast("timestamp_ntz").alias("event_dt"), "client_id",
                       F.lit(event_type).alias("event_type"), rules.report_dt_col(report_dt).alias("report_dt"))
    return attach_clients(rows, clients)


# --------------------------------------------------------------------- R4 --

WAITING = pa.schema([("key", pa.string()), ("us", pa.int64()), ("transaction_id", pa.string()), ("cents", pa.int64()), ("tries", pa.bool_()),
                     ("ends", pa.bool_()), ("client_id", pa.string()), ("own", pa.bool_())])
SHARES = 256  # fixed: a checkpoint's state is keyed by it


class Prober(StatefulProcessor):
    """Operations of a share of the accounts in two neighbouring buckets; judged when the watermark passes the later one.

    What arrives together waits as one value, so that calls to the state store are as many as shares and buckets, not
    as accounts.
    """

    def __init__(self, width_us: int, within_us: int, min_ops: int):
        self.width_us, self.within_us, self.min_ops = width_us, within_us, min_ops

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = not self.waiting.exists()
        for part in rows:
            batch = pa.RecordBatch.from_pandas(part[WAITING.names], schema=WAITING, preserve_index=False)
            self.waiting.appendValue((batch.serialize().to_pybytes(),))
        if first:
            end = (int(key[1]) + 1) * self.width_us
            self.handle.registerTimer(-(-end // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batches = [pa.ipc.read_record_batch(pa.py_buffer(bytes(x[0])), WAITING) for x in self.waiting.get()]
        found = self.hits(pa.Table.from_batches(batches, WAITING).to_pandas())
        self.waiting.clear()
        yield found

    def hits(self, rows: pd.DataFrame) -> pd.DataFrame:
        """(_us, transaction_id, client_id) of the own rows that end a chain."""
        rows["key"] = pd.factorize(rows["key"], use_na_sentinel=False)[0]
        rows = rows.sort_values(["key", "us", "transaction_id"], na_position="first", ignore_index=True)
        back, m = self.min_ops - 1, max(0, len(rows) - self.min_ops + 1)  # m: rows with so many before them
        at = {c: [rows[c].to_numpy()[k : k + m] for k in range(self.min_ops)] for c in ("key", "us", "cents", "tries", "ends", "own")}
        ok = at["own"][back] & at["ends"][back] & (at["key"][0] == at["key"][back]) & (at["us"][back] - at["us"][0] < self.within_us)
        for k in range(back):
            ok = ok & at["tries"][k] & (at["cents"][k] > at["cents"][k + 1])
        return rows[["us", "transaction_id", "client_id"]].iloc[back:][ok].rename(columns={"us": "_us"})

    def close(self) -> None:
        pass


def amount_probing(enriched: DataFrame, clients: DataFrame, within="20 minutes", min_ops: int = 4, key: str = "account", report_dt=None,
                   success: str = RESULT_SUCCESS, reject: str = RESULT_REJECT) -> DataFrame:
    """R4 over a stream of narrow enriched operations (``enrich_narrow`` of a ``clocked`` stream): mart rows."""
    if min_ops < 2:
        raise ValueError("min_ops must be >= 2")
    span = duration_us(within)
    width = max(span, duration_us(rules.LAG_BUCKET))
    us = epoch_us(TS)
    told = lambda result: F.coalesce((F.col("oper_result") == F.lit(result)) & F.col("amount").isNotNull(), F.lit(False))
    # amounts have two decimals, so cents are exact; an operation without an amount stands between others and is in no chain
    rows = enriched.select(TS, F.col(key).cast("string").alias("key"), us.alias("us"), "transaction_id",
                           F.coalesce((F.col("amount") * 100).cast("long"), F.lit(0).cast("long")).alias("cents"), told(reject).alias("tries"),
                           told(success).alias("ends"), "client_id", floor_div(us, width).alias("_b")).where("_b IS NOT NULL")
    rows = rows.withColumn("bucket", F.explode(F.array("_b", F.col("_b") + 1))).withColumn("own", F.col("bucket") == F.col("_b")).drop("_b")
    rows = rows.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(SHARES)).cast("int"))
    hits = rows.groupBy("share", "bucket").transformWithStateInPandas(
        Prober(width, span, min_ops), "_us long, transaction_id string, client_id string", "append", "EventTime")
    return _told(hits, clients, EVENT_PROBING, report_dt)


# --------------------------------------------------------------------- R3 --

MEETING = pa.schema([("key", pa.string()), ("us", pa.int64()), ("city", pa.string()), ("client_id", pa.string()), ("open", pa.bool_())])
CITY_BUCKET = "12 hours"  # least width; fixed, as SHARES
CITY_SHARES = 64
STATE_ROWS = 1 << 16  # in one value of the state


class Meeter(StatefulProcessor):
    """Operations of a share of the accounts in a time bucket, and those less than a span outside its borders.

    The bucket's own are open until one of the same account in another city is less than a span away, and reported then.
    The others serve as partners only: of those of an account in a city within one span, the first and the last meet
    whatever any of them meets (as the summaries of the batch rule), and no more are kept.
    """

    def __init__(self, span_us: int):
        self.span_us = span_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.held()
        ops = pa.Table.from_batches(held + [pa.RecordBatch.from_pandas(x[MEETING.names], MEETING, preserve_index=False) for x in rows], MEETING).combine_chunks()
        k, city = (ops[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("key", "city"))
        us, is_open = ops["us"].to_numpy(), ops["open"].to_numpy()
        hit = is_open & self.met(k, city, us)
        is_open = is_open & ~hit
        stays = self.ahead(us, timerValues.getCurrentWatermarkInMs()) & (is_open | self.ends(k, city, us, ~is_open))
        self.keep(ops.set_column(4, "open", pa.array(is_open)).filter(pa.array(stays)), held=bool(held), timed=bool(held))
        if hit.any():
            found = ops.filter(pa.array(hit))
            yield pd.DataFrame({"_us": found["us"].to_numpy(), "client_id": found["client_id"].to_pandas()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ops = pa.Table.from_batches(self.held(), MEETING)
        self.keep(ops.filter(pa.array(self.ahead(ops["us"].to_numpy(), timerValues.getCurrentWatermarkInMs()))), held=True, timed=False)
        return iter(())

    def held(self) -> list[pa.RecordBatch]:
        return [pa.ipc.read_record_batch(pa.py_buffer(bytes(x[0])), MEETING) for x in self.waiting.get()]

    def keep(self, ops: pa.Table, held: bool, timed: bool) -> None:
        """Holds these and no others; a group that holds any has a timer, set for when the newest it had was a span behind."""
        if held:
            self.waiting.clear()
        for part in ops.combine_chunks().to_batches(max_chunksize=STATE_ROWS) if ops.num_rows else ():
            self.waiting.appendValue((part.serialize().to_pybytes(),))
        if ops.num_rows and not timed:
            self.handle.registerTimer(-(-(int(ops["us"].to_numpy().max()) + self.span_us) // 1000))

    def ahead(self, us: np.ndarray, watermark_ms: int) -> np.ndarray:
        """Those that operations after the watermark may yet meet."""
        return us + self.span_us > watermark_ms * 1000

    def met(self, key: np.ndarray, city: np.ndarray, us: np.ndarray) -> np.ndarray:
        """Those with an operation of the same key and another city less than the span away: in the order of time, the
        nearest such are next to the run of operations in their own city."""
        order = np.lexsort((us, key))
        key, city, us = key[order], city[order], us[order]
        start = np.flatnonzero(_changes(key, city))
        last = np.append(start[1:], len(us)) - 1
        same = key[start[1:]] == key[last[:-1]]  # the run before is of the same key
        far = np.full(1, self.span_us)
        run = np.repeat(np.arange(len(start)), last - start + 1)
        before = np.concatenate([far, np.where(same, us[start[1:]] - us[last[:-1]], self.span_us)])[run] + us - us[start[run]]
        after = np.concatenate([np.where(same, us[start[1:]] - us[last[:-1]], self.span_us), far])[run] + us[last[run]] - us
        found = np.empty(len(us), bool)
        found[order] = np.minimum(before, after) < self.span_us
        return found

    def ends(self, key: np.ndarray, city: np.ndarray, us: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Of those `among`, the first and the last of a key and a city in each span."""
        at = np.flatnonzero(among)
        at = at[np.lexsort((us[at], city[at], key[at]))]
        new = _changes(key[at], city[at], us[at] // self.span_us)
        found = np.zeros(len(us), bool)
        found[at[new | np.append(new[1:], True)]] = True
        return found

    def close(self) -> None:
        pass


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the one before in any column; the first does."""
    differs = np.zeros(len(columns[0]), bool)
    differs[:1] = True
    for c in columns:
        differs[1:] |= c[1:] != c[:-1]
    return differs


def different_cities(enriched: DataFrame, terminals: DataFrame, clients: DataFrame, within="1 hour", key: str = "account", report_dt=None) -> DataFrame:
    """R3 over a stream of narrow enriched operations: mart rows, one per operation (operations of one client in the
    same microsecond give equal rows, which the batch form shows once)."""
    span = duration_us(within)
    width = max(span, duration_us(CITY_BUCKET))
    rows = with_city(enriched, terminals).where(F.col("terminal_city").isNotNull())
    us = epoch_us(TS)
    rows = rows.select(TS, F.col(key).cast("string").alias("key"), us.alias("us"), F.col("terminal_city").cast("string").alias("city"), "client_id",
                       floor_div(us, width).alias("_b")).where("_b IS NOT NULL AND key IS NOT NULL")
    into = F.col("us") - F.col("_b") * width
    near = F.array(F.col("_b"), F.when(into < span, F.col("_b") - 1), F.when(into > width - span, F.col("_b") + 1))
    rows = rows.withColumn("bucket", F.explode(F.array_compact(near))).withColumn("open", F.col("bucket") == F.col("_b")).drop("_b")
    rows = rows.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(CITY_SHARES)).cast("int"))
    hits = rows.groupBy("share", "bucket").transformWithStateInPandas(Meeter(span), "_us long, client_id string", "append", "EventTime")
    return _told(hits, clients, EVENT_CITIES, report_dt)


# ------------------------------------------------------------ R1A, R1B, R2 --

def profile_rules(ops: DataFrame, read_tables: Callable[[SparkSession], object], out_dir: str, checkpoint_dir: str, report_dt=None):
    """Starts R1A, R1B and R2 over all files not yet seen; returns the query.

    ``read_tables(spark)`` gives cards, accounts, clients and blacklist as they are at the trigger. A batch's hits
    replace those of an earlier try of the same batch.
    """
    def judge(batch: DataFrame, batch_id: int) -> None:
        t = read_tables(batch.sparkSession)
        rows = batch.withColumn(TS, F.col(TS).cast("timestamp_ntz"))
        hits = rules.profile_rules(enrich_narrow(rows, t.cards, t.accounts, t.clients, blacklist=t.blacklist), report_dt=report_dt)
        attach_clients(hits, t.clients).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    return ops.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


REPORT_COLUMNS = ["event_dt", "passport", "last_name", "first_name", "patronymic", "phone", "event_type", "report_dt"]


def read_hits(spark: SparkSession, out_dir: str, distinct: bool = True) -> DataFrame:
    """Mart rows that a rule's query has written; ``distinct`` as the batch rules R1 to R3 have it (R4 has not)."""
    rows = spark.read.parquet(out_dir).select(*REPORT_COLUMNS)
    return rows.distinct() if distinct else rows

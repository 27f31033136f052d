"""Repeated and late operations of a continuous feed.

Every delivered line ends in exactly one table of the root folder: ``kept`` (the first copy of an operation),
``late`` (behind the watermark when it came) or ``quarantine`` (malformed); what is left over are repeated copies,
which ``arrived`` holds next to the first ones.

Two queries. The first reads the drop files and parts the lines of a trigger by the watermark: the newest operation
time of all earlier triggers, less ``delay``. Streams drop late rows without a trace; here they are written aside.
Triggers' newest times are kept in ``clock``, one row each, so that a repeated trigger parts its lines as before.
The second reads what arrived in time and keeps the first copy of every transaction id, by
``dropDuplicatesWithinWatermark``, whatever the names of the files that copies came in. Its watermark is never ahead
of the first one's, so nothing that arrived in time is dropped there as late; a copy that comes after the state of its
operation has been dropped is late by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.functions.timecols import duration_us, epoch_us
from cardsentry.sources import files
from cardsentry.sources import transactions as tx
from cardsentry.streaming.rules import clocked, finish

TS = "transaction_date"
CLOCK = "newest_us long, batch long"


def _newest_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Newest operation time of the triggers before `batch_id` (microseconds)."""
    if not files.exists(spark, f"{root}/clock"):
        return None
    told = spark.read.schema(CLOCK).parquet(f"{root}/clock").where(F.col("batch") < batch_id)
    return told.agg(F.max("newest_us")).first()[0]


def _part(root: str, delay: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"batch={batch_id}"
        # written once: the lines are read and parsed once, then parted
        parsed = f"{root}/parsed/{place}"
        tx.parse(tx.lines_with_source(batch)).write.mode("overwrite").parquet(parsed)
        rows = spark.read.parquet(parsed)
        good = rows.where(F.col("reason").isNull()).select(*tx.TRANSACTION_FIELDS, "src_file")
        newest, us = _newest_before(spark, root, batch_id), epoch_us(TS)
        late = F.lit(False) if newest is None else us <= F.lit(newest - duration_us(delay))
        tx.bad_rows(rows).write.mode("overwrite").parquet(f"{root}/quarantine/{place}")
        good.where(late).write.mode("overwrite").parquet(f"{root}/late/{place}")
        good.where(~late).write.mode("overwrite").parquet(f"{root}/arrived/{place}")
        good.agg(F.max(us).alias("newest_us")).where("newest_us IS NOT NULL").coalesce(1).write.mode("overwrite").parquet(f"{root}/clock/{place}")
        files.delete(spark, parsed)
    return write


def run_available(spark: SparkSession, drop_dir: str, root: str, delay: str, pattern: str = tx.PATTERN) -> None:
    """Takes in all drop files not yet seen, then keeps the first copies of what arrived in time."""
    root = root.rstrip("/")
    lines = spark.readStream.format("text").option("pathGlobFilter", pattern).load(drop_dir).select("value", F.col("_metadata.file_name").alias("file_name"))
    finish(lines.writeStream.foreachBatch(_part(root, delay)).option("checkpointLocation", f"{root}/checkpoint/arrivals").trigger(availableNow=True).start())
    if not files.exists(spark, f"{root}/arrived"):
        return
    arrived = spark.readStream.schema(f"{schemas.TRANSACTIONS.simpleString()[7:-1].replace(':', ' ')}, src_file string, batch long").parquet(f"{root}/arrived")
    first = clocked(arrived.select(*tx.TRANSACTION_FIELDS), delay).dropDuplicatesWithinWatermark(["transaction_id"])
    finish(first.withColumn(TS, F.col(TS).cast("timestamp_ntz")).writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", f"{root}/checkpoint/kept").trigger(availableNow=True).start(f"{root}/kept"))


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The operations of ``kept``, ``late`` or ``arrived`` (empty before the first run)."""
    path = f"{root.rstrip('/')}/{table}"
    return spark.read.schema(schemas.TRANSACTIONS).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schemas.TRANSACTIONS)


def account_for(spark: SparkSession, root: str) -> DataFrame:
    """(transaction_id, status, n): copies that were kept, repeated and late, of every operation."""
    def counted(table: str, status: str) -> DataFrame:
        return read(spark, root, table).groupBy("transaction_id").agg(F.count("*").alias("n")).withColumn("status", F.lit(status))

    arrived = counted("arrived", "repeated").withColumn("n", F.col("n") - 1).where("n > 0")
    return counted("kept", "kept").unionByName(arrived).unionByName(counted("late", "late"))

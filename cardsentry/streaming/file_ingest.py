"""Incremental ingestion of transaction drops with Structured Streaming.

``readStream`` (text) over the drop folder, ``trigger(availableNow=True)``,
``foreachBatch`` doing S2 + S4 + S6. The checkpoint records which files were
processed, so a rerun (or a file delivered again under the same name)
adds no rows. A replayed micro-batch rewrites the same (load_date, src_file)
partitions, so the sink is idempotent under at-least-once replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.sources import files
from cardsentry.sources import transactions as tx
from cardsentry.sources.ledger import Ledger, archive, ingest_new


def _batch_writer(drop_dir: str, table_dir: str, quarantine_dir: str, ledger_dir: str | None, archive_dir: str | None, pattern: str):
    """Loads the files of a micro-batch like the batch path does; with a ledger, also records and archives them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = tx.lines_with_source(batch)
        names = [r[0] for r in lines.select("src_file").distinct().collect()]   # files of this batch
        dropped = files.list_files(spark, drop_dir, pattern)
        there = {f.name: f for f in dropped if f.name in set(names)}
        bare = {f.name: f for f in dropped if f.size == 0}      # without any line, so no line tells their names
        if ledger_dir is not None:
            known = {r["file_name"]: r for r in Ledger(spark, ledger_dir).latest()
                     .where(F.col("file_name").isin(names)).select("file_name", "size", "mtime").collect()}
            names = [n for n in names if n not in known or n not in there
                     or (known[n]["size"], known[n]["mtime"]) != (there[n].size, there[n].mtime)]
            lines = lines.where(F.col("src_file").isin(names))
        if names:
            stats = tx._replace_rows(spark, tx.parse(lines), table_dir, quarantine_dir, names)
            if ledger_dir is not None:
                Ledger(spark, ledger_dir).record(stats, {n: there[n] for n in names if n in there})
        if ledger_dir is not None and bare:
            seen = {(r["file_name"], r["mtime"]) for r in Ledger(spark, ledger_dir).latest().where(F.col("file_name").isin(list(bare))).collect()}
            if fresh := {n: f for n, f in bare.items() if (n, f.mtime) not in seen}:
                Ledger(spark, ledger_dir).record([], fresh)
        if archive_dir is not None:
            for name, f in {**there, **bare}.items():
                archive(spark, f.path, archive_dir, name)
    return write


def start(spark: SparkSession, drop_dir: str, table_dir: str, quarantine_dir: str,
          checkpoint_dir: str, available_now: bool = True, archive_dir: str | None = None, ledger_dir: str | None = None,
          pattern: str = tx.PATTERN, max_files_per_trigger: int | None = None):
    """Start the ingest stream; returns the StreamingQuery.

    ``ledger_dir``, ``archive_dir``: the batch path's ledger and ``.backup`` archive, kept by the stream as
    well, so that either path knows what the other has loaded.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(drop_dir).select("value", F.col("_metadata.file_name").alias("file_name"))
    writer = (stream.writeStream.foreachBatch(_batch_writer(drop_dir, table_dir, quarantine_dir, ledger_dir, archive_dir, pattern))
                    .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_available(spark: SparkSession, drop_dir: str, table_dir: str, quarantine_dir: str,
                  checkpoint_dir: str, **kw) -> None:
    """Process every file not yet seen, then stop."""
    q = start(spark, drop_dir, table_dir, quarantine_dir, checkpoint_dir, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def start_excel(spark: SparkSession, drop_dir: str, blacklist_dir: str, terminals_dir: str, quarantine_dir: str, ledger_dir: str,
                checkpoint_dir: str, archive_dir: str | None = None, pattern: str = "*.xlsx", available_now: bool = True,
                max_files_per_trigger: int | None = None):
    """Starts the ingest stream of xlsx drops; returns the StreamingQuery.

    The stream tells which files are new; a trigger loads them by the steps of the batch path (``excel.load_files``,
    ledger, archive), so all sheets reach their tables, bad rows and broken workbooks the quarantine, and neither path
    loads what the other has loaded. A corrected workbook under a known name is loaded with the next new file (or by
    the batch path).
    """
    from cardsentry.sources import excel

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        names = {r[0].rsplit("/", 1)[-1] for r in batch.select("path").distinct().collect()}    # files of this trigger
        # a file source does not tell of a path again: files dropped anew under a loaded name come along
        there = [f.name for f in files.list_files(session, drop_dir, pattern)]
        names |= {r[0] for r in Ledger(session, ledger_dir).table().where(F.col("file_name").isin(there)).select("file_name").distinct().collect()}
        ingest_new(session, drop_dir, pattern, ledger_dir, lambda paths: excel.load_files(session, paths, blacklist_dir, terminals_dir, quarantine_dir),
                   archive_dir=archive_dir, only=names)

    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # only paths: contents are read by the tasks that parse them
    writer = reader.load(drop_dir).select("path").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

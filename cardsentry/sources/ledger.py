"""The processed-files ledger, and which loaded files still need a report.

Two parquet tables per kind of file. The ledger has a row per load: (file_name, business_date, n_good, n_bad,
size, mtime, first_op, last_op, tables, loaded_at). ``<ledger>_reported`` has (file_name, loaded_at) of the loads
whose reports are in the mart. Both are only appended to, so a crash at any point leaves the work still to be
done visible: loaded but not reported.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.sources import files

SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("business_date", T.DateType()),
    T.StructField("n_good", T.LongType()), T.StructField("n_bad", T.LongType()),
    T.StructField("size", T.LongType()), T.StructField("mtime", T.LongType()),
    T.StructField("first_op", T.TimestampNTZType()), T.StructField("last_op", T.TimestampNTZType()),
    T.StructField("tables", T.StringType()), T.StructField("loaded_at", T.TimestampNTZType()),
])
REPORTED = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("loaded_at", T.TimestampNTZType())])
FOUND = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("path", T.StringType()),
                      T.StructField("found_size", T.LongType()), T.StructField("found_mtime", T.LongType())])

COMPACT_FILES = 64


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def exists(self) -> bool:
        return files.exists(self.spark, self.path)

    def table(self) -> DataFrame:
        """Every load."""
        return self._read(self.path, SCHEMA)

    def latest(self) -> DataFrame:
        """The last load of every file."""
        last = F.row_number().over(Window.partitionBy("file_name").orderBy(F.desc("loaded_at")))
        return self.table().withColumn("_n", last).where("_n = 1").drop("_n")

    def pending(self) -> DataFrame:
        """Last loads whose reports are not in the mart yet."""
        return self.latest().join(self._read(f"{self.path}_reported", REPORTED), ["file_name", "loaded_at"], "left_anti")

    def mark_reported(self, loads: list) -> None:
        if loads:
            rows = [(r["file_name"], r["loaded_at"]) for r in loads]
            self.spark.createDataFrame(rows, REPORTED).coalesce(1).write.mode("append").parquet(f"{self.path}_reported")

    def loaded_names(self) -> set[str]:
        """Names of loaded files (for small ledgers: tests, listings)."""
        return {r[0] for r in self.table().select("file_name").distinct().collect()}

    def record(self, stats, infos: dict) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = []
        for r in stats:
            info, more = infos.get(r["file_name"]), r.asDict() if hasattr(r, "asDict") else dict(r)
            rows.append((r["file_name"], r["business_date"], int(r["n_good"]), int(r["n_bad"]),
                         info.size if info else None, info.mtime if info else None,
                         more.get("first_op"), more.get("last_op"), more.get("tables"), now))
        seen = {r[0] for r in rows}
        for name, info in infos.items():       # files without any line
            if name not in seen:
                rows.append((name, files.business_date_of(name), 0, 0, info.size, info.mtime, None, None, None, now))
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        if len(files.list_files(self.spark, self.path, "part-*")) > COMPACT_FILES:
            self._compact()

    def _compact(self) -> None:
        """One file again: written beside, then swapped in; an interrupted swap is undone by ``recover``."""
        fresh, old = f"{self.path}_next-{uuid.uuid4().hex[:8]}", f"{self.path}_old"
        self.table().coalesce(1).write.parquet(fresh)
        files.delete(self.spark, old)
        files.rename(self.spark, self.path, old)
        files.rename(self.spark, fresh, self.path)
        files.delete(self.spark, old)

    def recover(self) -> None:
        if not self.exists() and files.exists(self.spark, f"{self.path}_old"):
            files.rename(self.spark, f"{self.path}_old", self.path)


def _content(spark: SparkSession, path: str) -> tuple:
    """Order-free digest of a file's lines (computed by Spark tasks)."""
    df = spark.read.text(path)
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("value").cast("decimal(38,0)"))).first())


def _archived(spark: SparkSession, archive_dir: str, name: str) -> list[str]:
    return [f.path for f in files.list_files(spark, archive_dir, f"{name}.backup*")]


def archive(spark: SparkSession, path: str, archive_dir: str, name: str) -> str:
    """Moves a loaded file to ``<name>.backup`` (or ``.backup.N`` if that exists); raises if it cannot be moved."""
    target, n = f"{archive_dir.rstrip('/')}/{name}.backup", 0
    while files.exists(spark, target):
        n += 1
        target = f"{archive_dir.rstrip('/')}/{name}.backup.{n}"
    if not files.rename(spark, path, target):
        raise OSError(f"cannot archive {path} as {target}")
    return target


def ingest_new(spark: SparkSession, drop_dir: str, pattern, ledger_dir: str, load_fn,
               archive_dir: str | None = None, force: bool = False, only: set[str] | None = None) -> list[str]:
    """Load drop files that are new or changed; ``load_fn(paths)`` replaces their rows and
    returns per-file rows (file_name, business_date, n_good, n_bad, ...). ``only``: names to look at.

    A file under a known name is a repeated delivery if its size and modification time, or its size and its lines
    (against the archived copy), are those of the last load: it is archived and not loaded again. Any other is a
    corrected file and replaces the rows of the earlier one. Steps, each repeatable after a crash: load (partition
    replacement) -> ledger -> move to ``archive_dir`` as ``<name>.backup``.
    """
    ledger = Ledger(spark, ledger_dir)
    ledger.recover()
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    found = [f for f in {f.path: f for p in patterns for f in files.list_files(spark, drop_dir, p)}.values() if only is None or f.name in only]
    if not found:
        return []
    given = spark.createDataFrame([(f.name, f.path, f.size, f.mtime) for f in found], FOUND)
    known = {r["file_name"]: r for r in given.join(ledger.latest(), "file_name").select("file_name", "size", "mtime").collect()}

    def repeated(f) -> bool:
        last = known.get(f.name)
        if last is None or last["size"] != f.size:
            return False
        if last["mtime"] == f.mtime:
            return True
        copies = _archived(spark, archive_dir, f.name) if archive_dir else []
        return bool(copies) and _content(spark, f.path) == _content(spark, max(copies, key=lambda c: files.modified(spark, c)))

    new = [f for f in found if force or not repeated(f)]
    if new:
        stats = load_fn([f.path for f in new])
        ledger.record(stats, {f.name: f for f in new})
    if archive_dir:
        for f in found:
            archive(spark, f.path, archive_dir, f.name)
    return [f.name for f in new]

"""Replace everything that given drop files put into a table, including what they no longer hold.

Rows are written once to a staging folder beside the tables, partitioned by (_table, load_date, src_file). Then,
file by file, the old partitions are deleted and the staged ones renamed into place (metadata only). A crash in
between leaves the files out of the ledger, so the next run loads them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cardsentry.sources import files

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _escaped(spark: SparkSession, value: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def stage(df: DataFrame, beside: str) -> str:
    """Writes ``df`` (with _table, load_date, src_file) next to ``beside``; returns the folder."""
    path = f"{beside.rstrip('/')}_stage-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy("_table", "load_date", "src_file").parquet(path)
    return path


def replace(spark: SparkSession, staged: str, targets: dict[str, tuple[str, str]], names) -> None:
    """Moves staged partitions into ``targets`` (_table value -> folder, date column) for the files ``names``."""
    for table, (folder, date_column) in targets.items():
        for name in names:
            day = files.business_date_of(name)
            for old in {day.isoformat() if day else NO_DATE, NO_DATE}:
                files.delete(spark, f"{folder.rstrip('/')}/{date_column}={old}/src_file={_escaped(spark, name)}")
        files.mkdirs(spark, folder)
        for date_dir in files.list_dirs(spark, f"{staged}/_table={table}"):
            day = date_dir.rsplit("=", 1)[1]
            for file_dir in files.list_dirs(spark, date_dir):
                target = f"{folder.rstrip('/')}/{date_column}={day}/{file_dir.rsplit('/', 1)[1]}"
                if not files.rename(spark, file_dir, target):
                    raise OSError(f"cannot move {file_dir} to {target}")
    files.delete(spark, staged)

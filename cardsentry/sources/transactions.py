"""Daily ``transactions_DDMMYYYY.txt`` drops.

Format (as the reference reads it): ``;``-separated, no quoting, seven
fields by position, a header line recognised by its ``transaction_id``
prefix. Lines are split on the JVM (text source + ``split``); lines whose
field count is not seven, or whose time/amount do not parse, go to a
quarantine table instead of aborting the load. Blank lines are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions.values import parse_amount, parse_ts
from cardsentry.schemas import LOADED, QUARANTINE, TRANSACTION_FIELDS
from cardsentry.sources import files, staging
from cardsentry.sources.ledger import ingest_new

PATTERN = "transactions_*.txt"
HEADER = ";".join(TRANSACTION_FIELDS)
GOOD_COLUMNS = TRANSACTION_FIELDS + ["load_date", "src_file"]


def business_date(file_name: Column | str = None) -> Column:
    """Business date from the file name (``_DDMMYYYY``), as a date column."""
    c = F.col("_metadata.file_name") if file_name is None else (
        F.col(file_name) if isinstance(file_name, str) else file_name)
    return F.to_date(F.regexp_extract(c, files.DATE_IN_NAME, 1), "ddMMyyyy")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Raw lines with their file name and business date (batch)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return lines_with_source(spark.read.text(paths))


def lines_with_source(text_df: DataFrame) -> DataFrame:
    """(line, src_file, business_date) from a text-source DataFrame.

    Uses a ``file_name`` column when present (a micro-batch of a stream that
    selected ``_metadata.file_name`` before the sink), else the hidden
    ``_metadata`` column of the file source.
    """
    name = F.col("file_name") if "file_name" in text_df.columns else F.col("_metadata.file_name")
    return text_df.select(F.col("value").alias("line"), name.alias("src_file"),
                          business_date(name).alias("business_date"))


def _field(fields: Column, i: int) -> Column:
    return F.nullif(F.trim(F.get(fields, i)), F.lit(""))


def parse(lines: DataFrame) -> DataFrame:
    """Typed rows plus a ``reason`` column (NULL for good rows)."""
    body = lines.where((F.trim("line") != "") & ~F.col("line").startswith("transaction_id"))
    fields = F.split(F.col("line"), ";", -1)
    typed = body.select(
        "line", "src_file", "business_date",
        F.size(fields).alias("n_fields"),
        _field(fields, 0).alias("transaction_id"),
        parse_ts(_field(fields, 1)).alias("transaction_date"),
        parse_amount(_field(fields, 2)).alias("amount"),
        _field(fields, 3).alias("card_num"),
        _field(fields, 4).alias("oper_type"),
        _field(fields, 5).alias("oper_result"),
        _field(fields, 6).alias("terminal"),
    )
    reason = (F.when(F.col("n_fields") != len(TRANSACTION_FIELDS), F.lit("field_count"))
               .when(F.col("business_date").isNull(), F.lit("file_name_date"))
               .when(F.col("transaction_id").isNull(), F.lit("transaction_id"))
               .when(F.col("transaction_date").isNull(), F.lit("transaction_date"))
               .when(F.col("amount").isNull(), F.lit("amount")))
    return typed.withColumn("reason", reason)


def good_rows(parsed: DataFrame) -> DataFrame:
    return (parsed.where(F.col("reason").isNull())
                  .select(*TRANSACTION_FIELDS, F.col("business_date").alias("load_date"), "src_file"))


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(
        "src_file", "business_date", "line", F.get(F.split("line", ";", -1), 0).alias("transaction_id"),
        "n_fields", "reason")


def stamped(df: DataFrame, day_col: str = "load_date") -> DataFrame:
    """Validity of a loaded batch -- its business day [day, day + 1), deleted_flg 0."""
    from cardsentry.operators.dimensions import stamp
    return stamp(df, F.col(day_col), F.date_add(F.col(day_col), 1))


def write_partitions(df: DataFrame, table_dir: str, partition_cols) -> None:
    """Replace exactly the partitions present in ``df`` (idempotent reload)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(table_dir))


def staged_rows(parsed: DataFrame) -> DataFrame:
    """Good and bad rows in one schema: _table (good, bad), the table's columns, and the line of bad rows."""
    bad = F.col("reason").isNotNull()
    rows = stamped(parsed.withColumnRenamed("business_date", "load_date"))
    return rows.withColumn("_table", F.when(bad, "bad").otherwise("good")).withColumn("line", F.when(bad, F.col("line")))


def _replace_rows(spark: SparkSession, parsed: DataFrame, table_dir: str, quarantine_dir: str, names) -> list:
    """One pass over the lines: good and bad rows are staged together and replace those of the files ``names``;
    per-file counts and operation times come from the staged columns."""
    staged = staging.stage(staged_rows(parsed), table_dir)
    back = spark.read.schema("_table string, load_date date, src_file string, transaction_date timestamp_ntz").parquet(staged)
    good = F.col("_table") == "good"
    stats = (back.groupBy(F.col("src_file").alias("file_name"), F.col("load_date").alias("business_date"))
                 .agg(F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"),
                      F.min(F.when(good, F.col("transaction_date"))).alias("first_op"),
                      F.max(F.when(good, F.col("transaction_date"))).alias("last_op"))).collect()
    staging.replace(spark, staged, {"good": (table_dir, "load_date"), "bad": (quarantine_dir, "business_date")}, names)
    return stats


def load_files(spark: SparkSession, paths, table_dir: str, quarantine_dir: str) -> list:
    """Parse ``paths``; their good rows (by load_date, src_file) and bad rows replace all earlier ones of these files.

    Returns per-file rows (file_name, business_date, n_good, n_bad, first_op, last_op).
    """
    return _replace_rows(spark, parse(read_lines(spark, paths)), table_dir, quarantine_dir, [str(p).rsplit("/", 1)[-1] for p in paths])


def ingest(spark: SparkSession, drop_dir: str, table_dir: str, quarantine_dir: str, ledger_dir: str,
           archive_dir: str | None = None, force: bool = False, pattern: str = PATTERN) -> list[str]:
    """Batch ingest of new drop files; returns the names loaded.

    Repeated deliveries of loaded files are skipped unless ``force``; a corrected file under a known
    name replaces everything the earlier one held (see ``ingest_new``).
    """
    return ingest_new(spark, drop_dir, pattern, ledger_dir,
                      lambda paths: load_files(spark, paths, table_dir, quarantine_dir),
                      archive_dir=archive_dir, force=force)


def read_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """The loaded operations, by their declared schema (empty before the first load)."""
    if not files.exists(spark, table_dir):
        return spark.createDataFrame([], LOADED)
    return spark.read.schema(LOADED).parquet(table_dir)


def read_quarantine(spark: SparkSession, quarantine_dir: str) -> DataFrame:
    if not files.exists(spark, quarantine_dir):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(quarantine_dir)

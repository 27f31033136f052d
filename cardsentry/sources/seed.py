"""The seed dimensions (cards, accounts, clients), stamped with validity.

The reference creates them with a DDL script followed by single-row
inserts, so a second run duplicates every row. Here the seed is read by
column name (delimited text with a header line, or parquet) and written with
``overwrite``: loading it again leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.operators.dimensions import stamp
from cardsentry.sources import files

SEED_SCHEMAS = schemas.SEED
DEFAULT_FROM = "1900-01-01 00:00:00"


def typed(df: DataFrame, table: str) -> DataFrame:
    """The columns of a seed table, by name; absent ones are null, unreadable values are errors."""
    have = {c.strip().lower(): c for c in df.columns}
    unknown = sorted(set(have) - {f.name for f in SEED_SCHEMAS[table].fields} - set(schemas.VALIDITY))
    if unknown:
        raise ValueError(f"seed table {table}: unknown columns {unknown}")
    missing = [f.name for f in SEED_SCHEMAS[table].fields[:2] if f.name not in have]
    if missing:
        raise ValueError(f"seed table {table}: missing columns {missing}")

    def value(f):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{have[f.name]}`")
        return (F.nullif(F.trim(c), F.lit("")) if dict(df.dtypes)[have[f.name]] == "string" else c).cast(f.dataType).alias(f.name)

    return df.select(*[value(f) for f in SEED_SCHEMAS[table].fields])


def read_csv(spark: SparkSession, path: str, table: str, sep: str = ",") -> DataFrame:
    """A seed table from delimited text with a header line, columns in any order."""
    return typed(spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST").csv(path), table)


def write_seed(tables: dict[str, DataFrame], root: str, effective_from=DEFAULT_FROM, effective_to=None) -> None:
    """Overwrite each seed table under ``root/<name>``, all rows stamped [effective_from, effective_to) (idempotent)."""
    for name, df in tables.items():
        stamp(typed(df, name), effective_from, effective_to).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def load_csv(spark: SparkSession, source: str, root: str, sep: str = ",", effective_from=DEFAULT_FROM, effective_to=None) -> list[str]:
    """Loads ``source/<table>.csv`` of every seed table into ``root``; returns the tables loaded."""
    names = [n for n in SEED_SCHEMAS if files.exists(spark, f"{source.rstrip('/')}/{n}.csv")]
    write_seed({n: read_csv(spark, f"{source.rstrip('/')}/{n}.csv", n, sep) for n in names}, root, effective_from, effective_to)
    return names


def read_seed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
            for name, schema in schemas.SEED_STORED.items()}

"""Catalog listing and ad-hoc parameterised SQL over the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Register each DataFrame as a temp view under its table name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def list_tables(spark: SparkSession) -> list[str]:
    """Names of the tables and views visible in the current catalog."""
    return sorted(t.name for t in spark.catalog.listTables())


def run_sql(spark: SparkSession, text: str, args=None) -> DataFrame:
    """Run SQL with named (dict) or positional (list) parameter bindings."""
    return spark.sql(text, args=args) if args is not None else spark.sql(text)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table chosen by name (P12) — ``IDENTIFIER(:t)`` in SQL."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": name})

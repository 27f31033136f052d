"""Proxy tables on the driver's test data (FIXTURES.md §2).

The reference ships no daily files, so its inputs are stood in for by tables
derived from `events`, `customer` and `nation`. Every proxy is a plain
DataFrame expression over those tables, so its size follows them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions.constants import OPEN_END, RESULT_REJECT, RESULT_SUCCESS

# --- fixed values of the proxy definition (must agree with oracle_sql.py) ---
PROXY_START = "2024-01-01"
TERMINAL_MOVE = "2024-01-16 00:00:00"
FIRST_NAME = "Proxy"
PATRONYMIC = "Testovich"
PHONE = "+0 000 000-00-00"


@dataclass
class Tables:
    transactions: DataFrame
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    blacklist: DataFrame
    terminals: DataFrame


# Columns of the driver's tables that the proxies read (declared, so no
# footer inference per read).
RAW_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = RAW_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    return ev.select(
        _s("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp_ntz").alias("transaction_date"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.concat(F.lit("C"), _s("user_id"), F.lit("-"), _s(F.col("event_id") % 3)).alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type") == "purchase", F.lit(RESULT_SUCCESS))
         .otherwise(F.lit(RESULT_REJECT)).alias("oper_result"),
        # json_tuple: one streaming parse of props per row (cheapest JSON path)
        F.json_tuple("props", "k").alias("_k"),
    ).withColumn("terminal", _s(F.col("_k").cast("int"))).drop("_k")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    c = c.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return c.select(
        F.concat(F.lit("C"), _s("c_custkey"), F.lit("-"), _s("i")).alias("card_num"),
        F.concat(F.lit("A"), _s("c_custkey"), F.lit("-"),
                 F.when(F.col("i") == 2, F.lit("1")).otherwise(F.lit("0"))).alias("account"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    c = c.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    return c.select(
        F.concat(F.lit("A"), _s("c_custkey"), F.lit("-"), _s("i")).alias("account"),
        F.date_add(F.lit(PROXY_START).cast("date"),
                   ((F.col("c_custkey") * 7 + F.col("i") * 30) % 90).cast("int")).alias("valid_to"),
        _s("c_custkey").alias("client"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        _s("c_custkey").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.lit(FIRST_NAME).alias("first_name"),
        F.lit(PATRONYMIC).alias("patronymic"),
        F.concat(F.lit("P"), _s("c_custkey")).alias("passport_num"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit(PROXY_START).cast("date"), (F.col("c_custkey") % 60).cast("int")))
         .alias("passport_valid_to"),
        F.lit(PHONE).alias("phone"),
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    shifts = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0)))
    c = c.withColumn("shift", F.explode(shifts))
    return c.select(
        F.date_add(F.lit(PROXY_START).cast("date"),
                   (F.col("c_custkey") % 30 + F.col("shift")).cast("int")).alias("date"),
        F.concat(F.lit("P"), _s("c_custkey")).alias("passport"),
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminal versions: ids k = nation key + 25*j; ids with k % 10 = 0 move city on TERMINAL_MOVE."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = n.withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(4)]))) \
         .withColumn("k", F.col("n_nationkey") + 25 * F.col("j"))
    moves = F.col("k") % 10 == 0
    start = F.lit(f"{PROXY_START} 00:00:00").cast("timestamp_ntz")
    move = F.lit(TERMINAL_MOVE).cast("timestamp_ntz")
    open_end = F.lit(OPEN_END).cast("timestamp_ntz")
    first = k.select(_s("k").alias("terminal_id"), F.col("n_name").alias("terminal_city"),
                     start.alias("effective_from"),
                     F.when(moves, move).otherwise(open_end).alias("effective_to"))
    target = n.select(F.col("n_nationkey").alias("to_key"), F.col("n_name").alias("to_name"))
    moved = (k.where(moves).withColumn("to_key", ((F.col("k") + 1) % 25).cast("int"))
             .join(target, "to_key")
             .select(_s("k").alias("terminal_id"), F.col("to_name").alias("terminal_city"),
                     move.alias("effective_from"), open_end.alias("effective_to")))
    return first.unionByName(moved)


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        transactions=transactions(spark, sf_dir), cards=cards(spark, sf_dir),
        accounts=accounts(spark, sf_dir), clients=clients(spark, sf_dir),
        blacklist=blacklist(spark, sf_dir), terminals=terminals(spark, sf_dir),
    )


def event_days(spark: SparkSession, sf_dir: str):
    """First and last calendar day of the operations (one aggregate row)."""
    r = (_read(spark, sf_dir, "events")
         .agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1")).first())
    return r["d0"], r["d1"]


def terminal_snapshots(versions: DataFrame, d0, d1) -> DataFrame:
    """Daily terminal lists (one row per terminal and day it is valid), days d0..d1.

    Each version expands to its own days (explode of a date sequence), so the
    output is exactly the snapshot rows; no join with a calendar.
    """
    lo = F.greatest(F.to_date("effective_from"), F.lit(d0).cast("date"))
    # effective_to is exclusive: the version's last day is the day before it
    # when it ends at midnight.
    last = F.to_date(F.col("effective_to") - F.expr("INTERVAL 1 MICROSECOND"))
    hi = F.least(last, F.lit(d1).cast("date"))
    v = versions.where(lo <= hi)
    return v.select("terminal_id", "terminal_city",
                    F.explode(F.sequence(lo, hi)).alias("load_date"))

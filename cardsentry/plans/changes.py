"""Which report days a changed blacklist or terminal list touches.

Beside the mart lies what it was built with: the first block date of every passport and the live terminal versions
(``mart_dims``). After new sheets these are compared with the present ones by key. Operations of passports whose
first block date moved, between the old and the new date, and operations whose city is another one now, tell the days
to rebuild; no other day's rows can differ. Only operations of changed passports and terminals are joined; what comes
back to the driver are days.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions.timecols import ntz
from cardsentry.operators.enrich import blocked_from
from cardsentry.sources import files

TS = "transaction_date"
BLOCKED = "passport string, blocked_from date"
VERSIONS = "terminal_id string, terminal_city string, effective_from timestamp_ntz, effective_to timestamp_ntz"


def _dims(tables) -> dict[str, DataFrame]:
    versions = tables.terminals.select("terminal_id", "terminal_city", "effective_from", "effective_to")
    return {"blocked": blocked_from(tables.blacklist).where("passport IS NOT NULL"), "versions": versions}


def known(spark: SparkSession, root: str) -> bool:
    """Whether it is known what the mart was built with."""
    if not files.exists(spark, root) and files.exists(spark, f"{root}_old"):
        files.rename(spark, f"{root}_old", root)        # a swap was interrupted
    return files.exists(spark, root)


def store(spark: SparkSession, root: str, tables) -> None:
    """Keeps what the mart has been built with: written beside, then swapped in."""
    fresh, old = f"{root}_next-{uuid.uuid4().hex[:8]}", f"{root}_old"
    for name, df in _dims(tables).items():
        df.write.parquet(f"{fresh}/{name}")
    files.delete(spark, old)
    if files.exists(spark, root):
        files.rename(spark, root, old)
    if not files.rename(spark, fresh, root):
        raise OSError(f"cannot move {fresh} to {root}")
    files.delete(spark, old)


def moved_passports(before: DataFrame, now: DataFrame) -> DataFrame:
    """(passport, since, until): operations after midnight of `since` and not after midnight of `until` are judged
    anew; no end where the passport is blocked in one of the two only."""
    both = before.select("passport", F.col("blocked_from").alias("a")).join(now.select("passport", F.col("blocked_from").alias("b")), "passport", "full_outer")
    until = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.greatest("a", "b"))
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("passport", F.least("a", "b").alias("since"), until.alias("until"))


def _cities(operations: DataFrame, versions: DataFrame) -> DataFrame:
    """(transaction_id, time, terminal_city): the versions valid at the operations' times."""
    valid = (F.col("terminal") == F.col("terminal_id")) & (F.col(TS) >= F.col("effective_from")) & (F.col(TS) < F.col("effective_to"))
    return operations.join(versions, valid).select("transaction_id", TS, "terminal_city")


def touched_days(spark: SparkSession, root: str, tables, around: dt.timedelta) -> set[dt.date]:
    """Days whose reports may differ from those built with the stored dimensions; ``around``: the longest time by
    which one operation's city matters to another."""
    now = _dims(tables)
    blocked, versions = spark.read.schema(BLOCKED).parquet(f"{root}/blocked"), spark.read.schema(VERSIONS).parquet(f"{root}/versions")

    moved = moved_passports(blocked, now["blocked"])
    holders = tables.clients.select("client_id", "passport_num").join(moved, F.col("passport_num") == F.col("passport"))
    holders = holders.join(tables.accounts.select("account", "client"), F.col("client") == F.col("client_id"))
    moved_cards = holders.join(tables.cards.select("card_num", "account"), "account").select("card_num", "since", "until")
    operations = tables.transactions.select("transaction_id", TS, "card_num", "terminal")
    judged = operations.join(moved_cards, "card_num").where(
        (F.col(TS) > F.col("since").cast("timestamp_ntz")) & (F.col("until").isNull() | (F.col(TS) <= F.col("until").cast("timestamp_ntz"))))

    gone, come = versions.exceptAll(now["versions"]), now["versions"].exceptAll(versions)
    changed = gone.union(come).select(F.col("terminal_id").alias("terminal")).distinct()
    there = operations.join(changed, "terminal", "left_semi")
    only = lambda v: v.join(changed, v["terminal_id"] == changed["terminal"], "left_semi")
    a, b = _cities(there, only(versions)), _cities(there, only(now["versions"]))
    placed = a.exceptAll(b).union(b.exceptAll(a))
    # the city of an operation also matters to its account's operations shortly before and after
    gap = F.lit(around)
    near = placed.select(F.explode(F.array(F.to_date(F.col(TS) - gap), F.to_date(TS), F.to_date(F.col(TS) + gap))).alias("day"))
    days = judged.select(F.to_date(TS).alias("day")).union(near).distinct()
    return {r["day"] for r in days.collect()}


def of_days(operations: DataFrame, days: list[dt.date], lookback: dt.timedelta) -> DataFrame:
    """Operations of the days, and those up to `lookback` before them."""
    wanted = [F.lit(d.isoformat()).cast("date") for d in days]
    lo, hi = min(days), max(days) + dt.timedelta(days=1)
    some = operations.where((F.col(TS) >= ntz(dt.datetime.combine(lo, dt.time()) - lookback)) & (F.col(TS) < ntz(dt.datetime.combine(hi, dt.time()))))
    if len(days) == (hi - lo).days:
        return some
    return some.where(F.to_date(TS).isin(wanted) | F.to_date(F.col(TS) + F.lit(lookback)).isin(wanted))

"""AQE splits a hot account's partitions in the sort-merge plans (no broadcast).

Skew splitting divides a reduce partition by ranges of map tasks, so the
input here is spread over several partitions (as any large input is)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.operators import rules, sizing
from cardsentry.operators.enrich import enrich_narrow
from cardsentry.plans import report
from conftest import World

SETTINGS = {
    "spark.cardsentry.broadcastMaxBytes": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
}


@pytest.fixture
def skew_conf(spark):
    prev = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in prev.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_operations(spark):
    base = dt.datetime(2024, 3, 1)
    cards = ["0002", "0003", "0004", "0005", "0011"]
    rows = []
    for i in range(9000):
        card = "0001" if i % 3 == 0 else cards[i % 5]           # one account: a third of all rows
        rows.append((f"{i:06d}", base + dt.timedelta(seconds=29 * i), Decimal(100 + i % 7), f"1000 0000 0000 {card}",
                     "pay", "SUCCESS" if i % 4 == 0 else "REJECT", ["T1", "T2", "T3"][i % 3]))
    return spark.createDataFrame(rows, schemas.TRANSACTIONS).repartition(8)


def test_hot_account_is_split_and_results_unchanged(spark, skew_conf):
    world = World(spark)
    tx = _hot_operations(spark)
    ev = world.enriched(tx)
    r3 = rules.different_cities(ev, world.terminals, report_dt="2024-04-01")
    got = sorted(map(tuple, r3.collect()))
    plan = r3._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    for k in SETTINGS:
        spark.conf.unset(k)
    want = sorted(map(tuple, rules.different_cities(world.enriched(tx), world.terminals,
                                                    report_dt="2024-04-01").collect()))
    assert got == want and len(got) > 0


def test_hot_card_and_hot_client_are_joined_in_shares(spark, monkeypatch):
    """A key whose rows compress well is below AQE's threshold and was one task, for operations and for hits."""
    world, tx = World(spark), _hot_operations(spark)
    world.with_blacklist([("2024-02-01", "1111 000001")])
    world.transactions = tx
    whole = sorted(map(tuple, report.build_report(world, report_dt="2024-04-01").collect()))
    monkeypatch.setattr(sizing, "HOT_ROWS", 250)
    monkeypatch.setattr(sizing, "DEFAULT_LIMIT", "100b")  # no dimension is broadcast
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, {"spark.sql.adaptive.enabled": "false"}.get(key, "-1"))
    try:
        ev = enrich_narrow(tx, world.cards, world.accounts, world.clients)
        most = lambda df: max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert ev.count() == 9000 and most(ev) < 2600  # one card has 3,600 of 9,000 operations
        r1 = rules.profile_rules(enrich_narrow(tx, world.cards, world.accounts, world.clients, blacklist=world.blacklist), report_dt="2024-04-01")
        shares = report.client_shares(ev, world.clients)
        assert {r["_key"] for r in shares.collect()} >= {"1"}
        hits = report.attach_clients(r1, world.clients, shares)
        assert hits.count() == r1.count() and most(hits) < 0.6 * r1.where("client_id = '1'").count()
        assert sorted(map(tuple, report.build_report(world, report_dt="2024-04-01").collect())) == whole and whole
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)

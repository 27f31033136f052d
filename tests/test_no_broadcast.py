"""The plans used beyond the broadcast limit (sort-merge joins, AQE skew
splitting) give the same rows as the broadcast plans."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# The hot-account report covers every rule of the report plan; the mart adds the
# day horizon; terminal history the calendar join.
KEYS = ["fraud_report_hot_account", "daily_mart", "terminal_history"]


@pytest.fixture
def no_broadcast(spark):
    prev = {k: spark.conf.get(k, None) for k in ("spark.cardsentry.broadcastMaxBytes",
                                                 "spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    yield lambda: [spark.conf.set(k, "-1") for k in prev]
    for k, v in prev.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_without_broadcast(spark, no_broadcast, key):
    with_bc = sorted(map(tuple, E.queries()[key](spark, SF).collect()))
    no_broadcast()
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, df.collect())) == with_bc

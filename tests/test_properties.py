"""Rule forms against brute force on random small fixtures, and hot-key shapes."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.functions.timecols import epoch_us
from cardsentry.operators import rules
from conftest import World

CARDS = ["0001", "0011", "0002", "0005", "0004"]
TERMS = ["T1", "T2", "T3", "TM", "TN", None, "T9"]


def _random_tx(spark, seed, n=400, span_h=30):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 3, 1, 20, 0, 0)
    rows = []
    for i in range(n):
        t = t0 + dt.timedelta(seconds=rnd.randrange(span_h * 3600))
        if rnd.random() < 0.1 and rows:         # exact ties and exact 20 min / 1 h offsets
            base = rows[rnd.randrange(len(rows))][1]
            t = base + rnd.choice([dt.timedelta(0), dt.timedelta(minutes=20), dt.timedelta(hours=1)])
        rows.append((f"{i:05d}", t, Decimal(rnd.randrange(1, 60)), f"1000 0000 0000 {rnd.choice(CARDS)}",
                     "pay", rnd.choice(["REJECT", "REJECT", "SUCCESS"]), rnd.choice(TERMS)))
    return spark.createDataFrame(rows, schemas.TRANSACTIONS)


def _brute_r3(world, ev, within_s):
    from cardsentry.operators.enrich import with_city
    pdf = with_city(ev, world.terminals).toPandas()
    pdf = pdf[pdf.terminal_city.notna()]
    out = set()
    for _, a in pdf.iterrows():
        same = pdf[(pdf.account == a.account) & (pdf.terminal_city != a.terminal_city)]
        if ((same.transaction_date - a.transaction_date).abs() < dt.timedelta(seconds=within_s)).any():
            out.add((a.transaction_date.to_pydatetime(), a.passport_num))
    return out


def _brute_r4(ev, within_s, min_ops=4):
    pdf = ev.toPandas().sort_values(["account", "transaction_date", "transaction_id"])
    out = []
    for _, g in pdf.groupby("account"):
        g = g.reset_index(drop=True)
        for i in range(min_ops - 1, len(g)):
            c = g.iloc[i - min_ops + 1: i + 1]
            res = list(c.oper_result)
            amt = list(c.amount)
            if (res[-1] == "SUCCESS" and all(r == "REJECT" for r in res[:-1])
                    and all(amt[k] > amt[k + 1] for k in range(min_ops - 1))
                    and (c.transaction_date.iloc[-1] - c.transaction_date.iloc[0]) < dt.timedelta(seconds=within_s)):
                out.append((g.transaction_date.iloc[i].to_pydatetime(), g.passport_num.iloc[i]))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_r3_semi_join_equals_brute_force_and_range_window(spark, seed):
    world = World(spark)
    ev = world.enriched(_random_tx(spark, seed))
    ours = {(r[0], r[1]) for r in rules.different_cities(ev, world.terminals, report_dt="2024-04-01")
            .select("event_dt", "passport").collect()}
    assert ours == _brute_r3(world, ev, 3600)
    # the range-window form (min(city) != max(city) over +-(L-1) us) gives the same rows
    from cardsentry.operators.enrich import with_city
    L = 3_600_000_000
    w = Window.partitionBy("account").orderBy("_us").rangeBetween(-(L - 1), L - 1)
    wc = (with_city(ev, world.terminals).where(F.col("terminal_city").isNotNull())
          .withColumn("_us", epoch_us("transaction_date"))
          .withColumn("_lo", F.min("terminal_city").over(w)).withColumn("_hi", F.max("terminal_city").over(w))
          .where(F.col("_lo") != F.col("_hi"))
          .select("transaction_date", "passport_num").distinct())
    assert ours == {(r[0], r[1]) for r in wc.collect()}


@pytest.mark.parametrize("seed,within", [(3, "20 minutes"), (4, "3 hours")])
def test_r4_bucketed_equals_brute_force(spark, seed, within):
    world = World(spark)
    ev = world.enriched(_random_tx(spark, seed, n=600, span_h=6))
    from cardsentry.functions.timecols import duration_us
    secs = duration_us(within) // 1_000_000
    expect = _brute_r4(ev, secs)
    for lag_bucket in ("1 second", "1 minute", "3650 days"):
        got = sorted((r[0], r[1]) for r in rules.amount_probing(ev, within=within, lag_bucket=lag_bucket)
                     .select("event_dt", "passport").collect())
        assert got == expect


def test_hot_account_spreads_over_buckets(spark):
    """One account holding most rows: the R4 window is partitioned by (account, bucket)."""
    world = World(spark)
    base = dt.datetime(2024, 3, 1)
    rows = [(f"{i:06d}", base + dt.timedelta(seconds=37 * i), Decimal(1000 - (i % 5) * 10),
             "1000 0000 0000 0001", "pay", "SUCCESS" if i % 5 == 4 else "REJECT", "T1" if i % 2 else "T2")
            for i in range(6000)]
    ev = world.enriched(spark.createDataFrame(rows, schemas.TRANSACTIONS))
    r4 = rules.amount_probing(ev, within="20 minutes")
    plan = r4._jdf.queryExecution().executedPlan().toString()
    assert "_sb" in plan                        # window partitioned by the time sub-bucket too
    assert r4.count() == 6000 // 5              # every 5th op closes a 5-op chain
    r3 = rules.different_cities(ev, world.terminals)
    assert r3.count() == 6000                   # alternating cities 37 s apart


def test_probing_window_groups_hold_two_buckets(spark):
    """The largest window group of a hot account is bounded by the rows of two time buckets."""
    from cardsentry.operators import sequence
    n, step, within = 20_000, 30, 1200
    df = spark.range(n).selectExpr("CASE WHEN id >= 0 THEN 'hot' END AS k", f"id * {step}000000 AS us", "lpad(id, 6, '0') AS id", "'wide' AS name", "id AS v")
    width = within * 1_000_000
    bucket = sequence.floor_div(F.col("us"), width)
    groups = df.select(F.explode(F.array(bucket, bucket + 1)).alias("b")).groupBy("b").count().agg(F.max("count")).first()[0]
    assert groups <= 2 * within // step
    got = sequence.near_lags(df, "k", "us", "id", ["v"], 3, width)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and re.search(r"hashpartitioning\(k#\d+, _sb#\d+L", plan)
    rows = got.orderBy("us").collect()
    assert len(rows) == n and all(r.name == "wide" for r in rows)
    assert all(r["_lag1_v"] == r.v - 1 and r["_lag3_v"] == r.v - 3 for r in rows[3:])


@pytest.mark.parametrize("bucket_s", [1, 5, 60, 10**8])
def test_sequence_lags_equal_plain_window_lags(spark, bucket_s):
    from cardsentry.operators.sequence import lag_name, sequence_lags
    rnd = random.Random(bucket_s)
    rows = []
    for i in range(3000):
        key = rnd.choice(["hot"] * 8 + ["a", "b", "c"])
        rows.append((key, rnd.randrange(0, 400) * 1_000_000 + rnd.choice([0, 0, 1]), f"{i:05d}", rnd.random()))
    df = spark.createDataFrame(rows, "k string, us long, id string, v double")
    got = sequence_lags(df, "k", "us", "id", ["v", "id"], 3, bucket_s * 1_000_000)
    w = Window.partitionBy("k").orderBy("us", "id")
    want = df.withColumns({lag_name(c, j): F.lag(c, j).over(w) for j in (1, 2, 3) for c in ("v", "id")})
    cols = ["k", "us", "id"] + [lag_name(c, j) for j in (1, 2, 3) for c in ("v", "id")]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_sequence_lags_with_nulls_old_predecessors_and_few_rows(spark):
    from cardsentry.operators.sequence import lag_name, sequence_lags
    rnd = random.Random(5)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([None, *range(-10**9, 10**9, 10**8)]), f"{i:05d}", rnd.choice([None, 1, 2])) for i in range(400)]
    rows += [("old", 0, "x", 1), ("old", 10**12, "y", 2), ("one", 7, "z", 3)]
    schema = "k string, us long, id string, v int"
    cols = ["k", "us", "id", "v"] + [lag_name(c, j) for j in (1, 2) for c in ("v", "us")]
    w = Window.partitionBy("k").orderBy("us", "id")
    for given in (rows, rows[-1:], [("n", None, "a", 1), ("n", None, "b", 2)], []):
        df = spark.createDataFrame(given, schema)
        want = df.withColumns({lag_name(c, j): F.lag(c, j).over(w) for j in (1, 2) for c in ("v", "us")})
        for fan in (2, 32):
            got = sequence_lags(df, "k", "us", "id", ["v", "us"], 2, 10**7 if fan == 2 else 10**6, fan)
            assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_sequence_lags_groups_stay_small(spark):
    """No collected group of the scan holds more than `fan` summaries, no window more than a bucket and n rows."""
    from cardsentry.operators import sequence
    n, fan, step = 20_000, 8, 1_000_000
    df = spark.range(n).selectExpr("'hot' AS k", f"id * {step} AS us", "lpad(id, 6, '0') AS id", "id AS v")
    placed = df.withColumn("_sb", sequence.floor_div(F.col("us"), 10 * step) + 1)
    carried = sequence._carried(placed, ["k"], ["us", "id", "v"], "us", "id", 3, fan, 4)
    sizes = carried.agg(F.count("*"), F.max(F.size("_carry"))).first()
    assert tuple(sizes) == (n // 10, 3)
    wrong = carried.where("_sb > 1").where("_carry[0].v <> (_sb - 1) * 10 - 1 OR _carry[2].v <> (_sb - 1) * 10 - 3")
    assert wrong.count() == 0
    plan = sequence.sequence_lags(df, "k", "us", "id", ["v"], 3, 10 * step, fan)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and re.search(r"hashpartitioning\(k#\d+, _sb#\d+L", plan)


def test_epoch_us_exact_in_any_session_zone(spark):
    from cardsentry.functions.timecols import epoch_us
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 30),), (dt.datetime(2024, 3, 10, 3, 30),),
                                (dt.datetime(1969, 12, 31, 23, 59, 59, 999999),)], "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # DST starts 2024-03-10 02:00
        got = [r[0] for r in df.select(epoch_us("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got[1] - got[0] == 2 * 3_600_000_000
    assert got[2] == -1

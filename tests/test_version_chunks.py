"""Point-in-time cities over chunks of versions: same rows as the range join, bounded candidates."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.operators.enrich import version_chunks, with_city, with_city_chunked
from conftest import ts

T0 = ts("2024-01-01 00:00:00")
EVENTS = "transaction_id string, transaction_date timestamp_ntz, terminal string"


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_chunked_equals_the_range_join(spark):
    rng = random.Random(7)
    versions = []
    for t in range(12):
        at = rng.randrange(0, 50)
        for _ in range(rng.choice([1, 1, 2, 40, 90])):
            to = at + rng.randrange(1, 30)
            versions.append((f"T{t}", rng.choice("ABC"), minutes(at), minutes(to)))
            at = to + rng.choice([0, 0, 0, 7])
        if t % 2:
            versions.append((f"T{t}", "open", minutes(at), ts("9999-12-31 00:00:00")))
    versions += [("T1", "long", minutes(5), minutes(900)), ("T1", "long", minutes(5), minutes(900)), ("T1", "never", minutes(9), minutes(9)), (None, "X", T0, minutes(5)),
                 ("T2", None, minutes(3000), minutes(3001))]
    events = [(str(i), minutes(rng.randrange(-5, 1500)) + dt.timedelta(microseconds=rng.choice([0, 0, 1, -1])), rng.choice([None, "none", *(f"T{t}" for t in range(12))]))
              for i in range(1500)]
    ev, ve = spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, schemas.TERMINALS)
    expected = sorted(map(str, with_city(ev, ve).collect()))
    assert len(expected) > 500
    for chunk in (1, 4, 1000):
        got = with_city_chunked(ev, ve, chunk)
        assert got.columns == with_city(ev, ve).columns
        assert sorted(map(str, got.collect())) == expected


def test_no_operation_meets_more_than_a_chunk(spark):
    versions = spark.range(10_000).select(
        F.lit("T").alias("_tid"), F.col("id").cast("string").alias("terminal_city"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("_tfrom"))
    versions = versions.withColumn("_tto", F.col("_tfrom") + F.expr("INTERVAL '1' MINUTE"))
    starts, dealt = version_chunks(versions, 32)
    assert starts.select(F.size("_starts")).first()[0] == 313
    sizes = dealt.groupBy("_tid", "_chunk").count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= 33 and sizes[1] <= 10_000 + 313


def test_empty_sides(spark):
    ev, ve = spark.createDataFrame([], EVENTS), spark.createDataFrame([], schemas.TERMINALS)
    assert with_city_chunked(ev, ve).count() == 0
    some = spark.createDataFrame([("1", T0, "T")], EVENTS)
    assert with_city_chunked(some, ve).count() == 0

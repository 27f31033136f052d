import datetime as dt

from pyspark.sql import functions as F

from cardsentry.operators import dimensions
from conftest import d, ts

OPEN = ts("9999-12-31 00:00:00")


def _snap(spark, rows):
    return spark.createDataFrame([(k, c, d(x)) for k, c, x in rows], "terminal_id string, terminal_city string, load_date date")


def test_stamp_literals_and_columns(spark):
    df = spark.createDataFrame([("a", ts("2024-03-01 10:00:00"))], "k string, t timestamp_ntz")
    out = dimensions.stamp(df, "2024-03-01 00:00:00", "2024-03-02 00:00:00").first()
    assert out["effective_from"] == ts("2024-03-01 00:00:00")
    assert out["effective_to"] == ts("2024-03-02 00:00:00") and out["deleted_flg"] == 0
    open_ = dimensions.stamp(df, F.to_date("t")).first()
    assert open_["effective_from"] == ts("2024-03-01 00:00:00") and open_["effective_to"] == OPEN


def test_history_change_delete_reappear(spark):
    snap = _snap(spark, [
        ("A", "X", "2024-03-01"), ("A", "X", "2024-03-02"), ("A", "Y", "2024-03-03"), ("A", "Y", "2024-03-04"),
        ("B", "X", "2024-03-01"),                                  # deleted from 03-02 on
        ("C", "Z", "2024-03-01"), ("C", "Z", "2024-03-03"), ("C", "Z", "2024-03-04"),  # gap on 03-02
    ])
    got = sorted(tuple(r) for r in dimensions.history(snap, "terminal_id", ["terminal_city"]).collect())
    assert got == sorted([
        ("A", "X", ts("2024-03-01 00:00:00"), ts("2024-03-03 00:00:00"), 0),
        ("A", "Y", ts("2024-03-03 00:00:00"), OPEN, 0),
        ("B", "X", ts("2024-03-01 00:00:00"), ts("2024-03-02 00:00:00"), 0),
        ("B", "X", ts("2024-03-02 00:00:00"), OPEN, 1),
        ("C", "Z", ts("2024-03-01 00:00:00"), ts("2024-03-02 00:00:00"), 0),
        ("C", "Z", ts("2024-03-02 00:00:00"), ts("2024-03-03 00:00:00"), 1),
        ("C", "Z", ts("2024-03-03 00:00:00"), OPEN, 0),
    ])


def test_apply_snapshot_incremental_equals_history(spark):
    days = [
        [("A", "X"), ("B", "X"), ("C", "Z")],
        [("A", "X"), ("C", "W")],
        [("A", "Y"), ("B", "X"), ("C", "W"), ("D", "Q")],
    ]
    start = dt.date(2024, 3, 1)
    cur = spark.createDataFrame([], "terminal_id string, terminal_city string, effective_from timestamp_ntz, "
                                    "effective_to timestamp_ntz, deleted_flg int")
    rows = []
    for i, snap_rows in enumerate(days):
        day = start + dt.timedelta(days=i)
        snap = spark.createDataFrame(snap_rows, "terminal_id string, terminal_city string")
        cur = dimensions.apply_snapshot(cur, snap, "terminal_id", ["terminal_city"], day.isoformat())
        cur = spark.createDataFrame(cur.collect(), cur.schema)   # keep the test plan small
        rows += [(k, c, day.isoformat()) for k, c in snap_rows]
    full = dimensions.history(_snap(spark, rows), "terminal_id", ["terminal_city"])
    assert sorted(map(tuple, cur.collect())) == sorted(map(tuple, full.collect()))


def test_as_of_picks_valid_version(spark):
    versions = spark.createDataFrame([
        ("T", "X", ts("2024-03-01 00:00:00"), ts("2024-03-02 00:00:00"), 0),
        ("T", "Y", ts("2024-03-02 00:00:00"), OPEN, 0),
    ], "terminal_id string, terminal_city string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg int")
    facts = spark.createDataFrame([("1", "T", ts("2024-03-01 23:59:59")), ("2", "T", ts("2024-03-02 00:00:00")),
                                   ("3", "T", ts("2024-02-01 00:00:00"))], "id string, terminal string, t timestamp_ntz")
    out = sorted(tuple(r) for r in dimensions.as_of(facts, versions, "terminal", "terminal_id", "t")
                 .select("id", "terminal_city").collect())
    assert out == [("1", "X"), ("2", "Y")]

"""The version store: a day writes what it closes and what is open, and an interrupted step leaves no trace."""

import datetime as dt

import pytest

from cardsentry import schemas
from cardsentry.plans import daily
from cardsentry.sources import files, version_store
from cardsentry.sources.version_store import VersionStore
from conftest import ts
from test_daily_state import Drops

OPEN = ts("9999-12-31 00:00:00")
AT = dt.datetime(2024, 3, 1)


def rows(spark, *versions):
    return spark.createDataFrame([(k, c, a, b, 0) for k, c, a, b in versions], schemas.VERSIONS)


def told(store):
    return sorted((r.terminal_id, r.terminal_city, r.effective_from.day, r.effective_to.year) for r in store.read().collect())


def folders(tmp_path, kind):
    return sorted(p.name for p in tmp_path.iterdir() if p.name.startswith(kind))


def test_steps_add_closed_and_replace_open(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path), schemas.VERSIONS)
    assert store.state() is None and store.read().count() == 0
    day = lambda n: ts(f"2024-03-{n:02d} 00:00:00")
    store.advance(rows(spark), rows(spark, ("T", "A", day(1), OPEN)), dt.date(2024, 3, 1), AT)
    first_closed = folders(tmp_path, "closed-")
    store.advance(rows(spark, ("T", "A", day(1), day(2))), rows(spark, ("T", "B", day(2), OPEN)), dt.date(2024, 3, 2), AT)
    assert told(store) == [("T", "A", 1, 2024), ("T", "B", 2, 9999)]
    assert store.state()["through"] == dt.date(2024, 3, 2)
    assert set(first_closed) < set(folders(tmp_path, "closed-")) and len(folders(tmp_path, "open-")) == 1
    from pyspark.sql import functions as F

    store.rebuild(rows(spark, ("T", "C", day(1), day(3)), ("T", "D", day(3), OPEN)), F.col("effective_to") == F.lit(OPEN), dt.date(2024, 3, 3), AT)
    assert told(store) == [("T", "C", 1, 2024), ("T", "D", 3, 9999)]
    assert len(folders(tmp_path, "closed-")) == len(folders(tmp_path, "open-")) == len(list((tmp_path / "state").iterdir())) == 1


def test_an_interrupted_step_is_not_read(spark, tmp_path, monkeypatch):
    store = VersionStore(spark, str(tmp_path), schemas.VERSIONS)
    day = lambda n: ts(f"2024-03-{n:02d} 00:00:00")
    store.advance(rows(spark), rows(spark, ("T", "A", day(1), OPEN)), dt.date(2024, 3, 1), AT)
    step = (rows(spark, ("T", "A", day(1), day(2))), rows(spark, ("T", "B", day(2), OPEN)), dt.date(2024, 3, 2), AT)
    with monkeypatch.context() as m:
        m.setattr(version_store.files, "rename", lambda *a: False)
        with pytest.raises(OSError):
            store.advance(*step)
    assert told(store) == [("T", "A", 1, 9999)]
    with monkeypatch.context() as m:        # the state counts, but old folders are still there
        m.setattr(version_store.files, "delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.advance(*step)
    assert told(store) == [("T", "A", 1, 2024), ("T", "B", 2, 9999)]
    assert len(folders(tmp_path, "open-")) == 3 and store.state()["number"] == 1


def test_many_steps_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(version_store, "MOST_FOLDERS", 3)
    store = VersionStore(spark, str(tmp_path), schemas.VERSIONS)
    for n in range(1, 9):
        old = [("T", f"c{n - 1}", ts(f"2024-03-{n:02d} 00:00:00"), ts(f"2024-03-{n + 1:02d} 00:00:00"))] if n > 1 else []
        store.advance(rows(spark, *old), rows(spark, ("T", f"c{n}", ts(f"2024-03-{n + 1:02d} 00:00:00"), OPEN)), dt.date(2024, 3, n), AT)
        assert len(store.steps()) <= 3 and store.read().count() == n
    assert [c for _, c, _, _ in told(store)] == [f"c{n}" for n in range(1, 9)]


def test_a_day_does_not_write_the_history(spark, tmp_path):
    drops = Drops(spark, tmp_path)
    day = lambda n: f"{n:02d}032024"
    drops.terminals(day(1), {f"T{i}": "A" for i in range(40)})
    daily.load_sheets(spark, drops.layout)
    drops.terminals(day(2), {f"T{i}": "B" for i in range(40)})
    daily.load_sheets(spark, drops.layout)
    store = daily.version_store(spark, drops.layout)
    written = []
    for n in range(3, 6):       # one terminal moves a day
        drops.terminals(day(n), {f"T{i}": f"C{n}" if i == n else "B" if not 3 <= i < n else f"C{i}" for i in range(40)})
        daily.load_sheets(spark, drops.layout)
        last = store.state()
        closed = spark.read.schema(schemas.VERSIONS).parquet(f"{store.root}/{last['closed']}").count()
        written.append((closed, store.open().count(), store.closed().count()))
    assert written == [(1, 40, 41), (1, 40, 42), (1, 40, 43)]
    assert files.exists(spark, f"{store.root}/state")

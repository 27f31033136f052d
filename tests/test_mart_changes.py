"""Late sheets rebuild only the days that they touch, and the mart equals a full rebuild."""

import datetime as dt
import random

import pandas as pd
import pytest

from cardsentry.plans import daily
from cardsentry.plans import report as plan
from conftest import World
from test_daily_state import HEADER, Drops


@pytest.fixture
def drops(spark, tmp_path):
    return Drops(spark, tmp_path)


def day(n):
    return dt.date(2024, 3, n)


def operations(drops, n, rows):
    lines = [f"{i};2024-03-{n:02d} {t};{a};1000 0000 0000 {c};pay;{r};{term}" for i, t, a, c, r, term in rows]
    (drops.drop / f"transactions_{n:02d}032024.txt").write_text("\n".join([HEADER, *lines]) + "\n")


def rebuilt(drops):
    """The mart from all tables at once."""
    t = daily.tables(drops.spark, drops.layout)
    return sorted(tuple(map(str, r)) for r in plan.daily_mart(t).select(*plan.read_mart(drops.spark, drops.layout.mart).columns).collect())


def mart(drops):
    return sorted(tuple(map(str, r)) for r in plan.read_mart(drops.spark, drops.layout.mart).collect())


def test_late_blacklist_touches_only_the_passports_days(drops):
    drops.terminals("01032024", {"T1": "Springfield", "T2": "Shelbyville"})
    for n in range(1, 8):
        operations(drops, n, [(f"{n}a", "10:00:00", 1, "0001", "SUCCESS", "T1"), *([(f"{n}b", "11:00:00", 1, "0004", "SUCCESS", "T1")] if n in (2, 5) else [])])
    drops.run()
    drops.workbook("passport_blacklist_03032024.xlsx", blacklist={"date": ["2024-03-03"], "passport": ["1111 000004"]})
    assert drops.run() == [day(5)]
    assert mart(drops) == rebuilt(drops) and any("locked passport" in r for r in mart(drops))
    # an earlier date for the same passport touches what lies between; a repeated or later one nothing
    drops.workbook("passport_blacklist_04032024.xlsx", blacklist={"date": ["2024-03-02", "2024-03-06"], "passport": ["1111 000004", "1111 000004"]})
    assert drops.run() == [day(2)]
    assert mart(drops) == rebuilt(drops)
    drops.workbook("passport_blacklist_05032024.xlsx", blacklist={"date": ["2024-03-06"], "passport": ["1111 000004"]})
    assert drops.run() == [] and drops.run() == []
    assert mart(drops) == rebuilt(drops)


def test_late_terminal_list_touches_days_of_moved_cities(drops):
    drops.terminals("01032024", {"T1": "Springfield", "T2": "Springfield"})
    for n in range(1, 8):
        operations(drops, n, [(f"{n}a", "10:00:00", 1, "0001", "SUCCESS", "T1"), *([(f"{n}b", "10:30:00", 1, "0001", "SUCCESS", "T2")] if n in (3, 6) else [])])
    drops.terminals("05032024", {"T1": "Springfield", "T2": "Springfield"})
    drops.run()
    assert not [r for r in mart(drops) if "different cities" in str(r)]
    drops.terminals("02032024", {"T1": "Springfield", "T2": "Shelbyville"})     # late: T2 was elsewhere from 2 to 5 March
    assert drops.run() == [day(3)]
    assert mart(drops) == rebuilt(drops) and len([r for r in mart(drops) if "different cities" in str(r)]) == 2


def test_interrupted_rebuild_is_done_again(drops, monkeypatch):
    for n in (1, 2):
        operations(drops, n, [(f"{n}a", "10:00:00", 1, "0004", "SUCCESS", "T1")])
    drops.terminals("01032024", {"T1": "Springfield"})
    drops.run()
    drops.workbook("passport_blacklist_01032024.xlsx", blacklist={"date": ["2024-03-02"], "passport": ["1111 000004"]})
    with monkeypatch.context() as m:
        m.setattr(plan, "replace_days", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            drops.run()
    assert drops.run() == [day(2)]
    assert mart(drops) == rebuilt(drops) and drops.run() == []


def test_random_sheets_in_any_order_equal_a_full_rebuild(drops):
    rng = random.Random(4)
    cards, terminals, cities = ["0001", "0002", "0003", "0004", "0005"], ["T1", "T2", "T3"], ["Springfield", "Shelbyville"]
    files = []
    for n in range(1, 8):
        rows = [(f"{n}-{i}", f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:00", rng.randrange(1, 9), rng.choice(cards),
                 rng.choice(["SUCCESS", "REJECT"]), rng.choice(terminals)) for i in range(12)]
        files.append(lambda n=n, rows=rows: operations(drops, n, rows))
        listed = {t: rng.choice(cities) for t in terminals if rng.random() < 0.8} or {"T1": cities[0]}
        files.append(lambda n=n, listed=listed: drops.terminals(f"{n:02d}032024", listed))
        black = [(f"2024-03-{rng.randrange(1, 8):02d}", f"1111 00000{rng.randrange(1, 5)}") for _ in range(2)]
        files.append(lambda n=n, black=black: drops.workbook(f"passport_blacklist_{n:02d}032024.xlsx", blacklist={
            "date": [d for d, _ in black], "passport": [p for _, p in black]}))
    rng.shuffle(files)
    while files:
        for _ in range(min(len(files), rng.randint(3, 7))):
            files.pop()()
        drops.run()
        assert mart(drops) == rebuilt(drops)

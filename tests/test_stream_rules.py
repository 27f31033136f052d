"""The detections on a stream: same rows as the batch rules, out of order, after restarts, and without lost rows."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry import schemas
from cardsentry.operators import rules as batch_rules
from cardsentry.operators.enrich import enrich, enrich_narrow
from cardsentry.streaming import arrivals, rules
from conftest import World, d, ts

REPORT_DT = "2024-04-01 00:00:00"
T0 = ts("2024-03-01 10:00:00")


@pytest.fixture(scope="module")
def own(spark):
    s = rules.stream_session(spark)
    s.conf.set("spark.sql.shuffle.partitions", "2")
    return s


@pytest.fixture(scope="module")
def world(own):
    return World(own)


def feed(world, folder, rows):
    """One more file of operations: (id, time, amount, card suffix, result, terminal)."""
    out = [(i, t, Decimal(str(a)), f"1000 0000 0000 {c}", "pay", r, term) for i, t, a, c, r, term in rows]
    world.spark.createDataFrame(out, schemas.TRANSACTIONS).coalesce(1).write.mode("append").parquet(folder)


def narrow(world, stream, blacklist=None):
    return enrich_narrow(stream, world.cards, world.accounts, world.clients, blacklist=blacklist)


def random_operations(seed, n=400):
    rng = random.Random(seed)
    return [(f"t{i:04d}", T0 + dt.timedelta(seconds=rng.randrange(0, 7200), microseconds=rng.randrange(2)), rng.randrange(1, 2000) / 100,
             rng.choice(["0001", "0002", "0011", "0005"]), rng.choices(["REJECT", "SUCCESS"], [3, 1])[0], rng.choice(["T1", "T2", "T3", "TM", "TN", None]))
            for i in range(n)]


def batches(operations, n, seed=0):
    """Operations parted into `n` files, each within an hour of its time order."""
    rng = random.Random(seed)
    by_arrival = sorted(operations, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(0, 3600)))
    size = -(-len(by_arrival) // n)
    return [by_arrival[i : i + size] for i in range(0, len(by_arrival), size)]


def held(query):
    """Rows in the query's state after its last trigger with state."""
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]


def test_probing_out_of_order_with_restarts(spark, own, world, tmp_path):
    operations = random_operations(3, 2500)
    folder, out, state = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "state")

    def run():  # a new query from the stored checkpoint
        stream = rules.operations(own, folder, "2 hours")
        return rules.finish(rules.append(rules.amount_probing(narrow(world, stream), world.clients, within="20 minutes", report_dt=REPORT_DT), out, state))

    for part in batches(operations, 3):
        feed(world, folder, part)
        assert held(run()) > 0
    rules.end_of_feed(own, max(r[1] for r in operations), "2 hours", "20 minutes").write.mode("append").parquet(folder)
    assert held(run()) == 0
    run()  # nothing new: nothing again
    got = Counter(tuple(r) for r in rules.read_hits(own, out, distinct=False).collect())
    expected = batch_rules.amount_probing(enrich(world.tx([]).unionByName(own.createDataFrame(
        [(i, t, Decimal(str(a)), f"1000 0000 0000 {c}", "pay", r, term) for i, t, a, c, r, term in operations], schemas.TRANSACTIONS)),
        world.cards, world.accounts, world.clients), within="20 minutes", report_dt=REPORT_DT).select(*rules.REPORT_COLUMNS)
    assert got == Counter(tuple(r) for r in expected.collect()) and sum(got.values()) > 3


def test_probing_planted_chains(own, world, tmp_path):
    at = lambda m, s=0: T0 + dt.timedelta(minutes=m, seconds=s)
    rows = [(f"a{i}", at(6 * i), 50 - i, "0001", "REJECT" if i < 3 else "SUCCESS", None) for i in range(4)]  # 18 minutes: hit
    rows += [(f"b{i}", at(100 + 20 * i // 3, 20 * (i % 3)), 50 - i, "0002", "REJECT" if i < 3 else "SUCCESS", None) for i in range(4)]  # 20:00: none
    rows += [(f"c{i}", at(i), 50, "0005", "REJECT" if i < 3 else "SUCCESS", None) for i in range(4)]  # equal amounts: none
    rows[7] = ("b3", at(120), *rows[7][2:])
    folder = str(tmp_path / "ops")
    feed(world, folder, rows)
    rules.end_of_feed(own, at(200), "1 hour", "20 minutes").write.mode("append").parquet(folder)
    stream = rules.operations(own, folder, "1 hour", files_per_trigger=1)
    rules.finish(rules.append(rules.amount_probing(narrow(world, stream), world.clients, report_dt=REPORT_DT), str(tmp_path / "hits"), str(tmp_path / "state")))
    assert [r.event_dt for r in rules.read_hits(own, str(tmp_path / "hits")).collect()] == [at(18)]


def test_state_is_as_many_values_as_shares_not_as_accounts(own, world, tmp_path):
    n = 1500
    cards = own.range(n).selectExpr("concat('card', id) AS card_num", "concat('acc', id) AS account")
    accounts = own.range(n).selectExpr("concat('acc', id) AS account", "DATE '2030-01-01' AS valid_to", "'1' AS client")
    rows = [(f"{i}-{k}", T0 + dt.timedelta(minutes=k, microseconds=i), None if (i, k) == (9, 1) else Decimal(50 - k), f"card{i}", "pay",
             "REJECT" if k < 3 else "SUCCESS", None) for i in range(n) for k in range(4 if i < 10 else 1)]
    own.createDataFrame(rows, schemas.TRANSACTIONS).coalesce(1).write.parquet(str(tmp_path / "ops"))

    def run():
        stream = enrich_narrow(rules.operations(own, str(tmp_path / "ops"), "1 hour"), cards, accounts, world.clients)
        return held(rules.finish(rules.append(rules.amount_probing(stream, world.clients, report_dt=REPORT_DT), str(tmp_path / "hits"), str(tmp_path / "state"))))

    assert 0 < run() <= 2 * 2 * rules.SHARES  # a value and a timer for each share in two buckets
    rules.end_of_feed(own, T0, "1 hour", "20 minutes").write.mode("append").parquet(str(tmp_path / "ops"))
    assert run() == 0
    got = sorted(r.event_dt for r in rules.read_hits(own, str(tmp_path / "hits"), distinct=False).collect())
    assert got == [T0 + dt.timedelta(minutes=3, microseconds=i) for i in range(9)]  # not the tenth: an operation without amount


def test_partitions_of_state_follow_cores_and_feed(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "200")
    cores = spark.sparkContext.defaultParallelism
    at = lambda size: int(rules.stream_session(own, size).conf.get("spark.sql.shuffle.partitions"))
    assert at(0) == cores and at((cores + 3) * rules.FEED_BYTES) == cores + 3 and at(10**15) == 200


def test_cities_like_the_batch_rule_and_state_dropped(own, world, tmp_path):
    operations = random_operations(9, 250)
    folder, out, state = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "state")

    def run():
        stream = narrow(world, rules.operations(own, folder, "90 minutes"))
        return held(rules.finish(rules.append(rules.different_cities(stream, world.terminals, world.clients, report_dt=REPORT_DT), out, state)))

    for part in batches(operations, 3):
        feed(world, folder, part)
        last = run()
    assert last > 0
    rules.end_of_feed(own, max(r[1] for r in operations), "90 minutes", "1 hour").write.mode("append").parquet(folder)
    assert run() == 0  # an hour behind the watermark nothing is held
    got = {tuple(r) for r in rules.read_hits(own, out).collect()}
    ops = own.createDataFrame([(i, t, Decimal(str(a)), f"1000 0000 0000 {c}", "pay", r, term) for i, t, a, c, r, term in operations], schemas.TRANSACTIONS)
    expected = batch_rules.different_cities(enrich(ops, world.cards, world.accounts, world.clients), world.terminals, report_dt=REPORT_DT)
    assert got == {tuple(r) for r in expected.select(*rules.REPORT_COLUMNS).collect()} and got


def cities(own, world, folder, out, state, delay, within="1 hour", stream=None, **read):
    """Runs R3 over the files not yet seen; returns the values its state then holds."""
    stream = narrow(world, rules.operations(own, folder, delay, **read)) if stream is None else stream
    return held(rules.finish(rules.append(rules.different_cities(stream, world.terminals, world.clients, within=within, report_dt=REPORT_DT), out, state)))


def test_cities_state_is_as_many_values_as_shares_not_as_operations(own, world, tmp_path):
    n = 1500
    cards = own.range(n).selectExpr("concat('card', id) AS card_num", "concat('acc', id) AS account")
    accounts = own.range(n).selectExpr("concat('acc', id) AS account", "DATE '2030-01-01' AS valid_to", "'1' AS client")
    rows = [(f"{i}-{k}", T0 + dt.timedelta(minutes=30 * k, microseconds=i), Decimal(1), f"card{i}", "pay", "SUCCESS", "T2" if i < 9 and k else "T1")
            for i in range(n) for k in range(2)]
    folder, out, state = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "state")
    own.createDataFrame(rows, schemas.TRANSACTIONS).coalesce(1).write.parquet(folder)

    def run():
        return cities(own, world, folder, out, state, "1 hour", stream=enrich_narrow(rules.operations(own, folder, "1 hour"), cards, accounts, world.clients))

    assert 0 < run() <= 2 * 2 * rules.CITY_SHARES  # a value and a timer for each share in two buckets
    rules.end_of_feed(own, T0, "1 hour", "1 hour").write.mode("append").parquet(folder)
    assert run() == 0
    got = sorted(r.event_dt for r in rules.read_hits(own, out).collect())
    assert got == [T0 + dt.timedelta(minutes=30 * k, microseconds=i) for k in range(2) for i in range(9)]


def test_cities_reported_when_the_partner_comes_and_once(own, world, tmp_path):
    folder, out, state = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "state")
    noon = ts("2024-03-01 12:00:00")  # a border of two buckets
    us = lambda k: dt.timedelta(microseconds=k)
    hour = dt.timedelta(hours=1)
    op = lambda i, t, term, card="0001": (i, t, 1, card, "SUCCESS", term)

    def after(*rows):
        feed(world, folder, rows)
        cities(own, world, folder, out, state, "3 hours")
        return sorted(r.event_dt for r in rules.read_hits(own, out, distinct=False).collect())

    assert after(op("a", noon - us(1), "T1"), op("b", noon - us(2), "T1"), op("x", noon, "T1", "0005")) == []
    first = [noon - us(1), noon + hour - us(2)]
    assert after(op("c", noon + hour - us(2), "T2"), op("y", noon + hour, "T2", "0005")) == first  # b and x: an hour to the microsecond
    assert after(op("d", noon + 2 * hour, "T2")) == first
    assert after(op("e", noon - us(2), "T2")) == sorted(first + [noon - us(2)] * 2)  # b and e
    assert after(op("f", noon + 20 * hour, "T2"), op("g", noon + 18 * hour, "T1")) == sorted(first + [noon - us(2)] * 2)


@pytest.mark.parametrize("within", ["1 hour", "20 hours"])
def test_cities_over_days_and_triggers_like_the_batch_rule(own, world, tmp_path, within):
    rng = random.Random(17)
    operations = [(i, T0 + (t - T0) * 30, a, c, r, term) for i, t, a, c, r, term in random_operations(23, 500)]  # two and a half days
    operations += [(f"n{k}", T0 + dt.timedelta(hours=2, minutes=rng.randrange(-90, 90), microseconds=rng.randrange(3)), 1, "0002", "SUCCESS", rng.choice(["T1", "T2"])) for k in range(40)]
    folder, out, state = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "state")
    for part in batches(operations, 6):
        feed(world, folder, part)
        cities(own, world, folder, out, state, "90 minutes", within)
    rules.end_of_feed(own, max(r[1] for r in operations), "90 minutes", within).write.mode("append").parquet(folder)
    assert cities(own, world, folder, out, state, "90 minutes", within) == 0
    got = Counter(tuple(r) for r in rules.read_hits(own, out, distinct=False).collect())
    ops = own.createDataFrame([(i, t, Decimal(str(a)), f"1000 0000 0000 {c}", "pay", r, term) for i, t, a, c, r, term in operations], schemas.TRANSACTIONS)
    expected = batch_rules.different_cities(enrich(ops, world.cards, world.accounts, world.clients), world.terminals, within=within, report_dt=REPORT_DT)
    assert set(got) == {tuple(r) for r in expected.select(*rules.REPORT_COLUMNS).collect()} and got
    assert sum(got.values()) <= len(operations)


def test_partners_that_are_kept_tell_as_much_as_all():
    rng, span = np.random.default_rng(5), 50
    meeter = rules.Meeter(span)
    for n in (1, 2, 30, 300):
        key, city, us, among = rng.integers(0, 3, n), rng.integers(0, 3, n), rng.integers(-200, 400, n), rng.random(n) < 0.8
        near = (key[:, None] == key) & (city[:, None] != city) & (abs(us[:, None] - us) < span)
        assert (meeter.met(key, city, us) == near.any(axis=1)).all()
        kept = meeter.ends(key, city, us, among)
        assert not (kept & ~among).any() and kept.sum() <= 2 * 3 * 3 * 13
        k, c, u = rng.integers(0, 3, 200), rng.integers(0, 3, 200), rng.integers(-250, 450, 200)
        told = lambda some: ((k[:, None] == key[some]) & (c[:, None] != city[some]) & (abs(u[:, None] - us[some]) < span)).any(axis=1)
        assert (told(kept) == told(among)).all()


def test_blacklist_row_added_between_triggers(own, world, tmp_path):
    folder, out, black = str(tmp_path / "ops"), str(tmp_path / "hits"), str(tmp_path / "black")
    own.createDataFrame([(d("2024-02-01"), "1111 000001")], schemas.BLACKLIST).write.parquet(black)

    def tables(s):
        w = World(s)
        w.blacklist = s.read.schema(schemas.BLACKLIST).parquet(black)
        return w

    def run(*rows):
        feed(world, folder, rows)
        rules.finish(rules.profile_rules(rules.operations(own, folder, "1 day"), tables, out, str(tmp_path / "state"), report_dt=REPORT_DT))
        return sorted((str(r.event_dt), r.passport, r.event_type) for r in rules.read_hits(own, out).collect())

    sound = [("1", ts("2024-03-01 10:00:00"), 1, "0001", "SUCCESS", None), ("2", ts("2024-03-01 10:00:00"), 1, "0004", "SUCCESS", None)]
    first = run(*sound)
    assert first == [("2024-03-01 10:00:00", "1111 000001", "locked passport")]
    own.createDataFrame([(d("2024-02-01"), "1111 000004")], schemas.BLACKLIST).write.mode("append").parquet(black)
    second = run(("3", ts("2024-03-06 10:00:00"), 1, "0004", "SUCCESS", None), ("4", ts("2024-03-06 10:00:00"), 1, "0002", "SUCCESS", None))
    assert second == sorted(first + [("2024-03-06 10:00:00", "1111 000004", "locked passport"), ("2024-03-06 10:00:00", "1111 000004", "invalid_contract"),
                                     ("2024-03-06 10:00:00", "1111 000002", "overdue passport")])


HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"


def test_repeated_and_late_operations_are_accounted_for(own, tmp_path):
    drop, root = tmp_path / "drop", str(tmp_path / "feed")
    drop.mkdir()

    def deliver(name, *rows):
        (drop / name).write_text("\n".join([HEADER, *(f"{i};2024-03-{day:02d} 10:00:00;1.00;c;pay;SUCCESS;T1" for i, day in rows)]) + "\n")

    def run():
        arrivals.run_available(own, str(drop), root, "3 days")
        return Counter({(r.transaction_id, r.status): r.n for r in arrivals.account_for(own, root).collect()})

    arrivals.run_available(own, str(drop), root, "3 days")  # an empty drop folder
    assert arrivals.account_for(own, root).count() == 0
    deliver("transactions_01032024.txt", ("a", 1), ("b", 2), ("a", 1))
    deliver("transactions_01032024-2.txt", ("b", 2), ("c", 10))
    (drop / "transactions_02032024.txt").write_text(f"{HEADER}\nbroken;line\n\n")
    first = Counter({("a", "kept"): 1, ("a", "repeated"): 1, ("b", "kept"): 1, ("b", "repeated"): 1, ("c", "kept"): 1})
    assert run() == first
    deliver("transactions_11032024.txt", ("a", 1), ("e", 7), ("f", 8), ("c", 10), ("g", 12))  # the watermark is at 7 March 10:00
    second = first + Counter({("a", "late"): 1, ("e", "late"): 1, ("f", "kept"): 1, ("c", "repeated"): 1, ("g", "kept"): 1})
    assert run() == second
    assert run() == second  # nothing new
    deliver("transactions_12032024.txt", ("f", 8), ("h", 10), ("g", 12))  # the watermark is at 9 March 10:00
    third = second + Counter({("f", "late"): 1, ("h", "kept"): 1, ("g", "repeated"): 1})
    assert run() == third
    assert sum(third.values()) == 13
    assert own.read.parquet(f"{root}/quarantine").count() == 1

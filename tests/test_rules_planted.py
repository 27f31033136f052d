"""Planted boundary cases of FIXTURES.md §3 for the five detections."""

import datetime as dt

from pyspark.sql import functions as F

from cardsentry.functions import constants as C
from cardsentry.operators import rules
from cardsentry.schemas import REPORT_COLUMNS
from conftest import ts

RDT = "2024-04-01 00:00:00"


def _events(df):
    return sorted((r["event_dt"], r["passport"]) for r in df.collect())


# ----------------------------------------------------------------- R1A ----

def test_r1a_block_date_midnight_is_strict(world):
    world.with_blacklist([("2024-03-01", "1111 000001")])
    ev = world.enriched(world.tx([
        ("1", "2024-03-01 00:00:00", 10, "0001", "SUCCESS", "T1"),
        ("2", "2024-03-01 00:00:01", 10, "0001", "SUCCESS", "T1"),
    ]))
    out = rules.locked_passport(ev, world.blacklist, report_dt=RDT)
    assert _events(out) == [(ts("2024-03-01 00:00:01"), "1111 000001")]
    assert out.columns == REPORT_COLUMNS
    assert out.first()["event_type"] == C.EVENT_LOCKED


def test_r1a_passport_listed_three_days_reported_once(world):
    world.with_blacklist([("2024-02-01", "1111 000001"), ("2024-02-02", "1111 000001"),
                          ("2024-02-03", "1111 000001")])
    ev = world.enriched(world.tx([("1", "2024-03-01 10:00:00", 10, "0001", "SUCCESS", "T1")]))
    assert rules.locked_passport(ev, world.blacklist, report_dt=RDT).count() == 1
    # the same through the folded profile column
    ev2 = world.enriched(world.tx([("1", "2024-03-01 10:00:00", 10, "0001", "SUCCESS", "T1")]),
                         blacklist=True)
    assert rules.locked_passport(ev2, report_dt=RDT).count() == 1


def test_r1a_min_blacklist_equals_raw_join(world):
    world.with_blacklist([("2024-03-02", "1111 000001"), ("2024-02-01", "1111 000001"),
                          ("2024-03-05", "1111 000002")])
    ev = world.enriched(world.tx([
        ("1", "2024-02-15 10:00:00", 10, "0001", "SUCCESS", "T1"),
        ("2", "2024-03-03 10:00:00", 10, "0001", "SUCCESS", "T1"),
        ("3", "2024-03-04 10:00:00", 10, "0002", "SUCCESS", "T1"),
        ("4", "2024-03-06 10:00:00", 10, "0002", "SUCCESS", "T1"),
    ]))
    ours = set(_events(rules.locked_passport(ev, world.blacklist, report_dt=RDT)))
    raw = (ev.join(world.blacklist, ev.passport_num == world.blacklist.passport)
             .where(F.col("transaction_date") > F.col("date").cast("timestamp_ntz"))
             .select("transaction_date", "passport_num").distinct().collect())
    assert ours == {(r[0], r[1]) for r in raw}
    assert len(ours) == 3


# ----------------------------------------------------------- R1B, R2 ----

def test_r1b_r2_expiry_midnight_null_and_vip(world):
    ev = world.enriched(world.tx([
        ("1", "2024-03-05 00:00:00", 10, "0002", "SUCCESS", "T1"),   # client 2 passport expires 03-05
        ("2", "2024-03-05 00:00:01", 10, "0002", "SUCCESS", "T1"),
        ("3", "2024-06-01 00:00:00", 10, "0003", "SUCCESS", "T1"),   # NULL passport expiry; account expired
        ("4", "2024-03-05 00:00:00", 10, "0004", "SUCCESS", "T1"),   # VIP-1 account expires 03-05
        ("5", "2024-03-05 00:00:01", 10, "0004", "SUCCESS", "T1"),
    ]))
    r1b = _events(rules.overdue_passport(ev, report_dt=RDT))
    assert r1b == [(ts("2024-03-05 00:00:01"), "1111 000002")]
    r2 = _events(rules.invalid_contract(ev, report_dt=RDT))
    assert r2 == [(ts("2024-03-05 00:00:01"), "1111 000004"), (ts("2024-06-01 00:00:00"), "1111 000003")]


def test_distinct_collapses_same_second(world):
    ev = world.enriched(world.tx([
        ("1", "2024-03-06 10:00:00", 10, "0002", "SUCCESS", "T1"),
        ("2", "2024-03-06 10:00:00", 20, "0002", "REJECT", "T2"),
    ]))
    assert rules.overdue_passport(ev, report_dt=RDT).count() == 1


def test_profile_rules_single_pass_equals_separate_rules(world):
    world.with_blacklist([("2024-03-01", "1111 000001"), ("2024-03-01", "1111 000002")])
    txs = world.tx([
        ("1", "2024-03-06 10:00:00", 10, "0002", "SUCCESS", "T1"),
        ("2", "2024-03-06 11:00:00", 20, "0001", "REJECT", "T2"),
        ("3", "2024-03-06 12:00:00", 20, "0004", "REJECT", "T2"),
        ("4", "2024-02-06 12:00:00", 20, "0003", "REJECT", "T2"),
    ])
    ev = world.enriched(txs, blacklist=True)
    one = sorted(map(tuple, rules.profile_rules(ev, report_dt=RDT).collect()))
    sep = (rules.locked_passport(ev, report_dt=RDT).unionByName(rules.overdue_passport(ev, report_dt=RDT))
           .unionByName(rules.invalid_contract(ev, report_dt=RDT)))
    assert one == sorted(map(tuple, sep.collect()))
    assert len(one) == 4


# ------------------------------------------------------------------ R3 ----

def _r3(world, rows, **kw):
    ev = world.enriched(world.tx(rows))
    return _events(rules.different_cities(ev, world.terminals, report_dt=RDT, **kw))


def test_r3_just_under_and_exactly_one_hour(world):
    under = _r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                        ("2", "2024-03-01 10:59:59", 1, "0001", "SUCCESS", "T2")])
    assert len(under) == 2
    exact = _r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                        ("2", "2024-03-01 11:00:00", 1, "0001", "SUCCESS", "T2")])
    assert exact == []


def test_r3_same_city_or_other_account(world):
    assert _r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                       ("2", "2024-03-01 10:10:00", 1, "0001", "SUCCESS", "T3")]) == []
    # other city, but on another account of the same client
    assert _r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                       ("2", "2024-03-01 10:10:00", 1, "0005", "SUCCESS", "T2")]) == []
    # two cards of one account count as one account
    assert len(_r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                           ("2", "2024-03-01 10:10:00", 1, "0011", "SUCCESS", "T2")])) == 2


def test_r3_moved_terminal_point_in_time(world):
    rows = [("1", "2024-03-01 23:30:00", 1, "0001", "SUCCESS", "TM"),
            ("2", "2024-03-02 00:10:00", 1, "0001", "SUCCESS", "TM")]
    # point in time: Springfield then Shelbyville, 40 min apart -> both
    assert len(_r3(world, rows)) == 2
    one_per_day = [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "TM"),
                   ("2", "2024-03-02 10:00:00", 1, "0001", "SUCCESS", "TM")]
    assert _r3(world, one_per_day) == []
    # key-only join: every version matches, an operation pairs with itself
    assert len(_r3(world, one_per_day, point_in_time=False)) == 2


def test_r3_pair_across_midnight_lookback(world):
    rows = [("1", "2024-03-01 23:50:00", 1, "0001", "SUCCESS", "T1"),
            ("2", "2024-03-02 00:10:00", 1, "0001", "SUCCESS", "T2")]
    assert _r3(world, rows, window="2024-03-02", lookback=0) == []
    assert _r3(world, rows, window="2024-03-02", lookback="1 hour") == [(ts("2024-03-02 00:10:00"), "1111 000001")]
    # the earlier day's run does not see the next day
    assert _r3(world, rows, window="2024-03-01", lookback="1 hour") == []


def test_r3_null_or_unknown_terminal_not_considered(world):
    assert _r3(world, [("1", "2024-03-01 10:00:00", 1, "0001", "SUCCESS", "T1"),
                       ("2", "2024-03-01 10:10:00", 1, "0001", "SUCCESS", None),
                       ("3", "2024-03-01 10:20:00", 1, "0001", "SUCCESS", "T9"),
                       ("4", "2024-03-01 10:30:00", 1, "0001", "SUCCESS", "TN")]) == []


# ------------------------------------------------------------------ R4 ----

def _chain(start, amounts, results, card="0001", step_s=60):
    t0 = dt.datetime.fromisoformat(start)
    out = []
    for i, (a, r) in enumerate(zip(amounts, results)):
        out.append((f"{start[-8:]}-{i}", (t0 + dt.timedelta(seconds=step_s * i)).isoformat(" "), a, card, r, "T1"))
    return out


def _r4(world, rows, **kw):
    ev = world.enriched(world.tx(rows))
    return _events(rules.amount_probing(ev, report_dt=RDT, **kw))


R, S = "REJECT", "SUCCESS"


def test_r4_chain_inside_and_at_twenty_minutes(world):
    inside = [("a", "2024-03-01 10:00:00", 400, "0001", R, "T1"),
              ("b", "2024-03-01 10:05:00", 300, "0001", R, "T1"),
              ("c", "2024-03-01 10:10:00", 200, "0001", R, "T1"),
              ("d", "2024-03-01 10:19:59", 100, "0001", S, "T1")]
    assert _r4(world, inside) == [(ts("2024-03-01 10:19:59"), "1111 000001")]
    at = inside[:3] + [("d", "2024-03-01 10:20:00", 100, "0001", S, "T1")]
    assert _r4(world, at) == []


def test_r4_chain_of_three_and_five(world):
    assert _r4(world, _chain("2024-03-01 10:00:00", [300, 200, 100], [R, R, S])) == []
    five = _chain("2024-03-01 10:00:00", [500, 400, 300, 200, 100], [R, R, R, R, S])
    assert _r4(world, five) == [(ts("2024-03-01 10:04:00"), "1111 000001")]


def test_r4_equal_amounts_or_success_inside(world):
    assert _r4(world, _chain("2024-03-01 10:00:00", [400, 300, 300, 100], [R, R, R, S])) == []
    assert _r4(world, _chain("2024-03-01 10:00:00", [400, 300, 200, 100], [R, S, R, S])) == []


def test_r4_other_accounts_between(world):
    mine = _chain("2024-03-01 10:00:00", [400, 300, 200, 100], [R, R, R, S], step_s=120)
    other = _chain("2024-03-01 10:01:00", [1, 2, 3, 4], [S, S, S, S], card="0002", step_s=120)
    assert _r4(world, mine + other) == [(ts("2024-03-01 10:06:00"), "1111 000001")]


def test_r4_null_terminal_unaffected(world):
    rows = [(a, b, c, card, r, None) for a, b, c, card, r, _ in
            _chain("2024-03-01 10:00:00", [400, 300, 200, 100], [R, R, R, S])]
    assert len(_r4(world, rows)) == 1


def test_r4_stitched_lags_match_plain_lags(world):
    # chains straddling bucket edges (20-minute buckets) and long runs
    rows = []
    for k, start in enumerate(["2024-03-01 10:15:00", "2024-03-01 10:38:00", "2024-03-01 23:55:00"]):
        rows += _chain(start, [900, 800, 700, 600, 500, 400], [R, R, R, R, R, S], step_s=100)
    plain = _r4(world, rows, lag_bucket="3650 days")
    assert _r4(world, rows) == plain
    assert _r4(world, rows, lag_bucket="7 seconds") == plain
    assert len(plain) == 3


def test_r4b_three_step_reports_middle(world):
    rows = [("a", "2024-03-01 10:00:00", 300, "0001", S, "T1"),
            ("b", "2024-03-01 10:05:00", 200, "0001", S, "T1"),
            ("c", "2024-03-01 10:10:00", 100, "0001", S, "T1")]
    ev = world.enriched(world.tx(rows))
    out = _events(rules.amount_probing_three_step(ev, report_dt=RDT))
    assert out == [(ts("2024-03-01 10:05:00"), "1111 000001")]
    late = rows[:2] + [("c", "2024-03-01 10:20:00", 100, "0001", S, "T1")]
    assert _events(rules.amount_probing_three_step(world.enriched(world.tx(late)), report_dt=RDT)) == []

"""The expected row counts of FIXTURES.md §2 (sf0.01) reproduced by the Spark forms."""

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import rules
from cardsentry.operators.enrich import enrich, with_city
from tools import proxy

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data(spark):
    t = proxy.load(spark, SF)
    return t, enrich(t.transactions, t.cards, t.accounts, t.clients)


def _distinct3(df):
    return df.select("event_dt", "passport", "last_name").distinct().count()


def test_enrichment_and_terminal_joins(data):
    t, ev = data
    assert ev.count() == 10_000
    assert with_city(ev, t.terminals, point_in_time=True).count() == 10_000
    assert with_city(ev, t.terminals, point_in_time=False).count() == 10_980


def test_rule_counts(data):
    t, ev = data
    assert _distinct3(rules.locked_passport(ev, t.blacklist)) == 624
    raw = (ev.join(t.blacklist, ev.passport_num == t.blacklist.passport)
             .where(F.col("transaction_date") > F.col("date").cast("timestamp_ntz")).count())
    assert raw == 893
    assert _distinct3(rules.overdue_passport(ev)) == 2_417
    assert _distinct3(rules.invalid_contract(ev)) == 1_686
    assert _distinct3(rules.different_cities(ev, t.terminals)) == 841
    assert _distinct3(rules.different_cities(ev, t.terminals, point_in_time=False)) == 1_741


@pytest.mark.parametrize("within,r4,r4b", [("20 minutes", 0, 0), ("24 hours", 4, 127),
                                           ("72 hours", 23, 282), ("168 hours", 36, 329)])
def test_probing_counts(data, within, r4, r4b):
    _, ev = data
    assert rules.amount_probing(ev, within=within).count() == r4
    assert rules.amount_probing_three_step(ev, within=within).count() == r4b

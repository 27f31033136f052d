import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardsentry.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="cardsentry-tests", shuffle_partitions=8,
                    conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cardsentry-test-ckpt-"))
    yield s


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


class World:
    """Small hand-made dimension set (invented people and values)."""

    CLIENTS = [
        # client_id, last, first, patronymic, passport, passport_valid_to, phone
        ("1", "Alder", "Mira", "K.", "1111 000001", d("2030-01-01"), "+1 555 010-00-01"),
        ("2", "Birch", "Oleg", "P.", "1111 000002", d("2024-03-05"), "+1 555 010-00-02"),
        ("3", "Cedar", "Lena", "R.", "1111 000003", None, "+1 555 010-00-03"),
        ("VIP-1", "Dogwood", "Ivo", "S.", "1111 000004", d("2030-01-01"), "+1 555 010-00-04"),
    ]
    ACCOUNTS = [
        ("40800000000000000001", d("2030-01-01"), "1"),
        ("40800000000000000002", d("2030-01-01"), "2"),
        ("40800000000000000003", d("2024-03-05"), "3"),
        ("40800000000000000004", d("2024-03-05"), "VIP-1"),
        ("40800000000000000005", d("2030-01-01"), "1"),
    ]
    CARDS = [
        ("1000 0000 0000 0001", "40800000000000000001"),
        ("1000 0000 0000 0002", "40800000000000000002"),
        ("1000 0000 0000 0003", "40800000000000000003"),
        ("1000 0000 0000 0004", "40800000000000000004"),
        ("1000 0000 0000 0005", "40800000000000000005"),
        ("1000 0000 0000 0011", "40800000000000000001"),
    ]
    TERMINALS = [
        ("T1", "Springfield", ts("2024-01-01 00:00:00"), ts("9999-12-31 00:00:00")),
        ("T2", "Shelbyville", ts("2024-01-01 00:00:00"), ts("9999-12-31 00:00:00")),
        ("T3", "Springfield", ts("2024-01-01 00:00:00"), ts("9999-12-31 00:00:00")),
        ("TM", "Springfield", ts("2024-01-01 00:00:00"), ts("2024-03-02 00:00:00")),
        ("TM", "Shelbyville", ts("2024-03-02 00:00:00"), ts("9999-12-31 00:00:00")),
        ("TN", None, ts("2024-01-01 00:00:00"), ts("9999-12-31 00:00:00")),
    ]

    def __init__(self, spark):
        from cardsentry import schemas
        self.spark = spark
        self.clients = spark.createDataFrame(self.CLIENTS, schemas.CLIENTS)
        self.accounts = spark.createDataFrame(self.ACCOUNTS, schemas.ACCOUNTS)
        self.cards = spark.createDataFrame(self.CARDS, schemas.CARDS)
        self.terminals = spark.createDataFrame(self.TERMINALS, schemas.TERMINALS)
        self.blacklist = spark.createDataFrame([], schemas.BLACKLIST)

    def tx(self, rows):
        """rows: (id, 'YYYY-MM-DD HH:MM:SS', amount, card_suffix, result, terminal)."""
        from cardsentry import schemas
        out = []
        for r in rows:
            tid, t, amt, card, res, term = r
            out.append((tid, ts(t), Decimal(str(amt)), f"1000 0000 0000 {card}", "pay", res, term))
        return self.spark.createDataFrame(out, schemas.TRANSACTIONS)

    def with_blacklist(self, rows):
        from cardsentry import schemas
        self.blacklist = self.spark.createDataFrame([(d(a), b) for a, b in rows], schemas.BLACKLIST)
        return self

    def enriched(self, txdf, blacklist=False):
        from cardsentry.operators.enrich import enrich
        return enrich(txdf, self.cards, self.accounts, self.clients,
                      blacklist=self.blacklist if blacklist else None)


@pytest.fixture
def world(spark):
    return World(spark)

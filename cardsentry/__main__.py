"""Command line: the daily operations, one command each.

  python -m cardsentry daily  --root DIR                 load pending drops, rebuild affected report days
  python -m cardsentry seed   --root DIR --from DIR      load cards.csv, accounts.csv, clients.csv (repeatable)
  python -m cardsentry report --root DIR --day D [--rule NAME] [--rows N]
                                                         show one day's report (or one rule's rows)
  python -m cardsentry tables --root DIR                 list the pipeline's tables
  python -m cardsentry sql    --root DIR "SELECT ..." [--param k=v ...]
                                                         ad-hoc SQL over the pipeline's tables

Results are shown with ``show()`` (bounded); nothing is collected whole.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from cardsentry.operators import rules
from cardsentry.operators.enrich import enrich, with_city
from cardsentry.plans import adhoc, daily
from cardsentry.plans import report as plan
from cardsentry.session import get_session
from cardsentry.sources import seed
from cardsentry.sources.ledger import Ledger

RULES = {
    "locked_passport": lambda t, ev, day: rules.locked_passport(ev, window=day),
    "overdue_passport": lambda t, ev, day: rules.overdue_passport(ev, window=day),
    "invalid_contract": lambda t, ev, day: rules.invalid_contract(ev, window=day),
    "different_cities": lambda t, ev, day: rules.different_cities(with_city(ev, t.terminals), None, day,
                                                                  lookback="1 hour"),
    "attempt_to_select_the_amount": lambda t, ev, day: rules.amount_probing(ev, day, lookback="20 minutes"),
}


def _views(spark, layout: daily.Layout) -> dict:
    t = daily.tables(spark, layout)
    views = {"transactions": t.transactions, "cards": t.cards, "accounts": t.accounts,
             "clients": t.clients, "blacklist": t.blacklist, "terminals": t.terminals}
    views["report"] = plan.read_mart(spark, layout.mart)    # empty before the first report
    return views


def main(argv=None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="cardsentry")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("daily", "seed", "report", "tables", "sql"):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True)
        p.add_argument("--master", default=None)
        if name == "seed":
            p.add_argument("--from", dest="source", required=True)
            p.add_argument("--sep", default=",")
        if name == "report":
            p.add_argument("--day", required=True)
            p.add_argument("--rule", choices=sorted(RULES), default=None)
            p.add_argument("--rows", type=int, default=50)
        if name == "sql":
            p.add_argument("query")
            p.add_argument("--param", action="append", default=[])
            p.add_argument("--rows", type=int, default=50)
    a = ap.parse_args(argv)
    spark = spark or get_session(a.master)
    layout = daily.Layout(a.root)
    if a.cmd == "daily":
        days = daily.run(spark, layout)
        print("rebuilt report days:", ", ".join(d.isoformat() for d in days) or "none")
    elif a.cmd == "seed":
        print("loaded:", ", ".join(seed.load_csv(spark, a.source, layout.seed, a.sep)) or "none")
    elif a.cmd == "report":
        if a.rule is None:
            df = plan.read_mart(spark, layout.mart, a.day).drop("report_date")
        else:
            # files that hold operations of the day or of an hour before it
            day = dt.datetime.fromisoformat(a.day)
            held = Ledger(spark, layout.ledger("transactions")).latest().where(
                (F.col("last_op") >= F.lit(day - dt.timedelta(hours=1))) & (F.col("first_op") < F.lit(day + dt.timedelta(days=1))))
            span = held.agg(F.min("business_date"), F.max("business_date")).first()
            t = daily.tables(spark, layout, tuple(span) if span[0] is not None else None)
            ev = enrich(t.transactions, t.cards, t.accounts, t.clients, blacklist=t.blacklist)
            df = RULES[a.rule](t, ev, a.day)
        df.orderBy("event_dt", "passport").show(a.rows, truncate=False)
    elif a.cmd == "tables":
        adhoc.register_views(_views(spark, layout))
        for name in adhoc.list_tables(spark):
            print(name)
    elif a.cmd == "sql":
        adhoc.register_views(_views(spark, layout))
        params = dict(kv.split("=", 1) for kv in a.param)
        adhoc.run_sql(spark, a.query, params or None).show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

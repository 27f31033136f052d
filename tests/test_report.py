import datetime as dt

from cardsentry.plans import adhoc
from cardsentry.plans import report as plan
from cardsentry.schemas import REPORT_COLUMNS
from tools import proxy

SF = "/root/testdata/sf0.001"


def test_daily_run_rebuild_is_idempotent(spark, tmp_path):
    t = proxy.load(spark, SF)
    mart = str(tmp_path / "mart")
    plan.run_daily_report(t, "2024-01-16", mart, report_dt="2024-01-17 06:00:00")
    first = sorted(map(tuple, plan.read_mart(spark, mart).collect()))
    plan.run_daily_report(t, "2024-01-16", mart, report_dt="2024-01-17 06:00:00")
    plan.run_daily_report(t, "2024-01-17", mart, report_dt="2024-01-18 06:00:00")
    again = plan.read_mart(spark, mart)
    assert sorted(map(tuple, again.where("report_date = DATE'2024-01-16'").collect())) == first
    assert {r.report_date for r in again.select("report_date").distinct().collect()} == {
        dt.date(2024, 1, 16), dt.date(2024, 1, 17)}


def test_daily_mart_equals_daily_runs(spark, tmp_path):
    """The one-job rebuild of all days equals running each day separately."""
    t = proxy.load(spark, SF)
    allm = plan.daily_mart(t, report_dt="2024-02-01 00:00:00").drop("report_dt")
    for day in ("2024-01-02", "2024-01-16", "2024-01-30"):
        one = plan.build_report(t, report_dt="2024-02-01 00:00:00", window=day).drop("report_dt")
        want = sorted(map(tuple, one.collect()))
        got = sorted(map(tuple, allm.where(f"report_date = DATE'{day}'").drop("report_date").collect()))
        assert got == want


def test_report_schema(spark):
    rep = plan.build_report(proxy.load(spark, SF), report_dt="2024-02-01 00:00:00")
    assert rep.columns == REPORT_COLUMNS
    assert {r.event_type for r in rep.select("event_type").distinct().collect()} <= {
        "locked passport", "overdue passport", "invalid_contract", "different cities within one hour",
        "attempt_to_select_the_amount"}


def test_adhoc_views_and_parameters(spark):
    t = proxy.load(spark, SF)
    adhoc.register_views({"transactions": t.transactions, "cards": t.cards})
    assert {"transactions", "cards"} <= set(adhoc.list_tables(spark))
    n = adhoc.run_sql(spark, "SELECT count(*) AS n FROM transactions WHERE oper_result = ?", ["SUCCESS"]).first().n
    assert n == t.transactions.where("oper_result = 'SUCCESS'").count()
    assert adhoc.table(spark, "cards").count() == t.cards.count()


def test_pipeline_daily_runs_incremental_terminals_equal_catch_up(spark, tmp_path):
    """Day-by-day runs (incremental SCD2 of terminals, one mart partition per run)
    give the same mart and versions as one catch-up run over all drops."""
    import shutil
    import __spark_entry__ as E
    from cardsentry.plans import daily
    from cardsentry.sources import files
    src = daily.Layout(str(tmp_path / "src"))
    E.write_proxy_drops(spark, SF, src)
    names = sorted(f.name for f in files.list_files(spark, src.drop))
    days = sorted({files.business_date_of(n) for n in names})[:3]
    catch = daily.Layout(str(tmp_path / "catch"))
    step = daily.Layout(str(tmp_path / "step"))
    for lay in (catch, step):
        shutil.copytree(src.seed, lay.seed)
        (tmp_path / lay.root.rsplit("/", 1)[-1] / "drop").mkdir()
    for n in names:
        if files.business_date_of(n) in days:
            shutil.copy(f"{src.drop}/{n}", f"{catch.drop}/{n}")
    assert daily.run(spark, catch) == days
    for day in days:
        for n in names:
            if files.business_date_of(n) == day:
                shutil.copy(f"{src.drop}/{n}", f"{step.drop}/{n}")
        assert daily.run(spark, step) == [day]
    got = plan.read_mart(spark, step.mart)
    want = plan.read_mart(spark, catch.mart)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0
    vt = daily.version_store(spark, step).read()
    assert vt.count() == 100 and vt.where("deleted_flg = 0").count() == 100
    assert sorted(map(tuple, vt.collect())) == sorted(map(tuple, daily.version_store(spark, catch).read().collect()))


def test_late_blacklist_file_rebuilds_later_days(spark, tmp_path):
    """A blacklist file that arrives after later days were reported changes
    those days' reports too; the run rebuilds them."""
    import shutil
    import __spark_entry__ as E
    from cardsentry.plans import daily
    from cardsentry.sources import files
    src = daily.Layout(str(tmp_path / "src"))
    E.write_proxy_drops(spark, SF, src)
    names = sorted(f.name for f in files.list_files(spark, src.drop))
    lay = daily.Layout(str(tmp_path / "late"))
    shutil.copytree(src.seed, lay.seed)
    (tmp_path / "late" / "drop").mkdir()
    late = [n for n in names if n.startswith("passport_blacklist_") and files.business_date_of(n) <= dt.date(2024, 1, 10)]
    for n in names:
        if n not in late:
            shutil.copy(f"{src.drop}/{n}", f"{lay.drop}/{n}")
    daily.run(spark, lay)
    for n in late:
        shutil.copy(f"{src.drop}/{n}", f"{lay.drop}/{n}")
    rebuilt = daily.run(spark, lay)
    # days on which no operation of a newly blocked passport falls stay as they are
    assert min(files.business_date_of(n) for n in late) <= rebuilt[0]
    assert rebuilt[-1] >= dt.date(2024, 1, 30)
    full = daily.Layout(str(tmp_path / "full"))
    shutil.copytree(src.root, full.root)
    daily.run(spark, full)
    got = sorted(map(tuple, plan.read_mart(spark, lay.mart).collect()))
    assert got == sorted(map(tuple, plan.read_mart(spark, full.mart).collect()))

"""The daily run from stored state: crashes, corrected and repeated files, late operations (planted files)."""

import datetime as dt
import io
import zipfile

import pandas as pd
import pytest

from cardsentry import schemas
from cardsentry.operators import sizing
from cardsentry.plans import daily
from cardsentry.plans import report as plan
from cardsentry.session import checkpoint_root
from cardsentry.sources import excel, seed
from cardsentry.sources import transactions as tx
from cardsentry.sources.ledger import Ledger
from tools import fixtures
from conftest import World, d

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"
OVERDUE = "1000 0000 0000 0002"      # passport valid to 2024-03-05
SOUND = "1000 0000 0000 0001"


class Drops:
    """A root folder with the hand-made seed, and files dropped into it."""

    def __init__(self, spark, root):
        self.layout, self.spark = daily.Layout(str(root)), spark
        world = World(spark)
        seed.write_seed({"cards": world.cards, "accounts": world.accounts, "clients": world.clients}, self.layout.seed)
        (root / "drop").mkdir()
        self.drop = root / "drop"

    def operations(self, day, rows):
        lines = [f"{i};{t};10.00;{card};pay;SUCCESS;T1" if card else f"{i};{t};broken" for i, t, card in rows]
        (self.drop / f"transactions_{day}.txt").write_text("\n".join([HEADER, *lines]) + "\n")

    def workbook(self, name, **sheets):
        (self.drop / name).write_bytes(fixtures.xlsx_bytes({k: pd.DataFrame(v) for k, v in sheets.items()}))

    def terminals(self, day, cities):
        self.workbook(f"terminals_{day}.xlsx", terminals={"terminal_id": list(cities), "terminal_city": list(cities.values())})

    def run(self):
        return daily.run(self.spark, self.layout)

    def mart(self):
        return sorted((str(r.event_dt), r.event_type, str(r.report_date)) for r in plan.read_mart(self.spark, self.layout.mart).collect())

    def versions(self):
        stored = daily.version_store(self.spark, self.layout).read()
        return sorted((r.terminal_id, r.terminal_city, r.effective_from.date(), r.effective_to.date(), r.deleted_flg) for r in stored.collect())


@pytest.fixture
def drops(spark, tmp_path):
    return Drops(spark, tmp_path)


HIT = ("2024-03-06 10:00:00", "overdue passport", "2024-03-06")
OPEN = dt.date(9999, 12, 31)


def test_report_is_built_after_a_crash_in_the_mart_write(drops, monkeypatch):
    drops.operations("06032024", [(1, "2024-03-06 10:00:00", OVERDUE)])
    with monkeypatch.context() as m:
        m.setattr(plan, "replace_days", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            drops.run()
    assert not list(drops.drop.iterdir())           # loaded and archived, but not reported
    assert drops.run() == [dt.date(2024, 3, 6)]
    assert drops.mart() == [HIT]
    assert drops.run() == []


def test_versions_are_built_after_a_crash_before_them(drops, monkeypatch):
    drops.terminals("05032024", {"T1": "Springfield", "T2": "Shelbyville"})
    drops.run()
    drops.terminals("06032024", {"T1": "Ogdenville", "T2": "Shelbyville"})
    with monkeypatch.context() as m:
        m.setattr(daily.VersionStore, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            drops.run()
    drops.terminals("07032024", {"T1": "Ogdenville"})
    drops.run()
    assert drops.versions() == [
        ("T1", "Ogdenville", dt.date(2024, 3, 6), OPEN, 0), ("T1", "Springfield", dt.date(2024, 3, 5), dt.date(2024, 3, 6), 0),
        ("T2", "Shelbyville", dt.date(2024, 3, 5), dt.date(2024, 3, 7), 0), ("T2", "Shelbyville", dt.date(2024, 3, 7), OPEN, 1)]


def test_corrected_files_replace_rows_quarantine_and_empty_days(drops):
    drops.operations("06032024", [(1, "2024-03-06 10:00:00", OVERDUE), (2, "2024-03-06 11:00:00", None)])
    drops.run()
    assert drops.mart() == [HIT]
    assert tx.read_quarantine(drops.spark, drops.layout.quarantine).count() == 1
    drops.operations("06032024", [(1, "2024-03-06 10:00:00", SOUND)])       # corrected: no hit, no bad line
    assert drops.run() == [dt.date(2024, 3, 6)]
    assert drops.mart() == [] and tx.read_quarantine(drops.spark, drops.layout.quarantine).count() == 0
    drops.operations("06032024", [(1, "2024-03-06 10:00:00", None)])        # now all bad
    drops.run()
    assert tx.read_table(drops.spark, drops.layout.transactions).count() == 0
    assert tx.read_quarantine(drops.spark, drops.layout.quarantine).count() == 1


def test_first_file_may_hold_only_bad_lines(drops):
    drops.operations("06032024", [(1, "2024-03-06 10:00:00", None)])
    assert drops.run() == [dt.date(2024, 3, 6)]
    assert drops.mart() == []


def test_repeated_delivery_is_archived_and_not_loaded(drops, tmp_path):
    rows = [(1, "2024-03-06 10:00:00", OVERDUE)]
    drops.operations("06032024", rows)
    drops.run()
    drops.operations("06032024", rows)
    assert drops.run() == []
    assert not list(drops.drop.iterdir())
    assert sorted(p.name for p in (tmp_path / "archive").iterdir() if not p.name.startswith(".")) == [
        "transactions_06032024.txt.backup", "transactions_06032024.txt.backup.1"]
    assert Ledger(drops.spark, drops.layout.ledger("transactions")).table().count() == 1


def test_operations_dated_before_their_file_are_reported_on_their_day(drops):
    drops.operations("07032024", [(1, "2024-03-06 10:00:00", OVERDUE), (2, "2024-03-07 09:00:00", OVERDUE)])
    assert dt.date(2024, 3, 6) in drops.run()
    drops.operations("09032024", [(3, "2024-03-07 23:59:00", OVERDUE)])
    assert drops.run()[0] == dt.date(2024, 3, 7)
    assert drops.mart() == [HIT, ("2024-03-07 09:00:00", "overdue passport", "2024-03-07"), ("2024-03-07 23:59:00", "overdue passport", "2024-03-07")]


class _Unset:
    """A session without a checkpoint folder, as far as checkpoint_root sees."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_checkpoint_folder_is_made_in_local_mode_only():
    assert checkpoint_root(_Unset("local[2]"))
    with pytest.raises(ValueError):
        checkpoint_root(_Unset("spark://host:7077"))


def test_daily_run_sets_the_checkpoint_folder_before_it_loads(drops, monkeypatch):
    drops.terminals("05032024", {"T1": "Springfield"})
    with monkeypatch.context() as m:
        m.setattr(daily, "checkpoint_root", lambda *a: (_ for _ in ()).throw(ValueError("none")))
        with pytest.raises(ValueError):
            drops.run()
    assert len(list(drops.drop.iterdir())) == 1      # nothing was loaded or archived
    drops.run()
    assert len(drops.versions()) == 1


def test_every_sheet_reaches_its_table(drops):
    drops.workbook("passport_blacklist_06032024.xlsx",
                   blacklist={"date": ["01.03.2024", 45352, "soon"], "passport": ["1111 000002", "1111 000003", "1111 000004"], "note": ["a", None, "b"]},
                   terminals={"terminal_id": ["T9"], "terminal_city": ["Springfield"], "street": ["Main"]}, other={"x": ["y"]})
    (drops.drop / "terminals_06032024.xlsx").write_bytes(b"no zip")
    hollow = io.BytesIO()
    with zipfile.ZipFile(hollow, "w") as z:
        z.writestr("readme.txt", "no workbook")
    (drops.drop / "terminals_07032024.xlsx").write_bytes(hollow.getvalue())
    drops.run()
    stored = {n: daily._stored(drops.spark, getattr(drops.layout, n), s).collect() for n, s in (
        ("blacklist", schemas.LOADED_BLACKLIST), ("terminal_snapshots", schemas.SNAPSHOTS), ("sheet_quarantine", schemas.SHEET_QUARANTINE))}
    assert sorted((r.date, r.passport, r.extra.get("note")) for r in stored["blacklist"]) == [
        (d("2024-03-01"), "1111 000002", "a"), (d("2024-03-01"), "1111 000003", None)]
    assert [(r.terminal_id, r.terminal_city, r.extra) for r in stored["terminal_snapshots"]] == [("T9", "Springfield", {"street": "Main"})]
    assert sorted((r.src_file, r.sheet or "", r.reason) for r in stored["sheet_quarantine"]) == [
        ("passport_blacklist_06032024.xlsx", "blacklist", "date"), ("passport_blacklist_06032024.xlsx", "other", "unknown_sheet"),
        ("terminals_06032024.xlsx", "", "broken_workbook"), ("terminals_07032024.xlsx", "", "broken_workbook")]
    counts = {r.file_name: (r.n_good, r.n_bad) for r in Ledger(drops.spark, drops.layout.ledger("sheets")).table().collect()}
    assert counts["passport_blacklist_06032024.xlsx"] == (3, 2) and counts["terminals_06032024.xlsx"] == (0, 1)


def test_ledger_is_compacted(spark, tmp_path, monkeypatch):
    from cardsentry.sources import ledger
    from cardsentry.sources.files import FileInfo, list_files
    monkeypatch.setattr(ledger, "COMPACT_FILES", 3)
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))
    for i in range(6):
        book.record([], {f"transactions_0{i + 1}032024.txt": FileInfo(f"transactions_0{i + 1}032024.txt", "p", 1, i)})
    assert book.table().count() == 6 and len(list_files(spark, book.path, "part-*")) <= 3


def test_rewritten_input_is_measured_anew(spark, tmp_path):
    path = str(tmp_path / "dim.parquet")
    spark.range(10).coalesce(1).write.parquet(path)
    small = sizing.size_bound(spark.read.parquet(path))
    part = next((tmp_path / "dim.parquet").glob("part-*.parquet"))
    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "big"))
    fresh = next((tmp_path / "big").glob("part-*.parquet"))
    (tmp_path / "dim.parquet" / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_bytes(fresh.read_bytes())
    spark.catalog.refreshByPath(path)
    assert sizing.size_bound(spark.read.parquet(path))[0] == 5000 and small[0] == 10

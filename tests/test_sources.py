import datetime as dt
import io
import zipfile
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from cardsentry.sources import excel, files
from cardsentry.sources import transactions as tx
from cardsentry.streaming import file_ingest
from tools import fixtures
from conftest import ts

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_parse_amount_forms_bad_lines_and_blank(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    _write(drop / "transactions_01032024.txt", "\n".join([
        HEADER,
        "1;2024-03-01 10:00:00;12,50;1000 0000 0000 0001;pay;SUCCESS;T1",
        "2;2024-03-01 10:01:00;12.50;1000 0000 0000 0001;pay;SUCCESS;T1",
        "3;2024-03-01 10:02:00;12.50;1000 0000 0000 0001;pay;SUCCESS",          # 6 fields
        "4;2024-03-01 10:03:00;12.50;1000 0000 0000 0001;pay;SUCCESS;T1;extra",  # 8 fields
        "5;not a time;1;1000 0000 0000 0001;pay;SUCCESS;T1",
        "6;2024-03-01 10:04:00;1.2.3;1000 0000 0000 0001;pay;SUCCESS;T1",
        "7;2024-03-01 10:04:00;1.234;1000 0000 0000 0001;pay;SUCCESS;T1",        # would be rounded
        "8;2024-03-01 10:04:00;1,2300;1000 0000 0000 0001;pay;SUCCESS;T1",
        "",
    ]) + "\n")
    parsed = tx.parse(tx.read_lines(spark, str(drop)))
    good = {r["transaction_id"]: r for r in tx.good_rows(parsed).collect()}
    assert set(good) == {"1", "2", "8"} and good["8"]["amount"] == Decimal("1.23")
    assert good["1"]["amount"] == good["2"]["amount"] == Decimal("12.50")
    assert good["1"]["load_date"] == dt.date(2024, 3, 1)
    bad = {r["transaction_id"]: r["reason"] for r in tx.bad_rows(parsed).collect()}
    assert bad == {"3": "field_count", "4": "field_count", "5": "transaction_date", "6": "amount", "7": "amount"}


def test_batch_ingest_ledger_archive_and_force(spark, tmp_path):
    root = tmp_path
    drop = root / "drop"
    drop.mkdir()
    body = HEADER + "\n1;2024-03-01 10:00:00;1.00;c;pay;SUCCESS;T1\n2;2024-03-01 11:00:00;2.00;c;pay;REJECT;T1\n"
    _write(drop / "transactions_01032024.txt", body)
    kw = dict(table_dir=str(root / "t"), quarantine_dir=str(root / "q"), ledger_dir=str(root / "l"),
              archive_dir=str(root / "archive"))
    assert tx.ingest(spark, str(drop), **kw) == ["transactions_01032024.txt"]
    assert (root / "archive" / "transactions_01032024.txt.backup").exists()
    assert not (drop / "transactions_01032024.txt").exists()
    # the same file delivered twice: skipped by the ledger
    _write(drop / "transactions_01032024.txt", body)
    assert tx.ingest(spark, str(drop), **kw) == []
    assert tx.read_table(spark, kw["table_dir"]).count() == 2
    # a corrected file under the same name, forced: replaces, never duplicates
    _write(drop / "transactions_01032024.txt", HEADER + "\n1;2024-03-01 10:00:00;1.00;c;pay;SUCCESS;T1\n")
    assert tx.ingest(spark, str(drop), force=True, **kw) == ["transactions_01032024.txt"]
    assert tx.read_table(spark, kw["table_dir"]).count() == 1


def test_stream_ingest_twice_adds_nothing(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    _write(drop / "transactions_01032024.txt", HEADER + "\n1;2024-03-01 10:00:00;1,00;c;pay;SUCCESS;T1\n")
    kw = dict(table_dir=str(tmp_path / "t"), quarantine_dir=str(tmp_path / "q"),
              checkpoint_dir=str(tmp_path / "ck"))
    file_ingest.run_available(spark, str(drop), **kw)
    _write(drop / "transactions_02032024.txt", HEADER + "\n2;2024-03-02 10:00:00;2.00;c;pay;SUCCESS;T1\nbad\n")
    file_ingest.run_available(spark, str(drop), **kw)
    file_ingest.run_available(spark, str(drop), **kw)
    t = tx.read_table(spark, kw["table_dir"])
    assert sorted((r.transaction_id, str(r.load_date)) for r in t.collect()) == [
        ("1", "2024-03-01"), ("2", "2024-03-02")]
    assert spark.read.parquet(kw["quarantine_dir"]).count() == 1


def test_drop_writer_round_trip(spark, tmp_path):
    rows = [("1", ts("2024-03-01 10:00:00.123456"), Decimal("3.10"), "c", "pay", "SUCCESS", "T1"),
            ("2", ts("2024-03-02 10:00:00"), Decimal("4.00"), "c", "pay", "REJECT", None)]
    from cardsentry import schemas
    df = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    names = fixtures.write_lines(spark, fixtures.to_lines(df, comma_amount=F.lit(True)), str(tmp_path / "drop"))
    assert all(files.business_date_of(n) for n in names)
    first = (tmp_path / "drop" / names[0]).read_text().splitlines()
    assert first[0] == HEADER
    back = tx.good_rows(tx.parse(tx.read_lines(spark, str(tmp_path / "drop"))))
    assert sorted(tuple(r)[:7] for r in back.collect()) == sorted(rows)


def test_business_date_names():
    assert files.business_date_of("transactions_01032021.txt") == dt.date(2021, 3, 1)
    assert files.business_date_of("passport_blacklist_02032021.xlsx") == dt.date(2021, 3, 2)
    assert files.business_date_of("terminals_03032021-00007.xlsx") == dt.date(2021, 3, 3)
    assert files.business_date_of("notes.txt") is None


def _inline_xlsx() -> bytes:
    """A workbook with inline strings, a boolean and two sheets, written by hand."""
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rns = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pns = "http://schemas.openxmlformats.org/package/2006/relationships"
    sheet1 = (f'<worksheet xmlns="{ns}"><sheetData>'
              '<row r="1"><c r="A1" t="inlineStr"><is><t>date</t></is></c><c r="B1" t="inlineStr"><is><t>passport</t></is></c></row>'
              '<row r="2"><c r="A2"><v>45352</v></c><c r="B2" t="inlineStr"><is><t>2222 000001</t></is></c></row>'
              '<row r="3"><c r="A3" t="inlineStr"><is><t>2024-03-05</t></is></c><c r="B3" t="inlineStr"><is><t>2222 000002</t></is></c></row>'
              '<row r="5"><c r="B5" t="inlineStr"><is><r><t>2222 </t></r><r><t>000003</t></r></is></c><c r="A5"><v>45353.5</v></c></row>'
              '</sheetData></worksheet>')
    sheet2 = (f'<worksheet xmlns="{ns}"><sheetData>'
              '<row r="1"><c r="A1" t="inlineStr"><is><t>flag</t></is></c></row>'
              '<row r="2"><c r="A2" t="b"><v>1</v></c></row></sheetData></worksheet>')
    wb = (f'<workbook xmlns="{ns}" xmlns:r="{rns}"><sheets><sheet name="blacklist" sheetId="1" r:id="rId1"/>'
          f'<sheet name="other" sheetId="2" r:id="rId2"/></sheets></workbook>')
    rels = (f'<Relationships xmlns="{pns}"><Relationship Id="rId1" Type="ws" Target="worksheets/sheet1.xml"/>'
            f'<Relationship Id="rId2" Type="ws" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/worksheets/sheet1.xml", sheet1)
        z.writestr("xl/worksheets/sheet2.xml", sheet2)
    return buf.getvalue()


def test_xlsx_reader_inline_strings_dates_and_sheets(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "passport_blacklist_05032024.xlsx").write_bytes(_inline_xlsx())
    cells = excel.read_cells(spark, str(drop))
    assert sorted(r.sheet for r in cells.select("sheet").distinct().collect()) == ["blacklist", "other"]
    got = sorted(tuple(r) for r in excel.blacklist_rows(cells).select("date", "passport", "load_date").collect())
    assert got == [(dt.date(2024, 3, 1), "2222 000001", dt.date(2024, 3, 5)),
                   (dt.date(2024, 3, 2), "2222 000003", dt.date(2024, 3, 5)),
                   (dt.date(2024, 3, 5), "2222 000002", dt.date(2024, 3, 5))]
    other = cells.where("sheet = 'other'").first()
    assert other.cells == {"flag": "TRUE"}


def test_xlsx_writer_round_trip(spark, tmp_path):
    pdf = pd.DataFrame({"terminal_id": ["T1", "T2"], "terminal_city": ["Springfield", "Shelby & Co <x>"],
                        "terminal_address": ["Main st. 1", None]})
    (tmp_path / "terminals_01032024.xlsx").write_bytes(fixtures.xlsx_bytes({"terminals": pdf}))
    rows = excel.terminal_rows(excel.read_cells(spark, str(tmp_path))).collect()
    got = sorted((r.terminal_id, r.terminal_city, r.extra.get("terminal_address"), r.load_date) for r in rows)
    assert got == [("T1", "Springfield", "Main st. 1", dt.date(2024, 3, 1)),
                   ("T2", "Shelby & Co <x>", None, dt.date(2024, 3, 1))]


def test_stream_excel_keeps_all_sheets_ledger_and_archive(spark, tmp_path):
    from cardsentry import schemas
    from cardsentry.plans import daily

    layout = daily.Layout(str(tmp_path))
    drop = tmp_path / "drop"
    drop.mkdir()
    black = pd.DataFrame({"date": [45352, 45353, "soon"], "passport": ["2222 000001", "2222 000002", "2222 000003"]})
    term = pd.DataFrame({"terminal_id": ["T1"], "terminal_city": ["Springfield"]})
    (drop / "passport_blacklist_02032024.xlsx").write_bytes(
        fixtures.xlsx_bytes({"blacklist": black, "terminals": term, "notes": pd.DataFrame({"x": ["y"]})}))
    (drop / "terminals_02032024.xlsx").write_bytes(b"not a workbook")

    def run():
        q = file_ingest.start_excel(spark, layout.drop, layout.blacklist, layout.terminal_snapshots, layout.sheet_quarantine,
                                    layout.ledger("sheets"), str(tmp_path / "ck"), archive_dir=layout.archive)
        q.awaitTermination()
        assert q.exception() is None
        bl = daily._stored(spark, layout.blacklist, schemas.LOADED_BLACKLIST).collect()
        qu = daily._stored(spark, layout.sheet_quarantine, schemas.SHEET_QUARANTINE).collect()
        return sorted((r.passport, str(r.date)) for r in bl), sorted((r.src_file, r.reason) for r in qu), bl

    passports, bad, rows = run()
    assert passports == [("2222 000001", "2024-03-01"), ("2222 000002", "2024-03-02")]
    assert bad == [("passport_blacklist_02032024.xlsx", "date"), ("passport_blacklist_02032024.xlsx", "unknown_sheet"),
                   ("terminals_02032024.xlsx", "broken_workbook")]
    assert [(r.terminal_id, r.terminal_city) for r in daily.snapshots(spark, layout).collect()] == [("T1", "Springfield")]
    assert {(r.effective_from, r.effective_to, r.deleted_flg) for r in rows} == {(ts("2024-03-02 00:00:00"), ts("2024-03-03 00:00:00"), 0)}
    assert sorted(p.name for p in (tmp_path / "archive").iterdir() if p.suffix == ".backup") == [
        "passport_blacklist_02032024.xlsx.backup", "terminals_02032024.xlsx.backup"]
    assert not [p for p in drop.iterdir() if p.suffix == ".xlsx"]
    assert daily.load_sheets(spark, layout) == []           # the batch path knows what the stream has loaded
    # a corrected workbook under a known name replaces the rows of the earlier one when a new one comes
    (drop / "terminals_03032024.xlsx").write_bytes(fixtures.xlsx_bytes({"terminals": term}))
    (drop / "passport_blacklist_02032024.xlsx").write_bytes(fixtures.xlsx_bytes({"blacklist": black.iloc[1:2]}))
    passports, bad, _ = run()
    assert passports == [("2222 000002", "2024-03-02")] and bad == [("terminals_02032024.xlsx", "broken_workbook")]


def test_repeated_headers_keep_their_columns(spark, tmp_path):
    assert excel.header_names(["a", "b", "a", None, "a", " b "]) == ["a", "b", "a.1", "col3", "a.2", "b.1"]
    assert excel.header_names(["a", "a", "a.1", "a"]) == ["a", "a.2", "a.1", "a.3"]
    given = pd.DataFrame([["T1", "Springfield", "A", "B"]], columns=["terminal_id", "terminal_city", "note", "note"])
    (tmp_path / "terminals_01032024.xlsx").write_bytes(fixtures.xlsx_bytes({"terminals": given}))
    assert excel.terminal_rows(excel.read_cells(spark, str(tmp_path))).first().extra == {"note": "A", "note.1": "B"}


def test_sheets_of_one_workbook_are_parsed_by_several_tasks(spark, tmp_path):
    sheets = {f"s{i}": pd.DataFrame([[f"{i}-{r}", r, "x"] for r in range(3000)], columns=["a", "n", "a"]) for i in range(6)}
    (tmp_path / "terminals_01032024.xlsx").write_bytes(fixtures.xlsx_bytes(sheets))
    cells = excel.read_cells(spark, str(tmp_path))
    rows = cells.select("sheet", "row_no", "cells", F.spark_partition_id().alias("task")).collect()
    assert len(rows) == 18_000 and len({r.task for r in rows}) > 1
    assert len({(r.sheet, r.task) for r in rows}) == 6          # a sheet is parsed by one task
    assert all(r.cells == {"a": f"{r.sheet[1:]}-{r.row_no - 2}", "n": str(r.row_no - 2), "a.1": "x"} for r in rows)


def test_broken_sheet_leaves_the_other_sheets(spark, tmp_path):
    whole = fixtures.xlsx_bytes({n: pd.DataFrame({"v": [n]}) for n in ("one", "two", "three")})
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(whole)) as z, zipfile.ZipFile(buf, "w") as out:
        for name in z.namelist():
            out.writestr(name, b"<worksheet" if name.endswith("sheet2.xml") else z.read(name))
    (tmp_path / "terminals_01032024.xlsx").write_bytes(buf.getvalue())
    rows = excel.read_cells(spark, str(tmp_path)).collect()
    assert sorted((r.sheet or "", r.cells.get("v")) for r in rows) == [("", None), ("one", "one"), ("three", "three")]
    assert next(r for r in rows if r.sheet is None).cells["broken_workbook"].startswith("two: ParseError")


def test_stream_records_files_without_lines(spark, tmp_path):
    from cardsentry.sources.ledger import Ledger

    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "transactions_01032024.txt").write_text("")
    for _ in range(2):
        file_ingest.run_available(spark, str(drop), str(tmp_path / "t"), str(tmp_path / "q"), str(tmp_path / "ck"),
                                  ledger_dir=str(tmp_path / "ledger"), archive_dir=str(tmp_path / "archive"))
    assert [(r.file_name, r.n_good, r.n_bad) for r in Ledger(spark, str(tmp_path / "ledger")).table().collect()] == [("transactions_01032024.txt", 0, 0)]
    assert [p.name for p in (tmp_path / "archive").iterdir() if p.suffix == ".backup"] == ["transactions_01032024.txt.backup"]


def test_seed_csv_overwrite_is_idempotent(spark, tmp_path):
    from cardsentry.sources import seed
    (tmp_path / "clients.csv").write_text(
        "client_id,last_name,first_name,patronymic,passport_num,passport_valid_to,phone\n"
        "VIP-7,Elm,Ada,T.,3333 000001,,+1 555 020-00-01\n"
        "8,Fir,Bo,U.,3333 000002,2030-05-01,+1 555 020-00-02\n")
    (tmp_path / "accounts.csv").write_text("account,valid_to,client\n40800000000000000099,2024-03-05,VIP-7\n")
    (tmp_path / "cards.csv").write_text("card_num,account\n1000 0000 0000 0099,40800000000000000099\n")
    dfs = {n: seed.read_csv(spark, str(tmp_path / f"{n}.csv"), n) for n in ("cards", "accounts", "clients")}
    root = str(tmp_path / "seed")
    seed.write_seed(dfs, root)
    seed.write_seed(dfs, root)                      # loading twice leaves the same tables
    back = seed.read_seed(spark, root)
    cl = {r.client_id: r for r in back["clients"].collect()}
    assert set(cl) == {"VIP-7", "8"} and cl["VIP-7"].passport_valid_to is None
    assert cl["8"].passport_valid_to == dt.date(2030, 5, 1)
    assert back["accounts"].first().client == "VIP-7" and back["cards"].count() == 1


def test_local_path():
    assert files.local_path("file:///a/b") == "/a/b"
    assert files.local_path("/a/b") == "/a/b"
    import pytest
    with pytest.raises(ValueError):
        files.local_path("hdfs://nn/a")

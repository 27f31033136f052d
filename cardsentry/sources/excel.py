"""S3: daily ``passport_blacklist_DDMMYYYY.xlsx`` / ``terminals_DDMMYYYY.xlsx`` drops.

Spark job: ``binaryFile`` source -> the packed XML parts of every sheet (nothing is unpacked but the workbook's list
of sheets) -> a shuffle by (file, sheet) -> ``mapInPandas`` over sheets, so that the sheets of one workbook are parsed
by several tasks; a sheet holds at most 1,048,576 rows, so a task's input is bounded -> rows (src_file, sheet, row_no,
cells: header -> text) -> typed projection per sheet. Every sheet is read; the sheet name says which table it feeds,
as in the reference. An xlsx is a zip of XML parts, so the standard library is enough (shared strings, inline strings,
numbers, booleans); sheets and shared strings are parsed as streams.

Defined cases: sheets of one name in a workbook are read each for themselves; a sheet whose part is missing has no
rows; a workbook or a sheet that cannot be read gives a row without a sheet that tells why, and the other sheets of
the workbook are still read; empty sheets and files without sheets give no rows.
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
import zlib
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions.values import parse_date_cell
from cardsentry.sources import files, staging

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}

CELLS_SCHEMA = T.StructType([
    T.StructField("src_file", T.StringType()), T.StructField("sheet", T.StringType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("cells", T.MapType(T.StringType(), T.StringType())),
])


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _fmt_number(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    return str(int(f)) if f.is_integer() and abs(f) < 2**53 else v


def sheet_parts(content: bytes):
    """Yield (sheet name, its place in the workbook, a zip of its part and the shared strings) for every sheet."""
    z = zipfile.ZipFile(io.BytesIO(content))
    names = set(z.namelist())
    rels = {}
    if "xl/_rels/workbook.xml.rels" in names:
        for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).findall("pr:Relationship", _NS):
            target = rel.get("Target").lstrip("/")
            rels[rel.get("Id")] = target if target.startswith("xl/") else "xl/" + target
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    for i, sh in enumerate(wb.find("m:sheets", _NS).findall("m:sheet", _NS)):
        part = rels.get(sh.get(f"{{{_NS['r']}}}id"))
        if part in names:
            yield sh.get("name"), i, _repacked(z, {part: _SHEET, _STRINGS: _STRINGS} if _STRINGS in names else {part: _SHEET})


_SHEET, _STRINGS = "sheet.xml", "xl/sharedStrings.xml"
_PIECE = 1 << 20


def _repacked(z: zipfile.ZipFile, parts: dict[str, str]) -> bytes:
    """A zip of some parts of `z` under new names, copied piece by piece."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as out:
        for part, name in parts.items():
            with z.open(part) as given, out.open(name, "w", force_zip64=True) as copy:
                while piece := given.read(_PIECE):
                    copy.write(piece)
    return buf.getvalue()


def sheet_rows(packed: bytes):
    """Yield (row_no, [cell texts]) of one sheet, as ``sheet_parts`` packs it."""
    z = zipfile.ZipFile(io.BytesIO(packed))
    shared = []
    if _STRINGS in z.namelist():
        with z.open(_STRINGS) as xml:
            for _, si in ET.iterparse(xml):
                if si.tag == f"{{{_NS['m']}}}si":
                    shared.append(_text(si))
                    si.clear()
    row_no = 0
    with z.open(_SHEET) as xml:       # row by row: a sheet is never held as one tree
        for _, row in ET.iterparse(xml):
            if row.tag != f"{{{_NS['m']}}}row":
                continue
            row_no = int(row.get("r") or row_no + 1)
            vals = {}
            for c in row.findall("m:c", _NS):
                ref = c.get("r")
                vals[_col_index(ref) if ref else (max(vals) + 1 if vals else 0)] = _cell_text(c, shared)
            row.clear()
            if vals:
                yield row_no, [vals.get(i) for i in range(max(vals) + 1)]


def _cell_text(c, shared: list[str]) -> str | None:
    kind, v = c.get("t"), c.find("m:v", _NS)
    if kind == "inlineStr":
        inline = c.find("m:is", _NS)
        return _text(inline) if inline is not None else None
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    return v.text if kind in ("str", "e") else _fmt_number(v.text)


def header_names(cells: list) -> list[str]:
    """Column names of a header row: empty cells are numbered, and a repeated name gets .1, .2 and so on, so that no
    column takes another one's place."""
    given = [str(c).strip() if c is not None else f"col{i}" for i, c in enumerate(cells)]
    out, times = [], {}
    for name in given:
        n = times.get(name, 0)
        told = name if not n else f"{name}.{n}"
        while n and (told in out or told in given):
            n += 1
            told = f"{name}.{n}"
        times[name] = n + 1
        out.append(told)
    return out


BROKEN = "broken_workbook"
_CHUNK = 10_000


_UNREADABLE = (zipfile.BadZipFile, ET.ParseError, KeyError, ValueError, IndexError, AttributeError, EOFError, zlib.error)
_PACKED = "src_file string, sheet string, place int, packed binary, error string"


def _packed_sheets(batches):
    """Workbooks -> a row per sheet with its packed parts, or a row that tells that the workbook cannot be read."""
    columns = ["src_file", "sheet", "place", "packed", "error"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            name = path.rsplit("/", 1)[-1]
            try:
                for sheet, place, packed in sheet_parts(bytes(content)):
                    yield pd.DataFrame([(name, sheet, place, packed, None)], columns=columns).astype({"place": "Int32"})
            except _UNREADABLE as e:
                yield pd.DataFrame([(name, None, None, None, f"{type(e).__name__}: {e}")], columns=columns).astype({"place": "Int32"})


def _sheet_cells(name: str, sheet: str | None, packed: bytes | None, error: str | None):
    """(src_file, sheet, row_no, cells) of one sheet; a row without a sheet tells that it cannot be read."""
    if packed is None:
        yield name, None, None, {BROKEN: error}
        return
    header = None
    try:
        for row_no, cells in sheet_rows(bytes(packed)):
            if header is None:
                header = header_names(cells)
                continue
            m = {header[i] if i < len(header) else f"col{i}": (None if v is None else str(v)) for i, v in enumerate(cells)}
            if any(v not in (None, "") for v in m.values()):
                yield name, sheet, row_no, m
    except _UNREADABLE as e:
        yield name, None, None, {BROKEN: f"{sheet}: {type(e).__name__}: {e}"}


def _parse_batches(batches):
    columns = ["src_file", "sheet", "row_no", "cells"]
    for pdf in batches:
        for given in zip(pdf["src_file"], pdf["sheet"], pdf["packed"], pdf["error"]):
            rows = _sheet_cells(*given)
            while out := list(itertools.islice(rows, _CHUNK)):
                made = pd.DataFrame(out, columns=columns)
                yield made.astype({"row_no": "Int32"})


def read_cells(spark: SparkSession, path, pattern: str = "*.xlsx") -> DataFrame:
    """All sheets of the xlsx files as (src_file, sheet, row_no, cells).

    ``path``: a folder (files matching ``pattern``) or a list of file paths.
    """
    if isinstance(path, str):
        n = len(files.list_files(spark, path, pattern))
        raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    else:
        n = len(path)
        raw = spark.read.format("binaryFile").load(list(path))
    return cells_from_binary(raw, n)


def cells_from_binary(raw: DataFrame, n_files: int | None = None) -> DataFrame:
    """(path, content) rows of xlsx files -> cells. The sheets of a workbook are parsed by tasks of their own."""
    raw = raw.select("path", "content")
    if n_files:
        raw = raw.repartition(max(1, n_files))      # round robin: files spread evenly
    sheets = raw.mapInPandas(_packed_sheets, _PACKED)
    # as many partitions as files: sheets of a file meet others', and no sheet is parsed with all of its workbook
    sheets = sheets.repartition(max(8, n_files), "src_file", "place") if n_files else sheets.repartition("src_file", "place")
    return sheets.mapInPandas(_parse_batches, CELLS_SCHEMA)


def sheet_tables(cells: DataFrame) -> DataFrame:
    """Every row with the table its sheet names (_table: blacklist, terminals) or, with a reason, quarantine."""
    sheet = F.lower(F.trim("sheet"))
    c = F.col("cells")
    known = {"blacklist": ["date", "passport"], "terminals": ["terminal_id", "terminal_city"]}

    def text(name):
        return F.nullif(F.trim(c[name]), F.lit(""))

    def extra(names):
        return F.map_filter(c, lambda k, v: ~F.array_contains(F.array(*[F.lit(n) for n in names]), k))

    rows = cells.select(
        "sheet", "row_no", "cells", "src_file", _bd().alias("load_date"), sheet.alias("_sheet"),
        parse_date_cell(text("date")).alias("date"), text("passport").alias("passport"),
        text("terminal_id").alias("terminal_id"), text("terminal_city").alias("terminal_city"),
        F.when(sheet == "blacklist", extra(known["blacklist"])).when(sheet == "terminals", extra(known["terminals"])).alias("extra"))
    reason = (F.when(F.col("_sheet").isNull(), F.lit(BROKEN)).when(~F.col("_sheet").isin(*known), F.lit("unknown_sheet"))
               .when(F.col("load_date").isNull(), F.lit("file_name_date"))
               .when((F.col("_sheet") == "blacklist") & F.col("date").isNull(), F.lit("date"))
               .when((F.col("_sheet") == "blacklist") & F.col("passport").isNull(), F.lit("passport"))
               .when((F.col("_sheet") == "terminals") & F.col("terminal_id").isNull(), F.lit("terminal_id")))
    rows = rows.withColumn("reason", reason)
    bad = F.col("reason").isNotNull()
    return rows.withColumn("_table", F.when(bad, "quarantine").otherwise(F.col("_sheet"))).withColumn("cells", F.when(bad, c)).drop("_sheet")


def load_files(spark: SparkSession, paths, blacklist_dir: str, terminals_dir: str, quarantine_dir: str) -> list:
    """Parse xlsx ``paths``: every sheet goes to the table it names, whichever file it came in; unknown sheets,
    unreadable rows and broken workbooks go to quarantine. Replaces all earlier rows of these files.

    Returns per-file rows (file_name, business_date, n_good, n_bad, tables).
    """
    from cardsentry.sources.transactions import stamped
    staged = staging.stage(stamped(sheet_tables(read_cells(spark, list(paths)))), blacklist_dir)
    back = spark.read.schema("_table string, load_date date, src_file string, row_no int").parquet(staged)
    bad = F.col("_table") == "quarantine"
    stats = (back.groupBy(F.col("src_file").alias("file_name"), F.col("load_date").alias("business_date"))
                 .agg(F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad"),
                      F.array_join(F.array_sort(F.collect_set(F.when(~bad, F.col("_table")))), ",").alias("tables"))).collect()
    targets = {"blacklist": (blacklist_dir, "load_date"), "terminals": (terminals_dir, "load_date"), "quarantine": (quarantine_dir, "load_date")}
    staging.replace(spark, staged, targets, [str(p).rsplit("/", 1)[-1] for p in paths])
    return stats


def _bd(col: str = "src_file"):
    return F.to_date(F.regexp_extract(F.col(col), files.DATE_IN_NAME, 1), "ddMMyyyy")


def blacklist_rows(cells: DataFrame, sheet: str = "blacklist") -> DataFrame:
    """Typed blacklist rows: date, passport, load_date."""
    c = cells.where(F.col("sheet") == sheet)
    return c.select(parse_date_cell(F.col("cells")["date"]).alias("date"),
                    F.trim(F.col("cells")["passport"]).alias("passport"),
                    _bd().alias("load_date"), "src_file")


def terminal_rows(cells: DataFrame, sheet: str = "terminals") -> DataFrame:
    """Typed terminal snapshot rows: terminal_id, terminal_city, extra cells, load_date."""
    c = cells.where(F.col("sheet") == sheet)
    known = F.array(F.lit("terminal_id"), F.lit("terminal_city"))
    extra = F.map_filter(F.col("cells"), lambda k, v: ~F.array_contains(known, k))
    return c.select(F.trim(F.col("cells")["terminal_id"]).alias("terminal_id"),
                    F.trim(F.col("cells")["terminal_city"]).alias("terminal_city"),
                    extra.alias("extra"), _bd().alias("load_date"), "src_file")

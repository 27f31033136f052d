"""Writers of the daily drop files, for tests and for the queries that read them back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.sources import files
from cardsentry.sources.excel import _NS
from cardsentry.sources.transactions import HEADER


def to_lines(df: DataFrame, comma_amount: Column | None = None, drop_terminal: Column | None = None,
             ts_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", day: Column | None = None) -> DataFrame:
    """Render typed transactions as drop lines (``day``: business date of the file, else the operation's).

    ``comma_amount``: rows whose amount is written with a decimal comma;
    ``drop_terminal``: rows written with six fields (malformed on purpose).
    """
    amt = F.col("amount").cast("string")
    if comma_amount is not None:
        amt = F.when(comma_amount, F.regexp_replace(amt, r"\.", ",")).otherwise(amt)
    head = [F.col("transaction_id"), F.date_format("transaction_date", ts_format), amt,
            F.col("card_num"), F.col("oper_type"), F.col("oper_result")]
    full = F.concat_ws(";", *head, F.coalesce(F.col("terminal"), F.lit("")))
    line = full if drop_terminal is None else F.when(drop_terminal, F.concat_ws(";", *head)).otherwise(full)
    return df.select(line.alias(HEADER), F.date_format(F.to_date("transaction_date") if day is None else day, "ddMMyyyy").alias("_day"))


def write_lines(spark: SparkSession, lines: DataFrame, drop_dir: str, prefix: str = "transactions",
               ext: str = "txt") -> list[str]:
    """Write rendered lines as ``<prefix>_DDMMYYYY[-NNNNN].<ext>`` files with a header line.

    Every Spark task writes its own part file per day (no day funnels into
    one task); part files are then renamed into the drop folder.
    """
    stage = drop_dir.rstrip("/") + "_stage"
    (lines.write.mode("overwrite").partitionBy("_day").option("header", True)
          .option("quote", "").option("escape", "").option("sep", "\t")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(stage))
    fs, root = files._fs(spark, stage)
    names = []
    for day_dir in fs.listStatus(root):
        if not day_dir.isDirectory():
            continue
        day = day_dir.getPath().getName().split("=", 1)[1]
        parts = sorted(st.getPath().toString() for st in fs.listStatus(day_dir.getPath())
                       if st.getPath().getName().startswith("part-"))
        for i, p in enumerate(parts):
            name = f"{prefix}_{day}.{ext}" if len(parts) == 1 else f"{prefix}_{day}-{i:05d}.{ext}"
            files.rename(spark, p, f"{drop_dir.rstrip('/')}/{name}")
            names.append(name)
    return sorted(names)


def _xml_escape(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _col_letter(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: dict[str, pd.DataFrame]) -> bytes:
    """A minimal xlsx (shared strings for text, numbers as numbers)."""
    strings, index = [], {}

    def sidx(s):
        if s not in index:
            index[s] = len(strings)
            strings.append(s)
        return index[s]

    sheet_xml = []
    for _, pdf in sheets.items():
        rows = [list(pdf.columns)] + pdf.astype(object).values.tolist()
        out = []
        for r, vals in enumerate(rows, start=1):
            cells = []
            for c, v in enumerate(vals):
                ref = f"{_col_letter(c)}{r}"
                if v is None or (isinstance(v, float) and v != v):
                    continue
                if isinstance(v, (int, float)) and not isinstance(v, bool):
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="s"><v>{sidx(str(v))}</v></c>')
            out.append(f'<row r="{r}">{"".join(cells)}</row>')
        sheet_xml.append('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                         f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(out)}</sheetData></worksheet>')
    names = list(sheets)
    wb = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
          f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
          + "".join(f'<sheet name="{_xml_escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                    for i, n in enumerate(names)) + "</sheets></workbook>")
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{_NS["pr"]}">'
            + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/'
                      f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                      for i in range(len(names)))
            + f'<Relationship Id="rId{len(names) + 1}" Type="http://schemas.openxmlformats.org/'
              'officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
            + "</Relationships>")
    sst = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           f'<sst xmlns="{_NS["m"]}" count="{len(strings)}" uniqueCount="{len(strings)}">'
           + "".join(f"<si><t>{_xml_escape(s)}</t></si>" for s in strings) + "</sst>")
    ctypes = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
              '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
              '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
              '<Default Extension="xml" ContentType="application/xml"/>'
              '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-'
              'officedocument.spreadsheetml.sheet.main+xml"/>'
              + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/'
                        'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                        for i in range(len(names)))
              + '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-'
                'officedocument.spreadsheetml.sharedStrings+xml"/></Types>')
    root_rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<Relationships xmlns="{_NS["pr"]}"><Relationship Id="rId1" '
                 'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
                 'Target="xl/workbook.xml"/></Relationships>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", ctypes)
        z.writestr("_rels/.rels", root_rels)
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/sharedStrings.xml", sst)
        for i, x in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", x)
    return buf.getvalue()


def write_workbooks(df: DataFrame, drop_dir: str, prefix: str, sheet: str | None = None, day_col: str = "_day") -> int:
    """Write ``df`` as ``<prefix>_DDMMYYYY-<task>.xlsx`` files (one sheet ``sheet``, or a sheet per value
    of column ``_sheet`` with the columns it uses); returns their number.

    Tasks build the workbooks and write them to the shared folder themselves, under names that a repeated task
    overwrites; only their number comes back.
    """
    cols = [c for c in df.columns if c not in (day_col, "_sheet")]

    def sheets(g: pd.DataFrame) -> dict[str, pd.DataFrame]:
        if sheet is not None:
            return {sheet: g[cols].reset_index(drop=True)}
        return {name: x[cols].dropna(axis=1, how="all").reset_index(drop=True) for name, x in g.groupby("_sheet")}

    def build(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        parts = list(batches)
        if parts:
            for day, g in pd.concat(parts).groupby(day_col):
                name = f"{prefix}_{day}-{pid:05d}.xlsx"
                _write(f"{drop_dir.rstrip('/')}/{name}", xlsx_bytes(sheets(g)))
                yield pd.DataFrame({"name": [name]})

    return df.mapInPandas(build, "name string").count()


def _write(path: str, content: bytes) -> None:
    """Writes a file of the shared folder from a task: aside first, then moved to its name."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    folder, name = place.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.tmp"
    with store.open_output_stream(aside) as out:
        out.write(content)
    store.move(aside, place)

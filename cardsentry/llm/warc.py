"""WARC archives: writing pages with revisit records, reading by boundary-chain verification.

Writing: a record per page; of pages with equal payloads the one with the largest id holds it (response), the others
refer to it (revisit). Records are text, ended by the blank line that the text sink puts between rows, so Spark
writes plain WARC/1.0 files to any file system.

Reading: the text source parts files at the magic `WARC/1.0` line, which splits long files among tasks. What follows
a magic is a candidate record; its header says where its successor begins. Magic may lie inside a payload, so
candidates are verified: neighbours that follow each other without another way in form runs, and pointer jumping
over the runs, from the start of each file, keeps what can be reached. All else is payload. A record that a magic
inside its payload has parted is put together from its chunks.

Defined cases: null html is an empty payload; null ids are written and read back as null; rows repeating the largest
id of their payload are all responses; line ends in urls are escaped; a record that its file cuts off is left out;
files that do not begin with a record give none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cardsentry.llm.common import saved

#: Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

BROADCAST_ROWS = 100_000  # repeated digests (some 40 bytes each) that are broadcast at most


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: five hexadecimal digits make four of base 32."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The text of every page's record (column value), without the line ends that close it."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"sha1": F.sha1("html"), "n": F.octet_length("html")})
    repeated = saved(rows.filter(F.col("n") >= least_bytes).groupBy("sha1", "n").agg(F.max("page_id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c"), "repeated")
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, ["sha1", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_id(F.col("first"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return rows.select(F.concat(header, block).alias("value"))


def write(pages: DataFrame, path: str, *, least_bytes: int = 0, records_per_file: int = 100_000) -> None:
    """Writes the pages (page_id, url, html) as WARC files to a new folder."""
    records(pages, least_bytes).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


_LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|$)", re.I)


def _extent(data: bytes) -> int | None:
    """Bytes from after the magic to the next record, if `data` begins with a record's header."""
    end = data.find(b"\r\n\r\n")
    length = _LENGTH.search(data, 0, end) if end > 0 else None
    return end + 4 + int(length[1]) + 4 if length else None


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in lines.decode("utf-8", "replace").split("\r\n") if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in reversed([*pairs])}


def parse(data: bytes, keep: bool) -> dict:
    """A record's fields; data: what follows its magic, up to the line ends that close it."""
    end = data.find(b"\r\n\r\n")
    head, block = _fields(data[:end]), data[end + 4 : -4]
    payload, said = block, {}
    if head.get("content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n")
        said, payload = _fields(block[: max(at, 0)]), block[at + 4 :] if at >= 0 else b""
    out = {"type": head.get("warc-type"), "record_id": head.get("warc-record-id"), "uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to")}
    if out["type"] == "revisit":
        told = said.get("content-length", "")
        return out | {"payload_bytes": int(told) if told.isdigit() else None, "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload": None}
    return out | {"payload_bytes": len(payload), "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(), "payload": payload if keep else None}


_RECORD = pa.struct([("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
_RECORD_SQL = "struct<type:string,record_id:string,uri:string,refers_to:string,payload_bytes:bigint,payload_digest:string,payload:binary>"


def chunks(spark: SparkSession, path: str, keep: bool) -> DataFrame:
    """What lies between magics: file, block (split), rel and n (place in the split, bytes), next (where a record that
    begins here would end, in the split's terms; null: no header), whole (ends at the next magic), record (if whole)
    and data (kept if not whole, or if a record before it in the split claims it; with `keep`, of all that have no record).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, rel, claimed = None, 0, -1
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                out = []
                for data, file, block in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if (file, block) != split:
                        split, rel, claimed = (file, block), 0, -1
                    extent = _extent(data)
                    whole = extent == len(data)
                    inside = rel < claimed
                    out.append({"file": file, "block": block, "rel": rel, "n": len(data), "next": None if extent is None else rel + extent, "whole": whole,
                                "record": parse(data, keep) if whole else None, "data": data if keep or inside or not whole else None})
                    if extent is not None and not whole:
                        claimed = max(claimed, rel + extent)
                    rel += len(data) + len(MAGIC)
                yield pa.RecordBatch.from_pylist(out, schema=_CHUNK)

    rows = spark.read.option("lineSep", MAGIC).text(path).select(F.col("value").cast("binary"), "_metadata.file_path", "_metadata.file_block_start")
    return rows.mapInArrow(run, f"file string, block long, rel long, n long, next long, whole boolean, record {_RECORD_SQL}, data binary")


_CHUNK = pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("n", pa.int64()), ("next", pa.int64()), ("whole", pa.bool_()),
                    ("record", _RECORD), ("data", pa.binary())])


def placed(found: DataFrame) -> DataFrame:
    """Adds at (offset of the magic before the chunk; -len(MAGIC) for a file's first) and succ (of the successor)."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("file", "block").agg(F.sum(F.col("n") + len(MAGIC)).alias("span"))
    base = spans.select("file", "block", F.coalesce(F.sum("span").over(before), F.lit(0)).alias("base"))
    out = found.join(base, ["file", "block"])
    return out.withColumns({"at": F.col("base") + F.col("rel") - len(MAGIC), "succ": F.col("base") + F.col("next")}).drop("base", "rel", "next", "block")


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, at, succ) on the chain from each file's start, by pointer jumping."""
    order = Window.partitionBy("file").orderBy("at")
    linked = candidates.withColumn("linked", F.coalesce(F.lag("succ").over(order) == F.col("at"), F.lit(False)))
    linked = saved(linked.withColumn("follows", F.coalesce(F.lead("at").over(order) == F.col("succ"), F.lit(False))), "linked")
    # a run must not be entered in its middle: places that others than the neighbour point to begin runs, too
    entered = linked.filter("NOT follows").select("file", F.col("succ").alias("at")).distinct().withColumn("entered", F.lit(True))
    runs = linked.join(entered, ["file", "at"], "left").withColumn("begins", ~F.col("linked") | F.coalesce("entered", F.lit(False)))
    runs = saved(runs.withColumn("run", F.sum(F.col("begins").cast("long")).over(order)).select("file", "at", "succ", "run"), "runs")
    jump = runs.groupBy("file", "run").agg(F.min("at").alias("at"), F.max_by("succ", "at").alias("to")).select("file", "at", "to")
    jump = saved(jump, "jump")
    reached, before = jump.filter("at = 0").select("file", "at"), -1
    while True:
        reached = saved(reached.union(reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).join(jump.select("file", "at"), ["file", "at"], "left_semi").distinct(), "reached")
        now = reached.count()
        if now == before:
            break
        before = now
        ahead = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = saved(jump.join(ahead, ["file", "to"], "left").select("file", "at", F.coalesce("further", "to").alias("to")), "jump")
    heads = runs.join(reached, ["file", "at"], "left_semi").select("file", "run")
    return runs.join(heads, ["file", "run"], "left_semi").select("file", "at")


def read(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Verified records of the WARC files in a folder: file, at (offset), type, record_id, uri, refers_to,
    payload_bytes, payload_digest (bare base32 SHA-1) and payload (null for revisits, and without `payloads`).
    """
    out = _read(spark, path, payloads, payloads)
    if out is None:  # a parted record goes on in another split, where its chunks were taken for records
        out = _read(spark, path, True, payloads)
    return out


def _read(spark: SparkSession, path: str, keep: bool, payloads: bool) -> DataFrame | None:
    every = saved(placed(chunks(spark, path, keep)), "chunks")
    sizes = every.groupBy("file").agg(F.max(F.col("at") + F.col("n") + len(MAGIC)).alias("size"))
    good = saved(reachable(every.filter("at >= 0 AND succ IS NOT NULL").select("file", "at", "succ")), "good")
    true = every.join(good, ["file", "at"])
    shown = F.col("record") if payloads else F.col("record").withField("payload", F.lit(None).cast("binary"))
    whole = true.filter("whole").select("file", "at", shown.alias("record"))
    parted = saved(true.filter("NOT whole").join(sizes, "file").filter("succ <= size").select("file", F.col("at").alias("start"), "succ"), "parted")
    if not parted.isEmpty():
        # chunks of parted records, found by the last record that begins before them
        marks = every.select("file", "at", "n", "data").join(parted.select("file", F.col("start").alias("at"), "start", "succ"), ["file", "at"], "left")
        held = marks.withColumns({c: F.last(c, ignorenulls=True).over(Window.partitionBy("file").orderBy("at")) for c in ("start", "succ")}).filter("at < succ")
        joined = held.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("at", "data"))).alias("parts"), F.max("succ").alias("succ"),
                                                   F.sum(F.col("n") + len(MAGIC)).alias("n"), F.count_if(F.col("data").isNull()).alias("missing"))
        joined = saved(joined, "joined")
        if not joined.filter("missing > 0").isEmpty():
            return None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 32):
                    part = batch.slice(at, 32)
                    made = [parse(MAGIC.encode().join(p["data"] for p in parts), payloads) for parts in part.column(2).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, _RECORD)], ["file", "at", "record"])

        again = joined.filter("n = succ - start").select("file", "start", "parts").mapInArrow(run, f"file string, at long, record {_RECORD_SQL}")
        whole = whole.union(again)
    return whole.select("file", "at", "record.*")

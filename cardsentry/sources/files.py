"""File-system helpers through Hadoop's FileSystem (works for any cluster FS).

Only metadata passes through the driver: listings, renames, directory
creation. File contents are always read by Spark tasks.
"""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Business date in a drop file name: transactions_DDMMYYYY.txt (also with a
# part suffix such as transactions_DDMMYYYY-00003.txt).
DATE_IN_NAME = r"_(\d{8})(?:\D|$)"


@dataclass(frozen=True)
class FileInfo:
    name: str
    path: str
    size: int
    mtime: int


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def total_size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> list[FileInfo]:
    """Plain files directly under ``directory`` whose name matches ``pattern`` (sorted)."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isFile():
            name = st.getPath().getName()
            if fnmatch.fnmatch(name, pattern):
                out.append(FileInfo(name, st.getPath().toString(), int(st.getLen()),
                                    int(st.getModificationTime())))
    return sorted(out, key=lambda f: f.name)


def modified(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def list_dirs(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the folders directly under ``directory`` (sorted; none if it is missing)."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file through the Hadoop file system (any cluster FS)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    return bool(fs.rename(s, d))


def business_date_of(name: str):
    """DDMMYYYY in a file name -> date (driver-side, for file names only)."""
    import datetime as dt
    m = re.search(DATE_IN_NAME, name)
    return dt.datetime.strptime(m.group(1), "%d%m%Y").date() if m else None


def local_path(path: str) -> str:
    """Path usable by Python file IO in tasks (``file:`` URIs only)."""
    if path.startswith("file:"):
        path = re.sub(r"^file:(//)?", "", path)
        if not path.startswith("/"):
            path = "/" + path
    elif re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", path):
        raise ValueError(f"python-side file IO needs a local or mounted path, got {path}")
    return path

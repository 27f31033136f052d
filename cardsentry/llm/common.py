"""Helpers shared by the training-data operators: checkpoints, word and shingle hashes."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whitespace bytes that part words (fixed values: space and the controls 9 to 13).
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_SPACES = re.compile(b"[" + SPACE + b"]")
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20  # bytes hashed at a time


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder named in spark.checkpoint.dir.

    Where the setting is absent, local sessions (tests) get a temporary folder; a cluster must name one.
    """
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not root and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='cardsentry-')}")
    return f"{(root or context.getCheckpointDir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.saved_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes the files of `saved` tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Remembered(dict):
    """Results by text, found when first asked for; bounded by the bytes that keys, values and entries take.

    Texts beyond `longest` characters are found anew each time. At half of the bound the entries become the older
    half; what is asked for again moves back, and the rest is forgotten when the next half is full.
    """

    ENTRY = 50  # bytes of an entry of a dict, about

    def __init__(self, find, most_bytes: int, longest: int = 64):
        super().__init__()
        self.find, self.half, self.longest, self.used = find, most_bytes // 2, longest, 0
        self.older: dict = {}

    def __missing__(self, text: str):
        found = self.older.pop(text, None)
        if found is None:
            found = self.find(text)
            if len(text) > self.longest:
                return found
        self.used += sys.getsizeof(text) + sys.getsizeof(found) + self.ENTRY
        if self.used > self.half:
            self.older = dict(self)
            self.clear()
            self.used = 0
        self[text] = found
        return found


SIEVE_WORDS = 1 << 19  # of 64 bits: the most rows of a sieve, some 16 bytes each


def _sieve_place(columns: Sequence[Column]) -> tuple[Column, Column]:
    """The word that stands for a key, and its four bits there."""
    bits = F.xxhash64(F.lit(1), *columns)
    at = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(bits, 6 * k) % 64).cast("int"))
    mask = at(1)
    for k in range(2, 5):
        mask = mask.bitwiseOR(at(k))
    return F.pmod(F.xxhash64(*columns), F.lit(SIEVE_WORDS)), mask


def sieved(rows: DataFrame, keys: DataFrame, on: Sequence[str], *, keep: bool = True) -> DataFrame:
    """Rows whose columns `on` may be those of a row of `keys` (keep), or surely are not (not keep).

    A Bloom filter of at most SIEVE_WORDS words, whatever the number of keys, so that it can be broadcast: wide rows
    then only shuffle if they may match. Many more keys than words let all rows pass, never too few. Nulls are keys.
    """
    word, mask = _sieve_place([F.col(c) for c in on])
    words = saved(keys.select(word.alias("sieve_word"), mask.alias("m")).groupBy("sieve_word").agg(F.bit_or("m").alias("sieve_bits")), "sieve")
    word, mask = _sieve_place([rows[c] for c in on])
    met = rows.join(F.broadcast(words), word == words["sieve_word"], "left")
    held = F.coalesce(F.col("sieve_bits").bitwiseAND(mask) == mask, F.lit(False))
    return met.filter(held if keep else ~held).drop("sieve_word", "sieve_bits")


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (shift, multiply) of an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULTIPLIER, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_UP = _powers(_BLOCK + 1)
_DOWN = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(_BLOCK, _INVERSE, np.uint64)]))


def _block_words(raw: np.ndarray) -> np.ndarray:
    """Hashes of the words of one block of at most _BLOCK bytes."""
    word = ~_IS_SPACE[raw]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)], dtype=np.uint64)])
    return mixed((total[end] - total[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def _long_word(data: bytes, start: int, end: int) -> np.ndarray:
    """Hash of the one word data[start:end], of any length."""
    total, power = end - start, 1
    for at in range(start, end, _BLOCK):
        raw = np.frombuffer(data, np.uint8, min(_BLOCK, end - at), at)
        total += int(((raw.astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)]).sum(dtype=np.uint64)) * power
        power = power * int(_UP[_BLOCK]) % (1 << 64)
    return mixed(np.array([total % (1 << 64)], np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each whitespace-separated word of UTF-8 `data`, in order.

    Works through blocks cut at whitespace, so that memory stays near eight bytes a word. A single word
    longer than a block is summed up block by block; its hash does not depend on where it starts.
    """
    if len(data) <= _BLOCK:
        return _block_words(np.frombuffer(data, np.uint8))
    parts, at = [], 0
    while at < len(data):
        to = min(at + _BLOCK, len(data))
        if to < len(data):
            cut = max(data.rfind(bytes([s]), at, to) for s in SPACE)
            if cut < at:
                space = _SPACES.search(data, to)
                to = space.start() if space else len(data)
                parts.append(_long_word(data, at, to))
                at = to
                continue
            to = cut + 1
        parts.append(_block_words(np.frombuffer(data, np.uint8, to - at, at)))
        at = to
    return np.concatenate(parts)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` words, in order; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x100000001B3) + words[j : j + n]
    return mixed(out + np.uint64(k))

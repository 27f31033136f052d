"""Versions of a dimension in two parts: closed ones, only ever added to, and open ones, replaced by every step.

Layout under one root folder:
  closed-<name>/   versions that one step has closed; written once
  open-<name>/     the open versions after a step
  state/<number>/  one row per step: number, generation, through, applied_at, and the step's two folders

A step writes its folders first and then moves its state row into place, which makes it count: what an interrupted
step has left is never read. The present versions are the open folder of the last state row and the closed folders of
all rows of its generation. A rebuild starts a new generation. So a step writes what it closes and what is open, and
not the history; when a generation has MOST_FOLDERS closed folders, the next step merges them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.sources import files

STATE = "number long, generation long, through date, applied_at timestamp_ntz, closed string, open string"
MOST_FOLDERS = 64


class VersionStore:
    def __init__(self, spark: SparkSession, root: str, schema):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def steps(self) -> list:
        """State rows of the present generation, by number (one per step, a bounded number)."""
        paths = [p for p in files.list_dirs(self.spark, f"{self.root}/state") if p.rsplit("/", 1)[1].isdigit()]
        if not paths:
            return []
        rows = sorted(self.spark.read.schema(STATE).parquet(*paths).collect(), key=lambda r: r["number"])
        return [r for r in rows if r["generation"] == rows[-1]["generation"]]

    def state(self):
        """The last step's row, None before the first."""
        steps = self.steps()
        return steps[-1] if steps else None

    def _part(self, names) -> DataFrame:
        paths = [f"{self.root}/{n}" for n in names if n]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def closed(self) -> DataFrame:
        return self._part([r["closed"] for r in self.steps()])

    def open(self) -> DataFrame:
        state = self.state()
        return self._part([state["open"]] if state else [])

    def read(self) -> DataFrame:
        """All versions."""
        return self.closed().unionByName(self.open())

    def advance(self, closed: DataFrame, current: DataFrame, through: dt.date, applied_at: dt.datetime) -> None:
        """One step: versions that it closes, and the open versions after it."""
        steps = self.steps()
        if len(steps) >= MOST_FOLDERS:
            self._commit(self.closed().unionByName(closed), current, through, applied_at, steps[-1]["generation"] + 1)
        else:
            self._commit(closed, current, through, applied_at, steps[-1]["generation"] if steps else 0)

    def rebuild(self, versions: DataFrame, is_open, through: dt.date, applied_at: dt.datetime) -> None:
        """All versions anew."""
        state = self.state()
        self._commit(versions.where(~is_open), versions.where(is_open), through, applied_at, state["generation"] + 1 if state else 0)

    def _commit(self, closed: DataFrame, current: DataFrame, through: dt.date, applied_at: dt.datetime, generation: int) -> None:
        before, name = self.steps(), uuid.uuid4().hex[:12]
        number = before[-1]["number"] + 1 if before else 0
        columns = [f.name for f in self.schema]
        closed.select(*columns).write.parquet(f"{self.root}/closed-{name}")
        current.select(*columns).write.parquet(f"{self.root}/open-{name}")
        row = [(number, generation, through, applied_at, f"closed-{name}", f"open-{name}")]
        fresh = f"{self.root}/state_next-{name}"
        self.spark.createDataFrame(row, STATE).coalesce(1).write.parquet(fresh)
        if not files.rename(self.spark, fresh, f"{self.root}/state/{number:012d}"):
            raise OSError(f"cannot move {fresh} into place")
        for r in before:    # what the new state does not name any more
            files.delete(self.spark, f"{self.root}/{r['open']}")
            if r["generation"] != generation:
                files.delete(self.spark, f"{self.root}/{r['closed']}")
                files.delete(self.spark, f"{self.root}/state/{r['number']:012d}")

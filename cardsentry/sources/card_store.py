"""J1-J3 on co-partitioned storage: operations and card profiles kept in the same buckets of the card, sorted by it.

A table that is enriched again and again is shuffled once, when it is stored: both sides are ``bucketBy`` tables with
as many buckets, so that their join plans no Exchange. A bucket is read by one task, so cards that hold more rows than
a bucket should are stored aside, in a table without buckets, as are operations without a card: these are fewer than
``buckets`` cards, and their profiles are broadcast if their size allows.

Defined cases: operations without a card, or with an unknown one, join nothing (they are stored all the same); repeated
rows stay; a card with several profiles gives a row for each; empty tables give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.operators.sizing import broadcast_if_small
from cardsentry.sources import files

KEY = "card_num"


@dataclass(frozen=True)
class CardStore:
    """Names of the tables in the session's catalog, and the shared folder that holds them."""

    name: str
    folder: str

    @property
    def even(self) -> str:
        return f"{self.name}_even"

    @property
    def hot(self) -> str:
        return f"{self.name}_hot"

    @property
    def profiles(self) -> str:
        return f"{self.name}_profiles"

    @property
    def hot_profiles(self) -> str:
        return f"{self.name}_hot_profiles"

    def _save(self, df: DataFrame, table: str, buckets: int = 0) -> None:
        # one file a bucket: rows are dealt by the hash that bucketBy uses, so each task writes one bucket
        writer = (df.repartition(buckets, KEY) if buckets else df).write.format("parquet").mode("overwrite")
        writer = writer.option("path", f"{self.folder}/{table}")
        (writer.bucketBy(buckets, KEY).sortBy(KEY) if buckets else writer).saveAsTable(table)

    def write(self, operations: DataFrame, profile: DataFrame, buckets: int) -> None:
        """Stores operations and card profiles (``enrich.card_profile``) in `buckets` buckets each."""
        spark = operations.sparkSession
        counts = operations.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("_n"))
        total = operations.count()
        # more rows than a bucket's even share: fewer than `buckets` cards can hold so many
        self._save(counts.where(F.col("_n") * buckets > total).select(KEY), f"{self.name}_hot_cards")
        hot = F.broadcast(spark.table(f"{self.name}_hot_cards"))
        self._save(operations.where(F.col(KEY).isNotNull()).join(hot, KEY, "left_anti"), self.even, buckets)
        aside = operations.join(hot, KEY, "left_semi").unionByName(operations.where(F.col(KEY).isNull()))
        self._save(aside, self.hot)
        self._save(profile, self.profiles, buckets)
        self._save(profile.join(hot, KEY, "left_semi"), self.hot_profiles)

    def enriched(self, spark: SparkSession, columns: list[str]) -> DataFrame:
        """Stored operations with their profiles: `columns` of both."""
        # both sides are read in their buckets; the hint keeps a small side from being sent around all the same
        even = spark.table(self.even).join(spark.table(self.profiles).hint("merge"), KEY)
        hot = spark.table(self.hot).join(broadcast_if_small(spark.table(self.hot_profiles)), KEY)
        return even.select(*columns).unionByName(hot.select(*columns))

    def drop(self, spark: SparkSession) -> None:
        """Forgets the tables and deletes their files."""
        for table in (self.even, self.hot, self.profiles, self.hot_profiles, f"{self.name}_hot_cards"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        files.delete(spark, self.folder)

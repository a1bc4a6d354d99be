"""Tables kept in buckets of their key, so that the archive and the cache are joined and looked up without a shuffle.

The archive is one table that only grows: a row for every row of a batch, with the version that it has and what was done.
It is bucketed by key. A batch is dealt into the same buckets and joined there with the rows of its keys, so that only
the batch is shuffled; the current records and the current view are aggregates by key over a scan of the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a table; a bucket should fit in a task.
BUCKETS = 16


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int = BUCKETS, mode: str = "overwrite") -> DataFrame:
    """``df`` as a table with its rows dealt by ``keys`` into ``buckets``, a file each, in order of the keys."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


class BucketedArchive:
    """A versioned archive of contents by key, as the table ``table``.

    New content of a key gets the next version, content that it had before its old number; equal content is only noted.
    A batch (key, hash, payload) has a number of its own, ``run``, that grows from batch to batch; a batch whose number is in
    the archive already is not added again, so that a rerun changes nothing. Of rows of a batch that share a key the
    one with the smallest hash is taken; a null key is left out, since buckets are joined by equality.
    """

    COLUMNS = "hash string, version int, payload string, action string, run long"

    def __init__(self, spark: SparkSession, table: str, key: T.StructField, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.key, self.buckets = spark, table, key.name, buckets
        self.schema = T.StructType([key, *T.StructType.fromDDL(self.COLUMNS)])
        if not spark.catalog.tableExists(table):
            save_bucketed(spark.createDataFrame([], self.schema), table, [self.key], buckets)

    def log(self) -> DataFrame:
        return self.spark.table(self.table)

    def _states(self, log: DataFrame) -> DataFrame:
        """key, its current record, the version of each content and the highest version."""
        known = F.map_from_entries(F.collect_list(F.when(F.col("action").isin("inserted", "updated"), F.struct("hash", "version"))))
        return log.groupBy(self.key).agg(F.max_by(F.struct("hash", "version"), "run").alias("now"), known.alias("known"), F.max("version").alias("top"))

    def upsert(self, batch: DataFrame, run: int) -> DataFrame:
        """Adds a batch and returns its counts by action."""
        rows = batch.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(F.struct("hash", "payload")).alias("b"))
        rows = rows.select(self.key, F.col("b.hash").alias("hash"), F.col("b.payload").alias("payload"))
        if self.log().filter(F.col("run") == run).isEmpty():
            dealt = rows.repartition(self.buckets, self.key)
            states = self._states(self.log().join(dealt.select(self.key), self.key, "left_semi"))
            joined = dealt.join(states, self.key, "left")
            old = F.element_at("known", F.col("hash"))
            action = F.when(F.col("now").isNull(), "inserted").when(F.col("now.hash") == F.col("hash"), "unchanged").when(old.isNotNull(), "reverted").otherwise("updated")
            version = F.when(F.col("now.hash") == F.col("hash"), F.col("now.version")).otherwise(F.coalesce(old, F.coalesce("top", F.lit(0)) + 1))
            added = joined.select(self.key, "hash", version.cast("int").alias("version"), "payload", action.alias("action"), F.lit(run).cast("long").alias("run"))
            added.write.format("parquet").mode("append").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.table)
        return self.log().filter(F.col("run") == run).groupBy("action").agg(F.count(F.lit(1)).alias("n"))

    def records(self) -> DataFrame:
        """key, hash, version, last_run of the current records."""
        current = self.log().groupBy(self.key).agg(F.max_by(F.struct("hash", "version"), "run").alias("now"), F.max("run").alias("last_run"))
        return current.select(self.key, "now.hash", "now.version", "last_run")

    def current_view(self) -> DataFrame:
        """key, version, payload: the content that each key has now."""
        made = F.collect_list(F.when(F.col("action").isin("inserted", "updated"), F.struct("version", "payload")))
        current = self.log().groupBy(self.key).agg(F.max_by("version", "run").alias("version"), F.map_from_entries(made).alias("payloads"))
        return current.select(self.key, "version", F.element_at("payloads", F.col("version")).alias("payload"))

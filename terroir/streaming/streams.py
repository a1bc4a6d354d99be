"""Structured Streaming forms of the incremental operators. Keyed state is in ``state.py``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.operators.common import scratch


def arriving(df: DataFrame, order: str, pieces: int) -> Iterator[DataFrame]:
    """``df`` as a stream whose rows land in pieces by ranges of ``order`` (null first), one more each time the stream
    is given out. The pieces are made in one pass, by as many tasks as read ``df``, and land by renaming a folder."""
    spark, staged, landed = df.sparkSession, scratch(df.sparkSession, "staged"), scratch(df.sparkSession, "landed")
    key = F.unix_micros(order) if dict(df.dtypes)[order] == "timestamp" else F.col(order)
    keyed = df.withColumn("__key", key.cast("double"))
    cuts = keyed.approxQuantile("__key", [i / pieces for i in range(1, pieces)], 0.01)
    piece = F.coalesce(sum((F.col("__key") > cut).cast("int") for cut in cuts), F.lit(0)) if cuts else F.lit(0)
    keyed.withColumn("__piece", piece).drop("__key").write.partitionBy("__piece").parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(landed))
    for i in range(pieces):
        if files.exists(path(f"{staged}/__piece={i}")):
            files.rename(path(f"{staged}/__piece={i}"), path(f"{landed}/piece-{i}"))
        yield spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(landed)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that has landed and ends; returns what it wrote as Parquet."""
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def deduplicated(stream: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """One row a key, repeats being looked for within the watermark's delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], size: str, slide: str | None, delay: str) -> DataFrame:
    """Counts over tumbling (or, with ``slide``, sliding) windows of event time, out when the watermark has passed."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return stream.withWatermark(time, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")

"""Helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Rows, and bytes of these rows as JSON, up to which a rule table or dimension may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows of together at most ``most`` bytes, written as
    JSON, and unchanged (a shuffled join) otherwise. The check reads at most one row more than the limit."""
    bytes_of = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.limit(limit + 1).select(bytes_of.alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= most else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, or the one set on the context. Where neither is
    set, a temporary folder in local mode, which has one machine; an error on a cluster."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all machines share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet files in a new shared folder, for rows that several readers must see alike."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Parts for each core over which rows are dealt where a task sorts, gathers or parses them.
PARTS = 16


def dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` in a fixed number of parts, by the keys or, without keys, in turn. Parts that Spark chooses by their bytes
    in a shuffle may hold many more rows the better these compress, and a small file is one part however costly a row."""
    return df.repartition(PARTS * df.sparkSession.sparkContext.defaultParallelism, *keys)


def running(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over all rows up to each in a global order. Rows are dealt by range and summed within
    parts; only the sum of each part reaches the driver. Equal keys lie in one part."""
    placed = written(df.withColumn("__v", value.cast("long")).repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before, seen = [], 0
    for part, n in sorted(map(tuple, placed.groupBy("__part").agg(F.sum("__v")).collect())):
        before.append((part, seen))
        seen += n or 0
    offsets = df.sparkSession.createDataFrame(before or [(0, 0)], "__part int, __before long")
    w = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, F.sum("__v").over(w) + F.col("__before")).drop("__v", "__part", "__before")


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Numbers from 1 in a total order, without gathering the rows."""
    return running(df, order, F.lit(1), name)


#: Characters by which names are filed, and texts looked through.
GRAM = 3


def grams(text: Column, n: Column | int) -> Column:
    """The distinct parts of a text with ``n`` characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    parts = F.array_distinct(F.transform(at, lambda i: F.substring(text, i, n if isinstance(n, Column) else F.lit(n))))
    return F.when(F.length(text) >= n, parts).otherwise(F.array().cast("array<string>"))


def contained(texts: DataFrame, text: str, names: DataFrame, name: str, gram: int = GRAM) -> DataFrame:
    """Rows of ``texts`` with each row of ``names`` whose name stands in the text.

    Each name is filed under that of its parts of ``gram`` characters that the fewest texts hold (a shorter name under
    itself); a text looks up its own parts and then the whole name. A name with a part that no text holds is dropped
    before. A text makes at most a row for each character and ``gram`` at most, however many lengths names have.
    """
    named = names.select(F.col(name).alias("__name")).distinct().filter("__name <> ''").withColumn("__n", F.least(F.length("__name"), F.lit(gram)))
    lengths = sorted(r[0] for r in named.select("__n").distinct().collect())  # ``gram`` at most
    if not lengths:
        return texts.join(names, F.lit(False))
    keyed = texts.withColumn("__part", F.explode(F.concat(*[grams(F.col(text), n) for n in lengths])))
    parts = named.select("__name", F.explode(grams(F.col("__name"), F.col("__n"))).alias("__part"))
    held = keyed.select("__part").join(parts.select("__part").distinct(), "__part", "left_semi").groupBy("__part").agg(F.count(F.lit(1)).alias("__texts"))
    rare = parts.join(held, "__part", "left").withColumn("__texts", F.coalesce("__texts", F.lit(0))).groupBy("__name").agg(F.min(F.struct("__texts", "__part")).alias("__least"))
    filed = rare.filter("__least.__texts > 0").select("__name", F.col("__least.__part").alias("__part"))
    looked_up = filed.join(names, F.col("__name") == F.col(name)).drop("__name")
    return keyed.join(looked_up, "__part").filter(F.contains(text, name)).drop("__part")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """code, key of every rule that a row breaks (the rule's column is true)."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in rules.items()]))
    return df.select(F.explode(found).alias("code"), key.cast("string").alias("key"))

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an aggregated side, and bytes of these as JSON, up to which it may be broadcast; beyond, a shuffled join is used.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
#: A join key is hot if it holds more than 1/HOT of all rows, and more than HOT_ROWS.
HOT, HOT_ROWS = 1024, 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, or the one set on the context. Where neither is
    set, a temporary folder in local mode, which has one machine; an error on a cluster."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, so that several readers (and retries after a
    lost executor) start from files."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """``df`` as Parquet files in the shared checkpoint folder: for tables so large that the compression counts,
    which a checkpoint doesn't have."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``limit`` rows of together at most ``most`` bytes as JSON, found by reading no more
    than one row beyond it."""
    bytes_of = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.limit(limit + 1).select(bytes_of.alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    return rows <= limit and (size or 0) <= most


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores more as it takes for no column of ``df`` to be called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], n: str = "n") -> DataFrame:
    """The rows of ``left`` that have their keys in ``right``, with its columns but for ``n``; keys are unique in
    ``right``, and ``n`` is how often each stands in ``left``. A key with more than 1/``HOT`` of these rows is dealt
    over several tasks, by a hash of the columns ``spread``; there are at most ``HOT`` such keys."""
    limit = max((right.agg(F.sum(n)).first()[0] or 0) / HOT, HOT_ROWS)
    salted = right.withColumn("__salts", F.ceil(F.col(n) / limit).cast("int")).drop(n)
    hot = salted.filter("__salts > 1").select(*keys, "__salts")
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*spread), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts")
    return dealt.join(salted.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts"), [*keys, "__salt"]).drop("__salt")


def row_numbers(df: DataFrame, *order: Column, name: str = "row_number") -> DataFrame:
    """Number all rows from 0 in a global order without gathering them: rows are dealt by range and sorted
    within partitions; only the row count of each partition reaches the driver."""
    placed = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    offsets, seen = [], 0
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect()):
        offsets.append((p, seen))
        seen += n
    table = df.sparkSession.createDataFrame(offsets or [(0, 0)], "__p long, __offset long")
    return (
        placed.join(F.broadcast(table), part == F.col("__p"))
        .withColumn(name, F.col("__offset") + F.col("__at").bitwiseAND((1 << 33) - 1))
        .drop("__at", "__p", "__offset")
    )

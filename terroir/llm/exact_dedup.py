"""Exact dedup by content sort.

Normalised texts are dealt to ranges by sampled splitters and sorted there, so that equal texts lie next to
each other; each row is compared in full with the row before it. Splitters and leading sort keys are a short
prefix and a 64-bit hash of the text (what the driver samples stays small); the id comes next, so a text that
a third of all rows share is split over many ranges. Runs whose hash is that of the first or last row of a batch may
go on elsewhere: they are few, and are merged by SHA-256 after each has been reduced to one row.

Defined results: null text counts as empty; a null id sorts last and is kept only if all ids of the group are
null; of rows that repeat with the same id and text exactly one is kept; an empty table gives an empty table.
Further columns are ignored here and returned by ``drop_exact_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import checkpoint, documents, free_names, text_of

SPACE = r"[\x20\x09-\x0D]+"
PREFIX = 24
_SEGMENT = "part int, seq long, first_id long, n long, sha string, open boolean, ids array<long>"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), SPACE, " ")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (hash, text, id) to one row for each run of equal texts within a batch."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text, ids = batch.column("text"), batch.column("id")
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = pc.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        hashes = batch.column("hash").to_numpy()
        opened = (hashes[starts] == hashes[0]) | (hashes[starts] == hashes[-1])
        sha = [hashlib.sha256(text[i].as_buffer() or b"").hexdigest() for i in starts.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), part, np.int32)),
                pa.array(np.arange(seq, seq + len(starts))),
                ids.take(pa.array(starts)),
                pa.array(ends - starts),
                pa.array(sha),
                pa.array(opened),
                pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype(np.int32)), ids),
            ],
            names=["part", "seq", "first_id", "n", "sha", "open", "ids"],
        )
        seq += len(starts)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), normalised(text_col).alias("text")).select(
        F.substring("text", 1, PREFIX).alias("head"), F.xxhash64("text").alias("hash"), "id", "text"
    )
    order = [F.col("head").asc(), F.col("hash").asc(), F.col("id").asc_nulls_last()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order[:2], F.col("text").asc(), order[2])
    segments = checkpoint(ranged.select("hash", "id", "text").mapInArrow(_segments, _SEGMENT))
    # structs with fields in order of rank: smallest id, null last, then place
    rank = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "part", "seq")
    merged = segments.filter("open").groupBy("sha").agg(F.min(rank).alias("best"), F.sum("n").alias("size"))
    closed = segments.filter("not open").select(
        F.posexplode("ids").alias("at", "doc_id"), F.col("first_id").alias("keep_id"), F.col("n").alias("group_size"), F.lit(True).alias("leads"), "sha"
    )
    opened = (
        segments.filter("open")
        .join(merged, "sha")
        .select(
            F.posexplode("ids").alias("at", "doc_id"),
            F.col("best.first_id").alias("keep_id"),
            F.col("size").alias("group_size"),
            ((F.col("part") == F.col("best.part")) & (F.col("seq") == F.col("best.seq"))).alias("leads"),
            "sha",
        )
    )
    return closed.unionByName(opened).select(
        "doc_id", "keep_id", "group_size", ((F.col("at") == 0) & F.col("leads")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text an earlier id has; rows that repeat an id and its text collapse
    to one, rows with a null id stay as one of each text."""
    its_id, sha, own = free_names(df, "__id", "__sha", "__sha_own")
    kept = exact_groups(df, id_col, text_col).filter("kept").select(F.col("doc_id").alias(its_id), F.col("text_sha256").alias(sha))
    left = df.withColumn(own, F.sha2(normalised(text_col).cast("binary"), 256))
    once = left.join(kept, F.col(id_col).eqNullSafe(F.col(its_id)) & (F.col(own) == F.col(sha)), "left_semi")
    return once.dropDuplicates([id_col, own]).drop(own)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


SQL = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)
"""

"""The corpus pipeline: five stages, each written as Parquet and reread as the next one's documents.

Toxic documents go; of equal texts and of near duplicates one document stays; sources are mixed to their target
weights, which repeats documents; the last stage encodes every document that is left and checks its decoding.

Defined results: null text counts as empty in every stage, and empty texts are equal to each other; a null id is
never labelled, is kept only where no equal or near text has an id, and draws in the mix like the id "null"; rows that
repeat an id and its text are one document from the second stage on; a source without words is left out of the mix;
further columns go along up to the last stage; empty tables give an empty table. Folders of the stages that nothing
reads any more are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm import bpe, exact_dedup, mixing, simhash, toxicity
from terroir.llm.common import checkpoint_folder, removed


def toxic_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def copies_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text."""
    both = bpe.encode(docs, bpe.rank_file(), ids_col="ids", decoded_col="__decoded", keep=["doc_id", "source", "text"])
    exact = F.col("__decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return both.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("toxicity", toxic_removed),
    ("exact dedup", copies_removed),
    ("SimHash near-dedup", near_copies_removed),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

#: SQL can't express the learned scores, the fingerprints or the merges; tests compare all stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4()}"
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{i}")
        if i:
            removed(docs)
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{i}")
    return docs

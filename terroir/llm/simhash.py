"""SimHash near-duplicates by pivot distance tables.

A fingerprint has 64 bits: bit k is 1 if it is set in over half of the XXH64 values of the document's 3-word
shingles. Two fingerprints link if they differ in at most ``bits`` = 2 bits, and documents are grouped by the
components of these links.

Only distinct fingerprints are compared. Each has a table, made once, of its Hamming distances to reference
fingerprints: zero, the 32 that have two neighbouring bits set, and ``PIVOTS`` random ones. By the triangle
inequality, two fingerprints within 2 bits have no coordinate that differs by more than 2. The distances to zero and
to a reference of two bits tell how many of these two bits are set; two differing bits change at most two of these
32 counts. So pairs to be tested come from equi-joins on the counts of three of five groups of references. Those with
a coordinate that differs by more than 2 are discarded, and the survivors are verified bit by bit. A bucket of more
than ``BUCKET`` fingerprints isn't paired: its members are keyed by their own value and all values one bit away
instead. Two fingerprints are within 2 bits exactly if they share such a key, a key has at most 65 of them, and all
of them are within 2 bits of each other, so linking each to the smallest loses no link between groups. These links
pass the same filter and check.

Defined results: null text counts as empty; a text without words has fingerprint zero and links like any other;
null ids are ignored as smallest id of a group unless all are null; rows that share an id are told apart by their
text; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import checkpoint, documents, free_names, text_of, written
from terroir.llm.components import connected_components

WORDS, SEED = 3, 42
BITS = 2
PIVOTS = 31
BUCKET = 16
#: Numbers of two-bit references in each of the five groups.
GROUPS = (7, 7, 6, 6, 6)


def _simhash(text: bytes, words: int, seed: int) -> int:
    tokens = text.lower().split()  # on bytes: A-Z only, and the six ASCII spaces
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    m = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[:m].tolist(), ends[-m:].tolist(), strict=True)], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, m, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_in * 2 > m, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, one, two (hashes of the text), fp: the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            made = pa.array([_simhash(texts[i].as_buffer().to_pybytes(), words, seed) for i in range(len(texts))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "one", "two")), made], names=["doc_id", "one", "two", "fp"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), *_text_hashes(text_col), text_of(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, one long, two long, fp long")


def _text_hashes(text_col: str) -> list[Column]:
    text = text_of(text_col)
    return [F.xxhash64(text).alias("one"), F.xxhash64(F.lit("two"), text).alias("two")]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def references(pivots: int = PIVOTS) -> list[int]:
    """The reference fingerprints, as signed integers: zero, those of two neighbouring bits, and random ones."""
    spread = [int.from_bytes(xxhash.xxh64_digest(f"pivot {i}".encode()), "big") for i in range(pivots)]
    return [_signed(x) for x in [0, *(3 << 2 * i for i in range(32)), *spread]]


def distance_tables(fps: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """fp, distances: the Hamming distances of each fingerprint to the references."""
    return fps.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for p in references(pivots)]).alias("distances"))


def _counts(distances: str = "distances") -> Column:
    """How many bits of each two-bit reference are set, two bits for each, from the distances."""
    d = F.col(distances)
    each = [F.shiftleft(((d[0] - d[i + 1] + 2) / 2).cast("long"), 2 * i) for i in range(32)]
    return reduce(lambda a, b: a.bitwiseOR(b), each)


def _masks() -> list[int]:
    groups, at = [], 0
    for n in GROUPS:
        groups.append(((1 << 2 * n) - 1) << at)
        at += 2 * n
    return [_signed(a | b | c) for a, b, c in combinations(groups, 3)]


def pairs(tables: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of fingerprints to be tested; the components of those within 2 bits are the components of all."""
    keyed = tables.select("fp", _counts().alias("counts")).select("fp", F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(m)) for m in _masks()])).alias("k", "value"))
    sizes = keyed.groupBy("k", "value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = checkpoint(keyed.join(sizes, ["k", "value"]))
    few = shared.filter(F.col("size") <= bucket).groupBy("k", "value").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    later = few.select("fps", F.posexplode("fps").alias("i", "a")).select("a", F.explode(F.expr("slice(fps, i + 2, size(fps))")).alias("b"))
    many = shared.filter(F.col("size") > bucket).select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    balls = many.select("fp", F.explode(near).alias("key")).groupBy("key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = balls.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return later.unionByName(stars).distinct()


def near_by_pivots(tested: DataFrame, tables: DataFrame, bits: int = BITS) -> DataFrame:
    """Of pairs (a, b) those that no coordinate of the tables tells apart by more than ``bits``."""
    both = tested.join(tables.select(F.col("fp").alias("a"), F.col("distances").alias("da")), "a").join(tables.select(F.col("fp").alias("b"), F.col("distances").alias("db")), "b")
    return both.filter(F.array_max(F.zip_with("da", "db", lambda x, y: F.abs(x - y))) <= bits).select("a", "b")


def verified(tested: DataFrame, bits: int = BITS) -> DataFrame:
    return tested.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """From distinct fingerprints (fp): edges (u, v) whose components are those of all pairs within 2 bits."""
    tables = written(distance_tables(fps))
    return verified(near_by_pivots(pairs(tables, bucket), tables)).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _grouped(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, one, two, fp, label (of the component), component_id."""
    docs = checkpoint(fingerprints(df, id_col, text_col))
    fps = checkpoint(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = connected_components(links(fps.select("fp"))).withColumnRenamed("node", "fp")
    labelled = fps.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return docs.join(labelled.join(least, "label").select("fp", "label", "component_id"), "fp")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest id that can be reached)."""
    return _grouped(df, id_col, text_col).select("doc_id", "fp", "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each component: that of the smallest id (null if no row of it has an id); of rows that
    share this id, one whose text has the smallest hashes."""
    leads = _grouped(df, id_col, text_col).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    its_id, its_one, its_two, one, two = free_names(df, "__id", "__one", "__two", "__own_one", "__own_two")
    leads = leads.groupBy("label").agg(F.min(F.struct("one", "two")).alias("text"), F.min("doc_id").alias(its_id))
    leads = leads.select(its_id, F.col("text.one").alias(its_one), F.col("text.two").alias(its_two))
    hashed = df.withColumns(dict(zip((one, two), _text_hashes(text_col), strict=True)))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(its_id)) & (F.col(one) == F.col(its_one)) & (F.col(two) == F.col(its_two))
    return hashed.join(leads, same, "left_semi").dropDuplicates([id_col, one, two]).drop(one, two)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

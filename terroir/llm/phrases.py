"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases by deterministic coin tossing: runs of one symbol are named, then symbols
are labelled by the lowest bit in which they differ from the symbol before, again and again until labels are
below 6, and a phrase begins at each local maximum of the labels. A phrase is named by a hash of its symbols,
and the names are parsed in turn, level by level, until one symbol is left. Where a phrase begins depends on a
few symbols around it alone, so equal substrings have the same interior phrases at any offset.

The fingerprint is a bottom-k sketch (the ``SKETCH`` smallest keys) of the distinct phrase names of all levels,
whatever the text's size. A name's key is its hash divided by the weight of its level (priority sampling): each
level has about a third of the names of the one below, so with ``WEIGHTS`` the first levels have about equal shares.
Likeness is the sketches' estimate of the weighted Jaccard similarity of the name sets. Equal texts have equal
fingerprints.

Defined results: null text counts as empty; an empty text has the empty fingerprint, which is like another empty
one (1.0) and unlike all else (0.0); a null id comes last in descending order; rows that repeat an id follow each
other by text; a single row is its own successor; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.llm.common import documents, text_of

SKETCH = 48
#: Weights of the names of levels 1, 2, ...; higher levels have the last.
WEIGHTS = (1, 3, 9)
LEVELS = 40
#: Bytes of text that are parsed at a time.
BLOCK = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss_table(size: int) -> np.ndarray:
    """Label of symbol y after symbol x: 2 x (lowest bit that differs) + that bit of y."""
    x, y = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    low = (x ^ y) & -(x ^ y)
    place = np.where(low > 0, np.log2(np.maximum(low, 1)), 0).astype(np.int64)
    return (2 * place + (y >> place & 1)).astype(np.uint8)


_TOSS = {size: _toss_table(size) for size in (128, 14, 8)}


def phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a phrase begins at each symbol. Neighbours differ, except where ``first`` begins a document."""
    n = len(symbols)
    before = np.empty_like(symbols)
    before[0], before[1:] = 0, symbols[:-1]
    before[first] = ~symbols[first]
    apart = before ^ symbols
    low = apart & (~apart + np.uint64(1))
    place = ((low.astype(np.float64).view(np.int64) >> 52) - 1023).astype(np.uint64)
    label = (place * np.uint64(2) + (symbols >> place & np.uint64(1))).astype(np.uint8)
    for size in (128, 14, 8):
        last = np.empty_like(label)
        last[0], last[1:] = 0, label[:-1]
        last[first] = label[first] ^ 1
        label = _TOSS[size][last, label]
    starts = np.zeros(n, bool)
    if n > 2:
        starts[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    starts[np.flatnonzero(first[1:])] = False  # the last of a document has no neighbour after it
    starts[-1] = False
    starts[first] = True
    return starts


def _named(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A name for each stretch: a hash of its symbols in order, equal for equal stretches only (but for 64-bit collisions)."""
    lengths = np.diff(np.append(starts, len(symbols)))
    place = (np.arange(len(symbols)) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(symbols + _ODD * (place + np.uint64(1))), starts) + lengths.astype(np.uint64))


def phrase_names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, name, weight) of the phrases of all levels, the last being the whole document; none is empty."""
    symbols, docs = data.astype(np.uint64) + np.uint64(1), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    found_docs, found, weights = [], [], []
    for depth in range(1, LEVELS):
        first = np.ones(len(symbols), bool)
        first[1:] = docs[1:] != docs[:-1]
        new = first.copy()
        new[1:] |= symbols[1:] != symbols[:-1]
        if not new.all():  # runs
            at = np.flatnonzero(new)
            runs = np.diff(np.append(at, len(symbols)))
            symbols, docs, first = symbols[at], docs[at], first[at]
            symbols = np.where(runs > 1, mixed(symbols * _ODD + runs.astype(np.uint64)), symbols)
        at = np.flatnonzero(phrase_starts(symbols, first))
        symbols, docs = _named(symbols, at), docs[at]
        alone = np.ones(len(symbols), bool)
        alone[1:] &= docs[1:] != docs[:-1]
        alone[:-1] &= docs[1:] != docs[:-1]
        found_docs.append(docs)
        found.append(symbols)
        weights.append(np.full(len(symbols), WEIGHTS[min(depth, len(WEIGHTS)) - 1], np.uint64))
        symbols, docs = symbols[~alone], docs[~alone]
        if not len(symbols):
            break
    return np.concatenate(found_docs), np.concatenate(found), np.concatenate(weights)


def sketches(texts: list[bytes], k: int = SKETCH) -> list[np.ndarray]:
    """The fingerprint of each text as sorted 32-bit keys."""
    out = [np.zeros(0, np.uint32)] * len(texts)
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return out
    offsets = np.concatenate(([0], np.cumsum([len(texts[i]) for i in full])))
    docs, names, weights = phrase_names(np.frombuffer(b"".join(texts[i] for i in full), np.uint8), offsets)
    key = np.sort(docs.astype(np.uint64) << np.uint64(32) | (mixed(names ^ _ODD) >> np.uint64(32)) // weights)
    key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    bounds = np.searchsorted(key, np.arange(len(full) + 1).astype(np.uint64) << np.uint64(32))
    for i, a, b in zip(full, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[i] = key[a : min(b, a + k)].astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    own, other = set(a.tolist()), set(b.tolist())
    both, union = own & other, sorted(own | other)[:k]
    return sum(x in both for x in union) / len(union)


def text_of_sketch(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def fingerprint(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each text as a hexadecimal string, instead of a column ``out`` that is there already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.encode() for t in b.column("__text").to_pylist()]
            for a, z in _stretches([len(t) for t in texts]):
                made = pa.array([text_of_sketch(s) for s in sketches(texts[a:z])], pa.string())
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(a, z - a) for c in names), made], names=[*names, out])

    names = [c for c in df.columns if c != out]
    schema = T.StructType([*df.select(*names).schema.fields, T.StructField(out, T.StringType())])
    return df.select(*names, text_of(text_col).alias("__text")).mapInArrow(run, schema)


def _stretches(lengths: list[int], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(lengths):
        yield at, len(lengths)


def with_successor(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (part, ghost, doc_id, text) in partitions sorted so that each row is followed by the next by descending
    id; the last row of a part is a copy (``ghost``) of the row that follows the part, the last part's being the
    first row of all. Texts are shuffled once; ids alone decide the parts, and one copied row a part is added."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    splits = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("int")
    def part_of(ids):
        missing = ids.isna().to_numpy()
        part = len(splits) - np.searchsorted(splits, ids.fillna(0).to_numpy().astype(np.int64), "left")
        part[missing] = len(splits)
        import pandas as pd

        return pd.Series(part.astype(np.int32))

    placed = docs.withColumn("part", part_of("doc_id"))
    tops = placed.groupBy("part").agg(F.max("doc_id").alias("top")).collect()  # one row for each part
    parts = sorted(r["part"] for r in tops)
    before = {p: parts[i - 1] for i, p in enumerate(parts)}
    heads = spark.createDataFrame([(r["top"], before[r["part"]]) for r in tops], "top long, part int")
    ghosts = docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("part").agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("text"))
    both = placed.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))
    return both.repartitionById(len(splits) + 1, F.col("part")).sortWithinPartitions("part", "ghost", F.col("doc_id").desc_nulls_last(), "text")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []
        size, part = 0, None
        for b in batches:
            for p, ghost, i, t in zip(*(b.column(c).to_pylist() for c in ("part", "ghost", "doc_id", "text")), strict=True):
                held.append((i, t))
                size += len(t)
                if ghost or size >= BLOCK:
                    if len(held) > 1:
                        yield _compared(held)
                    held, size = ([], 0) if ghost else (held[-1:], len(t))

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successor(documents(spark, sf_dir)).mapInArrow(run, schema)


def _compared(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    """Results of all rows but the last, which only follows."""
    texts = [t for _, t in rows]
    edited = []
    for t, then in zip(texts[:-1], texts[1:], strict=True):
        k = len(t) // 3
        edited.append((t[: len(t) - k] + then[:k]).encode())
    own, other = sketches([t.encode() for t in texts]), sketches(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in rows[:-1]], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
            pa.array([text_of_sketch(s) for s in own[:-1]]),
            pa.array([text_of_sketch(s) for s in other]),
            pa.array([likeness(a, b) for a, b in zip(own[:-1], other, strict=True)]),
            pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)]),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )

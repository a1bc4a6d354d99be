"""Token ids in a binary file format with frequency-ranked, byte-aligned, variable-length coding.

Texts are encoded once, into a table of ids of fixed width. All its ids are counted, so that the most frequent id
gets rank 0; then its rows, which are smaller than the texts, are dealt to ranges of ascending id and written as
blocks of whole documents. A block's ranks are coded with one to four bytes each, in two streams: control bytes,
which hold four 2-bit lengths each, and data bytes. Reading looks lengths up in a table by control byte and gathers
the data bytes with numpy.

The container is Parquet, so that Spark's writers commit it on any shared store: ``tokens`` has one row a block
(part, first: ids before it in its part, doc_ids, counts, control, data), ``ranks`` the id of each rank. A
tokenizer's pieces are encoded once for each worker that meets them; texts that hold a special token of the
tokenizer are handed to it whole.

Defined results: null text counts as empty and has the end id alone; null ids come first; rows that repeat an id
follow each other by their token ids; documents of any length are one block; an empty table gives an empty file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import checkpoint_folder, documents, removed, text_of, written
from terroir.llm.textblocks import Pieces, blocks

END = 2
#: Ids in a block, but for one that a longer document has to itself.
BLOCK_IDS = 1 << 19
#: Distinct pieces that a worker keeps, and bytes of text that it takes at a time.
PIECES, BYTES = 700_000, 4 << 20
_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = more
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = padded[starts].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        out |= padded[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return out & _MASK[lengths]


class _Encoder:
    """A tokenizer's ids of blocks of texts, without special tokens added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or self.tokenizer.normalizer:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self._make, PIECES)
        # the byte-level alphabet: printable characters stand for themselves, other bytes for those from 256 on
        plain = {b: chr(b) for b in range(256) if chr(b).isprintable() and b != 0x20}
        rest = (b for b in range(256) if b not in plain)
        self.alphabet = str.maketrans({chr(b): c for b, c in plain.items()} | {chr(b): chr(256 + i) for i, b in enumerate(rest)})

    def _make(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, which the tokenizer's splitter would leave whole, by its model alone."""
        tokenize, ids, ends = self.tokenizer.model.tokenize, array("i"), [0]
        for piece in pieces:
            ids.extend([t.id for t in tokenize(piece.decode("latin-1").translate(self.alphabet))])
            ends.append(len(ids))
        return np.array(ids, np.int32), np.array(ends, np.int64)

    def _has_special(self, data: np.ndarray) -> bool:
        raw = data.tobytes()
        return any(s in raw for s in self.special)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents of a block, each followed by the end id, and their number for each document."""
        ids, counts = self.pieces.encode(data, offsets)
        if self._has_special(data):
            cuts = np.cumsum(counts)[:-1]
            parts = np.split(ids, cuts)
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if self._has_special(data[a:b]):
                    parts[i] = np.array(self.tokenizer.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids, np.int32)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return np.insert(ids, np.cumsum(counts), END), counts + 1


_made: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _made:
        _made[path] = _Encoder(path)
    return _made[path]


def encoded(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of each text with the end id, as unsigned integers of ``_width`` bytes each."""
    kind = _width(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "text", BYTES):
                ids, counts = _encoder(tokenizer).encode(data, offsets)
                bounds = np.concatenate(([0], np.cumsum(counts))) * kind.itemsize
                raw = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids.astype(kind))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), raw.cast(pa.binary())], names=["doc_id", "ids"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, ids binary")


def _width(tokenizer: str) -> np.dtype:
    """The narrower of the two integer types that hold every id of a tokenizer."""
    return np.dtype("<u2" if _encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of binary values, and where each row's begin and end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind), (offsets - offsets[0]) // kind.itemsize


def count_ids(ids: DataFrame, kind: np.dtype) -> DataFrame:
    """id, n: how often each id stands in all rows of ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(_flat(batch.column("ids"), kind)[0], minlength=len(total)) if batch.num_rows else total * 0
            n[: len(total)] += total
            total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode all texts of ``df`` and write them to ``folder`` by ascending id."""
    spark, kind = df.sparkSession, _width(tokenizer)
    raw = written(encoded(df, tokenizer, id_col, text_col), "zstd")
    # one row for each id of the vocabulary at most, whatever the size of the corpus
    ranked = [r["id"] for r in count_ids(raw, kind).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame([(i, x) for i, x in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    table = np.zeros(max(ranked, default=0) + 1, np.uint32)
    table[ranked] = np.arange(len(ranked))
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        total = 0

        def block() -> pa.RecordBatch:
            control, data = pack(np.concatenate(held))
            ids, counts = pa.concat_arrays(docs), pa.array(np.concatenate(sizes).astype(np.int32))
            one = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.ListArray.from_arrays(one, ids), pa.ListArray.from_arrays(one, counts), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "first", "doc_ids", "counts", "control", "data"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, bounds = _flat(batch.column("ids"), kind)
            at = 0
            while at < batch.num_rows:  # whole documents up to the block's size
                if total and total + bounds[at + 1] - bounds[at] > block_ids:
                    yield block()
                    first += total
                    held, docs, sizes, total = [], [], [], 0
                end = max(at + 1, min(batch.num_rows, int(np.searchsorted(bounds, bounds[at] + block_ids - total, "right")) - 1))
                held.append(shared.value[ids[bounds[at] : bounds[end]]])
                docs.append(batch.column("doc_id").slice(at, end - at))
                sizes.append(np.diff(bounds[at : end + 1]))
                total += int(bounds[end] - bounds[at])
                at = end
        if docs:
            yield block()

    schema = "part int, first long, doc_ids array<long>, counts array<int>, control binary, data binary"
    order = [F.col("doc_id").asc_nulls_first()]
    raw.repartitionByRange(*order).sortWithinPartitions(*order, "ids").mapInArrow(run, schema).write.parquet(f"{folder}/tokens")
    removed(raw)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a file: doc_id, start, ids, crc32 (of the ids as little-endian 32-bit integers)."""
    tokens = spark.read.parquet(f"{folder}/tokens")
    ranked = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    shared = spark.sparkContext.broadcast(np.array(ranked, np.int32))
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    offsets, seen = [], 0
    for r in sorted(tokens.groupBy("part").agg(F.sum(size).alias("n")).collect()):  # one row for each part
        offsets.append((r["part"], seen))
        seen += r["n"]
    placed = tokens.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part").withColumn("first", F.col("first") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, docs, counts, control, data in zip(*(batch.column(c).to_pylist() for c in ("first", "doc_ids", "counts", "control", "data")), strict=True):
                bounds = np.concatenate(([0], np.cumsum(counts)))
                ids = shared.value[unpack(control, data, int(bounds[-1]))]
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(first + bounds[:-1]), lists, pa.array(crc, pa.int64())], names=["doc_id", "start", "ids", "crc32"])

    return placed.select("first", "doc_ids", "counts", "control", "data").mapInArrow(run, "doc_id long, start long, ids array<int>, crc32 long")


def new_folder(spark: SparkSession) -> str:
    """A folder not yet used, beside the checkpoints, which all machines share."""
    return f"{checkpoint_folder(spark)}/token-file-{uuid.uuid4()}"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    write(documents(spark, sf_dir), folder, tokenizer_file())
    return read(spark, folder).select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))

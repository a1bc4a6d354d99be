"""Byte-level BPE by merge replay over the distinct pieces of a stretch of the corpus.

Each task splits its texts into pieces, takes the distinct ones it hasn't met, lays them out as one sequence of
byte tokens and replays the merges on all of them at once, in order of rank. An inverted index from token pair
(filed under the rank of the merge) to the positions where the pair stands gives the positions a merge applies
to; a merge touches only these and their two neighbours, whose new pairs are filed in turn. Positions that went
stale are recognised when their turn comes. Texts are then read off a table from piece to ids, so what a task
does grows with its distinct pieces and its bytes, not with pieces times merges.

Defined results: null text counts as empty and has no ids; ids of any byte sequence decode to the same bytes;
documents of any length are handled whole; an empty table gives an empty table; other columns are kept by
``encode``, but for those that have the names of its own, which are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.llm.common import documents, text_of
from terroir.llm.textblocks import Pieces, blocks


class Merges:
    """The merges of a rank file, as a sorted table from pair of ids to rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.merged = np.ascontiguousarray(table[:, 0]), table[:, 1].astype(np.int32)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or -1."""
        key = left.astype(np.int64) << 32 | right
        where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[where] == key, self.merged[where], -1)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, concatenated, and the offsets of the pieces."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        token = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(token)
        after = np.arange(1, n + 1)
        after[bounds[1:][lengths > 0] - 1] = n  # nothing follows the last token of a piece
        before = np.arange(-1, n - 1)
        before[bounds[:-1][lengths > 0]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(left: np.ndarray) -> None:
            left = left[after[left] < n]
            rank = self.ranks_of(token[left], token[after[left]])
            left, rank = left[rank >= 0], rank[rank >= 0]
            if not len(left):
                return
            order = np.argsort(rank, kind="stable")
            left, rank = left[order], rank[order]
            cut = np.flatnonzero(np.diff(rank)) + 1
            for r, where in zip(rank[np.concatenate(([0], cut))].tolist(), np.split(left, cut), strict=True):
                if r in index:
                    index[r].append(where)
                else:
                    index[r] = [where]
                    heapq.heappush(heap, r)

        file(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            where = index.pop(rank)
            at = where[0] if len(where) == 1 else np.unique(np.concatenate(where))
            at = at[alive[at] & (after[at] < n)]
            at = at[self.ranks_of(token[at], token[after[at]]) == rank]
            if not len(at):
                continue
            if len(at) > 1:  # of pairs that overlap, the first, the third and so on
                linked = np.concatenate(([False], after[at[:-1]] == at[1:]))
                if linked.any():
                    step = np.arange(len(at))
                    at = at[(step - np.maximum.accumulate(np.where(linked, 0, step))) % 2 == 0]
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            then = after[gone]
            after[at] = then
            inner = then < n
            before[then[inner]] = at[inner]
            left = before[at]
            file(np.unique(np.concatenate((at, left[left >= 0]))))
        ends = np.concatenate(([0], np.cumsum(alive)))
        return token[alive], ends[bounds]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Ids that are decoded at a time.
_STRETCH = 1 << 16
_made: dict[str, tuple[Pieces, np.ndarray, np.ndarray]] = {}


def _codec(path: str) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """The encoder of a rank file with its table of pieces, and the bytes of all ids; kept while the worker lives."""
    if path not in _made:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        ends = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
        _made[path] = Pieces(Merges(ranks).replay), np.frombuffer(b"".join(tokens), np.uint8), ends
    return _made[path]


def decode_ids(ids: np.ndarray, bounds: np.ndarray, path: str) -> pa.Array:
    """The bytes of documents, whose ids lie between ``bounds``."""
    from terroir.llm.textblocks import ragged

    _, data, ends = _codec(path)
    stretches = [ragged(data, ends, ids[at : at + _STRETCH])[0] for at in range(0, len(ids), _STRETCH)]
    out = np.concatenate([np.zeros(0, np.uint8), *stretches])
    cuts = np.concatenate(([0], np.cumsum(np.diff(ends)[ids])))[bounds]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds the ids of each text, and with ``decoded_col`` the bytes that these ids decode to.

    ``keep``: the columns of ``df`` that are kept, all by default. ``path``: a rank file present on all machines.
    """
    names = [c for c in (df.columns if keep is None else keep) if c not in (ids_col, decoded_col)]
    fields = [*df.select(*names).schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _codec(path)[0]
        for batch in batches:
            for a, b, data, offsets in blocks(batch, "__text"):
                ids, counts = pieces.encode(data, offsets)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                out = [batch.column(c).slice(a, b - a) for c in names]
                out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
                if decoded_col:
                    out.append(decode_ids(ids, bounds, path))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return df.select(*names, text_of(text_col).alias("__text")).mapInArrow(run, T.StructType(fields))


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded and decoded documents."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(documents(spark, sf_dir), rank_file(), decoded_col="decoded", keep=["doc_id"]))

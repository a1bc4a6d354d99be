"""Removal of repeated byte strings by longest-previous-factor arrays over suffixes in sorted order.

A byte is removed if a string of ``length`` bytes that covers it also starts elsewhere (``keep="none"``), or
starts earlier (``keep="first"``: later copies go, the first stays).

Which suffixes must be sorted together: each window of ``length`` bytes has a signature, the hash of the
smallest of its ``SEED``-byte seeds by hash order. Equal windows have equal signatures, so only windows of one
signature can match. Consecutive windows with the same seed form a stretch, one for about every 80 bytes; in
text that repeats with a shorter period a stretch ends with each period and equals the one before it: of such a
run two stretches stay, the second of which tells how far the run goes on, so that a run of any length makes a
few rows. Stretches are counted by signature, and those whose signature is unique are dropped at once. Stretches
that are equal as a whole (signature, and two hashes of 64 bits) repeat in all their windows and are settled by
counting. For what differs within a signature (mostly the edges of shared passages), one stretch of each content
is fetched from its document; the windows of whole signatures are put in suffix order by prefix doubling, and
longest-previous-factor arrays, by the previous and next smaller position in that order, tell for each window
whether it starts earlier (and with positions reversed, whether it starts later).

A signature with more than ``MANY`` contents isn't gathered in a task. Its stretches are parted by where the
seed stands in a window, ``PARTS`` ranges at a time: windows of one range share all bytes but the outermost few,
so the part's signature is the hash of these shared bytes, which grow from round to round. A part whose
signature is unique is dropped, and the same steps follow, until no signature has more than ``MANY`` contents;
after a few rounds a range is one place, where equal signatures are equal windows.

Rows are numbered when their texts are first written, and told apart by that number. Keys that hold a large
share of all stretches are dealt over several tasks in joins.

Defined results: null text counts as empty and loses nothing; texts shorter than ``length`` lose nothing; rows
that repeat (same id, or same id and text) are copies of each other like any other rows, and follow each other
by number; documents of any length are handled whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import checkpoint, documents, join_hot, removed, text_of, written

LENGTH = 200
SEED = 40
MANY = 1024
PARTS = 4
_BITS = 20
_STEP = (1 << _BITS) - 4096
_CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@cache
def _powers(base: int) -> np.ndarray:
    """base^i modulo 2^64 for all places of a block."""
    out = np.ones((1 << _BITS) + 1, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


@cache
def _letters(salt: int) -> np.ndarray:
    return _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95 + 2 * salt))


class _Hashes:
    """Hashes of any stretch of bytes, from sums of powers."""

    def __init__(self, data: np.ndarray, salt: int = 0):
        base = _BASE + 4 * salt
        self.back = _powers(pow(base, -1, 1 << 64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_letters(salt)[data] * _powers(base)[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of a block of at most 2^20 bytes: signature, two content hashes, document, start, windows and place of the
    seed (from the start) of each stretch, and the windows of the stretches after it that were left out, being equal to
    it and to the one before it."""
    n, width = len(data), length - seed + 1
    windows = n - length + 1
    if windows <= 0:
        return (np.zeros(0, np.uint64),) * 3 + (np.zeros(0, np.int64),) * 5
    hashes = _Hashes(data)
    at = np.arange(n - seed + 1)
    seeds = hashes.of(at, at + seed)
    key = seeds >> np.uint64(_BITS) << np.uint64(_BITS) | at.astype(np.uint64)
    padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(key)] = key
    tiles = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    place = (least & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    # windows that lie within one document
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, offsets[:-1], 1)
    np.add.at(change, np.maximum(offsets[1:] - length + 1, offsets[:-1]), -1)
    inside = np.cumsum(change)[:windows] > 0
    same = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
    begins = inside.copy()
    begins[1:] &= ~same
    heads = offsets[1:-1][offsets[1:-1] < windows]  # windows of two documents never share a stretch
    begins[heads] |= inside[heads]
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    stop = np.flatnonzero(ends) + 1
    document = np.searchsorted(offsets, start, "right") - 1
    content = (h.of(start, stop + length - 1) for h in (hashes, _Hashes(data, 1)))
    found = (seeds[place[start]], *content, document, start - offsets[document], stop - start, place[start] - start)
    if not len(start):
        return *found, np.zeros(0, np.int64)
    again = np.zeros(len(start), bool)  # equal to the stretch before, which it follows directly
    again[1:] = (start[1:] == stop[:-1]) & np.logical_and.reduce([x[1:] == x[:-1] for x in (*found[:4], found[5], found[6])])
    left_out = again.copy()
    left_out[1:] &= again[:-1]
    kept = np.flatnonzero(~left_out)
    return *(x[kept] for x in found), np.add.reduceat(np.where(left_out, stop - start, 0), kept)


def packed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a number for each row, valid once the table is written), packed: texts as Zstandard frames,
    which halves what a shuffle of whole texts moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column("text")
            frames = pa.array([pack(texts[i].as_buffer()) for i in range(len(texts))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), frames], names=["doc_id", "row", "packed"])

    numbered = df.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(text_col).alias("text"))
    return numbered.mapInArrow(run, "doc_id long, row long, packed binary")


def _unpacked(frame: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame.as_buffer())


def _unpacked_blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of consecutive rows of at most ``size`` bytes; a longer text comes alone."""
    first, held, n = 0, [], 0
    frames = batch.column("packed")
    for i in range(len(frames)):
        raw = _unpacked(frames[i])
        if held and n + len(raw) > size:
            yield first, held
            first, held, n = i, [], 0
        held.append(raw)
        n += len(raw)
    if held:
        yield first, held


def stretches(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """From rows (doc_id, row, packed): sig, one, two (content), doc_id, row, start, windows, seed, more (windows that
    follow and repeat these)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _unpacked_blocks(batch, _STEP):
                data = np.frombuffer(b"".join(texts), np.uint8)
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
                for at in range(0, max(len(data) - length + 1, 1), _STEP) if len(texts) == 1 else (0,):
                    piece = data[at : at + _STEP + length - 1] if len(texts) == 1 else data
                    sig, one, two, document, start, windows, place, more = _stretches(piece, np.array([0, len(piece)]) if len(texts) == 1 else offsets, length, seed)
                    who = pa.array(document + first)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x.view(np.int64)) for x in (sig, one, two)), batch.column("doc_id").take(who), batch.column("row").take(who), pa.array((start + at).astype(np.int32)), pa.array(windows.astype(np.int16)), pa.array(place.astype(np.int16)), pa.array(more.astype(np.int32))],
                        names=["sig", "one", "two", "doc_id", "row", "start", "windows", "seed", "more"],
                    )

    return docs.mapInArrow(run, "sig long, one long, two long, doc_id long, row long, start int, windows short, seed short, more int")


def suffix_order(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``starts`` by their first ``length`` bytes, and the length (at most ``length``)
    that each shares with the one before it. Ranks of 8-byte prefixes are doubled; shared lengths are exact up to
    the last 8 bytes, and exact at ``length`` if that is a multiple of 8."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(length + 256, np.uint8)))
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    ranked = lambda x: np.unique(x, return_inverse=True)[1].astype(np.int32) + np.int32(1)
    levels = {8: ranked(key)}
    size = 8
    while size * 2 <= length:
        rank = np.concatenate((levels[size], np.zeros(size, np.int32)))
        levels[size * 2] = ranked(rank[:n].astype(np.int64) << 32 | rank[size : size + n])
        size *= 2
    last = np.concatenate((levels[size], np.zeros(length, np.int32)))
    order = np.lexsort((last[starts + length - size], last[starts]))
    a, b = starts[order[:-1]], starts[order[1:]]
    shared = np.zeros(len(a), np.int64)
    for step in sorted(levels, reverse=True):
        rank = np.concatenate((levels[step], np.zeros(length + 1, np.int32)))
        fits = (shared + step <= length) & (rank[a + shared] == rank[b + shared])
        shared[fits] += step
    return order, np.concatenate(([0], shared))[: len(starts)]


def longest_previous(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For suffixes in sorted order, with their positions and the length each shares with the one before: the
    longest string at each that also starts at a smaller position. It is the larger of what a suffix shares with
    the previous and with the next suffix in the order whose position is smaller."""
    n = len(position)
    out = [0] * n
    where, common = position.tolist(), [*shared.tolist(), 0]
    stack: list[tuple[int, int]] = []  # (index, length shared with the smaller position before it in the order)
    for i in range(n + 1):
        held = common[i]
        while stack and (i == n or where[stack[-1][0]] > where[i]):
            j, before = stack.pop()
            out[j] = max(before, held)
            held = min(before, held)
        if i < n:
            stack.append((i, held if stack else 0))
    return np.array(out, np.int64)


def repeated(slices: list[bytes], windows: list[int], rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the first windows of each slice: slice, offset, whether it starts earlier, whether it starts later;
    ``rank`` orders the slices. Only windows that start more than once are returned."""
    text = np.frombuffer(b"".join(slices), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(s) for s in slices])))
    count = np.array(windows, np.int64)
    owner = np.repeat(np.arange(len(slices)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    order, shared = suffix_order(text, begin[owner] + offset, length)
    linked = shared >= length
    member = linked.copy()
    member[:-1] |= linked[1:]
    order, shared = order[member], np.where(linked, shared, 0)[member]
    position = (rank[owner[order]].astype(np.int64) << 32) + offset[order]
    earlier = longest_previous(position, shared) >= length
    later = longest_previous(-position, shared) >= length
    return owner[order], offset[order], earlier, later


def _spans(row: np.ndarray, owner: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch | None:
    """Runs of consecutive windows as spans (row, begin, end)."""
    if not len(owner):
        return None
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(row[owner[first]]), pa.array(start[first].astype(np.int32)), pa.array((start[last] + length).astype(np.int32))], names=["row", "begin", "end"]
    )


def _by_suffixes(fetched: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans (row, begin, end) of repeated windows, from the slices of whole signatures."""

    def settle(rows: list[dict]) -> pa.RecordBatch | None:
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0, r["row"], r["start"]) for r in rows]
        rank = np.empty(len(rows), np.int64)
        rank[sorted(range(len(rows)), key=keys.__getitem__)] = np.arange(len(rows))
        owner, offset, earlier, later = repeated([r["slice"] for r in rows], [r["windows"] for r in rows], rank, length)
        gone = earlier if keep == "first" else earlier | later
        start = np.array([r["start"] for r in rows], np.int64)
        return _spans(np.array([r["row"] for r in rows], np.int64), owner[gone], start[owner[gone]] + offset[gone], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if size > _CHUNK and r["sig"] != rows[-1]["sig"]:
                    if (found := settle(rows)) is not None:
                        yield found
                    rows, size = [], 0
                rows.append(r)
                size += len(r["slice"])
        if rows and (found := settle(rows)) is not None:
            yield found

    wanted = fetched.select("sig", "doc_id", "row", "start", "windows", "slice")
    return wanted.repartition("sig").sortWithinPartitions("sig").mapInArrow(run, "row long, begin int, end int")


def _place() -> Column:
    """The order of places; a null id comes first."""
    return F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row", "start", "windows", "seed")


def _candidates(found: DataFrame) -> DataFrame:
    """The stretches whose signature isn't unique."""
    shared = checkpoint(found.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return join_hot(found, shared, ["sig"], ["row", "start"])


def _contents(candidates: DataFrame, *more: Column) -> DataFrame:
    """sig, one, two: the distinct contents with their number n and their first place."""
    return candidates.groupBy("sig", "one", "two").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first"), *more)


def _mixed(contents: DataFrame) -> DataFrame:
    """sig, contents: the signatures that have several contents, with their number."""
    return contents.groupBy("sig").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")


def _whole(candidates: DataFrame, contents: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans of stretches whose whole content stands more than once."""
    whole = join_hot(candidates, contents.filter("n > 1").select("sig", "one", "two", "n", "first"), ["sig", "one", "two"], ["row", "start"])
    if keep == "first":
        whole = whole.filter(_place() != F.col("first"))
    windows = F.col("windows") + F.col("more") if "more" in whole.columns else F.col("windows")
    return whole.select("row", F.col("start").alias("begin"), (F.col("start") + windows + (length - 1)).alias("end"))


def _parted(fetched: DataFrame, length: int, width: int) -> DataFrame:
    """Stretches whose seeds stand in a range of places, parted into ``PARTS`` narrower ranges of ``width`` places,
    with their bytes; ``low`` is where a range begins."""
    kinds = [*[pa.int64()] * 5, *[pa.int32()] * 4, pa.binary()]
    names = ["sig", "one", "two", "doc_id", "row", "start", "windows", "seed", "low", "slice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                data, seed, windows = r["slice"], r["seed"], r["windows"]
                # window k has its seed at place seed - k
                for low in range(r["low"], min(r["low"] + PARTS * width, seed + 1), width):
                    a, b = max(0, seed - low - width + 1), min(windows, seed - low + 1)
                    if a < b:
                        core = data[seed - low : seed - low - width + 1 + length]
                        part = data[a : b - 1 + length]
                        sig = int.from_bytes(xxhash.xxh64_digest(core, low), "big", signed=True)
                        both = xxhash.xxh3_128_digest(part)
                        one, two = (int.from_bytes(x, "big", signed=True) for x in (both[:8], both[8:]))
                        out.append((sig, one, two, r["doc_id"], r["row"], r["start"] + a, b - a, seed - a, low, part))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "sig long, one long, two long, doc_id long, row long, start int, windows int, seed int, low int, slice binary"
    return fetched.select("doc_id", "row", "start", "windows", "seed", "low", "slice").mapInArrow(run, schema)


def _by_parts(fetched: DataFrame, length: int, keep: str, seed: int, many: int) -> list[DataFrame]:
    """Spans of repeated windows of signatures with more than ``many`` contents."""
    spans, rest, width = [], fetched.withColumn("low", F.lit(0)), length - seed + 1
    while width > 1 and not rest.isEmpty():
        width = -(-width // PARTS)
        found = written(_parted(rest, length, width))
        candidates = _candidates(found)
        contents = written(_contents(candidates, F.min_by(F.struct("low", "slice"), _place()).alias("held")))
        settled = written(contents.join(_mixed(contents), "sig").select("sig", "contents", "first.*", "held.*"))
        # a range of one place has no contents but one, so that nothing is left after it
        few = settled.filter(F.col("contents") <= many) if width > 1 else settled
        spans += [_whole(candidates, contents, length, keep), _by_suffixes(few, length, keep)]
        rest = settled.filter(F.col("contents") > many)
    return spans


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "none", seed: int = SEED, many: int = MANY) -> DataFrame:
    """From written rows (doc_id, row, packed): the spans (row, begin, end) of bytes to remove; they may overlap."""
    found = written(stretches(docs, length, seed))
    candidates = written(_candidates(found))
    removed(found)
    contents = written(_contents(candidates))
    wanted = contents.join(_mixed(contents), "sig").select("sig", "contents", "first.*")
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("sig", "contents", "start", "windows", "seed")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, *[pa.int32()] * 3, pa.binary()]
        names = ["sig", "contents", "doc_id", "row", "start", "windows", "seed", "slice"]
        for batch in batches:
            texts = batch.column("packed")
            for i, (doc, row, want) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "wanted")), strict=True)):
                raw = _unpacked(texts[i])
                rows = [(w["sig"], w["contents"], doc, row, w["start"], w["windows"], w["seed"], raw[w["start"] : w["start"] + w["windows"] + length - 1]) for w in want]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "sig long, contents long, doc_id long, row long, start int, windows int, seed int, slice binary"
    fetched = written(docs.join(lists, "row").select("doc_id", "row", "packed", "wanted").mapInArrow(cut, schema))
    spans = [_whole(candidates, contents, length, keep), _by_suffixes(fetched.filter(F.col("contents") <= many), length, keep)]
    return reduce(DataFrame.unionByName, spans + _by_parts(fetched.filter(F.col("contents") > many), length, keep, seed, many))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: str = "none", seed: int = SEED, many: int = MANY) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal runs), kept (the bytes that stay)."""
    if length % 8 or not 0 < seed <= length:
        raise ValueError("length must be a multiple of 8, and seed at most length")
    docs = written(packed(df, id_col, text_col))
    spans = repeated_spans(docs, length, keep, seed, many).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = docs.join(spans, "row", "left").select("doc_id", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans = (batch.column(c) for c in ("doc_id", "packed", "spans"))
            n, lost, runs, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = _unpacked(texts[i])
                n.append(len(raw))
                if not spans[i].is_valid:
                    lost.append(0)
                    runs.append(0)
                    kept.append(raw)
                    continue
                found = spans[i].values
                change = np.zeros(len(raw) + 1, np.int64)
                np.add.at(change, found.field("begin").to_numpy(), 1)
                np.add.at(change, found.field("end").to_numpy(), -1)
                gone = np.cumsum(change)[:-1] > 0
                lost.append(int(gone.sum()))
                runs.append(int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])))
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(lost, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

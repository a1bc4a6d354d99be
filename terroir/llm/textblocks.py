"""Splitting blocks of texts into pieces on their UTF-8 bytes, without a loop over pieces.

A block is the concatenated bytes of some documents. Pieces are those of the published pattern of byte-level
BPE tokenizers (contractions; letters, numbers or other characters with at most one space before; white space),
found from the class of each character and of its neighbours.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The characters with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Bytes of text that are encoded at a time; a longer document is a block of its own.
BLOCK = 3 << 20
#: Bytes of text whose characters are classified at a time, for the arrays with a value for each of them.
SPLIT = 1 << 19


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = SPACE
    return table


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of its rows and the end) of consecutive rows with about ``size`` bytes."""
    array = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(array):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, len(array))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and code point of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[at].astype(np.int32)
    wide = np.flatnonzero(cp >= 0x80)
    if len(wide):
        lead, where = cp[wide], at[wide]
        n = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & np.array([0, 0, 0x1F, 0x0F, 0x07])[n]
        for k in (1, 2, 3):
            more = n > k
            value[more] = value[more] << 6 | (data[where[more] + k] & 0x3F)
        cp[wide] = value
    return at, cp


def split(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces begin; a piece never crosses documents."""
    starts, at = [np.zeros(0, np.int64)], 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SPLIT, "right")) - 1)
        inner = offsets[at : end + 1]
        starts.append(inner[0] + _split(data[inner[0] : inner[-1]], inner - inner[0]))
        at = end
    return np.concatenate(starts)


def _split(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    at, cp = code_points(data)
    n = len(at)
    kind = classes()[cp]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offsets[:-1])] = True
    first = first[:n]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    begins = run.copy()
    # runs of other kinds after white space of the same document: its last character is apart, and joins if it is 0x20
    after = np.flatnonzero(run[1:] & ~first[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
    begins[after - 1] = True
    begins[after] = cp[after - 1] != 0x20
    # contractions
    quote = np.flatnonzero((cp[:-1] == 0x27) & begins[:-1] & (kind[1:] == LETTER) & ~first[1:]) if n > 1 else np.zeros(0, int)
    if len(quote):
        b = np.append(cp, [0, 0])
        same = np.append(~first, [False, False])
        one = np.isin(b[quote + 1], [ord(c) for c in "stmd"])
        pair = b[quote + 1] * 256 + b[quote + 2]
        two = np.isin(pair, [ord(x) * 256 + ord(y) for x, y in ("re", "ve", "ll")]) & same[quote + 2]
        begins[quote[one | two] + 1] = False
        for hit, k in ((one, 2), (two & ~one, 3)):
            if k == 3:
                begins[quote[hit] + 2] = False
            then = quote[hit] + k
            begins[then[then < n]] = True
    return at[begins]


def piece_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The pieces as a binary Arrow array over the same bytes."""
    offsets = np.append(starts, len(data)).astype(np.int32 if len(data) < 1 << 31 else np.int64)
    kind = pa.binary() if offsets.dtype == np.int32 else pa.large_binary()
    return pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def ragged(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated rows ``index`` of a ragged array, and their lengths."""
    lengths = (offsets[1:] - offsets[:-1])[index]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    take = np.repeat(offsets[index] - (ends - lengths), lengths)
    take += np.arange(total)
    return values[take], lengths


class Pieces:
    """Numbers for distinct pieces and the token ids of each, made once for each piece a worker meets.

    ``make`` gives the ids of a list of pieces as (values, offsets). The table is emptied when it holds more
    than ``most`` pieces, so that memory stays bounded on any input.
    """

    def __init__(self, make, most: int = 300_000):
        self.make, self.most = make, most
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.values, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _numbered(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each distinct piece of a block, and for each piece which of these it is."""
        coded = piece_array(data, starts).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.number) + len(pieces) > self.most:
            self.clear()
        new = [p for p in pieces if p not in self.number]
        if new:
            values, ends = self.make(new)
            base = len(self.number)
            self.number.update(zip(new, range(base, base + len(new)), strict=True))
            self.values = np.concatenate((self.values, values))
            self.offsets = np.concatenate((self.offsets, self.offsets[-1] + ends[1:]))
        return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces)), coded.indices.to_numpy()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents of a block, and the number of ids of each."""
        starts = split(data, offsets)
        number, codes = self._numbered(data, starts)
        ids, lengths = ragged(self.values, self.offsets, number[codes])
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(bounds[np.searchsorted(starts, offsets)])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """How often each id stands in a block: pieces are counted, and their ids weighted."""
        number, codes = self._numbered(data, split(data, offsets))
        ids, lengths = ragged(self.values, self.offsets, number)
        return np.bincount(ids, np.repeat(np.bincount(codes, minlength=len(number)), lengths)).astype(np.int64)

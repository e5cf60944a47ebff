"""Vectorised words and fingerprints over the Arrow buffers of a text column.

All functions work on a chunk: the bytes of some whole texts, one after another,
and the offsets between them. Words never cross texts. Fingerprints are 64-bit
polynomials over random byte values, so the fingerprint of any stretch comes from
two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)

#: Bytes that part words: space and 0x09 to 0x0D.
_PARTS = np.zeros(256, bool)
_PARTS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes that part runs of letters and digits: all other ASCII.
SIGNS = np.zeros(256, bool)
SIGNS[:128] = True
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 64, 256, dtype=_U)


_PLAIN = _byte_values()
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]

_powers = {_BASE: np.ones(1, _U), _BACK: np.ones(1, _U)}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown as needed and kept."""
    have = _powers[base]
    if len(have) < n:
        row = np.full(max(n, 2 * len(have), CHUNK_BYTES), base, _U)
        row[0] = 1
        have = _powers[base] = np.multiply.accumulate(row)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible function)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Chunk:
    """Bytes of whole texts and where each begins; offsets has one more entry."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def prefix(self, lower: bool = False) -> np.ndarray:
        """Prefix sums of the fingerprints; entry i covers the bytes before i."""
        n = len(self.data)
        out = np.zeros(n + 1, _U)
        np.cumsum((_LOWER if lower else _PLAIN)[self.data] * powers(n), out=out[1:])
        return out


def stretch(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the stretches from start to end (exclusive)."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), _BACK)[start])


def chunk_of(column: pa.Array) -> Chunk:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if not len(column):
        return Chunk(np.empty(0, np.uint8), np.zeros(1, np.int64))
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return Chunk(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text, at least a row."""
    if not batch.num_rows:
        return
    whole = chunk_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        o = whole.offsets[at : to + 1]
        yield batch.slice(at, to - at), Chunk(whole.data[o[0] : o[-1]], o - o[0])
        at = to


class Words:
    """Words of a chunk: byte positions, fingerprints, first word of each text."""

    def __init__(self, chunk: Chunk, lower: bool = False, parts: np.ndarray = _PARTS):
        data, offsets = chunk.data, chunk.offsets
        inside = ~parts[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.empty(len(data), bool)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
        self.start = np.flatnonzero(inside & (first[:-1] | ~before))
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (first[1:] | ~after)) + 1
        self.of_text = np.searchsorted(self.start, offsets)
        self.prefix = chunk.prefix(lower)
        self.hash = stretch(self.prefix, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    def text_index(self) -> np.ndarray:
        """The text each word stands in."""
        return np.repeat(np.arange(len(self.of_text) - 1), self.counts)


def distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each text in a row, how often each occurs, and the text of each."""
    owner = words.text_index()
    order = np.lexsort((words.hash, owner))
    value, owner = words.hash[order], owner[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return value[at], np.diff(np.append(at, len(value))), owner[at]


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the n-word shingles of each text and their first words."""
    h = words.hash
    count = np.maximum(words.counts - (n - 1), 0)
    at = ranges(words.of_text[:-1], count)
    if not len(at):
        return np.empty(0, _U), at
    out = np.zeros(len(at), _U)
    for k in range(n):
        out = mix(out * _U(0xD6E8FEB86659FD93) + h[at + k])
    return out, at


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] values, then the same for the next."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(start - (np.cumsum(count) - count), count)
    return np.arange(total, dtype=np.int64) + shift


def as_long(h: np.ndarray) -> pa.Array:
    """Fingerprints as Spark's signed 64-bit type."""
    return pa.array(h.view(np.int64))


def list_column(values: pa.Array, count: np.ndarray) -> pa.Array:
    """A list column whose i-th row holds the next count[i] values."""
    offsets = np.zeros(len(count) + 1, np.int32)
    np.cumsum(count, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)

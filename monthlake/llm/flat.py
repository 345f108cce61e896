"""Texts of an Arrow batch as one flat array of bytes, for numpy inside tasks.

All functions take whole texts; a batch is cut between texts, never within one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
        return x ^ (x >> np.uint64(31))


def seed(name: str) -> np.uint64:
    """A constant that belongs to a name."""
    number = np.array([zlib.crc32(name.encode()) + 1], np.uint64)
    return mix(number)[0]


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64) + seed("bytes"))
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """1, base, base², …: at least n of them, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (or binary values) one after the other, and where each begins; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if pa.types.is_large_string(column.type):
        width = np.int64
    elif pa.types.is_binary(column.type):
        width = np.int32
    else:
        column, width = column.cast(pa.string()), np.int32
    _, places, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``limit`` bytes of text; a longer text is a run."""
    data, at = texts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes lie in one of the ranges, both ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of texts: runs of bytes that ``inside`` marks, with A-Z as a-z."""

    def __init__(self, data: np.ndarray, at: np.ndarray, inside: np.ndarray):
        self.data, self.at = data, at
        n = len(data)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.of_text = np.zeros(len(at), np.int64)
            return
        word = inside[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        inner = at[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: Words before each text; the words of text i are of_text[i]:of_text[i + 1].
        self.of_text = np.searchsorted(self.start, at)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    def text_index(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """64 bits for each word; the same for the same word, wherever it stands."""
        return span_hashes(LOWER[self.data], self.start, self.end)


class SpanHashes:
    """64 bits for spans of bytes, or of other small numbers; made once, asked often."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        with np.errstate(over="ignore"):
            terms = _BYTE_VALUES[values] if values.dtype == np.uint8 else mix(values.astype(np.uint64))
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(terms * _powers_of(_BASE, n)[:n], out=self.sums[1:])
        self.back = _powers_of(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each span."""
    return SpanHashes(values)(start, end) if len(start) else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, of_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, and the places before each text.

    A text of fewer words, but not none, gives one run: all its words.
    """
    counts = np.diff(of_text)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    of_runs = np.zeros(len(of_text), np.int64)
    np.cumsum(runs, out=of_runs[1:])
    total = int(of_runs[-1])
    text = np.repeat(np.arange(len(counts)), runs)
    first = np.arange(total) - of_runs[text] + of_text[text]
    length = np.minimum(counts, size)[text]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    with np.errstate(over="ignore"):
        h = length.astype(np.uint64) * seed("shingle")
        for k in range(size):
            h = mix(h ^ np.where(k < length, padded[first + k], np.uint64(k)))
    return h, of_runs


def crc_mod_4(ids: np.ndarray) -> np.ndarray:
    """crc32 of each id as text, modulo 4."""
    return np.fromiter((zlib.crc32(b"%d" % i) & 3 for i in ids.tolist()), np.int8, len(ids))

"""Vectorised helpers for Arrow batches of texts: byte buffers, word spans, word and shingle hashes.

Texts are treated as UTF-8 bytes. Both word patterns of this package split at ASCII bytes only, so every
byte of a multi-byte character belongs to a word. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step takes at most, unless a single row is longer. A step holds several arrays of
#: eight bytes for each; the running sums have one entry more, which must not double the tables of powers.
STEP_BYTES = (1 << 20) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BYTE = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ORDER = np.random.default_rng(0xC0DE).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept by the worker for a step of usual size, grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(1 << 12, 1 << (n - 1).bit_length()) if n <= 2 * STEP_BYTES else n, dtype=np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        if n <= 2 * STEP_BYTES:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null rows are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or a single longer row."""
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


class Words:
    """Word spans of the rows of a step: ``start``/``stop`` bytes, row bounds ``first`` (n + 1), 64-bit ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        self.start, self.stop = spans(self.data, offsets, kind)
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(prefix(self.data), self.start, self.stop)


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a kind that stay inside their row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def prefix(data: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial hash; differences give the hash of any span."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def inverse_powers(sums: np.ndarray) -> np.ndarray:
    """What ``span_hashes`` needs for these sums; who calls it often over long texts makes it once."""
    return powers(_INVERSE, len(sums))


def span_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, inverse: np.ndarray | None = None) -> np.ndarray:
    """Hashes of byte spans, the same for equal bytes anywhere."""
    inverse = inverse_powers(sums) if inverse is None else inverse
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words that stay in their row, and row bounds (n + 1).

    A row with fewer words, but not none, has one: all its words.
    """
    counts = np.diff(first)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(counts)), made)
    at = first[:-1][row] + np.arange(bounds[-1]) - bounds[:-1][row]
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(k):
        inside = counts[row] > i
        total[inside] += words[at[inside] + i] * _ORDER[i]
    return mix(total + np.minimum(counts[row], k).astype(np.uint64)), bounds


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of single words, as ``Words.hashes`` gives them."""
    data, offsets = buffers(pa.array(words, pa.string()))
    return span_hashes(prefix(data), offsets[:-1], offsets[1:])

"""Arrow batches in pieces: a task's Python holds the results of few rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: bytes of text whose results are handed back at once; a longer row is a piece of its own.
PIECE_BYTES = 1 << 20


def bounds(sizes: list[int]) -> pa.Array:
    """Offsets of lists of the given lengths."""
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def pieces(sizes: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, number) of consecutive rows with at most ``limit`` bytes together, for rows of the given sizes."""
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, n = 0, len(ends)
    while first < n:
        before = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, stop - first
        first = stop


def text_pieces(text: pa.Array) -> Iterator[tuple[int, int]]:
    return pieces(pc.binary_length(text))


def list_pieces(texts: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Pieces of rows that hold a list of texts each."""
    ends = np.append(0, np.cumsum(pc.list_value_length(texts).fill_null(0).to_numpy(zero_copy_only=False)))
    running = np.append(0, np.cumsum(pc.binary_length(texts.flatten()).fill_null(0).to_numpy(zero_copy_only=False)))
    return pieces(pa.array(np.diff(running[ends])))

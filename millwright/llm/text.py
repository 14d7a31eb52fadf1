"""Whole texts of an Arrow batch as flat bytes: slices, words, hashes. Runs inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 250_000
SHINGLE = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

#: True for the bytes that part words: space and the controls from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: True outside letters: what is neither A-Z, a-z nor part of a character beyond ASCII.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[0x41:0x5B] = NOT_LETTER[0x61:0x7B] = NOT_LETTER[0x80:] = False


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and its ``rows + 1`` offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return whole[first : int(offsets[-1])], offsets - first


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE), np.full(size, INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``size`` of them."""
    return _powers(1 << max(16, int(size).bit_length()))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes, for ``span_hashes``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    down = powers(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray = BLANK):
    """Starts and ends of the words, and for each text the range of its words.

    A word never crosses the end of a text.
    """
    inside = ~parting[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data) > 1:
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        opens[1:] &= ~inside[:-1] | edge[1:-1]
        closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words, and for each text the range of its own.

    A-Z is lowered. A text of one to four words has one hash, of all of them;
    a text without words has none.
    """
    data = LOWER[data]
    starts, ends, ranges = words(data, offsets)
    hashes = span_hashes(prefix_sums(data), starts, ends)
    factors = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
    counts = np.diff(ranges)
    runs = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(counts.dtype))
    out_ranges = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(ranges[:-1], runs) + np.arange(out_ranges[-1]) - np.repeat(out_ranges[:-1], runs)
    left = np.repeat(np.minimum(counts, SHINGLE), runs)
    total = left.astype(np.uint64)
    for i in range(SHINGLE):
        at = np.minimum(first + i, max(len(hashes) - 1, 0))
        total = total + np.where(left > i, hashes[at] if len(hashes) else np.uint64(0), np.uint64(0)) * factors[i]
    return mixed(total), out_ranges

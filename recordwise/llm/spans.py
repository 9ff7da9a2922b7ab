"""Hashes of byte ranges for whole Arrow batches at once.

Texts of a batch lie behind each other in one byte buffer. A prefix sum of ``byte * BASE**i``
(modulo 2**64) gives the hash of any range as a difference, so words, n-grams and windows of a
batch are hashed without a Python loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have an inverse modulo 2**64
SLICE_BYTES = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i < n."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, U64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        known = _powers[base] = tuple(pair)
    return known[0][:n], known[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly (the splitmix64 finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Prefix:
    """Prefix sums over one buffer of bytes or characters."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        up, self.down = powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each range; equal bytes give equal hashes wherever they stand."""
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and its offsets (n + 1); NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in ``column``; a longer text comes alone and whole."""
    _, offsets = buffer_of(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def word_table() -> np.ndarray:
    """Marks the bytes of words: ASCII letters and digits, and every byte of a longer character."""
    table = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = True
    return table


WORD = word_table()


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that don't cross a text border: starts and ends."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(mask))]
    first[borders] = mask[borders]
    last[borders - 1] = mask[borders - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's ranges begin in the sorted ``starts`` (n + 1 positions)."""
    return np.searchsorted(starts, offsets)

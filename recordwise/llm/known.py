"""Parts of texts that a Python process has already encoded, found by hash for whole batches at once.

Texts hold the same parts (words, words with their space) again and again. ``Known`` keeps the ids of
the parts it has seen in one flat array; a batch looks all its parts up with one sorted search, so only
parts never seen before reach an encoder. Two independent 64-bit hashes name a part: the first finds it,
the second proves it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from recordwise.llm.spans import BASES, U64, Prefix


class Known:
    """Ids of parts by their hashes; forgets all of them above ``limit`` parts, so its memory is bounded."""

    def __init__(self, limit: int = 700_000):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, U64)  # ascending
        self.numbers = np.zeros(0, np.int64)  # of the keys
        self.checks = np.zeros(0, U64)  # by number, like the ends
        self.ends = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def append(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New parts in ascending order of their keys; ``ids`` lie behind each other."""
        numbers = np.arange(len(self.ends), len(self.ends) + len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.numbers = np.insert(self.keys, at, keys), np.insert(self.numbers, at, numbers)
        self.checks = np.concatenate([self.checks, checks])
        self.ends = np.concatenate([self.ends, len(self.flat) + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])

    def ids(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all parts behind each other, and where each part's ids begin (n + 1); None if two parts share a hash.

        ``encode`` gets parts that were never seen and returns their ids behind each other and the count of each.
        """
        if len(self.ends) > self.limit:
            self.forget()
        first = Prefix(data, BASES[0]).ranges(starts, ends)
        second = Prefix(data, BASES[1]).ranges(starts, ends)
        keys, where, which = np.unique(first, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        else:
            new = np.ones(len(keys), bool)
        if new.any():
            raw, place = data.tobytes(), where[new]
            parts = [raw[s:e] for s, e in zip(starts[place].tolist(), ends[place].tolist())]
            self.append(keys[new], second[place], *encode(parts))
            at = np.searchsorted(self.keys, keys)
        numbers = self.numbers[at][which] if len(keys) else np.zeros(0, np.int64)
        if not np.array_equal(second, self.checks[numbers]):
            return None
        heads = np.where(numbers > 0, self.ends[numbers - 1], 0) if len(numbers) else numbers
        sizes = self.ends[numbers] - heads if len(numbers) else numbers
        before = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        return self.flat[np.repeat(heads - before[:-1], sizes) + np.arange(before[-1])], before

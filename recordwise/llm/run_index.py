"""A suffix-sorted index of many short phrases with their Burrows-Wheeler runs and match lengths.

The phrases lie behind each other, each closed by a separator that is smaller than every byte and
equal to no other one, so no match crosses a border. The Burrows-Wheeler transform of repetitive
phrases has few runs; only at run heads is the common prefix with the preceding suffix compared
explicitly. The whole suffix order is kept and answers the searches; the runs only spare comparisons. Inside a run the neighbour's preceding byte is the
same, so the match is one longer than at the next text position: streaming over the text,
``length[i] = max(length[i - 1] - 1, explicit[i])`` gives the matching statistics of every position.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, kinds: int) -> np.ndarray:
    """Suffix array by prefix doubling; only groups that are not yet told apart are sorted again."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(2, np.int64)])
    key = (padded[:-2] * kinds + padded[1:-1]) * kinds + padded[2:]
    order = np.argsort(key)
    rank, step = np.zeros(n + 1, np.int64), 3
    open_slots = np.arange(n)
    members, sorted_key = order, key[order]
    while True:
        new = np.ones(len(members), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(members)))
        rank[members] = np.repeat(open_slots[heads], sizes) + 1
        order[open_slots] = members
        shared = np.repeat(sizes > 1, sizes)
        if not shared.any():
            return order
        members, open_slots = members[shared], open_slots[shared]
        key = rank[members] * (n + 2) + rank[np.minimum(members + step, n)]
        again = np.argsort(key)
        members, sorted_key = members[again], key[again]
        step *= 2


class RunIndex:
    def __init__(self, phrases: list[bytes]):
        count, sizes = len(phrases), np.array([len(p) for p in phrases])
        text = np.frombuffer(b"\0".join(phrases) + b"\0", np.uint8).astype(np.int64) + count
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        ends = self.starts + sizes
        text[ends] = np.arange(count)
        self.text, self.sizes = text, sizes
        self.order = suffix_order(text, 256 + count)
        before = text[self.order - 1]
        head = np.ones(len(text), bool)
        head[1:] = before[1:] != before[:-1]
        self.run_heads = np.flatnonzero(head)  # rows where a run begins; a run ends before the next
        self.run_symbols = before[self.run_heads]
        self.run_samples = self.order[self.run_heads]  # text position at each run's first row

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, compared byte by byte in rounds."""
        length, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(open_):
            same = self.text[a[open_] + length[open_]] == self.text[b[open_] + length[open_]]
            open_ = open_[same]
            length[open_] += 1
        return length

    def match_lengths(self) -> np.ndarray:
        """Per text position the length of its match with the preceding suffix in suffix order."""
        explicit = np.full(len(self.text), -1, np.int64)
        rows = self.run_heads[1:] if len(self.run_heads) and self.run_heads[0] == 0 else self.run_heads
        explicit[self.order[0]] = 0
        explicit[self.order[rows]] = self.common_prefix(self.order[rows], self.order[rows - 1])
        places = np.arange(len(self.text))
        return np.maximum(np.maximum.accumulate(np.where(explicit >= 0, explicit + places, -1)) - places, 0)

    def earliest(self, length: int) -> np.ndarray:
        """Per text position the first position in the text where the same ``length`` bytes begin.

        Positions with fewer bytes left in their phrase get themselves.
        """
        matched = self.match_lengths()[self.order] >= length
        classes = np.flatnonzero(~matched)
        firsts = np.minimum.reduceat(self.order, classes)
        found = np.empty(len(self.text), np.int64)
        found[self.order] = np.repeat(firsts, np.diff(np.append(classes, len(self.order))))
        return found

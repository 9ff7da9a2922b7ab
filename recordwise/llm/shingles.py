"""Sets of word shingles, and their MinHash values."""

from __future__ import annotations

import numpy as np

from recordwise.llm.spans import U64, WORD, Prefix, mixed, per_text, runs

WORDS = 5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``words`` words.

    Words are runs of letters and digits; the caller lowers the case. A text of fewer words has
    one shingle of all its words, a text without words has none.
    """
    starts, ends = runs(WORD[data], offsets)
    hashes = Prefix(data).ranges(starts, ends)
    heads = per_text(starts, offsets)
    grams = hashes[: max(0, len(hashes) - words + 1)].copy()
    for step in range(1, words):
        grams = mixed(grams) + hashes[step : step + len(grams)]
    grams = mixed(grams)
    found = []
    for first, last in zip(heads.tolist(), heads[1:].tolist()):
        if last - first >= words:
            found.append(np.unique(grams[first : last - words + 1]))
        elif last > first:
            short = np.array([last - first], U64)
            for at in range(first, last):
                short = mixed(short) + hashes[at : at + 1]
            found.append(mixed(short))
        else:
            found.append(np.zeros(0, U64))
    return found


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set of shingles."""
    with np.errstate(over="ignore"):
        first = mixed(np.array([grams.sum(dtype=U64) + U64(len(grams))]))[0]
        second = mixed(np.array([np.bitwise_xor.reduce(grams * U64(0x9E3779B97F4A7C15) ^ (grams >> U64(32)))]))[0]
    return int(first.view(np.int64)), int(second.view(np.int64))


def multipliers(count: int, seed: int = 7) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=U64) + U64(seed << 32)) | U64(1)


def minhashes(grams: np.ndarray, factors: np.ndarray, piece: int = 2048) -> np.ndarray:
    """The smallest value of the set under each hash function, 32 bits each."""
    best = np.full(len(factors), np.iinfo(U64).max, U64)
    for at in range(0, len(grams), piece):
        np.minimum(best, np.multiply.outer(grams[at : at + piece], factors).min(0), out=best)
    return (best >> U64(32)).astype(np.uint32)

"""Byte-level BPE ids of whole Arrow batches with the ``tokenizers`` library.

In this vocabulary a space that stands before a non-space always begins a new pre-token, so a
text may be cut there and its parts encoded alone. A batch is cut by numpy, equal parts are
found by two 64-bit hashes (``known``), and the parts that a process has not met yet go to the
library in a few long strings: what begins with such a space may also be joined again. The ids
come back in one list, and the bytes that each id stands for say where a part ends. The ids of
a text are the ids of its parts in order. A part is never split where that could change its
ids, and texts are always processed whole.

With ``added_tokens`` the ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``: the string of
an added token (``<|endoftext|>``) is that token, and the text is cut before and behind it. Without, such a
string is ordinary text, so that its id never comes from a text and can separate documents.
"""

from __future__ import annotations

import os
import re

import numpy as np

from recordwise.llm.known import Known
from recordwise.llm.spans import U64

VOCABULARY = "byte_bpe_50k.json"
SLICE = 4 << 20  # larger slices hold more equal parts
JOINED_BYTES = 1 << 18


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Bytes that may begin a white-space character; a space before one of them is no safe cut.
UNSAFE = np.zeros(256, bool)
UNSAFE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Encodes the texts of a byte buffer; remembers the ids of parts it has seen."""

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens  # True: their strings in a text are ordinary text
        # without a normaliser every id of a byte-level vocabulary stands for as many bytes as its string has characters
        pretty = self.tokenizer.pre_tokenizer
        self.plain = self.tokenizer.normalizer is None and type(pretty).__name__ == "ByteLevel" and not pretty.add_prefix_space
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for name, number in vocab.items():
            self.bytes_of[number] = len(name)
        added = self.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        self.added = {token.content: number for number, token in added.items()}
        names = sorted((re.escape(name.encode()) for name in self.added), key=len, reverse=True)
        self.pattern = re.compile(b"|".join(names)) if names else None
        # tokens that take spaces or mind their neighbours can't be cut out here
        self.whole = any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.known = Known()

    def many_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, uncached."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def part_ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts behind each other and the count of each."""
        joins = [self.plain and len(p) > 1 and p[0] == 32 and not UNSAFE[p[1]] for p in parts]
        sizes, found = np.zeros(len(parts), np.int64), [np.zeros(0, np.int64)] * 2
        order = []  # numbers of the parts in the order of what was found
        alone = [i for i, j in enumerate(joins) if not j]
        if alone:
            rows = self.many_ids([parts[i].decode("utf-8", "replace") for i in alone])
            sizes[alone] = [len(r) for r in rows]
            found[0] = np.array([i for r in rows for i in r], np.int64)
            order += alone
        together = [i for i, j in enumerate(joins) if j]
        if together:
            lengths = np.array([len(parts[i]) for i in together], np.int64)
            ends = np.cumsum(lengths)
            cuts = np.flatnonzero(np.diff((ends - 1) // JOINED_BYTES)) + 1
            runs = np.split(np.array(together), cuts)
            found[1] = np.array([i for r in self.many_ids([b"".join([parts[i] for i in run]).decode("utf-8", "replace") for run in runs]) for i in r], np.int64)
            reached = np.cumsum(self.bytes_of[found[1]])
            last = np.searchsorted(reached, ends)
            if not len(reached) or reached[-1] != ends[-1] or not np.array_equal(reached[last], ends):
                self.plain = False  # bytes that are no UTF-8: every part by itself
                return self.part_ids(parts)
            sizes[together] = np.diff(last + 1, prepend=0)
            order += together
        ids, counts = np.concatenate(found), sizes[order]
        heads = np.zeros(len(parts), np.int64)
        heads[order] = np.cumsum(counts) - counts
        before = np.cumsum(sizes) - sizes
        return ids[np.repeat(heads - before, sizes) + np.arange(int(sizes.sum()))], sizes

    def one_by_one(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = self.many_ids([raw[s:e].decode("utf-8", "replace") for s, e in zip(offsets.tolist(), offsets[1:].tolist())])
        return np.array([i for row in ids for i in row], np.uint32), np.concatenate([[0], np.cumsum([len(row) for row in ids])])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and where each text's ids begin (n + 1)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data), bool)
        cut[:-1] = (data[:-1] == 32) & ~UNSAFE[data[1:]]
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        # a space that ends one text stands before no character of the next one
        last = offsets[1:-1] - 1
        last = last[(last >= 0)]
        starts_text = np.zeros(len(data), bool)
        starts_text[offsets[:-1][offsets[:-1] < len(data)]] = True
        cut[last] &= starts_text[last]
        if self.pattern and self.pattern.search(raw := data.tobytes()):
            if self.whole:
                return self.one_by_one(raw, offsets)
            borders = offsets.tolist()
            found = [m.span() for a, b in zip(borders, borders[1:]) for m in self.pattern.finditer(raw, a, b)]
            if found:
                begins, behind = np.array(found).T
                before = begins[begins > 0] - 1  # a space before the token ends its part of the text, as above
                cut[before] &= starts_text[before]
                for a, b in found:
                    cut[a:b] = False
                cut[begins] = True
                cut[behind[behind < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        found = self.known.ids(data, starts, ends, self.part_ids)
        if found is None:  # two parts share a hash: one text at a time, uncached
            return self.one_by_one(data.tobytes(), offsets)
        ids, heads = found
        return ids, heads[np.searchsorted(starts, offsets)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """The encoder of this Python process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = Encoder(path, added_tokens)
    return _encoders[path, added_tokens]


def ordered_texts(documents):
    """Documents dealt out in ascending ``doc_id`` (NULL first), rows that share an id by the hash of their text."""
    from pyspark.sql import functions as F

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return chosen.repartitionByRange(*order).sortWithinPartitions(*order)


__all__ = ["Encoder", "U64", "encoder", "ordered_texts", "vocabulary_path"]

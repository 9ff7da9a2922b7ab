"""BPE encoding and decoding of whole texts with a contiguous array of ranks per word.

A text is cut at ASCII white space, which no word of this kind of vocabulary crosses. Chunks that a
process has met before are answered from its memory (``known``); the rest pass the vocabulary's own
normaliser and splitter, and their words are merged here:

* All short words of one length form a matrix of symbol ids. Beside it lies the contiguous array of the
  ranks of adjacent pairs. Each step scans every row for its smallest rank (the leftmost of equal ones),
  deletes that boundary in both arrays and looks up the two ranks next to it. Every row that still merges
  loses one symbol a step, so the rows stay one rectangle; a row without a rank leaves with its ids.
* A word above ``SHORT`` symbols would make the scan quadratic. Its pairs wait in a heap instead, in the
  same order (rank, then place), so its ids are the same.

``encode_texts(documents, path)`` returns ``doc_id``, ``ids`` and ``decoded``. A row's result depends on its
text alone. NULL and empty texts give no ids and an empty text; a NULL or repeated ``doc_id`` passes through,
one result per row; very long texts and words are worked through whole; an empty table gives none; extra
columns are not read. The string of an added token in a text is that token, as the library has it.
Decoding gives what the library's ``decode(ids, skip_special_tokens=False)`` gives without a decoder:
the strings of the tokens, joined by one space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordwise.llm.known import Known
from recordwise.llm.spans import U64, buffer_of, runs, slices

VOCABULARY = "word_bpe_49k.json"
SHORT = 64
NO_RANK = np.int32(1 << 30)
WHITE = np.zeros(256, bool)
WHITE[[*range(0x09, 0x0E), 0x20]] = True
WIDE_SPACE = re.compile(b"[\xc2\xe1\xe2\xe3]")  # bytes that begin the white space beyond ASCII


class Merges:
    """Rank and result of a pair of ids, looked up for whole arrays in one open-addressing table."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: int):
        self.size = U64(size)
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = U64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        self.results = np.zeros(1 << bits, np.int32)
        self.probes, mask = 1, (1 << bits) - 1
        for rank, (left, right, result) in enumerate(pairs):
            key = left * size + right
            slot, probes = int((key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - bits)), 1
            while self.keys[slot] not in (-1, key):  # a pair listed twice keeps its later rank
                slot, probes = (slot + 1) & mask, probes + 1
            self.keys[slot], self.ranks[slot], self.results[slot] = key, rank, result
            self.probes = max(self.probes, probes)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (``NO_RANK`` where a pair has none) and results."""
        key = left.astype(U64) * self.size + right.astype(U64)
        slot = (key * U64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        key = key.astype(np.int64)
        ranks, results = np.full(key.shape, NO_RANK, np.int32), np.zeros(key.shape, np.int32)
        if key.ndim > 1:
            flat = self.find(left.ravel(), right.ravel())
            return flat[0].reshape(key.shape), flat[1].reshape(key.shape)
        open_ = np.arange(len(key))
        for step in range(self.probes):
            at = (slot[open_] + step) & (len(self.keys) - 1)
            held = self.keys[at]
            hit = held == key[open_]
            ranks[open_[hit]], results[open_[hit]] = self.ranks[at[hit]], self.results[at[hit]]
            open_ = open_[~hit & (held != -1)]
            if not len(open_):
                break
        return ranks, results


def merge_rows(ids: np.ndarray, merges: Merges) -> list[tuple[np.ndarray, np.ndarray]]:
    """Merge words of one length (rows of ``ids``); returns (row numbers, their final ids) by final length."""
    done, rows = [], np.arange(len(ids))
    ranks, results = merges.find(ids[:, :-1], ids[:, 1:])
    while ids.shape[1] > 1:
        least = ranks.argmin(1)
        live = ranks[np.arange(len(ids)), least] < NO_RANK
        if not live.all():
            done.append((rows[~live], ids[~live]))
            ids, ranks, results, rows, least = ids[live], ranks[live], results[live], rows[live], least[live]
        if not len(rows):
            return done
        row, width = np.arange(len(ids)), ids.shape[1]
        ids[row, least] = results[row, least]
        kept = np.ones(ids.shape, bool)
        kept[row, least + 1] = False  # the boundary between the two parts goes
        ids = ids[kept].reshape(len(row), width - 1)
        kept = np.ones(ranks.shape, bool)
        kept[row, least] = False
        ranks, results = ranks[kept].reshape(len(row), width - 2), results[kept].reshape(len(row), width - 2)
        for place in (least - 1, least):  # the pairs on both sides of the new part
            beside = np.flatnonzero((place >= 0) & (place < width - 2))
            at = place[beside]
            ranks[beside, at], results[beside, at] = merges.find(ids[beside, at], ids[beside, at + 1])
    done.append((rows, ids))
    return done


def merge_long(ids: list[int], merges: Merges) -> list[int]:
    """The same for one long word: pairs wait in a heap by rank and place."""
    n = len(ids)
    behind, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks, results = (a.tolist() for a in merges.find(np.array(ids[:-1]), np.array(ids[1:])))
    heap = [(r, i, ids[i], ids[i + 1], new) for i, (r, new) in enumerate(zip(ranks, results)) if r < NO_RANK]
    heapq.heapify(heap)
    met: dict[tuple[int, int], tuple[int, int]] = {}

    def push(left: int, right: int) -> None:
        pair = ids[left], ids[right]
        if pair not in met:
            rank, new = merges.find(np.array(pair[:1]), np.array(pair[1:]))
            met[pair] = int(rank[0]), int(new[0])
        rank, new = met[pair]
        if rank < NO_RANK:
            heapq.heappush(heap, (rank, left, *pair, new))

    while heap:
        _, left, a, b, new = heapq.heappop(heap)
        right = behind[left]
        if ids[left] != a or right >= n or ids[right] != b:
            continue  # one of the two parts has changed since
        ids[left], ids[right] = new, -1
        behind[left] = behind[right]
        if behind[left] < n:
            before[behind[left]] = left
            push(left, behind[left])
        if before[left] >= 0:
            push(before[left], left)
    return [i for i in ids if i >= 0]


class WordEncoder:
    """Encodes and decodes by a vocabulary file of the tokenizers library with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.end = model.get("end_of_word_suffix") or ""
        unlike = {"dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"}
        if model["type"] != "BPE" or any(model.get(k) for k in unlike):
            raise ValueError(f"{path}: only plain BPE without unknown tokens is encoded here")
        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError(f"{path}: added tokens that mind their neighbours are not encoded here")
        self.added = {token.content: number for number, token in added.items()}
        names = sorted((re.escape(name) for name in self.added), key=len, reverse=True)
        self.pattern = re.compile("(" + "|".join(names) + ")") if names else None
        self.normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], max(vocab.values()) + 1)
        letters = [name for name in vocab if len(name) == 1]
        self.inner = np.full(max(map(ord, letters)) + 1, -1, np.int32)  # id of a symbol inside a word, and of one that ends it
        self.last = self.inner.copy()
        for letter in letters:
            self.inner[ord(letter)], self.last[ord(letter)] = vocab[letter], vocab[letter + self.end]
        strings = {number: name for name, number in vocab.items()} | {n: name for name, n in self.added.items()}
        self.strings = [strings.get(i, "").encode() for i in range(max(strings) + 1)]
        self.known = Known()

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words behind each other and the count of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        symbols = self.inner[codes]
        symbols[ends - 1] = self.last[codes[ends - 1]]
        sizes, pieces = np.zeros(len(words), np.int64), []
        for length in np.unique(lengths).tolist():
            here = np.flatnonzero(lengths == length)
            if length > SHORT:
                found = [
                    (here[i : i + 1], np.array([merge_long(symbols[ends[w] - length : ends[w]].tolist(), self.merges)]))
                    for i, w in enumerate(here.tolist())
                ]
            else:
                found = merge_rows(symbols[(ends[here] - length)[:, None] + np.arange(length)], self.merges)
                found = [(here[rows], ids) for rows, ids in found]
            for rows, ids in found:
                sizes[rows] = ids.shape[1]
                pieces.append((rows, ids))
        heads = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.int64)
        for rows, ids in pieces:
            out[heads[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, sizes

    def plain_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens, each normalised and split on its own."""
        split = [[word for word, _ in self.split(self.normal(text))] for text in texts]
        return self.gathered([w for words in split for w in words], np.array([len(words) for words in split], np.int64))

    def gathered(self, words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of words; equal words are merged once."""
        numbers: dict[str, int] = {}
        which = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
        if not len(which):
            return np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
        ids, sizes = self.words(list(numbers))
        heads = (np.cumsum(sizes) - sizes)[which]
        sizes = sizes[which]
        before = np.concatenate([[0], np.cumsum(sizes)])
        flat = ids[np.repeat(heads - before[:-1], sizes) + np.arange(before[-1])]
        return flat, np.diff(before[np.concatenate([[0], np.cumsum(counts)])])

    def chunk_ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without ASCII white space."""
        joined = b" ".join(chunks)
        special = [i for i, chunk in enumerate(chunks) if self.apart(chunk)] if self.needs_care(joined) else []
        if special:
            rest = sorted(set(range(len(chunks))) - set(special))
            found: list = [None] * len(chunks)
            ids, sizes = self.chunk_ids([chunks[i] for i in rest]) if rest else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            for i, part in zip(rest, np.split(ids, np.cumsum(sizes)[:-1])):
                found[i] = part
            for i, part in zip(special, self.texts_ids([chunks[i].decode() for i in special])):
                found[i] = part
            return np.concatenate(found), np.array([len(f) for f in found])
        # no chunk holds white space or turns into it, so the blanks of the normal form are those between chunks
        normal = self.normal(joined.decode())
        split = self.split(normal)
        blanks = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), np.uint32) == 32)
        places = np.fromiter((span[0] for _, span in split), np.int64, len(split))
        chunk = np.searchsorted(blanks, places)
        return self.gathered([word for word, _ in split], np.bincount(chunk, minlength=len(chunks)))

    def needs_care(self, joined: bytes) -> bool:
        return bool(WIDE_SPACE.search(joined)) or any(name.encode() in joined for name in self.added)

    def apart(self, chunk: bytes) -> bool:
        """Whether a chunk holds white space beyond ASCII or an added token."""
        if WIDE_SPACE.search(chunk) and len(chunk.decode().split()) != 1:
            return True
        text = chunk.decode()
        return any(c.isspace() and ord(c) > 127 for c in text) or any(name in text for name in self.added)

    def texts_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text, without memory of earlier ones; added tokens cut a text into parts of their own."""
        parts = [self.pattern.split(text) if self.pattern else [text] for text in texts]
        flat = [part for row in parts for part in row]
        ids, sizes = self.plain_ids(["" if part in self.added else part for part in flat])
        found = np.split(ids, np.cumsum(sizes)[:-1])
        found = [np.array([self.added[part]]) if part in self.added else piece for part, piece in zip(flat, found)]
        ends = np.cumsum([len(row) for row in parts]).tolist()
        return [np.concatenate(found[a:b]) for a, b in zip([0, *ends], ends)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a byte buffer behind each other, and where each text's ids begin (n + 1)."""
        starts, ends = runs(~WHITE[data], offsets)
        found = self.known.ids(data, starts, ends, self.chunk_ids)
        if found is None:  # two chunks share a hash: one text at a time
            raw, borders = data.tobytes(), offsets.tolist()
            ids = self.texts_ids([raw[s:e].decode() for s, e in zip(borders, borders[1:])])
            return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(i) for i in ids])])
        ids, heads = found
        return ids, heads[np.searchsorted(starts, offsets)]

    def decode(self, ids: list[int]) -> bytes:
        """The strings of the tokens, joined by one space, in UTF-8."""
        strings = self.strings
        return b" ".join([strings[i] for i in ids])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def with_ids(documents: DataFrame, path: str, kinds: str, row) -> DataFrame:
    """``doc_id`` and the columns that ``row(encoder, ids)`` makes of each text."""
    names = [part.split(" ")[0] for part in kinds.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                ids, heads = own.encode(*buffer_of(part.column(1)))
                made = [row(own, ids[a:b]) for a, b in zip(heads.tolist(), heads[1:].tolist())]
                columns = [list(c) for c in zip(*made)]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns)], ["doc_id", *names])

    chosen = documents.selectExpr("cast(doc_id as long) as doc_id", "coalesce(cast(text as string), '') as text")
    return chosen.mapInArrow(encode, f"doc_id long, {kinds}")


def encode_texts(documents: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` and ``decoded``."""
    return with_ids(documents, path, "ids array<long>, decoded string", lambda own, ids: (ids.tolist(), own.decode(ids.tolist()).decode()))


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens`` and the SHA-256 of the ids (little-endian, 32 bits) and of the decoded text."""

    def row(own: WordEncoder, ids: np.ndarray) -> tuple[int, str, str]:
        raw = ids.astype("<u4").tobytes()
        return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(own.decode(ids.tolist())).hexdigest()

    return with_ids(documents, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)

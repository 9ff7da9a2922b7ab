"""Word BPE: ids and decoded texts equal the library's, and the row merge equals a plain one."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from recordwise.llm import queries, word_bpe
from recordwise.llm.spans import buffer_of
from recordwise.llm.tokens import vocabulary_path

PATH = vocabulary_path(word_bpe.VOCABULARY)
TEXTS = [
    "", " ", "\n\t ", "Hello, World!", "it's don't WE'LL 'sabc 's't", "a<|endoftext|>b <|startoftext|>", "x" * 3000 + "hello" * 2000,
    "İstanbul ΣΑΣ Ĳ é 가", "1234 56,7", "a b　c d\x85e", "\x1c\x1d a", "́ ́x", "日本語のテキスト。", "\U0001f40c‍",
    "don’t naïve", "a" * 63, "a" * 64, "a" * 65, "ab" * 40 + " " + "ab" * 40,
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def random_texts(n, seed):
    rnd = random.Random(seed)
    parts = [*"aAbBsStTeE019.,!'", " ", "  ", "\n", " ", "　", "é", "é", "İ", "Σ", "각", "中", "the", "ing", "'ll", "<|endoftext|>"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(50))) for _ in range(n)]


def test_ids_and_texts_equal_the_librarys(plain):
    own = word_bpe.WordEncoder(PATH)
    for texts in (TEXTS, random_texts(800, 3), TEXTS[::-1]):  # the last ones come from memory
        ids, heads = own.encode(*buffer_of(pa.array(texts)))
        for i, text in enumerate(texts):
            wanted = plain.encode(text, add_special_tokens=False).ids
            found = ids[heads[i] : heads[i + 1]].tolist()
            assert found == wanted, text[:60]
            assert own.decode(found).decode() == plain.decode(wanted, skip_special_tokens=False)


def test_rows_and_heap_merge_as_one_boundary_at_a_time():
    own = word_bpe.encoder(PATH)
    rnd = random.Random(5)
    words = ["".join(rnd.choices("aeinorst", k=rnd.randrange(1, 40))) for _ in range(300)]

    def merged(word):
        ids = [int(own.inner[ord(c)]) for c in word]
        ids[-1] = int(own.last[ord(word[-1])])
        while len(ids) > 1:
            ranks, results = own.merges.find(np.array(ids[:-1]), np.array(ids[1:]))
            at = int(ranks.argmin())
            if ranks[at] >= word_bpe.NO_RANK:
                break
            ids[at : at + 2] = [int(results[at])]
        return ids

    words = list(dict.fromkeys(words))
    ids, sizes = own.words(words)
    for word, found in zip(words, np.split(ids, np.cumsum(sizes)[:-1])):
        assert found.tolist() == merged(word)
        start = [int(own.inner[ord(c)]) for c in word[:-1]] + [int(own.last[ord(word[-1])])]
        if len(word) > 1:
            assert word_bpe.merge_long(start, own.merges) == merged(word)


def test_memory_is_bounded_and_equal_hashes_fall_back(plain):
    own = word_bpe.WordEncoder(PATH)
    own.known.limit = 5
    for _ in range(3):
        ids, heads = own.encode(*buffer_of(pa.array(["one two three four five six seven eight"])))
        assert ids.tolist() == plain.encode("one two three four five six seven eight").ids
    own.known.checks ^= np.uint64(1)  # as if other parts had the same first hash
    own.known.limit = 100
    ids, heads = own.encode(*buffer_of(pa.array(["one two", "three<|endoftext|>"])))
    assert ids.tolist() == plain.encode("one two").ids + plain.encode("three<|endoftext|>", add_special_tokens=False).ids


def test_rows_of_any_kind(spark, docs, plain):
    rows = [(1, "Hello World"), (1, "Hello World"), (None, None), (2, None), (3, ""), (None, "x y"), (4, "wordwithoutend" * 20_000)]
    found = word_bpe.encode_texts(docs(rows), PATH).collect()
    ids = {t: plain.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in found) == sorted((i is not None, i or 0, ids[t]) for i, t in rows)
    assert all(r.decoded == plain.decode(r.ids, skip_special_tokens=False) for r in found)
    assert word_bpe.encode_texts(docs([]), PATH).count() == 0


@pytest.mark.tables
def test_query_equals_the_library(spark, folder, plain):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, folder, "documents").collect()}
    found = {tuple(r) for r in queries.QUERIES["op12_word_bpe"](spark, folder).collect()}
    wanted = set()
    for doc_id, text in texts.items():
        ids = plain.encode(text, add_special_tokens=False).ids
        decoded = plain.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        wanted.add((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == wanted

"""Token files, piece sampling and archives: exact round trips."""

import io
import random
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import spark_partition_id

from recordwise.llm import known, pieces, queries, token_binary, token_counts, tokens, warc
from recordwise.llm.spans import buffer_of
from recordwise.operators.sizing import fresh_path

TEXTS = [
    "", " ", "  ", "a", "a b", "a  b", "a   b ", "a \nb", "a\n b", " lead", "trail ", "x  y", "x  y", "it's don't  we'll",
    "café naïve 日本 \U0001f40c", "1234 56,7 8.9!!  --", "<|endoftext|> x<|endoftext|>", "\x1c \x1d a", "tab\t\tb \t c", "w" * 3000,
    "the of and to " * 500, "▁▁ ▁x", "\x00\x01", "line\r\n\r\nline",
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(n, seed):
    rnd = random.Random(seed)
    parts = [" ", "  ", "\n", " \n", "the", "Of", "zq", "'s", "7", "-", ".", "é", "　", " ", "\t"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(60))) for _ in range(n)]


def test_ids_equal_the_librarys(plain):
    texts = TEXTS + random_texts(400, 1)
    encode = tokens.Encoder(tokens.vocabulary_path())
    for _ in range(2):  # the second time from what was kept
        ids, heads = encode.encode(*buffer_of(pa.array(texts)))
        for k, t in enumerate(texts):
            assert ids[heads[k] : heads[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_parts_that_share_a_hash_are_told_apart(monkeypatch, plain):
    encode = tokens.Encoder(tokens.vocabulary_path())
    real = known.Prefix.ranges
    first = lambda self, s, e: np.ones(len(s), np.uint64) if self.down[1] == known.Prefix(np.zeros(1, np.uint8)).down[1] else real(self, s, e)
    monkeypatch.setattr(known.Prefix, "ranges", first)
    ids, heads = encode.encode(*buffer_of(pa.array(["one two three", "two"])))
    assert ids.tolist() == plain.encode("one two three").ids + plain.encode("two").ids and heads.tolist()[-1] == len(ids)


END = "<|endoftext|>"
WITH_TOKENS = [
    END, f"a {END} b", f"a  {END}  b", f"{END}{END}", f" {END} {END} ", f"a\n {END}", f"x{END}y", "<|endoftext|", "|>", "<|endof", "text|> b ", f"<|endo{END}f",
]


def test_ids_equal_the_contracts_call(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    rnd = random.Random(4)
    texts = TEXTS + WITH_TOKENS + ["".join(rnd.choices([END, " ", "  ", "\n", "a", " of", "<|", "é", "|>"], k=rnd.randrange(12))) for _ in range(100)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encode = tokens.Encoder(tokens.vocabulary_path(), added_tokens=True)
    for whole in (False, False, True):
        encode.whole = whole
        ids, heads = encode.encode(*buffer_of(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(heads, heads[1:])] == want
    # the registered query, over texts with the token's string
    monkeypatch.setattr(queries, "table", lambda *_: docs(list(enumerate(texts))))
    start = 0
    for r, row in zip(queries.QUERIES["op8_token_binary"](spark, "").orderBy("start").collect(), want, strict=True):
        row = [*row, token_binary.END_ID]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(row), zlib.crc32(struct.pack(f"<{len(row)}I", *row)))
        start += len(row)


def test_elias_fano():
    rnd = random.Random(2)
    for n, span in ((0, 1), (1, 10**12), (5, 3), (2000, 10**9), (3000, 100)):
        values = np.array(sorted(rnd.randrange(-span, span) for _ in range(n)), np.int64)
        sequence, end = token_binary.EliasFano.from_bytes(token_binary.EliasFano.of(values).to_bytes())
        assert end == len(sequence.to_bytes())
        for _ in range(20):
            a, b = sorted(rnd.choices(range(n + 1), k=2))
            assert sequence.select(a, b).tolist() == values[a:b].tolist()
    dense = token_binary.EliasFano.of(np.cumsum(np.full(100_000, 700)))
    assert len(dense.to_bytes()) * 8 / 100_000 < 2.5 + np.log2(700)


def test_shards(spark, docs, plain):
    rows = [(k * 3 - 20, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (4, "again"), (4, "again"), (4, "other")]
    shards = token_binary.write_shards(docs(rows), fresh_path(spark, "shards"), tokens.vocabulary_path())
    got = token_binary.read_shards(spark, shards, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] is not None for r in got] == [False] * 2 + [True] * (len(rows) - 2)
    known = [r["doc_id"] for r in got[2:]]
    assert known == sorted(known)
    want = Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))
        start += len(r["ids"])
    none = token_binary.write_shards(docs(rows).where("false"), fresh_path(spark, "shards"), tokens.vocabulary_path())
    assert none == [] and token_binary.read_shards(spark, none).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1 << 22])
def test_counts_across_blocks(spark, docs, plain, block):
    rows = list(enumerate([t for t in TEXTS if len(t) < 200])) + [(None, "x y"), (3, "again"), (3, "again")]
    got = token_counts.count_tokens(docs(rows), tokens.vocabulary_path(), block_ids=block)
    want = Counter((i, len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == want


def test_flat_files_with_open_ends(spark, tmp_path):
    files = {"a": [5, 6, 9, 9, 7], "b": [9], "c": [], "d": [1] * 20, "e": [1] * 10 + [9] + [2] * 3 + [9]}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in files], "path string")
    for block in (1, 3, 100):
        got = token_counts.document_lengths(token_counts.flat_blocks(paths, block_ids=block), separator=9).collect()
        assert sorted((r["path"][-1], r["ordinal"], r["n_tokens"], r["closed"]) for r in got) == [
            ("a", 0, 2, True), ("a", 1, 0, True), ("a", 2, 1, False), ("b", 0, 0, True), ("d", 0, 20, False), ("e", 0, 10, True), ("e", 1, 3, True)]


# --- pieces


def batch(texts):
    return buffer_of(pa.array(texts))


def test_pieces_decode_to_the_text(spark, docs):
    p = pieces.pieces(pieces.model_path(), 1.0)
    texts = TEXTS + random_texts(200, 3)
    data, offsets = batch(texts)
    for seed in range(3):
        ids, heads = pieces.encode(p, data, offsets, np.arange(len(texts)), seed)
        assert pieces.same_texts(data, offsets, *pieces.decode(p, ids, heads)).all()
    rows = list(enumerate(texts)) + [(None, None), (None, "x y"), (1, "again"), (1, "again")]
    encoded = pieces.encode_texts(docs(rows), pieces.model_path())
    assert encoded.where("not lossless").count() == 0
    again = pieces.decode_texts(encoded, pieces.model_path())
    assert Counter(tuple(r) for r in again.collect()) == Counter((i, t or "") for i, t in rows)
    assert pieces.encode_texts(docs(rows).where("false"), pieces.model_path()).count() == 0


def test_the_library_decodes_the_samples_too():
    from sentencepiece import SentencePieceProcessor

    model, p = SentencePieceProcessor(model_file=pieces.model_path()), pieces.pieces(pieces.model_path(), 1.0)
    texts = ["Hello world, it is  late.", "café \U0001f40c x"]
    ids, heads = pieces.encode(p, *batch(texts), np.arange(2), 1)
    assert [model.decode(ids[a:b].tolist()) for a, b in zip(heads, heads[1:])] == texts


def test_samples_follow_the_segmentations_probabilities():
    alpha = 0.3
    p = pieces.pieces(pieces.model_path(), alpha)
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.model_path())
    known = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def segmentations(text):
        if not text:
            yield ()
        for n in range(1, len(text) + 1):
            if text[:n] in known:
                for rest in segmentations(text[n:]):
                    yield (known[text[:n]], *rest)

    ways = list(segmentations("▁other"))
    weight = {w: np.exp(sum(p.log_weight[i] for i in w)) for w in ways}
    total, n = sum(weight.values()), 20_000
    ids, heads = pieces.encode(p, *batch(["other"] * n), np.arange(n), 5)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(heads, heads[1:]))
    assert set(seen) <= set(ways) and len(seen) > 5
    for way, w in weight.items():
        share = w / total
        assert abs(seen[way] / n - share) < 5 * (share / n) ** 0.5 + 1e-3


def test_a_row_does_not_depend_on_its_neighbours():
    p = pieces.pieces(pieces.model_path(), 0.5)
    texts = random_texts(50, 9)
    ids, heads = pieces.encode(p, *batch(texts), np.arange(50), 1)
    for k in (0, 17, 49):
        alone, _ = pieces.encode(p, *batch([texts[k]]), np.array([k]), 1)
        assert alone.tolist() == ids[heads[k] : heads[k + 1]].tolist()
    other, _ = pieces.encode(p, *batch(texts), np.arange(50), 2)
    assert other.tolist() != ids.tolist()


def test_long_units_give_the_same_samples(monkeypatch):
    p = pieces.pieces(pieces.model_path(), 0.5)
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("etaoinshré日\U0001f40c▁", k=n)) + " tail of it" for n in (300, 700, 20, 300)]
    texts.append(texts[0])
    plain, heads = pieces.encode(p, *batch(texts), np.arange(5), 1)
    monkeypatch.setattr(pieces, "LONG_UNIT", 100)
    monkeypatch.setattr(pieces, "LONG_BLOCK", 64)
    again, same = pieces.encode(p, *batch(texts), np.arange(5), 1)
    assert again.tolist() == plain.tolist() and same.tolist() == heads.tolist()


def test_a_long_text_without_spaces_takes_seconds():
    p = pieces.pieces(pieces.model_path(), 0.5)
    text = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    started = time.process_time()
    ids, heads = pieces.encode(p, *batch([text]), np.arange(1), 1)
    assert time.process_time() - started < 20  # about 5 s on a free core; a place at a time in numpy took over 100
    assert pieces.decode(p, ids, heads)[0].tobytes().decode() == text


# --- archives


def test_archives(spark):
    big = "<p>" + "xé" * 700
    rows = [(1, "http://a/é x", big), (5, "http://b", big), (3, None, big), (None, "http://n", big), (7, "http://c", None), (8, "http://d", ""),
            (9, "http://e\r\nX-Page-Id: 4", "small"), (10, "http://f", "small"), (11, "u", "y" * 300_000), (11, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    files = warc.write_warc(warc.with_keepers(pages), fresh_path(spark, "warc"), file_bytes=4000)
    got = warc.read_warc(spark, files).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got) == Counter(
        [(1, "revisit", 5, len(big.encode())), (5, "response", None, len(big.encode())), (3, "revisit", 5, len(big.encode())),
         (None, "revisit", 5, len(big.encode())), (7, "response", None, 0), (8, "response", None, 0), (9, "response", None, 5), (10, "response", None, 5),
         (11, "response", None, 300_000), (11, "response", None, 300_000)])
    assert {r["page_id"]: r["payload"].decode() for r in got if r["payload"] is not None}[5] == big
    empty = warc.write_warc(warc.with_keepers(pages.where("page_id > 99")), fresh_path(spark, "warc"))
    assert warc.read_warc(spark, empty).count() == 0


def test_broken_archives_are_errors():
    record = warc.record_bytes(1, "http://a", b"payload" * 500, None, 6)
    assert len(list(warc.records_of(io.BytesIO(record * 3)))) == 3
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records_of(io.BytesIO(record + record[:-20])))
    plain = zlib.decompress(record, 31)
    for bad, message in ((plain.replace(b"payloadpay", b"payloadPay", 1), "digest"), (plain[:-4] + b"xx\r\n\r\n", "Content-Length"), (b"x" + plain, "not a WARC")):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        with pytest.raises(ValueError, match=message):
            list(warc.records_of(io.BytesIO(packer.compress(bad) + packer.flush())))


def test_the_scan_spreads_over_tasks(spark, docs):
    folder = fresh_path(spark, "spread")
    placed = token_counts.write_flat(docs([(i, "word " * 40) for i in range(64)]).repartition(32), folder, tokens.vocabulary_path())
    blocks = token_counts.flat_blocks(placed.select("path").distinct(), block_ids=256)
    n = blocks.count()
    lengths = token_counts.document_lengths(blocks)
    busy = lengths.select(spark_partition_id().alias("p")).distinct().count()
    assert n >= 16 and busy >= n // token_counts.BLOCKS_PER_TASK // 2
    assert lengths.agg({"n_tokens": "sum"}).first()[0] == sum(r.n_tokens for r in token_counts.count_tokens(docs([(i, "word " * 40) for i in range(64)]), tokens.vocabulary_path()).collect())

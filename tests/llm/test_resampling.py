"""Importance resampling and its radix sort against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwise.llm import queries, radix, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, max_n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain_result(documents, target, max_n=1, buckets=10_000, seed=2024, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in documents]), (t, target)):
        for text in texts:
            for f in plain_features(text, max_n):
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in documents:
        found = plain_features(text, max_n)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(order[: len(order) * percent // 100], 1):
        row.append(rank)
    return sorted((tuple(r) if len(r) == 5 else (*r, None) for r in rows), key=str)


def some_documents(n, seed):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma7", "é", "Été", "x", "_", "--", "\n", "the", "Of", "中文", "q" * 70]
    return [(i, " ".join(rnd.choices(words, k=rnd.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("max_n", [1, 3])
def test_result_equals_the_plain_one(spark, docs, max_n):
    rows = some_documents(120, 1) + [(None, None), (None, "a " * 25), (7, "beta " * 30), (7, "beta " * 30), (500, ""), (501, "w" * 300_000 + " tail" * 50)]
    target = ["Beta gamma7 the", None, "", "the of 中文", "été " * 4]
    marked = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    found = resampling.resample(docs(rows), marked, max_n=max_n, percent=30)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_result(rows, target, max_n, percent=30)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs([]), none).count() == 0
    assert resampling.resample(docs([(1, "a")]), none).collect()[0].rank is None


def test_checksums_of_ranges():
    data = np.frombuffer(random.Random(2).randbytes(4000), np.uint8)
    starts = np.array([0, 5, 5, 100, 3999, 40, 7])
    ends = np.array([0, 6, 53, 4000, 4000, 88, 56])
    assert resampling.crc32_of(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


@pytest.mark.parametrize("spread", [1, 3, 1 << 40])
def test_places_are_those_of_a_sort(spark, spread):
    rnd = random.Random(spread)
    rows = [(rnd.choice([None, -(1 << 63), (1 << 63) - 1, *range(-spread, spread, max(1, spread // 9))]), rnd.randrange(-5, 5)) for _ in range(700)]
    table = spark.createDataFrame(rows, "a long, b long").repartition(5)
    found = radix.with_place(table, [F.col("a"), F.col("b")], "place", bits=11 if spread > 9 else 4, block=50).orderBy("place").collect()
    assert [r.place for r in found] == list(range(700))
    assert [(r.a, r.b) for r in found] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_equal_rows_and_few_digits(spark):
    assert [r.place for r in radix.with_place(spark.range(9).selectExpr("1L as a"), [F.col("a")], "place").orderBy("place").collect()] == list(range(9))
    assert radix.digits([0, 0]) == [] and radix.digits([1 << 63, 0b1001], bits=2) == [(1, 0), (1, 3), (0, 63)]


@pytest.mark.tables
def test_query_equals_the_plain_one(spark, folder):
    documents = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    target = [r.text for r in queries.table(spark, folder, "benchmark").collect()]
    found = queries.QUERIES["op13_resampling"](spark, folder).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_result(documents, target)

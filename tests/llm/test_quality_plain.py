"""The quality classifier against plain Python: features, updates and scores of a few texts."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordwise.llm import quality
from recordwise.llm.spans import BASES, buffer_of

WORD = 2**64
DIMS = 12
TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x1c-\x20]+")


def mixed(h):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> shift)) * factor % WORD
    return h ^ (h >> 31)


def plain_features(text):
    raw = text.encode()
    tokens = []
    for match in TOKENS.finditer(raw):
        token = match[0]
        name = mixed(sum((byte + 1) * pow(BASES[0], j, WORD) for j, byte in enumerate(token)) % WORD)
        tokens.append((name, token, bool(re.match(rb"[0-9A-Za-z\x80-\xff]", token)), match.end()))
    words, shapes = [name for name, *_ in tokens], []
    for i, (name, token, is_word, _) in enumerate(tokens):
        upper = sum(65 <= b <= 90 or (b == 0xC3 and k + 1 < len(token) and 0x80 <= token[k + 1] < 0x9F) for k, b in enumerate(token))
        digits = sum(48 <= b <= 57 for b in token)
        again = is_word and (i > 0 and words[i - 1] == name or i > 1 and not tokens[i - 1][2] and words[i - 2] == name)
        kind = 1 if digits * 2 > len(token) else 2 if upper >= 2 and upper * 2 >= len(token) - upper else 3 if upper else 4
        shapes.append(mixed(kind + 8 * again + 16 * min(len(token) // 12, 3)) if is_word else name)
    sums = defaultdict(float)
    for values, length, seed in ((words, 1, 11), (words, 2, 12), (shapes, 1, 21), (shapes, 2, 22), (shapes, 3, 23)):
        for i in range(len(values) - length + 1):
            gram = values[i]
            for step in range(1, length):
                gram = (mixed(gram) + values[i + step]) % WORD
            hashed = mixed((gram + seed) % WORD)
            sums[hashed >> (64 - DIMS)] += 1.0 if hashed & 1 else -1.0
    values = {c: math.copysign(math.log1p(abs(s)), s) if s else 0.0 for c, s in sums.items()}
    length = max(math.sqrt(sum(v * v for v in values.values())), 1e-12)
    return {c: v / length for c, v in values.items()}


def plain_model(rows):
    z, n = defaultdict(float), defaultdict(float)
    bias = 1 << DIMS

    def weight(c):
        rate = (quality.BETA + math.sqrt(n[c])) / quality.ALPHA + quality.L2
        return -(z[c] - math.copysign(quality.L1, z[c])) / rate if abs(z[c]) > quality.L1 else 0.0

    passes = min(10 * quality.EPOCHS, max(quality.EPOCHS, quality.LEARNED // len(rows)))
    for _ in range(passes):
        for values, label in rows:
            values = {**values, bias: quality.BIAS_INPUT}
            held = {c: weight(c) for c in values}
            error = 1 / (1 + math.exp(-sum(held[c] * v for c, v in values.items()))) - label
            for c, v in values.items():
                g = error * v
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / quality.ALPHA * held[c]
                n[c] += g * g
    return {c: weight(c) for c in n}


def some_texts(n):
    rnd = random.Random(8)
    parts = ["the", "The", "CAPS", "word", "word", "42", "a1", "Émile", "été", "-", "...", "(x)", "longlonglonglong", "\n", "\x1c", "中"]
    return [" ".join(rnd.choices(parts, k=rnd.randrange(30))) for _ in range(n)] + ["", " ", "end word", "word start", "word - word"]


def test_features_equal_the_plain_ones_whatever_stands_beside():
    texts = some_texts(50)
    heads, columns, values = quality.text_features(*buffer_of(pa.array(texts)), DIMS)
    for i, text in enumerate(texts):
        found = dict(zip(columns[heads[i] : heads[i + 1]].tolist(), values[heads[i] : heads[i + 1]].tolist()))
        assert found == pytest.approx(plain_features(text), abs=1e-12), text


def test_model_and_scores_equal_the_plain_ones(spark):
    texts = some_texts(45)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rnd = random.Random(2)
    labels = spark.createDataFrame([(i, rnd.randrange(2)) for i in range(len(texts))], "doc_id long, quality int")
    shard_rows = 20
    weights = quality.train(documents, labels, dims_log2=DIMS, shard_rows=shard_rows)
    chosen = labels.where(~quality.held_out(F.col("doc_id"))).select("doc_id", "quality", F.xxhash64(F.col("doc_id").cast("string")).alias("order")).collect()
    n_shards = -(-len(chosen) // shard_rows)
    shards = defaultdict(list)
    for row in sorted(chosen, key=lambda r: r.order):
        single = {c: float(np.float32(v)) for c, v in plain_features(texts[row.doc_id]).items()}
        shards[row.order % n_shards].append((single, row.quality))
    total = defaultdict(float)
    for members in shards.values():
        for c, w in plain_model(members).items():
            total[c] += w * len(members) / len(chosen)
    assert len(shards) > 1
    assert weights.tolist() == pytest.approx([total[c] for c in range((1 << DIMS) + 1)], abs=1e-9)
    scored = {r.doc_id: r.score for r in quality.score(documents, weights).collect()}
    for i, text in enumerate(texts):
        dot = sum(total[c] * v for c, v in plain_features(text).items()) + quality.BIAS_INPUT * total[1 << DIMS]
        assert scored[i] == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-9)

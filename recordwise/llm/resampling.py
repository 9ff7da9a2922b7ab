"""Importance resampling towards a target distribution, after hashed n-grams.

Every run of 1 to ``max_n`` words is a feature and belongs to a bucket (CRC-32 of its bytes, modulo
``buckets``). The counts of all documents and of all target texts give each bucket a gain, the logarithm of how
much likelier the target makes it, in whole thousandths. A document's weight is the mean gain of its features,
its score the weight plus Gumbel noise that a hash of its id fixes, so the documents with the highest scores
are a sample without replacement in proportion to the exponential of the weights, the same on every run.

The gains are one array of fixed size that every task holds; documents are scored against it a slice at a
time. The scores are then ordered by a distributed radix sort (``radix``), whose places are the ranks.

Words are runs of ASCII letters (A to Z read as a to z), digits and all characters beyond ASCII. NULL and empty
texts have no features and weight 0. Texts are read whole, however long. Rows that repeat an id are rows of
their own with equal noise; a NULL id is hashed as empty text and comes before other ids of the same score.
Equal scores go to the smaller id. Empty documents give an empty result; without target texts every gain
compares with the uniform distribution. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.files import stored
from recordwise.llm.radix import with_place
from recordwise.llm.spans import WORD, buffer_of, per_text, runs, slices

STEPPED = 48  # bytes; longer features are rare and hashed one by one


def crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32, made from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte ranges, one byte of all of them at a time."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    long = int(np.searchsorted(-lengths, -STEPPED, "left"))
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    heads, kept = starts[long:], lengths[long:]
    crc = out[long:]
    for step in range(int(kept[0]) if len(kept) else 0):
        n = int(np.searchsorted(-kept, -step, "left"))  # ranges that have this byte
        crc[:n] = CRC[(crc[:n] ^ data[heads[:n] + step]) & 255] ^ (crc[:n] >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    view = memoryview(np.ascontiguousarray(data))
    for i in range(long):
        out[i] = zlib.crc32(view[starts[i] : starts[i] + lengths[i]])
    result = np.empty_like(out)
    result[order] = out
    return result


def features(data: np.ndarray, offsets: np.ndarray, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature and the text it belongs to."""
    data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * 32
    word = WORD[data]
    starts, ends = runs(word, offsets)
    if max_n > 1:  # words of a text with one space between them
        kept = word.copy()
        kept[1:] |= word[:-1]
        place = np.cumsum(kept) - kept
        data = np.where(word, data, np.uint8(32))[kept]
        lengths = ends - starts
        starts = place[starts]
        ends = starts + lengths
        offsets = np.append(place, len(data))[offsets]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(per_text(starts, offsets)))
    found, owners = [], []
    for n in range(1, max_n + 1):
        if len(starts) < n:
            break
        inside = text[: len(text) - n + 1] == text[n - 1 :]
        found.append(crc32_of(data, starts[: len(starts) - n + 1][inside], ends[n - 1 :][inside]) % np.uint32(buckets))
        owners.append(text[: len(text) - n + 1][inside])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found]).astype(np.int64), np.concatenate([none, *owners])


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How often each bucket occurs in all texts; only totals of a task leave it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(features(*buffer_of(part.column(0)), max_n, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    chosen = texts.selectExpr("coalesce(cast(text as string), '') as text")
    rows = chosen.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)  # at most one row per bucket came back
    for row in rows:
        counts[row.bucket] = row.n
    return counts


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over source probability per bucket, each count plus one, rounded down."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n)))) for s, t in pairs], np.int64)


def noise(seed: int, key: int | None) -> int:
    """Gumbel noise in thousandths, fixed by a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(documents: DataFrame, gains: np.ndarray, max_n: int = 1, seed: int = 2024) -> DataFrame:
    """Per row: doc_id, n_features, weight, score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found, owner = features(*buffer_of(part.column(1)), max_n, len(gains))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, owner, gains[found])
                weight = total // np.maximum(n, 1)
                drawn = np.array([noise(seed, key) for key in part.column(0).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, weight, weight + drawn))], ["doc_id", "n_features", "weight", "score"])

    chosen = documents.selectExpr("cast(doc_id as long) as doc_id", "coalesce(cast(text as string), '') as text")
    return chosen.mapInArrow(score, "doc_id long, n_features long, weight long, score long")


def drawn(scored: DataFrame, percent: int = 10, min_features: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the highest ``percent`` of a hundred rows with enough features, else NULL."""
    scored = stored(scored, "scores")
    placed = with_place(scored.where(F.col("n_features") >= min_features), [-F.col("score"), F.col("doc_id")], "place")
    wanted = placed.count() * percent // 100
    rank = F.when(F.col("place") < wanted, F.col("place") + 1)
    rest = scored.where(F.col("n_features") < min_features).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("place").unionByName(rest)


def resample(
    documents: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, min_words: int = 20
) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (NULL where it is not drawn).

    ``min_words`` counts features, which are words where ``max_n`` is 1.
    """
    gains = gains_of(bucket_counts(documents, max_n, buckets), bucket_counts(target, max_n, buckets))
    return drawn(scores(documents, gains, max_n, seed), percent, min_words)


SQL = r"""
with bytes_of as (select list_transform(range(256), lambda b: list_reduce(range(8)::ubigint[], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b::ubigint)) as crc),
words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from documents
),
targets as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
  from benchmark
),
per_document as (select doc_id, word, count(*) as n from words group by all),
hashed as (
  select word, xor(4294967295, list_reduce(
    list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::ubigint),
    lambda c, b: xor(c >> 8, list_extract(crc, (xor(c, b) & 255)::bigint + 1)), 4294967295::ubigint)) % 10000 as bucket
  from (select word from per_document union select word from targets), bytes_of
),
source as (select bucket, sum(n) as s from per_document join hashed using (word) group by all),
target as (select bucket, count(*) as t from targets join hashed using (word) group by all),
gains as (
  select bucket, floor(1000 * ln(
    (coalesce(t, 0) + 1)::double * ((select coalesce(sum(s), 0) from source) + 10000) / ((coalesce(s, 0) + 1)::double * ((select coalesce(sum(t), 0) from target) + 10000))
  )) as gain
  from source full join target using (bucket)
),
weights as (select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain) / sum(n))::bigint as weight from per_document join hashed using (word) join gains using (bucket) group by all),
scored as (
  select d.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::ubigint + 0.5) / 4294967296)))::bigint as score
  from documents d left join weights using (doc_id)
),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join ranked using (doc_id)
"""

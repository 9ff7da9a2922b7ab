"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are the 1- and 2-grams of its words and marks, and the 1- to 3-grams of their
shapes (letters in capitals, digits, the mark itself, "same word as before"), each hashed to one
of ``2**dims_log2`` columns with a sign of its own; a row is scaled to unit length. Training
takes a bounded, documented number of labelled rows (``max_rows``, those with the smallest hash of
their id). Each shard of ``shard_rows`` rows is trained in a task of its own with per-coordinate
FTRL-proximal updates in hash order, the shards' weights are averaged in the order of the shards, so the result depends on
neither layout nor retries. Scoring is a sparse dot product per text with the broadcast weights,
whose size is fixed by ``dims_log2``.

Defined cases: a NULL text is an empty one and gets the score of the bias alone; NULL labels and
labelled ids without a document are not trained on; of rows that share a labelled id the text
with the smallest hash is trained on; texts are read whole; extra columns pass through in ``keep_good``; with no labelled row
at all every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwise.llm.spans import U64, WORD, Prefix, buffer_of, mixed, slices
from recordwise.operators.sizing import settle

DIMS_LOG2 = 18
MAX_ROWS = 24_000
SHARD_ROWS = 6_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 1e-4
EPOCHS, LEARNED = 3, 18_000
BIAS_INPUT = 0.3
THRESHOLD = 0.7

SPACES = np.zeros(256, bool)
SPACES[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LEAD2 = 0xC3  # first byte of Latin letters with accents; capitals end below 0x9F


def held_out(doc_id: Column) -> Column:
    """Rows that are never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def token_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds (1 word, 2 marks) of the tokens of all texts."""
    kind = np.where(WORD[data], 1, np.where(SPACES[data], 0, 2)).astype(np.int8)
    change = np.empty(len(data), bool)
    change[:1] = True
    change[1:] = kind[1:] != kind[:-1]
    begins = offsets[:-1]
    change[begins[begins < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    kinds = kind[starts]
    real = kinds > 0
    return starts[real], ends[real], kinds[real]


def text_features(data: np.ndarray, offsets: np.ndarray, dims_log2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pointers, columns and values of the sparse feature matrix, rows of unit length."""
    n = len(offsets) - 1
    starts, ends, kinds = token_runs(data, offsets)
    if not len(starts):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    words = Prefix(data).ranges(starts, ends)
    owner = np.searchsorted(offsets, starts, "right") - 1
    capitals = UPPER[data]
    capitals[:-1] |= (data[:-1] == LEAD2) & (data[1:] < 0x9F) & (data[1:] >= 0x80)
    upper = np.concatenate([[0], np.cumsum(capitals)])
    digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
    sizes = ends - starts
    in_upper, in_digits = upper[ends] - upper[starts], digits[ends] - digits[starts]
    previous_word = np.zeros(len(words), U64)
    if len(words) > 1:
        previous_word[1:] = np.where(owner[1:] == owner[:-1], words[:-1], U64(0))
    again = (kinds == 1) & (previous_word == words)
    if len(words) > 2:  # the word before a mark counts as the one before
        before_mark = np.zeros(len(words), bool)
        before_mark[2:] = (kinds[1:-1] == 2) & (words[:-2] == words[2:]) & (kinds[2:] == 1) & (owner[:-2] == owner[2:])
        again |= before_mark
    shape = np.where(in_digits * 2 > sizes, 1, np.where((in_upper >= 2) & (in_upper * 2 >= sizes - in_upper), 2, np.where(in_upper > 0, 3, 4)))
    shape = shape + 8 * again + 16 * np.minimum(sizes // 12, 3)
    shapes = np.where(kinds == 2, words, mixed(shape.astype(U64)))
    columns, owners = [], []
    for values, length, seed in ((words, 1, 11), (words, 2, 12), (shapes, 1, 21), (shapes, 2, 22), (shapes, 3, 23)):
        gram = values[: len(values) - length + 1].copy()
        for step in range(1, length):
            gram = mixed(gram) + values[step : len(values) - length + 1 + step]
        rows = owner[: len(gram)]
        inside = rows == owner[length - 1 : length - 1 + len(gram)]
        columns.append(mixed(gram[inside] + U64(seed)))
        owners.append(rows[inside])
    hashed, rows = np.concatenate(columns), np.concatenate(owners)
    column = (hashed >> U64(64 - dims_log2)).astype(np.int64)
    sign = np.where(hashed & U64(1), 1.0, -1.0)
    keys, which = np.unique((rows << dims_log2) | column, return_inverse=True)
    sums = np.bincount(which, sign)
    rows, column = keys >> dims_log2, keys & ((1 << dims_log2) - 1)
    values = np.sign(sums) * np.log1p(np.abs(sums))
    length = np.sqrt(np.bincount(rows, values * values, n))
    values = values / np.maximum(length[rows], 1e-12)
    return np.searchsorted(rows, np.arange(n + 1)), column, values


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """FTRL-proximal with a learning rate per coordinate; the last coordinate is the bias."""

    def __init__(self, dims: int):
        self.z, self.n = np.zeros(dims + 1), np.zeros(dims + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, shrunk)

    def learn(self, column: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(column)
        g = (sigmoid(w @ value) - label) * value
        n = self.n[column]
        self.z[column] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[column] = n + g * g


def train_shard(rows: list[tuple[np.ndarray, np.ndarray, int]], dims: int) -> np.ndarray:
    """Passes over the shard until about LEARNED updates are made, at least EPOCHS and at most 10 times that."""
    model = Ftrl(dims)
    for _ in range(min(10 * EPOCHS, max(EPOCHS, LEARNED // max(1, len(rows))))):
        for column, value, label in rows:
            model.learn(np.append(column, dims), np.append(value, BIAS_INPUT), label)
    return model.weights()


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", dims_log2: int = DIMS_LOG2, max_rows: int = MAX_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> np.ndarray:
    """Weights (the bias last), learned from labelled rows that are not held out."""
    dims = 1 << dims_log2
    # at most max_rows labels: those with the smallest hash of their id, so always the same ones
    order = F.xxhash64(F.col("doc_id").cast("string"))
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"), order.alias("order"))
    chosen = settle(chosen.orderBy("order", "doc_id", "label").limit(max_rows))
    n_shards = max(1, -(-chosen.count() // shard_rows))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.withColumn("shard", F.pmod("order", F.lit(n_shards)))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                heads, column, value = text_features(*buffer_of(part.column("text")), dims_log2)
                names = zip(*(part.column(c).to_pylist() for c in ("shard", "order", "label")))
                for k, (shard, place, target) in enumerate(names):
                    inside = slice(heads[k], heads[k + 1])
                    shards.setdefault(shard, []).append((place, column[inside].astype(np.int32), value[inside].astype(np.float32), target))
        for shard, members in shards.items():
            members.sort(key=lambda m: (m[0], m[3], len(m[1])))
            weights = train_shard([m[1:] for m in members], dims)
            at = np.append(np.flatnonzero(weights), -1)  # -1 tells how many rows there were
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(at), pa.int64()), pa.array(at), pa.array(np.append(weights[at[:-1]], 1.0) * len(members))], ["shard", "at", "w"]
            )

    learned = rows.select("text", "label", "order", "shard").repartition(n_shards, "shard").mapInArrow(learn, "shard long, at long, w double")
    # one row per column of the model; a column's shards, at most max_rows / shard_rows of them, are added in their order
    in_order = F.aggregate(F.array_sort(F.collect_list(F.struct("shard", "w"))), F.lit(0.0), lambda total, s: total + s["w"])
    sums = learned.groupBy("at").agg(in_order.alias("w")).toArrow()
    at, w = sums["at"].to_numpy(), sums["w"].to_numpy()
    weights = np.zeros(dims + 1)
    weights[at[at >= 0]] = w[at >= 0]
    return weights / max(1.0, float(w[at < 0].sum()))


def scores_of(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    dims = len(weights) - 1
    heads, column, value = text_features(data, offsets, dims.bit_length() - 1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
    dots = np.bincount(rows, weights[column] * value, len(offsets) - 1)
    return sigmoid(dots + BIAS_INPUT * weights[-1])


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score``: the probability of label 1 for every document."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = scores_of(*buffer_of(part.column("text")), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double")


def keep_good(documents: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, all columns as they are."""
    shared, at = documents.sparkSession.sparkContext.broadcast(weights), documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                values = scores_of(*buffer_of(part.column(at)), shared.value)
                yield part.filter(pa.array(values >= threshold))

    return documents.mapInArrow(run, documents.schema)


def predictions(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(documents, train(documents, labels))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)

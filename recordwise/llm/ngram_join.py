"""N-gram Jaccard join with Bayesian candidate pruning over MinHash values.

Documents are compared by their sets of five-word shingles; a link is a pair with a Jaccard
similarity of at least 0.8.

1. Per document its shingle set, the set's name and 128 MinHash values. Documents with equal sets
   form one class and are compared once.
2. Classes meet in buckets of equal bands (32 bands of 4 values; a pair at 0.8 misses all of them
   with probability 5e-8). A bucket of more than ``block`` classes is split into blocks, and each
   pair of blocks is a task group of its own.
3. Within a bucket the MinHash values of pairs are compared in steps of 16. With a uniform prior,
   n values of which m agree leave a posterior probability P(J >= t) = P(Bin(n + 1, t) <= m); a pair
   is dropped when it falls below ``tolerance``. What survives is kept as a forest: at most one link
   per class and bucket, not all pairs.
4. The forests' components are clusters that hold every surviving pair. The texts of a cluster meet
   once (large clusters in pairs of blocks), pairs are pruned the same way again and the rest is
   verified by exact set intersection. Links are counted in place, and again only forests leave.

The result has one row per document: ``doc_id, class_id`` (the smallest doc_id that it is connected
with by links), ``set_id`` (the smallest doc_id with the same shingles) and ``n_links`` (documents
linked with it, copies counted without being expanded).

Defined cases: a NULL text is an empty one; a text without words has no links; a text of fewer than
five words has one shingle of all its words; a NULL doc_id is not compared and has a NULL class;
rows that repeat doc_id and text are copies of each other; texts are read whole; extra columns pass
through ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.files import free_name, stored
from recordwise.llm.graph import components
from recordwise.llm.shingles import minhashes, multipliers, set_key, shingle_sets
from recordwise.llm.spans import U64, buffer_of, mixed, slices
from recordwise.operators.sizing import broadcast_if_small

THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-6
BUCKET_BLOCK = 4096
CLUSTER_BLOCK = 512


def fewest_matches(threshold: float, tolerance: float, values: int) -> list[tuple[int, int]]:
    """(n, m): after n values, a pair with fewer than m matches is dropped."""
    wanted = []
    for n in range(STEP, values + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        wanted.append((n, m))
    return wanted


def plausible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float, steps) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) whose posterior never fell below the tolerance."""
    fits = np.minimum.outer(size_a, size_b) >= threshold * np.maximum.outer(size_a, size_b) - 1e-9
    left, right = np.nonzero(fits)
    matches, done = np.zeros(len(left), np.int32), 0
    for n, fewest in steps:
        if not len(left):
            break
        for at in range(0, len(left), 1 << 18):
            piece = slice(at, at + (1 << 18))
            matches[piece] += (a[left[piece], done:n] == b[right[piece], done:n]).sum(1, dtype=np.int32)
        kept = matches >= fewest
        left, right, matches, done = left[kept], right[kept], matches[kept], n
    return left, right


class Forest:
    """Union-find over small local numbers; remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((x, y))

    def join_all(self, left: np.ndarray, right: np.ndarray) -> None:
        """Many links: rounds of vectorised labels first, so that few are joined one by one."""
        if not len(left):
            return
        keep = np.unique(left, return_index=True)[1]
        for k in keep.tolist():
            self.join(int(left[k]), int(right[k]))
        while True:
            roots = np.array([self.root(x) for x in range(len(self.parent))])
            apart = roots[left] != roots[right]
            if not apart.any():
                return
            left, right = left[apart], right[apart]
            _, first = np.unique(roots[left], return_index=True)
            for k in first.tolist():
                self.join(int(left[k]), int(right[k]))


def stars(forest: Forest, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trees as links from each one's smallest name to its other names, so that components need few rounds."""
    roots = np.array([forest.root(x) for x in range(len(names))])
    order = np.lexsort((names, roots))
    first = np.ones(len(order), bool)
    first[1:] = roots[order][1:] != roots[order][:-1]
    centre = names[order][first][np.cumsum(first) - 1]
    return centre[~first], names[order][~first]


def grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one key from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            name = tuple(c[a] for c in columns)
            if held and name != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = name
    if held:
        yield pa.Table.from_batches(held)


def lowered(documents: DataFrame) -> DataFrame:
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def signed(documents: DataFrame) -> DataFrame:
    """``doc_id, key_a, key_b, size, values`` (16 bits of each MinHash value) and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(BANDS * BAND_ROWS)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*buffer_of(part.column("text")))
                keys = [set_key(s) if len(s) else (None, None) for s in sets]
                values = np.zeros((len(sets), len(factors)), np.uint32)
                for k, grams in enumerate(sets):
                    if len(grams):
                        values[k] = minhashes(grams, factors)
                bands = np.zeros((len(sets), BANDS), U64)
                wide = values.astype(U64).reshape(len(sets), BANDS, BAND_ROWS)
                for r in range(BAND_ROWS):
                    bands = mixed(bands + wide[:, :, r] + U64(1))
                flat = pa.array(bands.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([v.tobytes() for v in values.astype("<u2")], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), flat),
                    ],
                    ["doc_id", "key_a", "key_b", "size", "values", "bands"],
                )

    schema = "doc_id long, key_a long, key_b long, size int, values binary, bands array<long>"
    return lowered(documents).mapInArrow(run, schema)


def in_blocks(rows: DataFrame, group: list[str], counts: DataFrame, block: int, node: str) -> DataFrame:
    """Rows dealt to pairs of blocks: ``left`` and ``right`` number the pair, ``side`` says where a row stands.

    ``counts`` has one row per group with ``members``. A group of up to ``block`` rows is one pair (0, 0).
    """
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = rows.join(counts.select(*group, blocks.alias("blocks"), "members"), group).withColumn("own", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("*", other)
    return dealt.select(
        *rows.columns,
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        (F.col("own") > F.col("other")).alias("side"),
    )


def dealt(rows: DataFrame, group: list[str]) -> DataFrame:
    key = [*group, "left", "right"]
    return rows.repartition(*key).sortWithinPartitions(*key)


def two_sides(table: pa.Table, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks; a block paired with itself stands on both."""
    if left == right:
        everyone = np.arange(table.num_rows)
        return everyone, everyone
    side = table["side"].to_numpy()
    return np.flatnonzero(~side), np.flatnonzero(side)


def bucket_links(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``a, b``: a forest of the plausible pairs of each bucket."""
    steps = fewest_matches(threshold, tolerance, BANDS * BAND_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["band", "value", "left", "right"]):
            names = table["node"].to_numpy()
            values = np.frombuffer(b"".join(table["values"].to_pylist()), "<u2").reshape(len(names), -1)
            sizes = table["size"].to_numpy().astype(float)
            one, two = two_sides(table, table["left"][0].as_py(), table["right"][0].as_py())
            forest, same = Forest(len(names)), one is two
            for at in range(0, len(one), 256):
                rows_one = one[at : at + 256]
                others = two[two > rows_one[0]] if same else two
                left, right = plausible(values[rows_one], values[others], sizes[rows_one], sizes[others], threshold, steps)
                left, right = rows_one[left], others[right]
                real = left < right if same else left != right
                forest.join_all(left[real], right[real])
            if forest.links:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in stars(forest, names)], ["a", "b"])

    return dealt(rows, ["band", "value"]).mapInArrow(run, "a long, b long")


def intersections(one: list[np.ndarray], two: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs of sets, exactly."""
    if len(left) * 8 < len(one) + len(two):
        return np.array([len(np.intersect1d(one[a], two[b], assume_unique=True)) for a, b in zip(left, right)], np.int64)
    flat = [np.concatenate(x) if x else np.zeros(0, U64) for x in (one, two)]
    row = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (one, two)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    place = []
    for f, r in zip(flat, row):
        at = np.searchsorted(common, f)
        hit = at < len(common)
        hit[hit] = common[at[hit]] == f[hit]
        order = np.argsort(at[hit], kind="stable")
        place.append((at[hit][order], r[hit][order]))
    total, width = np.zeros((len(one), len(two)), np.float32), 2048
    for first in range(0, len(common), width):
        dense = []
        for (at, r), n in zip(place, (len(one), len(two))):
            inside = slice(*np.searchsorted(at, (first, first + width)))
            matrix = np.zeros((n, width), np.float32)
            matrix[r[inside], at[inside] - first] = 1
            dense.append(matrix)
        total += dense[0] @ dense[1].T
    return total[left, right].astype(np.int64)


def cluster_links(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Verified links: per class its linked documents (``a, linked``) and a forest (``a, b``)."""
    steps = fewest_matches(threshold, tolerance, BANDS * BAND_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(BANDS * BAND_ROWS)
        for table in grouped(batches, ["cluster", "left", "right"]):
            sets = []
            for batch in table.select(["text"]).combine_chunks().to_batches():
                for part in slices(batch, "text"):
                    sets += shingle_sets(*buffer_of(part.column("text")))
            # rows that share a doc_id but not the class's shingles are other classes'
            wanted = zip(table["key_a"].to_pylist(), table["key_b"].to_pylist())
            names = table["node"].to_pylist()
            mine, seen = [], set()
            for k, key in enumerate(wanted):
                if len(sets[k]) and set_key(sets[k]) == key and (names[k], key) not in seen:
                    seen.add((names[k], key))
                    mine.append(k)
            table, sets = table.take(mine), [sets[k] for k in mine]
            names, copies = table["node"].to_numpy(), table["copies"].to_numpy()
            if len(names) < 2:
                continue
            sizes = np.array([len(s) for s in sets], float)
            values = np.array([minhashes(s, factors) for s in sets])
            one, two = two_sides(table, table["left"][0].as_py(), table["right"][0].as_py())
            left, right = plausible(values[one], values[two], sizes[one], sizes[two], threshold, steps)
            if one is two:
                left, right = left[left < right], right[left < right]
            both = intersections([sets[k] for k in one], [sets[k] for k in two], left, right)
            left, right = one[left], two[right]
            linked = both >= threshold * (sizes[left] + sizes[right] - both) - 1e-9
            left, right = left[linked], right[linked]
            forest = Forest(len(names))
            forest.join_all(left, right)
            counts = np.bincount(left, copies[right], len(names)) + np.bincount(right, copies[left], len(names))
            some = np.flatnonzero(counts)
            centres, others = stars(forest, names)
            a = np.concatenate([names[some], centres])
            b = pa.array([None] * len(some) + others.tolist(), pa.int64())
            linked_documents = np.concatenate([counts[some], np.zeros(len(others))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(linked_documents)], ["a", "b", "linked"])

    return dealt(rows, ["cluster"]).mapInArrow(run, "a long, b long, linked long")


def jaccard_links(documents: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, class_id, set_id, n_links`` of every document."""
    rows = stored(signed(documents), "signed")
    named = rows.where("doc_id is not null and key_a is not null")
    key = ["key_a", "key_b"]
    classes = stored(
        named.groupBy(*key).agg(
            F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("values").alias("values"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    # bands are met by name alone; only classes that meet another one bring their values
    banded = classes.select("node", F.posexplode("bands").alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("members")).where("members > 1")
    buckets = broadcast_if_small(stored(buckets, "buckets"))
    placed = in_blocks(banded, ["band", "value"], buckets, BUCKET_BLOCK, "node")
    met = placed.join(classes.select("node", "size", "values"), "node")
    clusters = components(bucket_links(met, threshold, tolerance)).select("node", F.col("label").alias("cluster"))
    members = classes.select("node", *key, "copies").join(clusters, "node")
    members = broadcast_if_small(members)
    texts = lowered(documents).join(members, F.col("doc_id") == F.col("node")).select("cluster", "node", *key, "copies", "text")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("members"))
    placed = in_blocks(texts, ["cluster"], broadcast_if_small(sizes), CLUSTER_BLOCK, "node")
    verified = stored(cluster_links(placed, threshold, tolerance), "verified")
    labels = components(verified.where("b is not null").select("a", "b"))
    linked = verified.groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked")).join(labels, "node", "left")
    known = classes.select(*key, "node", "copies").join(linked, "node", "left").where("copies > 1 or linked is not null")
    result = rows.select("doc_id", *key).join(broadcast_if_small(known), key, "left")
    doc_id, alone = F.col("doc_id"), F.col("doc_id").isNull() | F.col("node").isNull()
    return result.select(
        doc_id,
        F.when(alone, doc_id).otherwise(F.least("node", F.coalesce("label", "node"))).alias("class_id"),
        F.when(alone, doc_id).otherwise(F.col("node")).alias("set_id"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
    )


def keep_one(documents: DataFrame, threshold: float = THRESHOLD, links: Callable[..., DataFrame] = jaccard_links) -> DataFrame:
    """The documents without those that are linked, directly or by others, with one of a smaller id."""
    name = free_name(documents.columns, "gone")
    gone = links(documents, threshold).where("doc_id <> class_id").select(F.col("doc_id").alias(name)).distinct()
    return documents.join(broadcast_if_small(gone), F.col("doc_id") == F.col(name), "left_anti")

"""Removal of long repeated passages with suffix-sorted indexes of phrases and their Burrows-Wheeler runs.

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a document with a
smaller doc_id, or earlier in the same one. Strings are judged on the input.

1. Every window of ``length`` bytes has a minimiser: the gram of 16 bytes with the smallest hash, the
   leftmost of equal ones. Neighbouring windows with one minimiser form a phrase of at most
   ``2 * length - 16`` bytes, and equal windows have equal minimisers, so they always meet.
2. Minimisers are counted; those seen once cannot repeat. The others enter a filter of bounded
   size, and only phrases that pass it are shuffled, with their bytes. Equal phrases of one slice
   of input are combined before the shuffle, however many there are.
3. Phrases are dealt by minimiser. Distinct phrases are indexed in their order of first occurrence
   (``RunIndex``: a suffix array of the part, with the Burrows-Wheeler runs to save comparisons), and every
   window that matches an earlier one is marked. All later copies of a phrase are marked as a whole, by the
   phrase's 64-bit hash. A minimiser with more than ``group_bytes`` bytes of distinct phrases (a very common
   gram) is marked window by window in a grouped aggregation over two 64-bit hashes of each window instead,
   which spreads it over all tasks. So this is no run-length index in the strict sense; README says why.
4. Marks meet their document once, where overlapping marks are merged and the rest is put together.

Defined cases: a NULL text is an empty one; texts shorter than ``length`` keep everything; rows that
share a doc_id are ordered by the hash of their text, and rows that repeat id and text are one
document, so both lose the same; a NULL doc_id comes before all others; texts are read whole;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.exact_dedup import repeated_words
from recordwise.llm.run_index import RunIndex
from recordwise.llm.spans import BASES, U64, Prefix, buffer_of, mixed, slices
from recordwise.operators.sizing import fresh_path

LENGTH = 100
GRAM = 16
SLICE = 2 << 20
CHUNK_BYTES = 1 << 18
GROUP_BYTES = 8 << 20
FILTER_WORDS_LOG2 = 20
PLACE_BITS = 16
PLACES = U64((1 << PLACE_BITS) - 1)
NO_ID = -(1 << 63)


def keyed(documents: DataFrame) -> DataFrame:
    """``id`` (NULL as the smallest number), ``tie`` and ``text``; both numbers together name a document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text")
    )


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` = 16 bytes from each place, from two overlapping views of 8 bytes each."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = (eight[:-8] * U64(BASES[0]) + eight[8:]) * U64(BASES[1])
    h ^= h >> U64(32)
    h *= U64(0x94D049BB133111EB)
    return h


def phrases_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, start, end, minimiser hash) of all phrases, in order; positions in the buffer."""
    n, windows = len(data), length - GRAM + 1
    owner_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    last_start = (offsets[1:] - length).astype(np.int64)
    found, block = [], (1 << PLACE_BITS) - length  # small enough to stay in the cache
    for at in range(0, n - length + 1, block):
        piece = data[at : min(at + block + length - 1, n)]
        grams = gram_hashes(piece)
        places = np.arange(len(grams), dtype=U64)
        best = (grams & ~PLACES) | places
        width = 1
        while width * 2 <= windows:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if windows > width:
            best = np.minimum(best[: width - windows], best[windows - width :])
        chosen = (best & PLACES).astype(np.int32)
        owner = owner_of[at : at + len(chosen)]
        inside = np.arange(at, at + len(chosen)) <= last_start[owner]
        new = np.ones(len(chosen) + 1, bool)  # where a phrase or a gap begins
        new[1:-1] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
        heads = np.flatnonzero(new)
        tails, heads = heads[1:], heads[:-1]
        real = inside[heads]
        heads, tails = heads[real], tails[real]
        found.append((owner[heads], heads + at, tails + (at + length - 1), grams[chosen[heads]]))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.view(U64)
    owner, starts, ends, minimiser = (np.concatenate(c) for c in zip(*found))
    return owner.astype(np.int64), starts, ends, mixed(minimiser)


def minimisers(texts: DataFrame, length: int) -> DataFrame:
    """``hash, times`` (1, or 2 for more) of the minimisers of each slice of input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                *_, minimiser = phrases_of(*buffer_of(part.column("text")), length)
                values, times = np.unique(minimiser, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(np.minimum(times, 2).astype(np.int32))], ["hash", "times"]
                )

    return texts.select("text").mapInArrow(run, "hash long, times int")


def filter_array(words: DataFrame, words_log2: int) -> np.ndarray:
    """The filter as an array of 2**words_log2 words; its size is fixed whatever the data is."""
    table = words.toArrow()
    dense = np.zeros(1 << words_log2, np.int64)
    dense[table["word"].to_numpy()] = table["bits"].to_numpy()
    return dense.view(U64)


def in_filter(dense: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Tests the bits that ``repeated_words`` set for 64-bit hashes."""
    words = U64(len(dense) - 1)
    hit = np.ones(len(hashes), bool)
    for shift in (0, 32):
        part = (hashes >> U64(shift)) & U64(0xFFFFFFFF)
        hit &= ((dense[((part >> U64(6)) & words).astype(np.int64)] >> (part & U64(63))) & U64(1)).astype(bool)
    return hit


COLUMNS = ["group", "phrase", "id", "tie", "start", "end", "bytes"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
SCHEMA = "group long, phrase long, id long, tie long, start long, end long, bytes binary"


def batch_of(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, KINDS)], COLUMNS)


def candidates(texts: DataFrame, dense, length: int) -> DataFrame:
    """Phrases that may repeat, with their bytes; and marks (no bytes) for later copies within a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = buffer_of(part.column("text"))
                owner, starts, ends, minimiser = phrases_of(data, offsets, length)
                kept = in_filter(dense.value, minimiser)
                owner, starts, ends, minimiser = (x[kept] for x in (owner, starts, ends, minimiser))
                if not len(owner):
                    continue
                phrase = Prefix(data).ranges(starts, ends)
                ids, ties = (part.column(c).to_numpy()[owner] for c in ("id", "tie"))
                inner = starts - offsets[owner]
                size = ends - starts
                order = np.lexsort((inner, ties, ids, phrase, minimiser))
                first = np.ones(len(order), bool)
                first[1:] = (phrase[order][1:] != phrase[order][:-1]) | (minimiser[order][1:] != minimiser[order][:-1])
                head = order[first]
                numbers = np.cumsum(first) - 1
                same = (ids[order] == ids[head][numbers]) & (ties[order] == ties[head][numbers]) & (inner[order] == inner[head][numbers])
                later = np.sort(order[~same])
                raw = data.tobytes()
                pieces = pa.array([raw[a:b] for a, b in zip(starts[head].tolist(), ends[head].tolist())], pa.binary())
                yield batch_of([minimiser[head].view(np.int64), phrase[head].view(np.int64), ids[head], ties[head], inner[head], inner[head] + size[head], pieces])
                if len(later):  # neighbouring marks of one document as one
                    new = np.ones(len(later), bool)
                    new[1:] = (owner[later][1:] != owner[later][:-1]) | (starts[later][1:] > ends[later][:-1])
                    a = later[new]
                    b = later[np.append(np.flatnonzero(new)[1:], len(later)) - 1]
                    none = np.zeros(len(a), np.int64)
                    place = mixed(ties[a].view(U64) + U64(1)).view(np.int64)
                    yield batch_of([place, none, ids[a], ties[a], inner[a], ends[b] - offsets[owner[b]], pa.nulls(len(a), pa.binary())])

    return texts.mapInArrow(run, SCHEMA)


def marked_windows(index: RunIndex, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, from, to) of the maximal runs of bytes whose windows occur earlier in the index."""
    earliest = index.earliest(length)
    places = np.arange(len(index.text))
    phrase = np.repeat(np.arange(len(index.sizes)), index.sizes + 1)
    inner = places - index.starts[phrase]
    marked = np.flatnonzero((inner + length <= index.sizes[phrase]) & (earliest < places))
    if not len(marked):
        return marked, marked, marked
    new = np.ones(len(marked), bool)
    new[1:] = (marked[1:] > marked[:-1] + 1) | (phrase[marked[1:]] != phrase[marked[:-1]])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(marked)) - 1
    return phrase[marked[heads]], inner[marked[heads]], inner[marked[tails]] + length


class Chunk:
    """Distinct phrases of whole groups, in order of first occurrence, until they are indexed."""

    def __init__(self, length: int):
        self.length = length
        self.phrases: list[bytes] = []
        self.firsts: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, phrases: list[bytes], firsts: list[tuple[int, int, int]]) -> None:
        self.phrases += phrases
        self.firsts += firsts
        self.size += sum(map(len, phrases))

    def marks(self) -> Iterator[pa.RecordBatch]:
        if self.phrases:
            phrase, begin, end = marked_windows(RunIndex(self.phrases), self.length)
            if len(phrase):
                ids, ties, starts = (np.array(c, np.int64)[phrase] for c in zip(*self.firsts))
                none = np.zeros(len(phrase), np.int64)
                yield batch_of([none, none, ids, ties, starts + begin, starts + end, pa.nulls(len(phrase), pa.binary())])
        self.__init__(self.length)


def index_marks(rows: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """Marks from the index; phrases of groups that are too large for one come out with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, group, last = Chunk(length), None, None
        phrases: list[bytes] = []
        firsts: list[tuple[int, int, int]] = []
        seen: dict[int, tuple[int, int, int]] = {}
        size, large = 0, False

        def close() -> None:
            if not large and (len(phrases) > 1):
                chunk.add(phrases, firsts)

        for batch in batches:
            done: list[tuple] = []
            loose: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in COLUMNS]
            for name, phrase, id_, tie, start, end, data in zip(*columns):
                if data is None:
                    done.append((id_, tie, start, end))
                    continue
                if name != group:
                    close()
                    group, phrases, firsts, seen, size, large = name, [], [], {}, 0, False
                    if chunk.size >= CHUNK_BYTES:
                        yield from chunk.marks()
                place = (id_, tie, start)
                if phrase in seen:
                    if seen[phrase] != place:
                        done.append((id_, tie, start, end))
                    continue
                seen[phrase] = place
                size += len(data)
                if not large and size > group_bytes:
                    large = True
                    loose += [(name, 0, *f, f[2] + len(p), p) for f, p in zip(firsts, phrases)]
                    phrases, firsts = [], []
                if large:
                    loose.append((name, 0, id_, tie, start, end, data))
                else:
                    phrases.append(data)
                    firsts.append(place)
            if done:
                none = np.zeros(len(done), np.int64)
                yield batch_of([none, none, *([d[k] for d in done] for k in range(4)), pa.nulls(len(done), pa.binary())])
            if loose:
                yield batch_of([[r[k] for r in loose] for k in range(7)])
        close()
        yield from chunk.marks()

    order = ["group", "id", "tie", "start"]
    return rows.repartition("group").sortWithinPartitions(*order).mapInArrow(run, SCHEMA)


def window_marks(loose: DataFrame, length: int) -> DataFrame:
    """Marks of the phrases of very common minimisers, window by window: all but the earliest of equal windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes", 1 << 18):
                data, offsets = buffer_of(part.column("bytes"))
                at = np.arange(max(0, len(data) - length + 1))
                row = np.searchsorted(offsets, at, "right") - 1
                at, row = at[at + length <= offsets[row + 1]], row[at + length <= offsets[row + 1]]
                hashes = [Prefix(data, base).ranges(at, at + length).view(np.int64) for base in BASES]
                start = part.column("start").to_numpy()[row] + at - offsets[row]
                ids, ties = (part.column(c).to_numpy()[row] for c in ("id", "tie"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*hashes, ids, ties, start)], ["h1", "h2", "id", "tie", "start"])

    windows = loose.select("id", "tie", "start", "bytes").mapInArrow(run, "h1 long, h2 long, id long, tie long, start long")
    place = F.struct("id", "tie", "start")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(first, ["h1", "h2"]).where(place != F.col("first"))
    return later.select("id", "tie", "start", (F.col("start") + length).alias("end"))


def repeated_spans(documents: DataFrame, length: int = LENGTH, group_bytes: int = GROUP_BYTES, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """``id, tie, start, end``: marks, which may overlap, of the bytes to remove."""
    spark = documents.sparkSession
    texts = keyed(documents)
    counted = minimisers(texts, length).groupBy("hash").agg(F.sum("times").alias("times")).where("times > 1")
    dense = spark.sparkContext.broadcast(filter_array(repeated_words(counted.select("hash"), words_log2), words_log2))
    marked = index_marks(candidates(texts, dense, length), length, group_bytes)
    path = fresh_path(spark, "repeats")
    marked.drop("group", "phrase").write.parquet(path)
    stored = spark.read.schema("id long, tie long, start long, end long, bytes binary").parquet(path)
    marks = stored.where("bytes is null").drop("bytes")
    loose = stored.where("bytes is not null")
    return marks if loose.isEmpty() else marks.union(window_marks(loose, length))


def remove_repeats(documents: DataFrame, length: int = LENGTH, group_bytes: int = GROUP_BYTES, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes that stay) of every document."""
    spans = repeated_spans(documents, length, group_bytes, words_log2)
    lists = spans.groupBy("id", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    met = keyed(documents).join(lists, ["id", "tie"], "left").select("id", "text", "spans.start", "spans.end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, text, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
                data = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                if starts.is_valid:
                    for a, b in zip(starts.as_py(), ends.as_py()):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(b, merged[-1][1])
                        else:
                            merged.append([a, b])
                edges = [0, *(x for span in merged for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else data
                rows.append((None if id_ == NO_ID else id_, len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            for at in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[at : at + 512]], kind) for k, kind in enumerate(kinds)], names)

    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


SQL = f"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
    select doc_id, i, substr(h, 2 * i + 1, 2 * {LENGTH}) as w
    from (select doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - {LENGTH} + 1))) as i from texts)
),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by w order by doc_id, i) as n from windows) where n > 1),
begun as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + {LENGTH} then 0 else 1 end as new from later),
numbered as (select doc_id, i, sum(new) over (partition by doc_id order by i) as span from begun),
spans as (select doc_id, span, min(i) as a, max(i) + {LENGTH} as b from numbered group by all),
gaps as (
    select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as kept_from,
           lead(a) over (partition by doc_id order by a) is null as last
    from spans
),
kept as (
    select g.doc_id, count(*) as n_spans, sum(b - a) as n_removed,
           string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || case when last then substr(h, 2 * b + 1) else '' end, '' order by a) as h
    from gaps g join texts t using (doc_id) group by g.doc_id
)
select t.doc_id, length(t.h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(k.h, t.h))) as kept_sha256
from texts t left join kept k using (doc_id)
"""

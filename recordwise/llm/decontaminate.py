"""Benchmark decontamination by pigeonhole edit matching.

A document contains a test item when some part of it is within ``floor(error_rate * length)`` edits of
the item. Each item is cut into one piece more than that budget, so a match has at least one piece
without an edit. All pieces go into one Aho-Corasick automaton; documents stream through it, and
around each exact hit the item is verified with Myers' bit-parallel distance, where the bits of one
whole number hold a column of the edit matrix.

Both sides are compared in lower case with every run of other characters than letters and digits
as one space; positions are in that form. The items are a stated query set: they are read in blocks
of at most ``block_bytes`` bytes, each of them broadcast, so any number of them can be used.

Defined cases: a NULL text is an empty one; an item without letters or digits matches nothing; items
of equal text are all reported; a NULL id is reported as NULL; rows that repeat an id give the best
match of each row; texts are searched whole; an empty table on either side gives an empty result;
extra columns pass through ``keep_clean``, which keeps documents with a NULL doc_id only if their
own text is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwise.llm.files import free_name, stored

ERROR_RATE = 0.08
BLOCK_BYTES = 8 << 20


def normalised(text: Column) -> Column:
    plain = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(plain, "[^\\p{L}\\p{N}]+", " "))


class Item:
    """A test item as bit masks of its characters."""

    def __init__(self, item_id: int | None, text: str, error_rate: float):
        self.item_id, self.text, self.size = item_id, text, len(text)
        self.budget = int(error_rate * self.size + 1e-9)
        self.masks: dict[str, int] = {}
        for place, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << place

    def pieces(self) -> Iterator[tuple[int, str]]:
        """Budget + 1 pieces of nearly equal length, with their places."""
        n = self.budget + 1
        cuts = [self.size * k // n for k in range(n + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield a, self.text[a:b]

    def best(self, text: str) -> tuple[int, int]:
        """Smallest edit distance to any part of ``text``, and the first place where such a part ends."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        best, end = score, 0
        masks = self.masks
        for place, c in enumerate(text, 1):
            equal = masks.get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best, end = score, place
                    if not best:
                        break
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
        return best, end


class Matcher:
    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        import ahocorasick

        self.items = [Item(i, t, error_rate) for i, t in items if t]
        self.automaton, places = ahocorasick.Automaton(), {}
        for number, item in enumerate(self.items):
            for at, piece in item.pieces():
                places.setdefault(piece, []).append((number, at + len(piece)))
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item, distance, end) of the items that ``text`` contains; the best place of each."""
        if not self.items:
            return []
        hits: dict[int, list[int]] = {}
        for end, where in self.automaton.iter(text):
            for number, after in where:
                hits.setdefault(number, []).append(end + 1 - after)
        found = []
        for number, begins in hits.items():
            item = self.items[number]
            begins.sort()
            best = None
            first = last = begins[0]
            for begin in [*begins[1:], None]:
                if begin is not None and begin - last <= item.size:
                    last = begin
                    continue
                start = max(0, first - item.budget)
                distance, end = item.best(text[start : last + item.size + item.budget])
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = (distance, start + end)
                first = last = begin
            if best:
                found.append((item.item_id, *best))
        return found


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The normalised items in blocks of about ``block_bytes``; one block at a time is with the driver."""
    plain = stored(items.distinct(), "items")
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in plain.where(number == k).orderBy("item_id", "text").collect()]


def plain_items(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long").alias("item_id"), normalised(F.col("text")).alias("text"))


def find_items(
    documents: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, item_id, distance, end_at`` for every document and item that it contains."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    parts = []
    for block in item_blocks(plain_items(items), block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    rows += [(doc_id, *m) for m in matcher.matches(text.as_py())]
                kinds = zip(("doc_id", "item_id", "distance", "end_at"), (pa.int64(), pa.int64(), pa.int32(), pa.int64()))
                columns = {name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds)}
                yield pa.RecordBatch.from_pydict(columns)

        parts.append(texts.mapInArrow(run, "doc_id long, item_id long, distance int, end_at long"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def keep_clean(documents: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that contain no item, all columns as they are; a row goes by its own text."""
    names = documents.columns
    plain = free_name(names, "plain_text")
    texts = plain_items(items).select(F.lit(0).cast("long").alias("item_id"), "text")  # which of equal items it is doesn't matter here
    kept = documents.withColumn(plain, normalised(F.col("text")))
    for block in item_blocks(texts, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate)
            for batch in batches:
                clean = [not matcher.matches(text.as_py()) for text in batch.column(plain)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, kept.schema)
    return kept.select(*[F.col(f"`{name}`") for name in names])

"""Exact deduplication: two Bloom passes find the rows that may be repeated, only those shuffle.

Texts are equal when identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted.

* Pass 1 sets one bit of a sparse filter of 2**40 bits for each row and counts how often each
  bit is set. Tasks count their own rows first, and only (bit, count) pairs meet. Bits that
  were set twice enter the second filter, a dense one of ``2**filter_words_log2`` words of 64
  bits, two bits for each. Its size is bounded whatever the data is, so it can be broadcast.
* Pass 2 tests every row against the dense filter. A row that misses a bit has no copy: it
  passes straight through, without a shuffle. Only the others are grouped by their SHA-256, so
  a false hit costs a little work and never changes the result.

Groups are reduced by partial aggregation; copies meet their group's row in a join that is
broadcast when measured small and otherwise split by adaptive execution, so a text that holds a
third of all rows goes to no single task. Only built-in expressions are used.

Defined cases: a NULL text is an empty one, and all empty texts are copies of each other; the
copy with the most code points in the original text stays, then the smallest doc_id (NULL
last); of rows that repeat doc_id and text too, exactly one stays; extra columns of
any names pass through, because a row travels as one struct; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwise.operators.sizing import broadcast_if_small, settle

SPARSE_BITS = 40
FILTER_WORDS_LOG2 = 20
SPACE = "[\\x20\\x09-\\x0D]"


def normalised_hash(text: Column) -> Column:
    """SHA-256 of the text without white space, as 32 bytes."""
    bare = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, "")
    return F.unhex(F.sha2(F.encode(bare, "UTF-8"), 256))


def hashed_rows(documents: DataFrame) -> DataFrame:
    """All columns, with the hash and the rank of each row among its copies (the smallest stays)."""
    code_points = F.char_length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    doc_id = F.col("doc_id").cast("long")
    rank = F.struct((-code_points).alias("fewer"), doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"))
    return documents.withColumns({"_sha": normalised_hash(F.col("text")), "_rank": rank})


def filter_bits(sha: Column) -> list[Column]:
    """Two independent 64-bit positions of a hash."""
    return [F.xxhash64(sha, F.lit(seed)) for seed in (1, 2)]


def word_and_mask(position: Column, words_log2: int) -> tuple[Column, Column]:
    word = F.pmod(position, F.lit(1 << words_log2))
    return word, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(position, 40), F.lit(64)).cast("int"))


def repeated_filter(hashes: DataFrame, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """The dense filter: ``word, bits`` for hashes (column ``_sha``) whose sparse bit was set more than once."""
    bit = F.pmod(F.xxhash64("_sha"), F.lit(1 << SPARSE_BITS)).alias("bit")
    repeated = hashes.select(bit).groupBy("bit").count().where("count > 1")
    # the dense positions come from the sparse bit, so pass 2 derives them from the hash the same way
    entries = [F.struct(*(c.alias(n) for c, n in zip(word_and_mask(p, words_log2), ("word", "mask")))) for p in filter_bits(F.col("bit"))]
    pairs = repeated.select(F.explode(F.array(*entries)).alias("entry"))
    return pairs.groupBy("entry.word").agg(F.bit_or("entry.mask").alias("bits"))


def repeated_words(hashes: DataFrame, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """A dense filter over 64-bit hashes (column ``hash``): their two halves give a bit each. ``word, bits``."""
    halves = [F.col("hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("hash", 32)]
    entries = [
        F.struct(
            F.shiftright(half, 6).bitwiseAND((1 << words_log2) - 1).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), half.bitwiseAND(63).cast("int")).alias("mask"),
        )
        for half in halves
    ]
    pairs = hashes.select(F.explode(F.array(*entries)).alias("entry"))
    return pairs.groupBy("entry.word").agg(F.bit_or("entry.mask").alias("bits"))


def may_repeat(rows: DataFrame, dense: DataFrame, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """``rows`` with ``_maybe``: whether both bits of the row are set. ``dense`` has at most 2**words_log2 rows."""
    sparse = F.pmod(F.xxhash64("_sha"), F.lit(1 << SPARSE_BITS))
    hit, flagged = F.lit(True), rows
    for number, position in enumerate(filter_bits(sparse)):
        word, mask = word_and_mask(position, words_log2)
        side = dense.select(F.col("word").alias(f"_word{number}"), F.col("bits").alias(f"_bits{number}"))
        flagged = flagged.withColumn(f"_at{number}", word)
        flagged = flagged.join(F.broadcast(side), F.col(f"_at{number}") == F.col(f"_word{number}"), "left")
        hit = hit & (F.coalesce(F.col(f"_bits{number}"), F.lit(0).cast("long")).bitwiseAND(mask) != 0)
    return flagged.withColumn("_maybe", hit).drop("_at0", "_at1", "_word0", "_word1", "_bits0", "_bits1")


def copies(documents: DataFrame, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    narrow = settle(hashed_rows(documents).select("_sha", "_rank"))
    dense = settle(repeated_filter(narrow, words_log2))
    flagged = may_repeat(narrow, dense, words_log2)
    text_hash = F.lower(F.hex("_sha")).alias("text_sha256")
    alone = flagged.where("not _maybe").select(
        F.col("_rank.doc_id").alias("doc_id"),
        F.col("_rank.doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        text_hash,
    )
    counted = flagged.where("_maybe").groupBy("_sha", "_rank").agg(F.count("*").alias("same"))
    groups = counted.groupBy("_sha").agg(F.min("_rank").alias("best"), F.sum("same").alias("group_size"))
    met = counted.join(broadcast_if_small(groups.where("group_size > 1")), "_sha", "left")
    # rows that repeat doc_id and text are counted above and listed again here; the first of them may stay
    listed = met.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("same"))).alias("number"))
    together = listed.select(
        F.col("_rank.doc_id").alias("doc_id"),
        F.when(F.col("best").isNull(), F.col("_rank.doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best").isNull() | ((F.col("_rank") == F.col("best")) & (F.col("number") == 1))).alias("kept"),
        text_hash,
    )
    return alone.unionByName(together)


def drop_copies(documents: DataFrame, words_log2: int = FILTER_WORDS_LOG2) -> DataFrame:
    """The documents that stay, with all their columns."""
    # the row travels as one struct, so its columns may have any names
    rows = hashed_rows(documents.select(F.struct("*").alias("_row"), "doc_id", "text")).select("_row", "_sha", "_rank")
    narrow = settle(rows.select("_sha", "_rank"))
    dense = settle(repeated_filter(narrow, words_log2))
    suspects = may_repeat(narrow, dense, words_log2).where("_maybe")
    groups = suspects.groupBy("_sha").agg(F.min("_rank").alias("_best"), F.count("*").alias("_size")).where("_size > 1")
    flagged = may_repeat(rows, dense, words_log2)
    alone = flagged.where("not _maybe").select("_row.*")
    met = flagged.where("_maybe").join(broadcast_if_small(groups), "_sha", "left")
    best = met.where(F.col("_best").isNull() | (F.col("_rank") == F.col("_best")))
    return alone.unionByName(best.dropDuplicates(["_sha"]).select("_row.*"))


COPIES_SQL = """
with hashed as (
    select doc_id, length(coalesce(text, '')) as code_points,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256
    from documents
)
select doc_id,
       first_value(doc_id) over best as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over best = 1 as kept,
       text_sha256
from hashed
window best as (partition by text_sha256 order by code_points desc, doc_id)
"""

"""Tokens per document of flat token files that have no index.

A flat file is nothing but ids, where an end-of-document id closes each document. Files are cut
into blocks of equal size whatever the documents are, so one document may span many blocks and
a block may hold thousands. Pass 1 finds the separators of each block with one vectorised
comparison and keeps three numbers per block. A prefix scan over the blocks of a file then
stitches the borders: how many documents were closed before a block, and how many ids the open
document already has. Pass 2 turns each block's separators into document lengths with these.

Defined cases: documents of no ids count 0 tokens; ids behind a file's last separator are an
unclosed document of their own; an empty file has no documents. In ``count_tokens`` a NULL text
is empty, a NULL or repeated doc_id is one more row with that id, and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordwise.llm.files import Replacing, attempt_number, opened, partition_number, stored
from recordwise.llm.spans import buffer_of, slices
from recordwise.llm.tokens import SLICE, encoder
from recordwise.operators.sizing import fresh_path

SEPARATOR = 50256
BLOCK_IDS = 1 << 22
BLOCKS_PER_TASK = 4
SCAN_IDS = 1 << 20


def write_flat(documents: DataFrame, folder: str, vocabulary: str, separator: int = SEPARATOR, kind: str = "<u2") -> DataFrame:
    """Encode documents into flat files, one per partition in its own order; returns the rows ``path, ordinal, doc_id``.

    The rows are what the files don't say: which document stands where. They are written as a
    table in the same folder, so that reading them doesn't encode again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, n = encoder(vocabulary), None, 0
        name = f"{folder}/flat/part-{partition_number():06d}.bin"
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                if out is None:
                    out = Replacing(name, attempt_number())
                ids, heads = encode.encode(*buffer_of(part.column("text")))
                if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError(f"ids don't fit into {kind}")
                out.write(np.insert(ids.astype(kind), heads[1:], separator).tobytes())
                ordinals = np.arange(n, n + part.num_rows)
                n += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * part.num_rows, pa.string()), pa.array(ordinals), part.column("doc_id")],
                    ["path", "ordinal", "doc_id"],
                )
        if out is not None:
            out.close()

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.mapInArrow(write, "path string, ordinal long, doc_id long")
    rows.write.parquet(f"{folder}/documents")
    return documents.sparkSession.read.schema(rows.schema).parquet(f"{folder}/documents")


def flat_blocks(paths: DataFrame, kind: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """``path, block, first, n``: the blocks of the files in column ``path``, from the files' sizes."""
    width = np.dtype(kind).itemsize

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                system, place = opened(path)
                rows.append((path, system.get_file_info(place).size // width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["path", "ids"]
            )

    blocks = F.expr(f"explode(sequence(0L, greatest(0L, ids - 1) div {block_ids}L))").alias("block")
    sized = paths.select("path").mapInArrow(sizes, "path string, ids long").where("ids > 0").select("path", "ids", blocks)
    first = F.col("block") * block_ids
    return sized.select("path", "block", first.alias("first"), F.least(F.lit(block_ids), F.col("ids") - first).alias("n"))


def separators(path: str, first: int, n: int, separator: int, kind: str) -> np.ndarray:
    """Positions of the separators within one block, searched in pieces of bounded size."""
    system, place = opened(path)
    width, found = np.dtype(kind).itemsize, []
    with system.open_input_file(place) as file:
        file.seek(first * width)
        for at in range(0, n, SCAN_IDS):
            ids = np.frombuffer(file.read(min(SCAN_IDS, n - at) * width), kind)
            found.append(np.flatnonzero(ids == separator) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def document_lengths(blocks: DataFrame, separator: int = SEPARATOR, kind: str = "<u2") -> DataFrame:
    """``path, ordinal, n_tokens, closed`` of every document in the files of ``flat_blocks``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, tail = [], []
            for path, _, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                places = separators(path, first, n, separator, kind)
                found.append(len(places))
                tail.append(n - 1 - int(places[-1]) if len(places) else n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64()), pa.array(tail, pa.int64())],
                ["path", "block", "first", "n", "found", "tail"],
            )

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, n, before, carried, last in zip(*(c.to_pylist() for c in batch.columns)):
                places = separators(path, first, n, separator, kind)
                counts = np.diff(places, prepend=-1) - 1
                if len(counts):
                    counts[0] += carried
                closed = np.ones(len(counts), bool)
                open_ids = n - 1 - int(places[-1]) if len(places) else n + carried
                if last and open_ids:
                    counts, closed = np.append(counts, open_ids), np.append(closed, False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(counts), pa.string()),
                        pa.array(before + np.arange(len(counts))),
                        pa.array(counts.astype(np.int64)),
                        pa.array(closed),
                    ],
                    ["path", "ordinal", "n_tokens", "closed"],
                )

    # a stated number of partitions, one for every few blocks: adaptive execution would join these small rows in one task
    blocks = stored(blocks, "blocks")
    ways = max(1, -(-blocks.count() // BLOCKS_PER_TASK))
    kept = "path string, block long, first long, n long"
    sums = blocks.repartition(ways, "path", "block").mapInArrow(summarise, kept + ", found long, tail long")
    by_file = Window.partitionBy("path").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    # ids since the last separator: all of the blocks after the latest one that has any, and that one's tail
    size_before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    latest = F.last(F.when(F.col("found") > 0, F.col("sum_to") - F.col("tail")), ignorenulls=True).over(earlier)
    stitched = (
        sums.withColumn("sum_before", size_before)
        .withColumn("sum_to", F.col("sum_before") + F.col("n"))
        .withColumn("carried", F.col("sum_before") - F.coalesce(latest, F.lit(0)))
        .withColumn("before", F.coalesce(F.sum("found").over(earlier), F.lit(0)))
        .withColumn("last", F.lead("block").over(by_file).isNull())
    )
    chosen = stitched.select("path", "first", "n", "before", "carried", "last")
    return chosen.repartition(ways, "path", "first").mapInArrow(lengths, "path string, ordinal long, n_tokens long, closed boolean")


def count_tokens(documents: DataFrame, vocabulary: str, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``doc_id, path, ordinal, n_tokens`` of every document, counted in the flat files."""
    folder = fresh_path(documents.sparkSession, "flat")
    placed = write_flat(documents, folder, vocabulary, separator)
    blocks = flat_blocks(placed.select("path").distinct(), block_ids=block_ids)
    counted = document_lengths(blocks, separator).drop("closed")
    # compressed files look small to the planner, so it must not choose to broadcast them
    return placed.hint("merge").join(counted, ["path", "ordinal"]).select("doc_id", "path", "ordinal", "n_tokens")

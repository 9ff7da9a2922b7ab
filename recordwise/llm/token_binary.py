"""Token ids as binary shards with Elias-Fano document boundaries.

A shard is two files. ``.ids`` holds the ids of its documents behind each other, each document
closed by the end id, as little-endian unsigned integers of the smallest width that fits the
vocabulary. ``.index`` holds two Elias-Fano sequences: the end of each document within ``.ids``,
and the document ids, which ascend too. An Elias-Fano sequence of n values below u takes about
``n * (2 + log2(u / n))`` bits: the low bits packed, the high bits in unary, and every 512th
one's position as a 32-bit sample. ``select`` starts at the nearest sample and unpacks only the
bits it passes, so no table of 64-bit offsets exists in the file or in memory.

Shards are in ascending ``doc_id`` order, NULL ids first; rows that share an id are ordered by
the hash of their text. A NULL text is empty and consists of the end id alone. Very long texts
are written whole. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordwise.llm.files import Replacing, attempt_number, one_task_each, opened, partition_number
from recordwise.llm.spans import buffer_of, slices
from recordwise.llm.tokens import SLICE, encoder, ordered_texts, vocabulary_path

MAGIC = b"TOKEF001"
SAMPLE = 512
END_ID = 2
READ_IDS = 1 << 21


def packed_bits(values: np.ndarray, width: int) -> bytes:
    """``values`` with ``width`` bits each, least significant bit first."""
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """A sequence of ascending whole numbers."""

    HEAD = struct.Struct("<qQQQQ")  # smallest value, count, low width, bytes of low bits, bytes of high bits

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        self = cls()
        values = np.asarray(values, np.int64)
        self.n = len(values)
        self.base = int(values[0]) if self.n else 0
        rest = (values - self.base).view(np.uint64)
        span = int(rest[-1]) + 1 if self.n else 1
        self.width = max(0, (span // max(1, self.n)).bit_length() - 1)
        low = rest & np.uint64((1 << self.width) - 1)
        ones = (rest >> np.uint64(self.width)).astype(np.int64) + np.arange(self.n)
        high = np.zeros(int(ones[-1]) // 8 + 1 if self.n else 0, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        self.high, self.low = high, np.frombuffer(packed_bits(low, self.width), np.uint8)
        self.samples = ones[::SAMPLE].astype("<u4")
        return self

    def to_bytes(self) -> bytes:
        head = self.HEAD.pack(self.base, self.n, self.width, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        self = cls()
        self.base, self.n, self.width, low, high = cls.HEAD.unpack_from(data, at)
        at += cls.HEAD.size
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        at += low + high
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at)
        return self, at + 4 * len(self.samples)

    def select(self, first: int, last: int) -> np.ndarray:
        """The values number ``first`` to ``last - 1``."""
        if first >= last:
            return np.zeros(0, np.int64)
        block, after = first // SAMPLE, -(-last // SAMPLE)
        begin = int(self.samples[block]) // 8
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + 8 * begin
        skipped = int(np.searchsorted(ones, int(self.samples[block])))
        ones = ones[skipped + first - block * SAMPLE :][: last - first]
        value = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bit = first * self.width
            bits = np.unpackbits(self.low[bit // 8 : -(-last * self.width // 8)], bitorder="little")
            bits = bits[bit % 8 :][: (last - first) * self.width].reshape(-1, self.width).astype(np.uint64)
            value |= (bits << np.arange(self.width, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return value.view(np.int64) + self.base


def write_shards(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, added_tokens: bool = False
) -> list[tuple[str, int, int]]:
    """Encode and write all documents; returns (path without ending, documents, ids) per shard, in order.

    ``added_tokens`` encodes the string of an added token as that token, as the library's ``encode`` does.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, added_tokens)
        width = "<u2" if encode.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        name, attempt = f"{folder}/shard-{partition_number():06d}", attempt_number()
        out, total, ends, keys, without_id = None, 0, [], [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                if out is None:
                    out = Replacing(name + ".ids", attempt)
                ids, heads = encode.encode(*buffer_of(part.column("text")))
                closed = np.insert(ids.astype(width), heads[1:], end_id)
                out.write(closed.tobytes())
                ends.append(total + heads[1:] + np.arange(1, len(heads)))
                total += len(closed)
                column = part.column("doc_id")
                without_id += column.null_count
                keys.append(column.drop_null().to_numpy())
        done = []
        if out is not None:
            out.close()
            ends, keys = np.concatenate(ends), np.concatenate(keys)
            index = Replacing(name + ".index", attempt)
            index.write(MAGIC + struct.pack("<QQ", int(width[-1]), without_id))
            index.write(EliasFano.of(ends).to_bytes() + EliasFano.of(keys).to_bytes())
            index.close()
            done = [(name, len(ends), total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "n_documents", "n_ids"],
        )

    manifest = ordered_texts(documents).mapInArrow(write, "path string, n_documents long, n_ids long")
    return sorted(tuple(r) for r in manifest.collect())


class Shard:
    """One shard, read by position."""

    def __init__(self, path: str):
        system, place = opened(path + ".index")
        with system.open_input_stream(place, compression=None) as stream:
            data = stream.read()
        if data[:8] != MAGIC:
            raise ValueError(f"{path}.index is no shard index")
        width, self.without_id = struct.unpack_from("<QQ", data, 8)
        self.kind = np.dtype(f"<u{width}")
        self.ends, at = EliasFano.from_bytes(data, 24)
        self.keys, _ = EliasFano.from_bytes(data, at)
        system, place = opened(path + ".ids")
        self.ids = system.open_input_file(place)

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Begin of document ``first`` and the ends of documents ``first`` to ``last - 1``."""
        begin = self.ends.select(first - 1, first) if first else np.zeros(1, np.int64)
        return np.concatenate([begin, self.ends.select(first, last)])

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        missing = max(0, min(last, self.without_id) - first)
        return [None] * missing + self.keys.select(first + missing - self.without_id, last - self.without_id).tolist()

    def read(self, begin: int, end: int) -> np.ndarray:
        self.ids.seek(begin * self.kind.itemsize)
        data = np.frombuffer(self.ids.read((end - begin) * self.kind.itemsize), self.kind)
        if len(data) != end - begin:
            raise ValueError("a shard is shorter than its index says")
        return data

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """Number of the first document and the bounds of runs of documents, about READ_IDS ids each."""
        for at in range(0, self.ends.n, 4096):
            bounds = self.bounds(at, min(at + 4096, self.ends.n))
            first = 0
            while first < len(bounds) - 1:
                last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + READ_IDS, "right")) - 1)
                yield at + first, bounds[first : last + 1]
                first = last


def read_shards(spark, shards: list[tuple[str, int, int]], with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``with_ids`` adds the ids themselves as an array.
    """
    starts = np.concatenate([[0], np.cumsum([s[2] for s in shards])]).astype(int).tolist()
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                shard = Shard(path)
                for first, bounds in shard.blocks():
                    ids = shard.read(int(bounds[0]), int(bounds[-1])).astype("<u4")
                    cuts = (bounds - bounds[0]).tolist()
                    view = memoryview(ids).cast("B")
                    columns = [
                        pa.array(shard.doc_ids(first, first + len(cuts) - 1), pa.int64()),
                        pa.array(bounds[:-1] + base),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    ]
                    if with_ids:
                        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int64)))
                        columns.append(lists)
                    yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    entries = [(path, start) for (path, _, _), start in zip(shards, starts)]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return one_task_each(spark, entries, "path string, base long").mapInArrow(read, schema)


__all__ = ["EliasFano", "Shard", "read_shards", "vocabulary_path", "write_shards"]

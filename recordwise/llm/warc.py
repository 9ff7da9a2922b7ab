"""WARC archives: one gzip member per record, written and read record by record.

Writing keeps one copy of equal payloads: of records with the same payload of at least
``revisit_bytes`` bytes the one with the largest id is a ``response``, the others are
``revisit`` records that name it. Smaller payloads are always stored. Reading is sequential:
members are inflated piece by piece, a record's block is framed by its Content-Length, and both
digests are verified while the bytes pass, so memory is one record at most.

Defined cases: a NULL payload is an empty one; a NULL url leaves the target header out; a NULL
id is never the largest (equal payloads that have only NULL ids are all stored); rows that repeat
id and payload are each stored, for none of them is larger; extra columns are ignored; an empty
table gives no record. A wrong digest, a cut record or trailing rubbish raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.files import Replacing, attempt_number, one_task_each, opened, partition_number
from recordwise.operators.sizing import broadcast_if_small

FILE_BYTES = 1 << 30
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def with_keepers(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, refers_to``: the id of the stored copy, NULL for records that are stored."""
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    repeated = (
        page.where(F.col("size") >= revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
        .where("copies > 1 and keeper is not null")
        .select("digest", "size", "keeper")
    )
    joined = page.join(broadcast_if_small(repeated), ["digest", "size"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def record_id(page_id: int | None, url: str | None) -> str:
    name = f"page:{page_id}" if page_id is not None else "url:" + hashlib.sha1((url or "").encode()).hexdigest()
    return f"<urn:{name}>"


def digest_header(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int) -> bytes:
    """One complete record as one gzip member."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no dates; a fixed one keeps the bytes repeatable
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {digest_header(payload)}",
        f"WARC-Block-Digest: {digest_header(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=-._~"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, None)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_warc(records: DataFrame, folder: str, level: int = 4, file_bytes: int = FILE_BYTES) -> list[tuple[str, int]]:
    """Write the rows of ``with_keepers`` as archives of up to about ``file_bytes``; returns file and record count."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = partition_number(), attempt_number()
        out, name, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                        done.append((name, count))
                    name = f"{folder}/part-{part:06d}-{len(done):04d}.warc.gz"
                    out, size, count = Replacing(name, attempt), 0, 0
                data = record_bytes(page_id, url, payload, refers_to, level)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            done.append((name, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "n"]
        )

    manifest = records.select("page_id", "url", "payload", "refers_to").mapInArrow(write, "path string, n long")
    return sorted((r["path"], r["n"]) for r in manifest.collect())


class Members:
    """The inflated bytes of a gzip file, member by member, from pieces of bounded size."""

    def __init__(self, stream):
        self.stream, self.rest = stream, b""

    def begin(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self.rest:
            self.rest = self.stream.read(CHUNK)
        self.inflater = zlib.decompressobj(31)
        self.ready = b""
        return bool(self.rest)

    def more(self) -> bytes:
        """The next inflated piece of this member, empty at its end."""
        while not self.inflater.eof:
            given = self.inflater.unconsumed_tail or self.rest or self.stream.read(CHUNK)
            if not given:
                raise ValueError("the archive ends inside a record")
            piece = self.inflater.decompress(given, CHUNK)
            self.rest = self.inflater.unused_data if self.inflater.eof else b""
            if piece:
                return piece
        return b""

    def until(self, mark: bytes) -> bytes:
        while mark not in self.ready:
            piece = self.more()
            if not piece:
                raise ValueError("a record ends inside its header")
            self.ready += piece
        found, _, self.ready = self.ready.partition(mark)
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            piece = self.ready or self.more()
            if not piece:
                raise ValueError("a record is shorter than its Content-Length")
            taken, self.ready = piece[:n], piece[n:]
            n -= len(taken)
            yield taken

    def end(self) -> None:
        """Only the closing blank lines may be left."""
        left = self.ready
        while piece := self.more():
            left += piece
            if len(left) > 4:
                break
        if left != b"\r\n\r\n":
            raise ValueError("a record does not end after its Content-Length")


def header_fields(lines: list[str]) -> dict[str, str]:
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def records_of(stream, payload: bool = True) -> Iterator[dict]:
    """Records of one archive in order, digests verified."""
    members = Members(stream)
    while members.begin():
        version, *lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = header_fields(lines)
        block_hash, body_hash = hashlib.sha1(), hashlib.sha1()
        http, body, body_size, in_body = b"", [], 0, False
        for piece in members.exactly(int(head["content-length"])):
            block_hash.update(piece)
            if not in_body:
                http += piece
                if b"\r\n\r\n" not in http:
                    continue
                http, _, piece = http.partition(b"\r\n\r\n")
                in_body = True
            body_hash.update(piece)
            body_size += len(piece)
            if payload:
                body.append(piece)
        members.end()
        stored = head["warc-type"] == "response"
        full_size = int(header_fields(http.decode().split("\r\n")[1:])["content-length"])
        claimed = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
        if base64.b32decode(head["warc-block-digest"].removeprefix("sha1:")) != block_hash.digest():
            raise ValueError(f"wrong block digest in {head['warc-record-id']}")
        if stored and (claimed != body_hash.digest() or full_size != body_size):
            raise ValueError(f"wrong payload digest in {head['warc-record-id']}")
        yield {
            "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
            "url": head.get("warc-target-uri"),
            "record_type": head["warc-type"],
            "payload_bytes": full_size,
            "payload_digest": claimed.hex(),
            "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
            "payload": b"".join(body) if payload and stored else None,
        }


def read_warc(spark, files: list[tuple[str, int]], payload: bool = True) -> DataFrame:
    """Records of the given archives (path, expected count), each file read once from start to end."""
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(columns, kinds)], columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = opened(path)
                rows, held, seen = [], 0, 0
                with system.open_input_stream(place, compression=None) as stream:
                    for record in records_of(stream, payload):
                        rows.append(record)
                        seen += 1
                        held += len(record["payload"] or b"") + 200
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if seen != expected:
                    raise ValueError(f"{path} has {seen} records, {expected} were written")
                yield batch_of(rows)

    return one_task_each(spark, files, "path string, n long").mapInArrow(read, RECORDS)

"""WARC archives as a table of record chunks.

A record is a run of rows (archive, record, chunk): its bytes, cut at CHUNK_BYTES, with the SHA-256 of the payload up
to there. Writer and reader go from chunk to chunk, so neither ever builds a whole record, and Spark commits the
archive as it commits any table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.lake import scratch_folder

CHUNK_BYTES = 1 << 16
BATCH_BYTES = 4 << 20
#: Shorter payloads are never written as revisits.
LEAST_SHARED = 100

CHUNKS = "archive int, record long, chunk int, last boolean, payload_sha256 string, data binary"
ARROW_CHUNKS = pa.schema(
    [
        ("archive", pa.int32()), ("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()),
        ("payload_sha256", pa.string()), ("data", pa.binary()),
    ]
)
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def record_types(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """`pages` (page_id, url, payload) with size, digest and, for revisits, `refers_to`.

    Among pages of one payload of at least `least` bytes, the smallest page_id keeps it. Only digests that occur
    more than once are joined back; their first pages are found by a grouped minimum, which combines before the
    shuffle, and the join's long side is one that adaptive execution can split.
    """
    spark = pages.sparkSession
    known = pages.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    folder = scratch_folder(spark, "warc-first")
    firsts = known.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts.where("n > 1").select("digest", "first").write.parquet(folder)
    repeated = spark.read.schema("digest string, first long").parquet(folder)
    return known.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "size", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def head(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """A record's header and, for a response, its HTTP header. Line ends within the address are escaped."""
    inner = HTTP.format(size) if refers_to is None else ""
    length = len(inner) + (size if refers_to is None else 0)
    address = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Payload-Length: {size}",
    ]
    if refers_to is not None:
        fields += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}", "", ""]
    return ("\r\n".join(fields) + inner).encode()


def chunks_of(start: bytes, payload: memoryview, end: bytes, most: int) -> Iterator[tuple[bool, str, bytes]]:
    """(is last, digest of the payload so far, bytes) for each chunk of start + payload + end."""
    digest, total = hashlib.sha256(), len(start) + len(payload) + len(end)
    for at in range(0, total, most):
        to = min(at + most, total)
        own = payload[max(0, at - len(start)) : max(0, to - len(start))]
        digest.update(own)
        tail_from, tail_to = (max(0, x - len(start) - len(payload)) for x in (at, to))
        yield to == total, digest.hexdigest(), b"".join((start[at:to], own, end[tail_from:tail_to]))


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", chunk_bytes: int = CHUNK_BYTES
) -> None:
    """A WARC record per row of `pages`; its payload is the html in UTF-8, a null one empty.

    Repeated rows give repeated records; rows that repeat the first page_id of a payload are responses like it. A null
    page_id is written as an empty id; it is a revisit if a numbered page has its payload. An empty table gives
    an empty archive.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "utf-8").alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, record = TaskContext.get().partitionId(), 0
        held, filled = [], 0
        for batch in batches:
            payloads = batch.column("payload")
            for k, row in enumerate(batch.drop_columns(["payload"]).to_pylist()):
                whole = memoryview(payloads[k].as_buffer())
                start = head(row["page_id"], row["url"], row["size"], row["digest"], row["refers_to"])
                body = whole if row["refers_to"] is None else whole[:0]
                for n, (last, digest, data) in enumerate(chunks_of(start, body, END, chunk_bytes)):
                    held.append((archive, record, n, last, digest, data))
                    filled += len(data)
                    if filled > BATCH_BYTES:
                        yield _batch(held)
                        held, filled = [], 0
                record += 1
        if held:
            yield _batch(held)

    record_types(rows).mapInArrow(run, CHUNKS).write.option("compression", "zstd").parquet(path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW_CHUNKS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=ARROW_CHUNKS)


class Record:
    """A record as its chunks arrive: the header is held until it is whole, the payload only hashed and counted."""

    def __init__(self):
        self.start, self.fields, self.left = b"", None, 0
        self.inner, self.digest, self.size = b"", hashlib.sha256(), 0

    def add(self, data: bytes) -> None:
        if self.fields is None:
            self.start += data
            at = self.start.find(b"\r\n\r\n")
            if at < 0:
                return
            lines = self.start[:at].decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"not a WARC record: {lines[0]}")
            self.fields = dict(line.split(": ", 1) for line in lines[1:])
            self.left = int(self.fields["Content-Length"])
            data, self.start = self.start[at + 4 :], b""
        block, self.left = data[: self.left], max(0, self.left - len(data))
        if self.inner is not None and self.fields["WARC-Type"] == "response":
            self.inner += block
            at = self.inner.find(b"\r\n\r\n")
            if at < 0:
                return
            block, self.inner = self.inner[at + 4 :], None
        self.digest.update(block)
        self.size += len(block)

    def row(self) -> tuple:
        said = self.fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = self.fields["WARC-Type"]
        if self.left or kind == "response" and self.digest.hexdigest() != said:
            raise ValueError(f"record {self.fields['WARC-Record-ID']} is damaged")
        page, refers = (self.fields.get(k, "")[len("<urn:page:") : -1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
        size = self.size if kind == "response" else int(self.fields["Payload-Length"])
        return int(page) if page else None, self.fields["WARC-Target-URI"], size, said, kind, int(refers) if refers else None


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) per record of an archive.

    The digest of each response is computed anew and must agree with its header. A revisit has no payload: its
    header tells size and digest. Chunks meet by record, so the largest record sets no task's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, expected, rows = Record(), 0, []
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        types = [pa.string() if f.endswith("string") else pa.int64() for f in RECORDS.split(", ")]
        for batch in batches:
            for chunk, last, data in zip(*(batch.column(c) for c in ("chunk", "last", "data")), strict=True):
                if chunk.as_py() != expected:
                    raise ValueError("a chunk is missing")
                record.add(data.as_py())
                expected += 1
                if last.as_py():
                    rows.append(record.row())
                    record, expected = Record(), 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows = []
        if expected:
            raise ValueError("the last record has no end")

    stored = spark.read.schema(CHUNKS).parquet(path).select("archive", "record", "chunk", "last", "data")
    ordered = stored.repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return ordered.mapInArrow(run, RECORDS)


def through_archive(pages: DataFrame) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back."""
    path = scratch_folder(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)

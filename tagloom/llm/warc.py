"""WARC archives: written by tasks, read back in byte ranges.

**Writing.** Every task writes one file of gzip members, a record each, below a folder that all executors share, and
reports its name. Only reported files are read, so what a lost or repeated task leaves behind does no harm. Records whose
payload equals that of another page refer to it and carry headers alone. Which page that is comes from a grouping by
digest that combines before it shuffles; the html moves once, keyed by page.

**Reading.** A task gets a file and a byte range. It looks for gzip magic from the start of its range, takes a place as a
member if its header decodes and it starts with a WARC version line, and owns the records that start inside its range,
also where they end beyond it. Each member is decompressed as a stream to its checksum; lengths and digests are checked.

Defined cases: null html is an empty payload; empty and short payloads are responses; a row without page id is a
response; rows that repeat a page id are records of their own, alike if their payload is; a null url is written as
``about:blank``; an empty table makes no file and no rows. Extra columns are not written.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.shared import open_store, work_folder

MAGIC = b"\x1f\x8b\x08"
REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
CHUNK = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_EMPTY_DIGEST = hashlib.sha1(b"").hexdigest()


def mark_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload (binary), digest, refers_to`` of all pages.

    Of equal payloads of at least ``least`` bytes the one with the largest page id is kept, the others refer to it.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    brief = rows.select("page_id", F.unhex("digest").alias("key"), F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    groups = brief.groupBy("key", "size").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    revisits = (
        brief.join(groups, ["key", "size"]).where(F.col("page_id") < F.col("keeper"))
        .select(F.col("page_id").alias("of"), F.col("key").alias("of_key"), F.col("keeper").alias("refers_to")).distinct()
    )
    return rows.join(revisits, (F.col("page_id") == F.col("of")) & (F.unhex("digest") == F.col("of_key")), "left").select(
        "page_id", "url", "payload", "digest", "refers_to"
    )


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member. A revisit keeps the HTTP headers, among them the length of the payload, and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", "WARC-Date: 2020-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe='/:?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    squeeze = zlib.compressobj(5, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def write_archives(records: DataFrame, folder: str) -> list[tuple[str, int]]:
    """Write what :func:`mark_revisits` gives; returns path and size of each file, one for each task that had rows."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = path = out = None
        size = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, path = open_store(name)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                member = record_bytes(*(c[i].as_py() for c in columns))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "size": [size]}, pa.schema({"path": pa.string(), "size": pa.int64()}))

    return [(r.path, r.size) for r in records.mapInArrow(write, "path string, size long").collect()]


class MemberScan:
    """The records of a byte range of one file: those that start in ``[start, end)``."""

    def __init__(self, source, size: int, start: int, end: int) -> None:
        self.source, self.size, self.start, self.end = source, size, start, end
        self.base, self.held = start, b""

    def _have(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, fewer at the end of the file."""
        if not (self.base <= at and at + n <= self.base + len(self.held)):
            self.source.seek(at)
            self.base, self.held = at, self.source.read(max(n, min(CHUNK, self.size - at)))
        return self.held[at - self.base : at - self.base + n]

    def _looks_right(self, at: int) -> bool:
        head = self._have(at, 1024)
        if len(head) < 18 or head[3] & 0xE0:
            return False
        try:
            return zlib.decompressobj(31).decompress(head, 64).startswith(b"WARC/1.")
        except zlib.error:
            return False

    def __iter__(self) -> Iterator[bytes]:
        at = self.start
        while at < self.end:
            ahead = self._have(at, min(CHUNK, self.end - at + len(MAGIC) - 1))
            found = ahead.find(MAGIC)
            if found < 0:
                at += max(1, len(ahead) - len(MAGIC) + 1)
                continue
            at += found
            if at >= self.end:
                return
            record = None
            if self._looks_right(at):
                record, past = self._member(at)
            if record is None:
                at += 1
            else:
                yield record
                at = past

    def _member(self, at: int) -> tuple[bytes | None, int]:
        unpack, parts = zlib.decompressobj(31), []
        try:
            while not unpack.eof:
                chunk = self._have(at, min(CHUNK, max(0, self.base + len(self.held) - at) or CHUNK))
                if not chunk:
                    return None, at
                parts.append(unpack.decompress(chunk))
                at += len(chunk) - len(unpack.unused_data)
        except zlib.error:
            return None, at
        return b"".join(parts), at


def parse_record(record: bytes) -> tuple:
    """The columns of RECORD; raises ValueError where length or digest is wrong."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:-4]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("a record's length differs from its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda text: None if text in (None, "<urn:page:none>") else int(text.removeprefix("<urn:page:").removesuffix(">"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its header")
    return number(fields["WARC-Record-ID"]), length, digest, kind, number(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"]


def read_archives(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the files, read in ranges of ``split_bytes``, one task for some ranges each."""
    table = spark.createDataFrame(files, "path string, size long")
    ranges = table.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    total = sum(-(-size // split_bytes) for _, size in files)
    ranges = ranges.repartition(max(1, min(total, 100_000)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string()}
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "start"))):
                store, inner = open_store(path)
                with store.open_input_file(inner) as source:
                    rows = [parse_record(r) for r in MemberScan(source, size, start, min(size, start + split_bytes))]
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    return ranges.mapInArrow(read, RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives and read every record back."""
    spark = pages.sparkSession
    files = write_archives(mark_revisits(pages), work_folder(spark, "warc"))
    return read_archives(spark, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

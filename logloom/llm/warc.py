"""WARC archives: one gzip member per record, read back sequentially.

Writing: every page is a record; of pages with equal payloads the one with the
largest id carries it as a response, the others are revisits that refer to it.
A task writes its records into archives of about ``ARCHIVE_BYTES`` below the
shared folder and returns their names. Only named archives count, so what a
lost or repeated task attempt leaves behind is never read.

Reading: each archive is a stream. Compressed bytes are inflated piece by piece,
one member after the other; a record is framed by its Content-Length, and its
block and payload are checked against their digests. Memory is bounded by the
largest record, not by the archive.

Results: a null html is an empty payload. Pages of null id are written with an
empty id and come after all others in the choice of the response; repeated rows
are records each, and rows that repeat the chosen id are all responses. Extra
columns stay aside.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import staged, work_dir

ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
#: Tasks that read archives; each reads one after the other.
READ_TASKS = 20_000
LEVEL = 6
MIN_REVISIT_BYTES = 0

RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def marked(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, url, payload, response_id, first): the page that answers for the payload, and whether it is this one.

    Payloads meet by their digest: a maximum by partial aggregation, then a
    join that the planner can split where one payload is hot.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    largest = rows.groupBy("sha1").agg(F.max("page_id").alias("response_id"))
    small = F.octet_length("payload") < min_bytes
    return rows.join(largest, "sha1").select("page_id", "url", "payload", "response_id",
                                             (small | F.col("page_id").eqNullSafe(F.col("response_id"))).alias("first"))


def record(page_id: int | None, url: str, payload: bytes, response_id: int | None, first: bool) -> bytes:
    """A WARC 1.1 record; a revisit keeps the full payload's length and digest in its header."""
    name = "" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (b"Content-Length: %d\r\n\r\n" % len(payload)) + (payload if first else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"), "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}", f"X-Payload-Length: {len(payload)}"]
    if not first:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{'' if response_id is None else response_id}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def archived(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages' records; returns the archives (path, records). The rows must be computed once: keep them."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        out, path, n, size = None, "", 0, 0

        def close():
            out.close()
            return pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    path, n, size = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(opened(path)[1], compression=None)
                page_id, url, payload, response_id, first = (c[i].as_py() for c in batch.columns)
                data = member(record(page_id, url, payload, response_id, first))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return marked(pages).mapInArrow(write, "path string, records long")


def members(stream, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The gzip members of a stream, each inflated piece by piece."""
    inflate, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(read_bytes):
        parts.append(inflate.decompress(data))
        rest = b""
        if inflate.eof:
            yield b"".join(parts)
            rest, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends inside a member")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header and block of a record, framed by Content-Length and checked against its digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    if fields["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
        raise ValueError("the block's digest is wrong")
    return fields, block


def row_of(data: bytes) -> tuple:
    fields, block = parsed(data)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest_of(payload) != digest or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError("the payload's digest is wrong")
    number = [fields.get(name, "").removeprefix("<urn:page:").removesuffix(">") for name in ("WARC-Record-ID", "WARC-Refers-To")]
    page, refers = (int(x) if x else None for x in number)
    return page, int(fields["X-Payload-Length"]), digest, kind, refers


def records(archives: DataFrame) -> DataFrame:
    """One row per record of the archives (path): ids, payload length and digest, type, what it refers to."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

        def table_of(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, base = opened(path)
                rows = []
                with store.open_input_stream(base, compression=None) as stream:
                    for data in members(stream):
                        rows.append(row_of(data))
                        if len(rows) == 4096:
                            yield table_of(rows)
                            rows = []
                if rows:
                    yield table_of(rows)

    # As many tasks as archives, up to a bound; a number that is given is not coalesced again.
    spread = archives.select("path").repartition(min(max(archives.count(), 1), READ_TASKS))
    return spread.mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives below a shared folder and read the records back."""
    folder = folder or work_dir(pages.sparkSession, "warc")
    # The list of archives is kept as a table: reading it again never writes again.
    return records(staged(archived(pages, folder), "warc-list"))

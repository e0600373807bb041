"""WARC archives: written by tasks, read back as a table of record chunks.

Every row becomes one record in a gzip member of its own. Of the rows with equal
payloads one is a ``response`` record with the payload; the others are
``revisit`` records that refer to it. Reading streams an archive: a record is
passed on as rows of its identifier, a chunk number and at most so many bytes,
each with the digest of the payload up to there, so that no task ever holds a
whole record or a whole archive.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.scratch import scratch_dir, settled

CHUNK_BYTES = 1 << 20
#: An archive is closed when its compressed records exceed this.
ARCHIVE_BYTES = 1 << 28
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ, _BATCH_BYTES = 1 << 18, 8 << 20
_PRINTABLE = "".join(chr(c) for c in range(0x21, 0x7F))
_CHUNKS = (
    "archive string, record long, record_id string, record_type string, refers_to string, "
    "chunk int, start long, payload binary, digest string, last boolean, "
    "stated_digest string, stated_bytes long"
)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(kind: str, page_id, url, payload: memoryview, refers_to) -> Iterator[bytes]:
    """The parts of one record, the payload in slices."""
    digest = _base32(hashlib.sha1(payload).digest())
    size = len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = size if kind == "response" else 0
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe=_PRINTABLE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + body}",
    ]
    if kind == "revisit":
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Payload-Length: {size}",
        ]
    yield "\r\n".join(head).encode() + b"\r\n\r\n" + http
    for start in range(0, body, CHUNK_BYTES):
        yield payload[start : start + CHUNK_BYTES]
    yield b"\r\n\r\n"


def _opened(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder and the path there.

    Spark's readers know stores by some names that Arrow has others for, and one
    store that executors see as a folder.
    """
    scheme, colon, rest = folder.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        folder = f"s3:{rest}"
    elif colon and scheme == "dbfs":
        folder = f"/dbfs/{rest.lstrip('/')}"
    return arrow_fs.FileSystem.from_uri(folder)


def _write(folder: str):
    """Archives of a task's rows; gives name, records and bytes of each."""

    def run(batches):
        files, base = _opened(folder)
        files.create_dir(base, recursive=True)
        task, made = TaskContext.get().partitionId(), []
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("page_id", "url", "payload", "record_type", "refers_to")))
            for page_id, url, payload, kind, refers_to in rows:
                if out is None:
                    # A task that runs again writes a file of another name, and
                    # only files in the list that Spark has stored are read.
                    name = f"part-{task:05d}-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    records, size = 0, 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = memoryview(payload.as_buffer())
                for part in _record(kind.as_py(), page_id.as_py(), url.as_py(), data, refers_to.as_py()):
                    packed = packer.compress(part)
                    out.write(packed)
                    size += len(packed)
                packed = packer.flush()
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    made.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            made.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["archive", "records", "bytes"],
        )

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record per row into ``folder``; returns the stored list of archives.

    The payload is ``html`` in UTF-8, empty where it is null. Of the rows with
    equal payloads of at least ``least`` bytes that of the largest ``page_id``
    is the response. Rows that repeat its id are responses too, rows without id
    revisit it unless no row of the payload has an id.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    key = [F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")]
    keyed = rows.select("*", *key)
    shared = (
        rows.select("page_id", *key)
        .filter(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    shared = settled(shared, "shared-payloads")
    joined = keyed.join(shared, ["digest", "size"], "left")
    again = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    typed = joined.select(
        "page_id", "url", "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("refers_to")).alias("refers_to"),
    )
    archives = typed.mapInArrow(_write(folder), "archive string, records long, bytes long")
    return settled(archives, "archives")


class _Stream:
    """Bytes of the gzip members of an archive, a little at a time."""

    def __init__(self, source):
        self._source, self._kept = source, bytearray()
        self._member = zlib.decompressobj(31)

    def _more(self) -> bool:
        rest = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
        rest = rest or self._source.read(_READ)
        if not rest:
            return False
        if self._member.eof:
            self._member = zlib.decompressobj(31)
        # No more at a time than this, however well a record is compressed.
        self._kept += self._member.decompress(rest, _READ)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before ``mark``, which is taken too; none at the end."""
        seen = 0
        while (at := self._kept.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self._kept)
            if not self._more():
                return None
        found = bytes(self._kept[:at])
        del self._kept[: at + len(mark)]
        return found

    def upto(self, n: int) -> bytes:
        """The next ``n`` bytes."""
        while len(self._kept) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        found = bytes(self._kept[:n])
        del self._kept[:n]
        return found


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def record_chunks(source, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Rows of the chunk table, without the archive's name, from an open archive."""
    stream, number = _Stream(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        left = int(fields["content-length"])
        if "application/http" in fields.get("content-type", ""):
            http = stream.until(b"\r\n\r\n")
            left -= len(http) + 4
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size = fields.get("x-payload-length")
        fixed = (
            number, fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"),
        )
        digest, chunk, start = hashlib.sha1(), 0, 0
        while True:
            part = stream.upto(min(chunk_bytes, left))
            left -= len(part)
            digest.update(part)
            so_far = _base32(digest.copy().digest())
            yield (*fixed, chunk, start, part, so_far, not left, stated, int(size) if size else None)
            chunk, start = chunk + 1, start + len(part)
            if not left:
                break
        stream.upto(4)
        number += 1


def _read(folder: str, chunk_bytes: int):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(),
             pa.binary(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in _CHUNKS.split(", ")]

    def batch(rows):
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches):
        files, base = _opened(folder)
        for listed in batches:
            for name in listed.column("archive").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for row in record_chunks(source, chunk_bytes):
                        rows.append((name, *row))
                        size += len(row[6]) + 200
                        if size >= _BATCH_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_chunks(archives: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the listed archives, which lie in ``folder``.

    ``archive`` and ``record`` number a record; ``start`` is where a chunk's
    ``payload`` begins in the record's; ``digest`` is the base32 SHA-1 of the
    payload up to the chunk's end and ``last`` marks the chunk at which it is
    that of the whole. ``stated_digest`` is that of the header, ``stated_bytes``
    the length of the payload a revisit leaves out. A record without payload has
    one empty chunk.
    """
    spread = archives.select("archive").repartition(F.col("archive"))
    return spread.mapInArrow(_read(folder, chunk_bytes), _CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its chunks: length, digest, type and reference."""
    own = ["archive", "record"]
    same = ["record_id", "record_type", "refers_to", "stated_digest", "stated_bytes"]
    return chunks.groupBy(own).agg(
        *[F.first(c).alias(c) for c in same],
        F.sum(F.octet_length("payload")).alias("bytes"),
        F.max_by("digest", "chunk").alias("digest"),
    )


def _page_id(record: str):
    return F.regexp_extract(record, "^<urn:page:(-?[0-9]*)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Every row's record as read back: identifier, payload, type and reference.

    A revisit has the length and digest stated in its header, a response those
    counted while its chunks were read.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    found = records(read_chunks(write_archives(pages, folder, least), folder))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        _page_id("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        _page_id("refers_to").alias("refers_to"),
    )

"""WARC archives: a writer with revisit records, and a splittable reader.

Writing tasks make archives of one gzip member per record in the shared folder. A file
is named by its task attempt and counts only if the row that names it was committed,
so a lost or repeated attempt leaves a file nobody reads. Reading tasks take byte
ranges: a task looks for the gzip magic from the start of its range, decodes each
candidate's first bytes to see a record header, and owns the records that begin inside
its range, reading on beyond the end to finish the last.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import written
from siftline.session import shared_dir

MIN_REVISIT_BYTES = 100
SPLIT_BYTES = 32 << 20
FILE_BYTES = 512 << 20
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
GZIP = zlib.MAX_WBITS | 16
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture

_ID = re.compile(r"<urn:siftline:page:(-?\d+)>")


def _page_urn(page_id: int | None) -> str:
    return f"<urn:siftline:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; with ``refers_to`` a revisit, which keeps the HTTP header and not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {_page_urn(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def parse(data: bytes) -> dict:
    """The fields of a record from its decompressed bytes; a revisit has no payload of its own.

    Header names count in any case, and lines that are no headers are passed over. What a record does not say is null;
    without a length its block goes to the end, without the two line ends that close a record.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    fields = {name.strip().lower(): value.strip() for name, colon, value in lines if colon}
    stated = fields.get("content-length", "")
    block = rest[: int(stated)] if stated.isdigit() else rest.removesuffix(b"\r\n\r\n")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    page, refers = (_ID.match(fields.get(name, "")) for name in ("warc-record-id", "warc-refers-to"))
    revisit = fields.get("warc-type") == "revisit"
    digest = fields.get("warc-payload-digest")
    return {
        "page_id": int(page[1]) if page else None,
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "refers_to": int(refers[1]) if refers else None,
        "payload": None if revisit else payload,
        "payload_bytes": (int(length[1]) if length else None) if revisit else len(payload),
        "payload_digest": (digest and digest.removeprefix("sha256:")) if revisit else hashlib.sha256(payload).hexdigest(),
    }


class _Range:
    """Bytes of a file by position, read in large pieces."""

    def __init__(self, file, size: int):
        self._file, self.size, self._at, self._data = file, size, 0, b""

    def take(self, at: int, size: int) -> bytes:
        size = max(0, min(size, self.size - at))
        if not self._at <= at <= at + size <= self._at + len(self._data):
            self._at, self._data = at, self._file.read_at(min(max(size, READ_BYTES), self.size - at), at)
        return self._data[at - self._at : at - self._at + size]


def _member(data: _Range, at: int) -> tuple[bytes, int] | None:
    """The decompressed record of the gzip member at ``at`` and where it ends; None if there is no such member.

    A member that begins as a record and has no end in the file is an error: the archive was cut short.
    """
    unpack, parts, begun = zlib.decompressobj(GZIP), [], b""
    while not unpack.eof:
        piece = data.take(at, 1 << 16)
        if not piece:
            if begun == VERSION:
                raise ValueError("the archive ends inside a record")
            return None
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error:
            return None
        at += len(piece)
        if len(begun) < len(VERSION):
            begun += parts[-1][: len(VERSION) - len(begun)]
            if not VERSION.startswith(begun):
                return None
    if begun != VERSION:
        return None
    end = at - len(unpack.unused_data)
    # Bytes inside a payload can look like a member; a real one is followed by another or by the end of the file.
    if end < data.size and data.take(end, len(MAGIC)) != MAGIC:
        return None
    return b"".join(parts), end


def records_in(data: _Range, start: int, end: int):
    """The decompressed records that begin in [start, end)."""
    at = start
    while at < end:
        window = data.take(at, min(READ_BYTES, end - at) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        if found < 0:
            at += min(READ_BYTES, end - at)
            continue
        at += found
        member = _member(data, at)
        if member is None:
            at += 1
            continue
        yield member[0]
        at = member[1]


def _open(path: str):
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which pages repeat the payload of a page with a smaller id.

    Among equal payloads of at least 100 bytes the smallest id has the response. Rows that
    share the smallest id, and rows without an id, are responses too: nothing smaller exists
    that they could refer to.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # Only digests and ids are grouped; copies are counted before the shuffle.
    short = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("size"))
    groups = short.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    repeated = groups.where("first < last").select("digest", "first")
    refers_to = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    return rows.join(repeated, "digest", "left").select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


def write(pages: DataFrame) -> DataFrame:
    """Write a record per page; returns (path, bytes, records), one row per finished archive."""
    folder = shared_dir(pages.sparkSession, "warc")
    folder = folder if "://" in folder else f"file://{folder}"

    def run(batches):
        context = TaskContext.get()
        system, inner = _open(folder)
        system.create_dir(inner, recursive=True)
        file, name, size, records, number = None, "", 0, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.gz"
                    file = system.open_output_stream(f"{inner}/{name}", compression=None)  # members are compressed one by one
                    size, records, number = 0, 0, number + 1
                member = record(*row)
                file.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    file.close()
                    file = None
                    yield _named(folder, name, size, records)
        if file is not None:
            file.close()
            yield _named(folder, name, size, records)

    archives = with_revisits(pages).mapInArrow(run, "path string, bytes long, records long")
    return written(archives, "archives")


def _named(folder: str, name: str, size: int, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [records]})


_FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
    "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
}
_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
BATCH_BYTES = 8 << 20


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives (path, bytes), each from the task whose byte range it begins in.

    Payload length and digest are those of the whole payload, for revisits too. No archives
    give no rows. An archive that ends inside a record is an error; ``short_reads`` tells of records that are not found.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = archives.select("path", "bytes", starts.alias("start"))
    number = max(1, ranges.count())

    def run(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = _open(path)
                rows, held = [], 0
                with system.open_input_file(inner) as file:
                    for data in records_in(_Range(file, size), start, min(start + split_bytes, size)):
                        rows.append(parse(data))
                        held += len(data)
                        if held >= BATCH_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    # Rows are dealt in turn, so each task gets a range or few.
    return ranges.repartition(min(number, 20_000)).mapInArrow(run, _SCHEMA)


def short_reads(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, records, found) of the archives (path, bytes, records) in which not so many records are found as were written.

    Reads the archives once more, and hands on counts only.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = archives.select("path", "bytes", starts.alias("start"))

    def run(batches):
        for batch in batches:
            paths, found = [], []
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = _open(path)
                with system.open_input_file(inner) as file:
                    paths.append(path)
                    found.append(sum(1 for _ in records_in(_Range(file, size), start, min(start + split_bytes, size))))
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "found": pa.array(found, pa.int64())})

    counted = ranges.repartition(max(1, min(ranges.count(), 20_000))).mapInArrow(run, "path string, found long")
    counted = counted.groupBy("path").agg(F.sum("found").alias("found"))
    both = archives.select("path", "records").join(counted, "path", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.where("found <> records")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], t) for n, t in _FIELDS.items()})


ORACLE = f"""
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as size, sha256(payload) as digest from p),
f as (select *, case when size >= {MIN_REVISIT_BYTES} then min(page_id) over (partition by digest) end as first from d)
select page_id, size as payload_bytes, digest as payload_digest,
    case when page_id > first then 'revisit' else 'response' end as record_type,
    case when page_id > first then first end as refers_to
from f
"""

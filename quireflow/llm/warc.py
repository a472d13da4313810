"""WARC archives: one gzip member per record, written and read sequentially.

Writing: every page becomes a record.  Payloads are compared by length and SHA-1; of equal ones
(of at least ``min_bytes``), the largest page_id is the response and carries the payload, the others are revisit
records that name it.  Roles come from one aggregation by digest (map-side combined, so a
payload shared by a third of all pages is one small row per task) joined back on the digest; AQE
may split a skewed digest there.  Each task appends its records to archives of about
``ARCHIVE_BYTES`` and stores them as rows of a table in the shared folder, so any store that
Spark can write will do; a row's bytes are a ``.warc.gz`` file as they stand.

Reading: archives are such rows, or any ``.warc.gz`` files (``read_files``).  Each is inflated step by
step with zlib, and no more than a record's head and block are held at a time: the head ends at an
empty line, the block is exactly Content-Length bytes, two line ends follow, and whatever digests the
record names in a known way (SHA-1, base32 or hex) are verified.  A damaged record raises ``BadRecord``.
Records of all types are read, with their own type, whatever their ids; the payload of an HTTP block is
what follows its head, that of any other block the block itself, and where no payload digest is
named it is computed.

Defined results: null html is the empty payload; pages that repeat both id and payload are each a
response if that id is the largest of its payload; a null page_id is written as an empty id, read as null, and
counts as the smallest; a record whose id is not one of ours has a null page_id; a revisit without an HTTP
Content-Length has null payload_bytes; payloads of any length are one record; an empty table writes and
reads no record; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

ARCHIVE_BYTES = 8 << 20
#: Bytes of an archive given to zlib at a time.
STEP = 1 << 16
_DATE = b"2024-01-01T00:00:00Z"


class BadRecord(ValueError):
    """The archive breaks off or a record doesn't say what it holds."""


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, payload_digest: str | None = None, level: int = 6) -> bytes:
    """One gzip member with one record: a response, or a revisit of ``refers_to``'s payload."""
    payload_digest = payload_digest or digest(payload)
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE.decode()),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(head + block + b"\r\n\r\n") + gz.flush()


#: Most bytes of a record's head.
MOST_HEAD = 1 << 20


def records(archive: bytes, step: int = STEP) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields with lower-case names, block) of every gzip member, inflated and framed piece by piece."""
    view, at = memoryview(archive), 0
    while at < len(view):
        inflater, held, fields, length = zlib.decompressobj(31), bytearray(), None, 0
        while True:
            if fields is None and (end := held.find(b"\r\n\r\n")) >= 0:
                fields = _fields(bytes(held[:end]))
                length = _length(fields)
                del held[: end + 4]
            if fields is None and len(held) > MOST_HEAD or fields is not None and len(held) > length + 4:
                raise BadRecord("no WARC header" if fields is None else "the block isn't as long as Content-Length says")
            if inflater.eof:
                break
            # what the inflater still holds comes first; at most ``step`` bytes come out at a time
            rest = inflater.unconsumed_tail
            piece = rest or view[at : at + step]
            if not len(piece):
                raise BadRecord("the last gzip member breaks off")
            try:
                held += inflater.decompress(piece, step)
            except zlib.error as e:
                raise BadRecord(str(e)) from e
            at += 0 if rest else len(piece)
        at -= len(inflater.unused_data)
        if fields is None:
            raise BadRecord("no WARC header")
        if len(held) != length + 4 or held[length:] != b"\r\n\r\n":
            raise BadRecord("the block isn't as long as Content-Length says")
        block = bytes(held[:length])
        if not agrees(fields.get("warc-block-digest"), block):
            raise BadRecord("the block's digest differs")
        yield fields, block


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BadRecord("no WARC header")
    fields, name = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:  # a folded line
            fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord(f"header line without a colon: {line[:80]}")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not text.isdecimal():
        raise BadRecord("no Content-Length")
    return int(text)


def agrees(named: str | None, data: bytes) -> bool:
    """Whether a named digest is that of ``data``; true where none is named or in a way that isn't known."""
    kind, _, value = (named or "").partition(":")
    if kind.lower() != "sha1":
        return True
    return value.lower() == hashlib.sha1(data).hexdigest() if len(value) == 40 else value.upper() == digest(data)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if urn.startswith("<urn:page:") and number.lstrip("-").isdecimal() else None


def _bare(named: str) -> str:
    """A named digest without its kind; SHA-1 as upper-case base32."""
    kind, _, value = named.partition(":")
    if kind.lower() != "sha1":
        return named
    return base64.b32encode(bytes.fromhex(value)).decode() if len(value) == 40 else value.upper()


def parse(archive: bytes) -> Iterator[tuple[int | None, str, int | None, str, str, int | None, bytes | None]]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every record."""
    for fields, block in records(archive):
        kind, named = fields.get("warc-type", ""), fields.get("warc-payload-digest")
        payload, n = block, None
        if fields.get("content-type", "").lower().startswith("application/http"):
            http, gap, payload = block.partition(b"\r\n\r\n")
            if not gap and kind != "revisit":
                raise BadRecord("no HTTP header in the block")
            lengths = [line.split(b":", 1)[1].strip() for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
            n = int(lengths[0]) if lengths and lengths[0].isdigit() else None
        if kind == "revisit":
            yield _page(fields.get("warc-record-id", "")), fields.get("warc-target-uri", ""), n, _bare(named or ""), kind, _page(fields.get("warc-refers-to", "")), None
            continue
        if not agrees(named, payload):
            raise BadRecord("the payload's digest differs")
        yield _page(fields.get("warc-record-id", "")), fields.get("warc-target-uri", ""), len(payload), _bare(named) if named else digest(payload), kind, None, payload


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and, for those that revisit another page's payload, refers_to."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.unhex(F.sha1("payload"))).withColumn("n", F.octet_length("payload"))
    largest = rows.where(F.col("n") >= min_bytes).groupBy("same", "n").agg(F.max("page_id").alias("first"))
    met = rows.join(largest, ["same", "n"], "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("first"), F.col("page_id").isNull() & F.col("first").isNotNull()), F.col("first"))
    return met.select("page_id", "url", "payload", F.hex("same").alias("sha1"), refers.alias("refers_to"))


def write(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A written table of archives (archive: binary), each a series of gzip members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                page, url, payload, sha1, refers = (batch.column(i)[row].as_py() for i in range(5))
                held.append(record(page, url, payload, refers, base64.b32encode(bytes.fromhex(sha1)).decode()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    return written(with_roles(pages, min_bytes).mapInArrow(run, "archive binary"), "warc")


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of a table of archives (column ``archive``)."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for page, url, n, named, kind, refers, payload in parse(archive.as_py()):
                    rows.append((page, n, named, kind, refers) + ((url, payload) if with_payload else ()))
                    size += len(payload or b"") * with_payload
                    if len(rows) >= 5000 or size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + ", url string, payload binary" * with_payload
    return archives.select("archive").mapInArrow(run, schema)


def read_files(spark, path: str, with_payload: bool = False) -> DataFrame:
    """All records of the ``.warc.gz`` files under a path that Spark can read, a file per task at least."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path)
    return read(files.select(F.col("content").alias("archive")), with_payload)


def op7(spark, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "pages").select("page_id", "url", "html")))


#: The same by SQL over ``pages``; base32 is spelt from groups of twenty bits.
ORACLE = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h
  FROM pages),
f AS (SELECT h, n, max(page_id) AS first FROM p GROUP BY h, n),
r AS (
  SELECT p.page_id, p.n, p.h,
         CASE WHEN p.page_id < f.first OR (p.page_id IS NULL AND f.first IS NOT NULL) THEN f.first END AS refers_to
  FROM p JOIN f ON p.h = f.h AND p.n = f.n)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""

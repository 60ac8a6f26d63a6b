"""Legacy ARC archives: write, convert to WARC, write, read back.

ARC.  A file begins with a ``filedesc://`` version block whose first line names the
version; it fixes the fields of every record's header line: five in version 1, ten in
version 2.  The line's last field declares the record's length, and only the declared
length ends a record.  Header lines are split from the right, so an old URL with
blanks in it is read whole.

Conversion.  Each ARC record gives a WARC record: an identifier from file and offset,
the 14-digit date as a W3C date, ``response`` for ``HTTP/`` documents and ``resource``
for others, and SHA-1 digests of block and payload.  Records with equal payloads of
``min_bytes`` or more keep one response, the one with the largest page id (null ids
last, then the larger record id); the others become revisits of it, with the HTTP
header and no payload.

Files are written by Spark's text writer (one record a row, the format's own
separator between rows, gzip), so a lost task leaves nothing half written.  A task cuts
its records into files of about ``FILE_BYTES`` before compression (a file holds one
record at least), so a file is a row of bounded size when it is read back, through
streaming decompression.  Payloads of a partition pass through a task in small batches.

Null payloads are empty, null URLs are ``urn:unknown``.  Blanks, control and non-ASCII
characters of URLs are percent-encoded.  Rows that repeat an id are records of their
own.  No rows, no records.  A file that breaks its format raises ``ValueError`` with
file and offset.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import col, staged
from medallion.session import scratch_dir

# The field lines of the two ARC versions, as their version blocks state them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PRINTABLE = "".join(map(chr, range(33, 127)))
_BATCH_BYTES = 4 << 20
FILE_BYTES = 64 << 20
#: Of gzip's nine levels: about half the time of the sixth for a twentieth more bytes.
GZIP_LEVEL = "THREE"
ID_HEADER = b"X-Page-Id: "


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _batches(rows, schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= _BATCH_BYTES or len(held) >= 2000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


# ---- ARC ---------------------------------------------------------------------


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 medallion\n{ARC_FIELDS[version]}\n".encode()
    middle = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {middle}{len(body)}\n".encode() + body


def arc_record(version: int, name: str, url: str, ip: str, date: str, mime: str, doc: bytes, offset: int) -> bytes:
    middle = "" if version == 1 else f"200 {_sha1(doc)} - {offset} {name} "
    return f"{url} {ip} {date} {mime} {middle}{len(doc)}\n".encode() + doc


def read_arc(stream, name: str) -> Iterator[dict]:
    """Records of one ARC file (bytes stream), version block left out."""
    version, offset = None, 0

    def bad(why: str):
        raise ValueError(f"{name}, offset {offset}: {why}")

    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if line in (b"\n", b"\r\n"):
            continue
        count = len(ARC_FIELDS[version or 1].split())
        fields = line.rstrip(b"\r\n").rsplit(b" ", count - 1)
        if version is None and not line.startswith(b"filedesc://"):
            bad("no version block")
        if not fields[-1].isdigit():
            bad("a header line without a length")
        length = int(fields[-1])
        doc = stream.read(length)
        offset += len(doc)
        if len(doc) < length:
            bad(f"{length} bytes declared, {len(doc)} there")
        if version is None:
            first = doc.split(b" ", 1)[0]
            version = int(first) if first in (b"1", b"2") else bad("unknown version")
            continue
        if len(fields) != count:
            bad(f"{len(fields)} fields in a version {version} header line")
        # the date and type follow URL and address in either version
        yield {"version": version, "offset": start, "url": fields[0].decode("latin-1"), "ip": fields[1].decode("latin-1"),
               "date": fields[2].decode("latin-1"), "mime": fields[3].decode("latin-1"), "doc": doc}


_CUT = pa.schema([("file", pa.int32()), ("nth", pa.int64()), ("value", pa.binary())])


def _cut(records: Iterator, make, gap: int, head, file_bytes: int) -> Iterator[dict]:
    """Records numbered in files of about ``file_bytes``: ``head(file)`` opens a file,
    ``make(record, file, offset)`` gives a record's bytes."""
    file, offset, nth = -1, 0, 0
    for r in records:
        if file < 0 or offset >= file_bytes:
            file, offset, nth = file + 1, 0, 0
            if (first := head(file)) is not None:
                yield {"file": file, "nth": 0, "value": first}
                offset, nth = len(first) + gap, 1
        value = make(r, file, offset)
        yield {"file": file, "nth": nth, "value": value}
        offset, nth = offset + len(value) + gap, nth + 1


def _write_cut(rows: DataFrame, path: str, gap: str) -> None:
    """A folder for each file number, in it a file of every task that has one."""
    (rows.sortWithinPartitions("file", "nth").select("file", F.col("value").cast("string"))
     .write.partitionBy("file").option("lineSep", gap).option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(path))


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
              date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> None:
    """Write each partition of pages as gzipped ARC files, version 1 and 2 in turn,
    without a shuffle."""
    src = pages.select(col(id_col).cast("string").alias("id"), col(url_col).cast("string").alias("url"),
                       F.coalesce(col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))

    def run(batches):
        part = TaskContext.get().partitionId()

        def name(file: int) -> tuple[int, str]:
            return 1 + (part + file) % 2, f"medallion-{part:06d}-{file:04d}.arc"

        def record(r: dict, file: int, offset: int) -> bytes:
            own = b"" if r["id"] is None else ID_HEADER + quote(r["id"], safe="").encode() + b"\r\n"
            doc = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own
                   + b"Content-Length: %d\r\n\r\n" % len(r["payload"]) + r["payload"])
            url = quote(r["url"] or "urn:unknown", safe=_PRINTABLE)
            return arc_record(*name(file), url, "0.0.0.0", date, "text/html", doc, offset)

        rows = (r for b in batches for r in b.to_pylist())
        cut = _cut(rows, record, 1, lambda file: arc_version_block(*name(file), date), file_bytes)
        yield from _batches(cut, _CUT, lambda r: len(r["value"]))

    _write_cut(src.mapInArrow(run, "file int, nth long, value binary"), path, "\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _opened(content: bytes):
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content), 1 << 16)


def _split_http(doc: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload; no header for others."""
    if not doc.startswith(b"HTTP/"):
        return b"", doc
    end = doc.find(b"\r\n\r\n")
    return (doc[:end + 4], doc[end + 4:]) if end >= 0 else (doc, b"")


def _header_value(header: bytes, name: bytes) -> str | None:
    for line in header.split(b"\r\n"):
        if line.startswith(name):
            return unquote(line[len(name):].decode())
    return None


def _as_warc(r: dict, name: str) -> dict:
    header, payload = _split_http(r["doc"])
    # a file's name and that of its folder are its own
    place = hashlib.sha1(f"{'/'.join(name.rsplit('/', 2)[-2:])} {r['offset']}".encode()).digest()
    d = r["date"]
    return {"record_id": f"<urn:uuid:{uuid.UUID(bytes=place[:16], version=5)}>", "uri": r["url"], "ip": r["ip"],
            "date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", "mime": r["mime"], "header": header,
            "page": _header_value(header, ID_HEADER), "payload_bytes": len(payload), "payload_digest": _sha1(payload),
            "same": hashlib.sha256(payload).digest(), "payload": payload}


_RECORD = pa.schema([("record_id", pa.string()), ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                     ("mime", pa.string()), ("header", pa.binary()), ("page", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("same", pa.binary()), ("payload", pa.binary())])
_RECORD_DDL = ("record_id string, uri string, ip string, date string, mime string, header binary, page string, "
               "payload_bytes long, payload_digest string, same binary, payload binary")


def convert_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """WARC fields of every record of the ARC files under ``path``."""
    def run(batches):
        def rows():
            for batch in batches:
                for f in batch.to_pylist():
                    for r in read_arc(_opened(f["content"]), f["path"]):
                        out = _as_warc(r, f["path"])
                        yield out if payloads else out | {"payload": None}

        yield from _batches(rows(), _RECORD, lambda r: len(r["payload"] or b""))

    return _files(spark, path).mapInArrow(run, _RECORD_DDL)


def with_revisits(records: DataFrame, narrow: DataFrame, id_type: str, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``lead_id``, ``lead_uri``, ``lead_date`` of the response they
    revisit, null for responses.  ``narrow``: the same records, payloads not read."""
    page = F.col("page").cast(id_type)
    lead = (narrow.filter(F.col("payload_bytes") >= min_bytes).groupBy("same")
            .agg(F.max(F.struct(page.isNotNull().alias("has"), page.alias("page"), "record_id", "uri", "date")).alias("lead")))
    lead = staged(lead, "warc-leads")
    other = F.col("lead.record_id") != F.col("record_id")
    return records.join(lead, "same", "left").select(
        *[c for c in _RECORD.names], *[F.when(other, F.col(f"lead.{c}")).alias(f"lead_{c}")
                                       for c in ("record_id", "uri", "date")])


# ---- WARC --------------------------------------------------------------------


def warc_record(r: dict) -> bytes:
    """One record without its closing blank lines; a revisit holds no payload."""
    revisit = r["lead_record_id"] is not None
    block = r["header"] + (b"" if revisit else r["payload"])
    http = r["header"].startswith(b"HTTP/")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response' if http else 'resource'}",
             f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}", f"WARC-Target-URI: {r['uri']}",
             f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
             f"WARC-Block-Digest: sha1:{_sha1(block)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {r['lead_record_id']}", f"WARC-Refers-To-Target-URI: {r['lead_uri']}",
                  f"WARC-Refers-To-Date: {r['lead_date']}"]
    lines += [f"Content-Type: {'application/http; msgtype=response' if http else r['mime']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    def run(batches):
        rows = (r for b in batches for r in b.to_pylist())
        cut = _cut(rows, lambda r, file, offset: warc_record(r), 4, lambda file: None, file_bytes)
        yield from _batches(cut, _CUT, lambda r: len(r["value"]))

    _write_cut(records.mapInArrow(run, "file int, nth long, value binary"), path, "\r\n\r\n")


def read_warc(stream, name: str) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record of one WARC file."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"{name}: no WARC version line but {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.rstrip(b"\r\n").decode("utf-8").partition(": ")
            fields[k.lower()] = v
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{name}: {size} bytes declared, {len(block)} there")
        yield fields, block


_BACK = pa.schema([("record_id", pa.string()), ("page", pa.string()), ("record_type", pa.string()),
                   ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("intact", pa.bool_())])


def _read_back(fields: dict, block: bytes) -> dict:
    header, payload = _split_http(block)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    size = int(_header_value(header, b"Content-Length: ") or len(payload)) if revisit else len(payload)
    intact = fields["warc-block-digest"] == f"sha1:{_sha1(block)}" and (revisit or digest == _sha1(payload))
    return {"record_id": fields["warc-record-id"], "page": _header_value(header, ID_HEADER), "record_type": fields["warc-type"],
            "refers_to_id": fields.get("warc-refers-to"), "payload_bytes": size, "payload_digest": digest, "intact": intact}


def warc_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``; ``intact``: its digests
    agree with its bytes."""
    def run(batches):
        rows = (_read_back(f, b) for batch in batches for x in batch.to_pylist()
                for f, b in read_warc(_opened(x["content"]), x["path"]))
        yield from _batches(rows, _BACK, lambda r: 200)

    return _files(spark, path).mapInArrow(run, "record_id string, page string, record_type string, refers_to_id string, "
                                               "payload_bytes long, payload_digest string, intact boolean")


def warc_roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Pages → ARC files → WARC files → one row per page read back from them."""
    spark, id_type = pages.sparkSession, pages.select(col(id_col)).schema[0].dataType.simpleString()
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arc, id_col, url_col, payload_col)
    write_warc(with_revisits(convert_arc(spark, arc), convert_arc(spark, arc, payloads=False), id_type, min_bytes), warc)
    back = staged(warc_index(spark, warc), "warc-index")
    page = F.col("page").cast(id_type)
    leads = back.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), page.alias("refers_to"))
    # responses refer to none: only revisits have a key to join by
    alone = back.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast(id_type))
    again = back.filter("record_type = 'revisit'").join(leads, "refers_to_id", "left")
    return alone.unionByName(again).select(page.alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")

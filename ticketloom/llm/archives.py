"""ARC archives and their conversion to WARC.

An ARC file opens with a version block whose lines name the fields of every header line: version 1 has five fields,
version 2 ten. A record is a header line, as many bytes as its last field declares, and a line break. The converter
reads those lines and makes equivalent WARC records: identifiers from the record's place and content, timestamps from
14-digit dates, types from the scheme and the block, digests from block and payload; later copies of a large payload
become revisits of one response.

Files are written by Spark's text writer, one file for each row that a task hands over: about ``FILE_BYTES`` of records
(or one longer record), gzipped. They are read with Spark's binary-file source. So both work on any file system that
Spark reaches, and a lost task is repeated.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.blocks import blocks
from ticketloom.runtime import cut

FILE_BYTES = 8 << 20
#: Field names of the two header versions, last line of the version block (fixed values of the format).
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT_BYTES = 1000


@dataclass(frozen=True)
class ArcRecord:
    offset: int
    version: int
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes


def _token(value: str | None, otherwise: str = "-") -> str:
    """A header field: white space and control characters are escaped."""
    return quote(value, safe="".join(map(chr, range(33, 127)))) if value else otherwise


def arc_header(version: int, url: str, ip: str, date: str, kind: str, length: int, status: str = "200", offset: int = 0, name: str = "-") -> bytes:
    middle = "" if version == 1 else f" {status} - - {offset} {name}"
    return f"{url} {ip} {date} {kind}{middle} {length}\n".encode()


def version_block(version: int, date: str, name: str) -> bytes:
    body = f"{version} 0 ticketloom\n{FIELDS[version]}\n".encode()
    return arc_header(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name=name) + body + b"\n"


def read_arc(content: bytes) -> Iterator[ArcRecord]:
    """All records of a file, the version block first. The version block decides how header lines are read.

    Fields are taken from the right, as old files have blanks in addresses. Line breaks between records are optional.
    """
    at, version = 0, 1
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line at byte {at} does not end")
        line = content[at:end].decode("utf-8", "replace").rstrip("\r")
        if line.startswith("filedesc:"):
            version = int(content[end + 1 : content.find(b" ", end + 1)])
            if version not in FIELDS:
                raise ValueError(f"version {version} is not known")
        fields = line.rsplit(" ", FIELDS[version].count(" "))
        length = int(fields[-1])
        block = content[end + 1 : end + 1 + length]
        if len(fields) != len(FIELDS[version].split()) or len(block) != length:
            raise ValueError(f"record at byte {at} is not complete")
        yield ArcRecord(at, version, fields[0], fields[1], fields[2], fields[3], block)
        at = end + 1 + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its empty line) and payload of a recorded HTTP response."""
    at = block.find(b"\r\n\r\n")
    return (block[: at + 4], block[at + 4 :]) if at >= 0 else (block, b"")


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def warc_date(date: str) -> str:
    """ISO form of a date of up to 14 digits; missing parts are the least possible."""
    digits = date[:14] + "00000101000000"[len(date[:14]) :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, record: ArcRecord) -> str:
    """The same for every conversion of the same record."""
    place = f"{archive}#{record.offset} {record.url} {record.date} {sha1(record.block)}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def warc_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a file."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not complete")
        yield headers, content[start:stop]
        at = stop + 4


def _write_files(rows: DataFrame, kernel, path: str) -> None:
    """``kernel`` yields the contents of files; the writer adds their last line break itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in kernel(batches):
            yield pa.RecordBatch.from_arrays([pa.array([content[:-1]], pa.binary())], names=["content"])

    files = rows.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            name, data = path.as_py().rpartition("/")[2], content.as_py()
            yield name, gzip.decompress(data) if name.endswith(".gz") else data


def write_arc(
    pages: DataFrame, path: str, version: int = 1, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "20240101000000", file_bytes: int = FILE_BYTES,
) -> None:
    """Record pages as HTTP responses in ARC files; the page id is a header field of the response.

    A null page is an empty one, a null address is written as about:blank, a null id leaves out the field.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        parts: list[bytes] = []
        size = n = 0
        for batch in blocks(batches, "html"):
            for key, address, body in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                if not parts:
                    parts, n = [version_block(version, date, f"part-{n}.arc")], n + 1
                payload = (body or "").encode()
                head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
                head += [f"X-Page-Id: {key}"] if key is not None else []
                block = "\r\n".join([*head, "", ""]).encode() + payload
                line = arc_header(version, _token(address, "about:blank"), "0.0.0.0", date, "text/html", len(block), offset=size)
                parts.append(line + block + b"\n")
                size += len(parts[-1])
                if size >= file_bytes:
                    yield b"".join(parts)
                    parts, size = [], 0
        if parts:
            yield b"".join(parts)

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    _write_files(rows, kernel, path)


CONVERTED = (
    "record_id string, warc_type string, url string, ip string, date string, content_type string, page_id long, "
    "payload_bytes long, payload_digest string"
)


def converted(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """What WARC says of every ARC record below ``path`` (version blocks aside), with its block if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *((n, pa.string()) for n in ("record_id", "warc_type", "url", "ip", "date", "content_type")),
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            *([("block", pa.binary())] if with_blocks else []),
        ])
        for name, content in _contents(batches):
            rows: list[dict] = []
            held = 0
            for r in read_arc(content):
                if r.url.startswith("filedesc:"):
                    continue
                http = r.block.startswith(b"HTTP/")
                head, payload = split_http(r.block) if http else (b"", r.block)
                page = http_field(head, "X-Page-Id")
                rows.append({
                    "record_id": record_id(name, r), "warc_type": "response" if http else "resource", "url": r.url, "ip": r.ip,
                    "date": warc_date(r.date), "content_type": "application/http; msgtype=response" if http else r.content_type,
                    "page_id": int(page) if page is not None else None, "payload_bytes": len(payload),
                    "payload_digest": sha1(payload),
                } | ({"block": r.block} if with_blocks else {}))
                held += len(r.block)
                if held >= FILE_BYTES or len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return _files(spark, path).mapInArrow(run, CONVERTED + (", block binary" if with_blocks else ""))


def with_revisits(records: DataFrame, index: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Add ``refers_id, refers_url, refers_date, refers_page`` to records that repeat another's payload.

    Of equal payloads of at least ``least_bytes`` the record with the largest page id (then the largest record id) stays
    a response. ``index`` is the same records without blocks: only payloads that occur twice are looked up, in a written
    table whose size the planner knows, so blocks move only if that table is large.
    """
    chosen = F.max(F.struct("page_id", "record_id", "url", "date")).alias("r")
    large = index.where((F.col("payload_bytes") >= least_bytes) & (F.col("warc_type") == "response"))
    repeated = cut(large.groupBy("payload_digest").agg(chosen, F.count("*").alias("n")).where("n > 1").select("payload_digest", "r"))
    eligible = F.when((F.col("payload_bytes") >= least_bytes) & (F.col("warc_type") == "response"), F.col("payload_digest"))
    found = records.withColumn("__digest", eligible).join(repeated.withColumnRenamed("payload_digest", "__digest"), "__digest", "left")
    other = F.col("r").isNotNull() & (F.col("r.record_id") != F.col("record_id"))
    names = {"refers_id": "record_id", "refers_url": "url", "refers_date": "date", "refers_page": "page_id"}
    return found.select(*records.columns, *(F.when(other, F.col(f"r.{c}")).alias(n) for n, c in names.items()))


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write converted records with their revisits as WARC files. A revisit keeps the head of its response only."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if not parts:
                    info = b"software: ticketloom\r\nformat: WARC File Format 1.1\r\n"
                    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'info ' + row['record_id'])}>"
                    parts = [warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", name), ("WARC-Date", row["date"]),
                                          ("Content-Type", "application/warc-fields")], info)]
                block, again = row["block"], row["refers_id"] is not None
                if again:
                    block = split_http(block)[0]
                parts.append(warc_record([
                    ("WARC-Type", "revisit" if again else row["warc_type"]), ("WARC-Record-ID", row["record_id"]),
                    ("WARC-Date", row["date"]), ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]),
                    ("WARC-Payload-Digest", row["payload_digest"]), ("WARC-Block-Digest", sha1(block)),
                    ("WARC-Profile", REVISIT if again else None), ("WARC-Refers-To", row["refers_id"]),
                    ("WARC-Refers-To-Target-URI", row["refers_url"]), ("WARC-Refers-To-Date", row["refers_date"]),
                    ("X-Refers-To-Page", row["refers_page"]), ("X-Payload-Length", row["payload_bytes"] if again else None),
                    ("Content-Type", row["content_type"]),
                ], block))
                size += len(parts[-1])
                if size >= file_bytes:
                    yield b"".join(parts)
                    parts, size = [], 0
        if parts:
            yield b"".join(parts)

    _write_files(records, kernel, path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_id, record_type, payload_bytes, payload_digest`` (hexadecimal) ``, refers_to`` of every record.

    Digests of responses are worked out from their payloads and must be those of the headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
        for _, content in _contents(batches):
            rows = []
            for headers, block in read_warc(content):
                kind = headers["WARC-Type"]
                if kind == "warcinfo":
                    continue
                head, payload = split_http(block) if headers["Content-Type"].startswith("application/http") else (b"", block)
                digest, length = headers["WARC-Payload-Digest"], len(payload)
                if kind == "revisit":
                    length = int(headers["X-Payload-Length"])
                elif sha1(payload) != digest:
                    raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                page, other = http_field(head, "X-Page-Id"), headers.get("X-Refers-To-Page")
                rows.append({
                    "page_id": int(page) if page is not None else None, "record_id": headers["WARC-Record-ID"], "record_type": kind,
                    "payload_bytes": length, "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
                    "refers_to": int(other) if other is not None else None,
                })
            yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = "page_id long, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return _files(spark, path).mapInArrow(run, kinds)


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Convert all ARC files of a folder to WARC files in another."""
    write_warc(with_revisits(converted(spark, arc_path), converted(spark, arc_path, with_blocks=False)), warc_path)

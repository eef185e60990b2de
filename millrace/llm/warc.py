"""Legacy ARC archives to WARC: parsing, conversion with revisit records, reading back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import query, slices
from millrace.session import load, scratch_folder, written

#: An archive is closed when it holds so many bytes; one task holds one at a time.
ARCHIVE_BYTES = 16 << 20

# Fixed values of the two ARC versions: the header fields of a record.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length",
    ),
}
_ID_HEADER = "X-Page-Id"


class Capture(NamedTuple):
    """A record of an ARC archive; ``content`` is what the declared length covers."""

    version: int
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    content: bytes


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------


def arc_head(version: int, name: str) -> bytes:
    """The version block that an ARC archive starts with."""
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", "20240101000000", "text/plain", body, 0, name)


def arc_record(
    version: int, url: str, ip: str, date: str, mime: str, content: bytes, offset: int, name: str
) -> bytes:
    values = {
        "URL": re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "-",
        "IP-address": ip,
        "Archive-date": date,
        "Content-type": mime,
        "Result-code": "200",
        "Checksum": "-",
        "Location": "-",
        "Offset": str(offset),
        "Filename": name,
        "Archive-length": str(len(content)),
    }
    line = " ".join(values[field] for field in ARC_FIELDS[version])
    return line.encode() + b"\n" + content + b"\n"


def parse_arc(content: bytes) -> Iterator[Capture]:
    """Records of an archive behind its version block, cut by their declared lengths."""
    at, version = 0, 0
    # The header of the version block has the fields of one version or the other.
    first = content.lstrip(b"\r\n").split(b"\n", 1)[0]
    fields = ARC_FIELDS[2 if first.count(b" ") >= len(ARC_FIELDS[1]) else 1]
    while True:
        while content[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(content):
            return
        end = content.find(b"\n", at)
        values = content[at : end if end >= 0 else len(content)].decode("utf-8").split(" ")
        if end < 0 or len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"no ARC header line of version {version or 1} at byte {at}")
        named = dict(zip(fields, values, strict=True))
        start, stop = end + 1, end + 1 + int(named["Archive-length"])
        if stop > len(content):
            raise ValueError(f"the ARC record at byte {at} is cut off")
        block = content[start:stop]
        if not version:
            version = int(block.split(b" ", 1)[0])
            fields = tuple(block.split(b"\n")[1].decode().split(" "))
        else:
            yield Capture(
                version, at, named["URL"], named["IP-address"], named["Archive-date"],
                named["Content-type"], block,
            )
        at = stop


def write_arcs(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    fetched: str = "fetched",
) -> None:
    """Write captures into gzipped ARC archives, of version 1 and version 2 in turn.

    A capture is an HTTP response with the UTF-8 of ``html`` (null: empty) as its body. A
    null url is written as ``-``. Archives are closed at ``ARCHIVE_BYTES``; a longer page
    has one to itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size, number = [], 0, 0

        def started() -> tuple[int, str]:
            return 1 + (part + number) % 2, f"pages-{part:05d}-{number:05d}.arc"

        for batch in slices(batches):
            for name, link, body, date in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                version, archive = started()
                if not held:
                    held.append(arc_head(version, archive))
                    size = len(held[0])
                payload = (body or "").encode()
                named = f"{_ID_HEADER}: {name}\r\n" if name is not None else ""
                head = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"{named}Content-Length: {len(payload)}\r\n\r\n"
                )
                held.append(
                    arc_record(
                        version, link or "-", "0.0.0.0", date or "19700101000000", "text/html",
                        head.encode() + payload, size, archive,
                    )
                )
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield _archive(held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _archive(held)

    rows = pages.select(
        F.col(key).cast("bigint"), F.col(url), F.col(html),
        F.date_format(F.col(fetched), "yyyyMMddHHmmss"),
    )
    _write(rows.mapInArrow(run, "value binary"), folder)


def _archive(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(records)], pa.binary())], ["value"])


def _write(archives: DataFrame, folder: str) -> None:
    """A file for each row, as bytes; the sink's closing line feed stands behind the records."""
    (
        archives.select(F.col("value").cast("string"))
        .write.option("compression", "gzip")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """``archive``, ``content``: the files of a folder, still compressed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select(F.regexp_extract("path", r"[^/]*$", 0).alias("archive"), "content")


# --- conversion --------------------------------------------------------------------------


def _http_parts(content: bytes) -> tuple[bytes, bytes]:
    """Head, with its blank line, and body of an HTTP message; other content is all body."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def _http_header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{offset}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    head = f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _warc_date(date: str) -> str:
    y, m, d, h, i, s = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", date).groups()
    return f"{y}-{m}-{d}T{h}:{i}:{s}Z"


def captures(archives: DataFrame) -> DataFrame:
    """Light rows of all ARC records: ``archive, offset, page_id, payload_bytes, digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            name = batch.column(0)[0].as_py()
            rows = []
            for capture in parse_arc(gzip.decompress(batch.column(1)[0].as_py())):
                head, payload = _http_parts(capture.content)
                own = _http_header(head, _ID_HEADER)
                rows.append(
                    (name, capture.offset, int(own) if own else None, len(payload), digest_of(payload))
                )
            yield pa.RecordBatch.from_pylist([dict(zip(_LIGHT.names, r, strict=True)) for r in rows], _LIGHT)

    return archives.mapInArrow(
        run, "archive string, offset bigint, page_id bigint, payload_bytes bigint, digest string"
    )


_LIGHT = pa.schema(
    [
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("digest", pa.string()),
    ]
)


def decide(light: DataFrame, least: int = 0) -> DataFrame:
    """For each record, the place of the record that it revisits, or nulls.

    Of equal payloads of at least ``least`` bytes the smallest page id is the original; a
    null id comes last, and repeated ids follow by place. Groups are combined before the
    exchange, and the join back may split a group of many copies.
    """
    large = F.col("payload_bytes") >= least
    place = F.struct(F.col("page_id").isNull().alias("_last"), "page_id", "archive", "offset")
    firsts = (
        light.where(large).groupBy("digest", "payload_bytes").agg(F.min(place).alias("_first"))
    )
    joined = light.withColumn("_large", large).join(firsts, ["digest", "payload_bytes"], "left")
    revisits = F.col("_large") & (
        (F.col("_first.archive") != F.col("archive")) | (F.col("_first.offset") != F.col("offset"))
    )
    return joined.select(
        "archive",
        "offset",
        "digest",
        F.when(revisits, F.col("_first.archive")).alias("to_archive"),
        F.when(revisits, F.col("_first.offset")).alias("to_offset"),
    )


def convert(archives: DataFrame, decisions: DataFrame, folder: str) -> None:
    """Write a gzipped WARC archive for every ARC archive.

    Each starts with a warcinfo record. HTTP captures become response records, or revisit
    records of identical payload without their body; other captures become resources.
    Identifiers are name-based, from the place of the record. Only the compressed archives
    are exchanged, to meet the decisions on their records.
    """
    plan = decisions.groupBy("archive").agg(
        F.collect_list(F.struct("offset", "digest", "to_archive", "to_offset")).alias("plan")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            name, content, plan = (column[0].as_py() for column in batch.columns)
            by_offset = {step["offset"]: step for step in plan or []}
            info = f"software: converter\r\nformat: WARC File Format 1.0\r\nsource: {name}\r\n"
            out = [
                warc_record(
                    [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", record_id(name, 0)),
                        ("WARC-Date", "2024-01-01T00:00:00Z"),
                        ("Content-Type", "application/warc-fields"),
                    ],
                    info.encode(),
                )
            ]
            for capture in parse_arc(gzip.decompress(content)):
                step = by_offset[capture.offset]
                head, payload = _http_parts(capture.content)
                kind = "response" if head else "resource"
                block, more = capture.content, []
                if head and step["to_archive"] is not None:
                    kind, block = "revisit", head
                    more = [
                        ("WARC-Profile", _PROFILE),
                        ("WARC-Refers-To", record_id(step["to_archive"], step["to_offset"])),
                    ]
                out.append(
                    warc_record(
                        [
                            ("WARC-Type", kind),
                            ("WARC-Record-ID", record_id(name, capture.offset)),
                            ("WARC-Date", _warc_date(capture.date)),
                            ("WARC-Target-URI", capture.url),
                            ("WARC-IP-Address", capture.ip),
                            ("WARC-Payload-Digest", f"sha1:{step['digest']}"),
                            ("Content-Type", _HTTP if head else capture.mime),
                            *more,
                        ],
                        block,
                    )
                )
            yield _archive(out)

    planned = archives.join(plan, "archive", "left").select("archive", "content", "plan")
    _write(planned.mapInArrow(run, "value binary"), folder)


# Fixed values of the WARC format.
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HTTP = "application/http; msgtype=response"


# --- reading back ------------------------------------------------------------------------


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record."""
    at = 0
    while True:
        while content[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(content):
            return
        end = content.find(b"\r\n\r\n", at)
        first, *lines = content[at:end].decode("utf-8").split("\r\n")
        if end < 0 or not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        pairs = (line.partition(":") for line in lines)
        headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
        start, stop = end + 4, end + 4 + int(headers["content-length"])
        if stop > len(content):
            raise ValueError(f"the WARC record at byte {at} is cut off")
        yield headers, content[start:stop]
        at = stop


_READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("to_record", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_warcs(archives: DataFrame) -> DataFrame:
    """Records of WARC archives but for warcinfo; a revisit has no ``payload``.

    ``payload_bytes`` and ``payload_digest`` are of the full payload. Those of a stored
    payload are computed anew, and a digest unlike the declared one raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = []
            for headers, block in parse_warc(gzip.decompress(batch.column(1)[0].as_py())):
                kind = headers["warc-type"]
                if kind == "warcinfo":
                    continue
                head, payload = _http_parts(block)
                own = _http_header(head, _ID_HEADER)
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                size = len(payload)
                if kind == "revisit":
                    size, payload = int(_http_header(head, "Content-Length")), None
                elif digest_of(payload) != digest:
                    raise ValueError(f"damaged payload of {headers['warc-record-id']}")
                values = (
                    headers["warc-record-id"], kind, headers.get("warc-target-uri"),
                    headers["warc-date"], int(own) if own else None, size, digest,
                    headers.get("warc-refers-to"), payload,
                )
                rows.append(dict(zip(_READ.names, values, strict=True)))
            for start in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[start : start + 256], _READ)

    return archives.mapInArrow(
        run,
        "record_id string, record_type string, url string, date string, page_id bigint, "
        "payload_bytes bigint, payload_digest string, to_record string, payload binary",
    )


#: SHA-1 in base 32: five hexadecimal digits are four characters.
_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages),
named AS (
  SELECT page_id, payload_bytes,
         list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
             ('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT & 31), 1)),
           'string_agg', '') AS payload_digest
  FROM hashed),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM named GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named JOIN firsts USING (payload_digest)"""


@query("op7_warc", _SQL)
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages through ARC archives into WARC archives and back: a row per record.

    The pages have no fetch time, so one is derived from the page id.
    """
    fetched = F.timestamp_seconds(F.lit(1704067200) + F.pmod("page_id", F.lit(31536000)))
    pages = load(spark, folder, "pages", "page_id", "url", "html").withColumn("fetched", fetched)
    arcs, warcs = scratch_folder(spark), scratch_folder(spark)
    write_arcs(pages, arcs)
    archives = archive_files(spark, arcs)
    convert(archives, decide(written(captures(archives))), warcs)
    records = written(read_warcs(archive_files(spark, warcs)).drop("payload"))
    originals = records.where("record_type = 'response'").select(
        F.col("record_id").alias("to_record"), F.col("page_id").alias("refers_to")
    )
    return records.join(originals, "to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )

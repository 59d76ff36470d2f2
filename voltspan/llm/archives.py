"""Legacy ARC archives converted to WARC.

An ARC archive opens with a version block that names the fields of its URL records; version 1 has
five, version 2 ten. Records follow one another by their declared lengths. Each becomes a WARC record
with an identifier derived from what it holds, the archive date as timestamp, a type and SHA-1
digests. Of records with equal payloads one is the response and the others revisit it: their records
hold the headers alone.

Defined results: null html is an empty payload; null urls are written as ``-``; a null page id sorts
below all others; rows that repeat the response's page id and payload are responses too; empty
tables give empty archives; payloads may hold any bytes, record marks and version lines included.

Scale: WARC files are written by Spark's text writer (record by record, any file system) and read
back as whole files of at most ``FILE_RECORDS`` records. Equal payloads are found by digest among (page
id, digest, length) rows, and only digests that occur twice are joined. Each record is joined to at most
one revisit by row and digest; payloads are shuffled only if the revisits are too many to broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltspan.session import fresh_path, maybe_broadcast, stage

FILE_RECORDS = 2000
SLICE_ROWS = 200  # of html and archives
# fixed values: the field lines of both ARC versions
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
END = b"\r\n\r\n"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_archive(version: str, name: str, date: str, records: list[tuple[str, str, bytes]]) -> bytes:
    """An uncompressed ARC archive of (url, content type, content)."""
    about = f"{version} 0 voltspan\n{FIELDS[version]}\n".encode()
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain {f'200 - - 0 {name} ' if version == '2' else ''}{len(about)}\n".encode(), about, b"\n"]
    for url, kind, content in records:
        url = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url) or "-"
        middle = f"200 {base32_sha1(content)} - {sum(map(len, out))} {name} " if version == "2" else ""
        out += [f"{url} 0.0.0.0 {date} {kind} {middle}{len(content)}\n".encode(), content, b"\n"]
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[dict]:
    """The URL records of an ARC archive, with their fields by name and ``content``.

    Raises ``ValueError`` on an unknown version, a header line that doesn't fit it, or a length that
    runs past the end: a damaged archive is never read in part.
    """
    line_end = data.find(b"\n")
    head = data[:line_end].decode().split(" ")
    if line_end < 0 or not head[0].startswith("filedesc://"):
        raise ValueError("no ARC version block")
    length = int(head[-1])
    about = data[line_end + 1 : line_end + 1 + length].decode().split("\n")
    version = about[0].split(" ")[0]
    if version not in FIELDS or len(about) < 2:
        raise ValueError(f"unknown ARC version {version!r}")
    names, at = about[1].split(" "), line_end + 1 + length
    if len(names) != len(FIELDS[version].split(" ")):
        raise ValueError("field line doesn't fit the version")
    while True:
        while data[at : at + 1] == b"\n":
            at += 1
        if at >= len(data):
            return
        line_end = data.find(b"\n", at)
        values = data[at:line_end].decode().split(" ") if line_end >= 0 else []
        if len(values) != len(names):
            raise ValueError(f"header line of {len(values)} fields, not {len(names)}")
        record = dict(zip(names, values))
        start = line_end + 1
        at = start + int(record["Archive-length"])
        if at > len(data):
            raise ValueError("record runs past the end of the archive")
        yield record | {"version": version, "content": data[start:at]}


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def warc_record(record: dict, row: int | None, digest: str, response: int | None) -> bytes:
    """The WARC record of an ARC record, without the two line ends that close it.

    ``response`` is the row whose record holds the payload, if it isn't this one.
    """
    date = datetime.strptime(record["Archive-date"], "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
    content = record["content"]
    http = f"HTTP/1.1 {record.get('Result-code', '200')} -\r\nContent-Type: {record['Content-type']}\r\nContent-Length: {len(content)}\r\n\r\n".encode()
    revisit = response is not None
    block = http if revisit else http + content
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row, digest)}",
        f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {record['URL']}",
        f"WARC-IP-Address: {record['IP-address']}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"X-Source-Row: {'' if row is None else row}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(response, digest)}",
            f"X-Refers-To-Row: {response}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, cut by declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should start")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        start = end + len(END)
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + len(END)] != END:
            raise ValueError("record doesn't end where it should")
        yield headers, data[start:stop]
        at = stop + len(END)


def legacy(pages: DataFrame, date: str = "19970601000000") -> DataFrame:
    """(row, arc): each page as a small ARC archive, of version 1 and 2 by turns of its id."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = [c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns]
                arcs = [arc_archive("12"[(n or 0) % 2], f"{n}.arc", date, [(url or "-", "text/html", (html or "").encode())]) for n, url, html in zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(arcs, pa.binary())], names=["row", "arc"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(make, "row long, arc binary")


def payloads(archives: DataFrame) -> DataFrame:
    """(row, digest, bytes) of every record of (row, arc)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(n.as_py(), base32_sha1(r["content"]), len(r["content"])) for n, arc in zip(*batch.columns) for r in arc_records(arc.as_py())]
            n, digest, size = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(size, pa.int64())], names=["row", "digest", "bytes"])

    return archives.mapInArrow(look, "row long, digest string, bytes long")


def revisits(found: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(row, digest, response) of records whose payload a record of a larger row holds."""
    found = stage(found, "payload-digests").filter(F.col("bytes") >= min_bytes)
    shared = found.groupBy("digest").agg(F.max("row").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return found.join(maybe_broadcast(stage(shared, "shared-payloads")), "digest").filter(~F.col("row").eqNullSafe(F.col("response"))).select("row", "digest", "response").distinct()


def records(archives: DataFrame) -> DataFrame:
    """(row, digest, fields, content) of every record of (row, arc)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                out = []
                for n, arc in zip(*(c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns)):
                    for record in arc_records(arc):
                        content = record.pop("content")
                        out.append((n, base32_sha1(content), json.dumps(record), content))
                columns = list(zip(*out)) or [()] * 4
                types = [pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "digest", "fields", "content"])

    return archives.select("row", "arc").mapInArrow(split, "row long, digest string, fields string, content binary")


def convert(archives: DataFrame, path: str, min_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """Writes the WARC records of (row, arc) as files below ``path``."""
    again = maybe_broadcast(stage(revisits(payloads(archives), min_bytes), "revisits"))
    given = records(archives)
    # a row may hold several payloads, so a record is told by both
    same = given["row"].eqNullSafe(again["row"]) & (given["digest"] == again["digest"])
    rows = given.join(again, same, "left").select(given["row"], given["digest"], "fields", "content", "response")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                out = [
                    warc_record(json.loads(fields) | {"content": content}, n, digest, response)
                    for n, digest, fields, content, response in zip(*(c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # the payloads are UTF-8, so a record is a string; the writer closes each with two line ends
    lines = rows.mapInArrow(write, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", file_records).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Headers and payload size of every record of the WARC files below ``path``.

    Fails where a response's payload hasn't the length and digest its headers tell.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for h, block in warc_records(content.as_buffer().to_pybytes()):
                    head = block[: block.index(END)].decode().lower().split("\r\n")
                    size = int(next(x for x in head if x.startswith("content-length:")).split(":")[1])
                    if h["WARC-Type"] == "response":  # the payload is there, so it is measured, not believed
                        payload = block[block.index(END) + len(END) :]
                        if len(payload) != size or base32_sha1(payload) != h["WARC-Payload-Digest"].removeprefix("sha1:"):
                            raise ValueError(f"payload of {h['WARC-Record-ID']} doesn't fit its headers")
                    number = lambda x: int(x) if x else None
                    out.append((number(h["X-Source-Row"]), h["WARC-Target-URI"], size, h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], number(h.get("X-Refers-To-Row")), h["WARC-Record-ID"], h["WARC-Date"]))
                columns = list(zip(*out)) or [()] * 8
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, warc_date string")


_READ = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date"]


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages as legacy archives, converted to WARC files and read back."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    convert(legacy(pages), path, min_bytes)
    return read_warc(spark, path)


ORACLE = """
with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as last from pages),
h as (select *, sha1(html) as hex from p),
b as (select *, list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + (
             (cast('0x' || substr(hex, cast(1 + 5 * (i // 4) as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31) as bigint), 1)) as digits from h)
select page_id, cast(strlen(html) as bigint) as payload_bytes, array_to_string(digits, '') as payload_digest,
       case when page_id is not distinct from last then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from last then last end as refers_to
from b
"""

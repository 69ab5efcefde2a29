"""Legacy archive converter: ARC records become WARC records.

* ``parse_arc`` reads ARC files of both header versions: the version block says
  how many fields a record's header line has, and the declared length says where
  its content ends.
* ``convert`` synthesises the WARC side: identifiers, ISO timestamps, record
  types and digests. Records with equal payloads become one ``response`` and
  ``revisit`` records that refer to it.
* ``write_warc`` lays the records out as gzip archives through Spark's text
  writer (its line separator is the two line ends that close a record);
  ``read_warc`` parses archives back by their Content-Length.

Payload digests are found in a first pass that shuffles digests only; the second
pass writes. Payloads are shuffled only if the table of revisits is too large to
be broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, scratch_path, staged

#: Field names of an ARC record's header line, by the version in the version block.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
#: Their names as the version block spells them.
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Payloads from this size on are written once and revisited.
REVISIT_BYTES = 1000
#: Rows up to which the table of revisits is broadcast (about 100 bytes each).
BROADCAST_REVISITS = 100_000
#: Payload bytes an archive file should hold about, before compression.
ARCHIVE_BYTES = 64 << 20
#: Payload bytes of an ARC segment rendered from pages, rows of an Arrow batch read back.
SEGMENT_BYTES = 4 << 20
READ_ROWS = 512
RECORD = ("record_id long, key_is_null boolean, url string, ip string, date string, mime string, status int, "
          "http binary, payload binary")
PAGE_HEADER = b"X-Page-Id"


# ---------------------------------------------------------------- ARC


def version_block(version: int, date: str = "20000101000000") -> bytes:
    """The record that opens an ARC file."""
    body = f"{version} 0 InternetArchive\n{ARC_TITLES[version]}\n".encode()
    first = {"url": "filedesc://pages.arc", "ip": "0.0.0.0", "date": date, "mime": "text/plain", "status": "200",
             "checksum": "-", "location": "-", "offset": "0", "filename": "pages.arc", "length": str(len(body))}
    return " ".join(first[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, mime: str, status: int, content: bytes) -> bytes:
    """A record: header line, content of the declared length, line end."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    fields = {"url": url, "ip": "0.0.0.0", "date": date, "mime": mime, "status": str(status), "checksum": "-",
              "location": "-", "offset": "0", "filename": "-", "length": str(len(content))}
    return " ".join(fields[f] for f in ARC_FIELDS[version]).encode() + b"\n" + content + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file: its header fields and ``content``.

    The first record must be the version block (ValueError otherwise), which
    fixes the fields of all header lines. URLs may hold spaces: the other fields
    are counted from the right. A header line of another length, a declared
    length that is no number, or content cut off at the end of the file raises
    ValueError; empty data has no records.
    """
    at, fields, offset = 0, None, 0
    while at < len(data):
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            break
        offset = at
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].rstrip(b"\r").decode("utf-8", "replace")
        opening = fields is None
        if opening:
            if not line.startswith("filedesc:"):
                raise ValueError("an ARC file begins with its version block")
            length = line.rsplit(" ", 1)[-1]
        else:
            parts = line.rsplit(" ", len(fields) - 1)
            if len(parts) != len(fields):
                raise ValueError(f"ARC header line at byte {offset} has {len(parts)} fields, not {len(fields)}")
            record = dict(zip(fields, parts))
            length = record["length"]
        if not length.isdigit() or end < 0 or end + 1 + int(length) > len(data):
            raise ValueError(f"ARC record at byte {offset}: the declared length does not fit")
        content = data[end + 1:end + 1 + int(length)]
        at = end + 1 + int(length)
        if opening:
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            fields = ARC_FIELDS[version]
        else:
            yield record | {"content": content, "arc_offset": offset}


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(status line and headers with the blank line, payload); no headers if it isn't HTTP."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    ends = [(i + len(s)) for s in (b"\r\n\r\n", b"\n\n") if (i := content.find(s)) >= 0]
    cut = min(ends) if ends else len(content)
    return content[:cut], content[cut:]


def _header(block: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb"[ \t]*:[ \t]*([^\r\n]*)", block)
    return found[1].strip() if found else None


def _row(record: dict) -> dict:
    http, payload = split_http(record["content"])
    key = _header(http, PAGE_HEADER)
    status = re.match(rb"HTTP/\S+[ \t]+(\d{3})", http)
    if key is None:  # a foreign record: its key follows from what it says of itself
        digest = hashlib.sha1(f"{record['url']} {record['date']} {record['arc_offset']} ".encode() + record["content"]).digest()
        number = int.from_bytes(digest[:8], "big", signed=True)
    else:
        number = int(key) if key != b"null" else 0
    return {"record_id": number, "key_is_null": key == b"null", "url": record["url"], "ip": record["ip"], "date": record["date"],
            "mime": record["mime"], "status": int(record.get("status") or (status[1] if status else 0)), "http": http,
            "payload": payload}


_ROW = pa.schema([("record_id", pa.int64()), ("key_is_null", pa.bool_()), ("url", pa.string()), ("ip", pa.string()),
                  ("date", pa.string()), ("mime", pa.string()), ("status", pa.int32()), ("http", pa.binary()),
                  ("payload", pa.binary())])


def arc_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files under ``path`` (``.gz`` files are unpacked),
    one row each. A file is one task's input, so files should stay below 1 GB."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = b"".join(_unzipped(data))
                rows = []
                for record in parse_arc(data):
                    rows.append(_row(record))
                    if len(rows) == READ_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, _ROW)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    return map_arrow(files, run, RECORD)


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as records of legacy archives: each task renders its rows as ARC
    segments (of either version in turn) and reads them with ``parse_arc``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))

    def run(batches):
        segment = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                version = 1 + segment % 2
                parts, size = [version_block(version)], 0
                while at < batch.num_rows and (size < SEGMENT_BYTES):
                    key, url, html = (batch.column(i)[at].as_py() for i in range(3))
                    name = b"null" if key is None else b"%d" % key
                    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s: %s\r\n\r\n"
                            % (len(html), PAGE_HEADER, name))
                    parts.append(arc_record(version, url or "", "20000101000000", "text/html", 200, http + html))
                    size += len(html)
                    at += 1
                segment += 1
                yield pa.RecordBatch.from_pylist([_row(r) for r in parse_arc(b"".join(parts))], _ROW)

    return map_arrow(rows, run, RECORD)


# ---------------------------------------------------------------- WARC


def record_uuid(record_id: int, is_null: bool, digest: bytes) -> str:
    """A version 8 UUID that holds the record's number (64 bits), whether it is
    null, and 57 bits of the payload digest."""
    number = record_id & ((1 << 64) - 1)
    low = ((number & 0xF) << 58) | (int(is_null) << 57) | (int.from_bytes(digest[:8], "big") >> 7)
    value = ((number >> 16) << 80) | (8 << 76) | (((number >> 4) & 0xFFF) << 64) | (2 << 62) | low
    h = f"{value:032x}"
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def uuid_record(uuid: str) -> int | None:
    """The number in a ``record_uuid``; None if it is a null's."""
    value = int(uuid.replace("-", ""), 16)
    if value >> 57 & 1:
        return None
    number = ((value >> 80) << 16) | ((value >> 64 & 0xFFF) << 4) | (value >> 58 & 0xF)
    return number - (1 << 64) if number >> 63 else number


def warc_date(arc_date: str) -> str:
    """``yyyyMMddHHmmss`` as ISO time; shorter dates are filled up, others are the epoch."""
    digits = arc_date + "00000101000000"[len(arc_date):] if re.fullmatch(r"\d{4}(\d\d){0,5}", arc_date) else "19700101000000"
    try:
        return datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(row: dict, refers_to: str | None) -> bytes:
    """A WARC/1.0 record without the two line ends that close it. With
    ``refers_to`` (a record UUID) it is a revisit that keeps the headers only."""
    digest = hashlib.sha1(row["payload"]).digest()
    uuid = record_uuid(row["record_id"], row["key_is_null"], digest)
    block = row["http"] if refers_to else row["http"] + row["payload"]
    kind = "revisit" if refers_to else "response" if row["http"] else "resource"
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid}>", f"WARC-Date: {warc_date(row['date'])}",
            f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", f"WARC-Block-Digest: {base32_sha1(block)}"]
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{refers_to}>"]
    head += ["Content-Type: " + ("application/http; msgtype=response" if row["http"] else row["mime"]),
             f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block


def payload_digests(records: DataFrame) -> DataFrame:
    """(record_id, key_is_null, digest, bytes) of every record."""
    return records.select("record_id", "key_is_null", F.sha1("payload").alias("digest"), F.length("payload").alias("bytes"))


def revisits(digests: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(record_id, key_is_null, digest, first) of the records to write as revisits:
    those whose payload a record with a larger number has too; ``first`` is the
    largest. Null numbers count as smallest. Records repeated under the largest
    number are all responses."""
    rank = F.struct(~F.col("key_is_null"), F.col("record_id"))
    large = digests.where(F.col("bytes") >= min_bytes).withColumn("rank", rank)
    firsts = large.groupBy("digest").agg(F.max("rank").alias("top"), F.count("*").alias("n")).where("n > 1")
    found = large.join(firsts, "digest").where(F.col("rank") < F.col("top"))
    return found.select("record_id", "key_is_null", "digest", F.col("top.record_id").alias("first")).distinct()


def convert(records: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """``value``, the WARC record of every ARC record (see ``warc_record``), and ``archive`` int:
    a task's records in turn fill archives of ``ARCHIVE_BYTES``, beyond which only the last
    record of one goes.

    Every record is written once; equal payloads of ``REVISIT_BYTES`` and more
    are kept once, smaller ones always."""
    digests = staged(payload_digests(records), "payload_digests") if digests is None else digests
    again = staged(revisits(digests), "revisits")
    few = again.limit(BROADCAST_REVISITS + 1).count() <= BROADCAST_REVISITS
    again = again.select(F.col("record_id").alias("r"), F.col("key_is_null").alias("k"), F.col("digest").alias("d"), "first")
    found = records.withColumn("digest", F.sha1("payload"))
    found = found.join(F.broadcast(again) if few else again,
                       (F.col("record_id") == F.col("r")) & (F.col("key_is_null") == F.col("k")) & (F.col("digest") == F.col("d")),
                       "left").select(*records.columns, "first", F.unhex("d").alias("first_digest"))

    most = ARCHIVE_BYTES

    def run(batches):
        archive, size = 0, 0
        for batch in batches:
            out, archives = [], []
            for row in batch.to_pylist():
                first = row["first"]
                out.append(warc_record(row, None if first is None else record_uuid(first, False, row["first_digest"])))
                if size >= most:
                    archive, size = archive + 1, 0
                archives.append(archive)
                size += len(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(archives, pa.int32())], names=["value", "archive"])

    return map_arrow(found, run, "value binary, archive int")


def write_warc(warc: DataFrame, path: str) -> None:
    """Writes the records (value, archive) as ``.gz`` archives below ``path``, one for each
    task and ``archive``. The bytes go through Spark's text writer unchanged: a
    record's end is the writer's line end."""
    (warc.select(F.col("value").cast("string"), "archive").write.partitionBy("archive").option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").text(path))


def _unzipped(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, in pieces."""
    while data:
        unzip = zlib.decompressobj(31)
        view = memoryview(data)
        for at in range(0, len(view), 1 << 20):
            piece = unzip.decompress(view[at:at + (1 << 20)])
            if piece:
                yield piece
            if unzip.eof:
                data = unzip.unused_data + bytes(view[at + (1 << 20):])
                break
        else:
            if not unzip.eof:
                raise ValueError("the archive is cut off")
            return
        data = data.lstrip(b"\x00")


def parse_warc(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an archive that
    arrives in pieces. A record that is cut off or malformed raises ValueError."""
    buffer, at, more = b"", 0, True

    def need(n: int) -> bool:
        nonlocal buffer, at, more
        parts, have = [buffer[at:]], len(buffer) - at
        while more and have < n:
            piece = next(pieces, None)
            if piece is None:
                more = False
            else:
                parts.append(piece)
                have += len(piece)
        buffer, at = b"".join(parts), 0
        return have >= n

    pieces = iter(pieces)
    while True:
        if len(buffer) - at < 4 and not need(4):
            if buffer[at:].strip():
                raise ValueError("the archive is cut off")
            return
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not need(len(buffer) - at + 1):
                raise ValueError("a WARC header is cut off")
        lines = buffer[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at = end + 4
        size = int(head["content-length"])
        if len(buffer) - at < size + 4 and not need(size + 4):
            raise ValueError("a WARC block is cut off")
        block = buffer[at:at + size]
        if buffer[at + size:at + size + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where it says")
        at += size + 4
        yield head, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: record_id long, url, record_type,
    date, payload_bytes long, payload_digest (hex SHA-1), refers_to long, payload
    binary (null for revisits). A payload that does not match its digest raises."""
    schema = ("record_id long, url string, record_type string, date string, payload_bytes long, payload_digest string, "
              "refers_to long, payload binary")
    arrow = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("date", pa.string()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                       ("payload", pa.binary())])
    files = spark.read.format("binaryFile").load(path).select("content")

    def row(head: dict[str, str], block: bytes) -> dict:
        kind = head["warc-type"]
        http, payload = split_http(block)
        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
        if kind != "revisit" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
        size = int(_header(http, b"Content-Length") or 0) if kind == "revisit" else len(payload)
        uuid = lambda name: uuid_record(head[name].removeprefix("<urn:uuid:").removesuffix(">"))
        return {"record_id": uuid("warc-record-id"), "url": head["warc-target-uri"], "record_type": kind,
                "date": head["warc-date"], "payload_bytes": size, "payload_digest": digest,
                "refers_to": uuid("warc-refers-to") if kind == "revisit" else None,
                "payload": None if kind == "revisit" else payload}

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                rows = []
                for head, block in parse_warc(_unzipped(data) if data[:2] == b"\x1f\x8b" else iter([data])):
                    rows.append(row(head, block))
                    if len(rows) == READ_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return map_arrow(files, run, schema)


def archive_pages(pages: DataFrame, path: str) -> None:
    """Writes a WARC record for every page below ``path``, by way of ARC records."""
    records = page_records(pages)
    digests = staged(payload_digests(records), "payload_digests")
    write_warc(convert(records, digests), path)


def warc_report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back
    from the archives that ``archive_pages`` writes into the shared folder.

    A null html is an empty payload, a null url is written as ``-``, a null
    page_id counts as the smallest and comes back as null. Rows repeated under
    the largest page_id of a payload are all responses. An empty table gives none.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    archive_pages(pages, path)
    return read_warc(spark, path).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")

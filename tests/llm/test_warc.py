import gzip
import hashlib

import pytest

from labrelay.llm import warc


def test_both_arc_versions_are_parsed():
    for version in (1, 2):
        data = (warc.version_block(version) + warc.arc_record(version, "http://a b/", "19990203040506", "text/html", 200, b"HTTP/1.0 200 OK\n\nx\n\n")
                + warc.arc_record(version, "", "x", "text/plain", 200, b""))
        got = list(warc.parse_arc(data))
        assert [(r["url"], r["content"], r["mime"]) for r in got] == [
            ("http://a%20b/", b"HTTP/1.0 200 OK\n\nx\n\n", "text/html"), ("-", b"", "text/plain")]
        assert ("checksum" in got[0]) == (version == 2)
        for broken in (data[:-3], data.replace(b" 19990203040506", b"", 1), data[20:]):
            with pytest.raises(ValueError):
                list(warc.parse_arc(broken))
    assert list(warc.parse_arc(b"")) == []


def test_identifiers_and_dates():
    for n in (0, 1, -1, 2**63 - 1, -(2**63), 12345678901234):
        assert warc.uuid_record(warc.record_uuid(n, False, b"\xff" * 20)) == n
    assert warc.uuid_record(warc.record_uuid(0, True, b"\x00" * 20)) is None
    assert [warc.warc_date(d) for d in ("1999", "19990203040506", "19991399000000", "?", "")] == [
        "1999-01-01T00:00:00Z", "1999-02-03T04:05:06Z", "1970-01-01T00:00:00Z", "1970-01-01T00:00:00Z", "1970-01-01T00:00:00Z"]


def test_foreign_archives_are_converted(spark, scratch_dir):
    body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + bytes(range(256)) * 8
    data = {v: warc.version_block(v) + warc.arc_record(v, f"http://h/{v}", "20010203", "text/html", 200, body)
            + warc.arc_record(v, f"dns:h{v}", "20010203", "text/dns", 200, b"answer\r\n\r\nWARC/1.0\r\n") for v in (1, 2)}
    import os

    os.makedirs(f"{scratch_dir}/arc")
    open(f"{scratch_dir}/arc/a.arc", "wb").write(data[1])
    open(f"{scratch_dir}/arc/b.arc.gz", "wb").write(gzip.compress(data[2][:200]) + gzip.compress(data[2][200:]))
    records = warc.arc_records(spark, f"{scratch_dir}/arc")
    warc.write_warc(warc.convert(records), f"{scratch_dir}/warc")
    rows = sorted(warc.read_warc(spark, f"{scratch_dir}/warc").collect(), key=lambda r: r.url)
    assert [(r.url, r.record_type) for r in rows if r.url.startswith("dns")] == [("dns:h1", "resource"), ("dns:h2", "resource")]
    pages = [r for r in rows if r.url.startswith("http")]
    assert sorted(r.record_type for r in pages) == ["response", "revisit"]
    first, again = sorted(pages, key=lambda r: r.record_type)
    assert bytes(first.payload) == bytes(range(256)) * 8 and again.refers_to == first.record_id and again.payload is None
    assert {r.date for r in rows} == {"2001-02-03T00:00:00Z"}


def test_pages_come_back(spark, monkeypatch):
    big, other = "<p>é" + "x" * 2000, "y" * 1000
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, big), (4, "http://c d\n", "small"), (5, "http://e", "small"), (6, "u", None),
            (7, "u", ""), (None, "u", other), (8, "u", other), (9, "u", "z" * 3_000_000), (10, "u", "same" * 300), (10, "u", "same" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest")
    top = {big: 3, other: 8, "same" * 300: 10}

    def want(page_id, html):
        data = (html or "").encode()
        first = top.get(html)
        revisit = first is not None and page_id != first
        return (str(page_id), len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", str(first if revisit else None))

    expected = sorted(want(p, h) for p, _, h in rows)
    for limit in (warc.BROADCAST_REVISITS, 0):  # broadcast and joined
        monkeypatch.setattr(warc, "BROADCAST_REVISITS", limit)
        got = sorted((str(r[0]), r[1], r[2], r[3], str(r[4])) for r in warc.warc_report(pages).collect())
        assert got == expected
    assert warc.warc_report(pages.limit(0)).count() == 0


def test_archives_are_cut_by_bytes_in_a_partition_of_large_pages(spark, scratch_dir, monkeypatch):
    import glob
    import random

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(1)
    rows = [(i, "u", "<p>" + "".join(chr(rng.randrange(33, 127)) for _ in range(50 if i < 300 else 7000))) for i in range(340)]  # sorted by size
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.archive_pages(pages, f"{scratch_dir}/warc")
    files = glob.glob(f"{scratch_dir}/warc/**/*.gz", recursive=True)
    sizes = [sum(len(block) for _, block in warc.parse_warc(iter([gzip.decompress(open(f, "rb").read())]))) for f in files]
    assert len(files) > 10 and max(sizes) < 20_000 + 8_000
    got = {r.record_id: (r.payload_bytes, bytes(r.payload)) for r in warc.read_warc(spark, f"{scratch_dir}/warc").collect()}
    assert got == {i: (len(h), h.encode()) for i, _, h in rows}

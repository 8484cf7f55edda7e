"""Archives written and read back."""

import base64
import gzip
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aislekit.llm import warc


@pytest.fixture(scope="module")
def make_pages(spark):
    def make(rows):
        full = [(i, u, h, "clash", 1) for i, u, h in rows]
        return spark.createDataFrame(full, "page_id long, url string, html string, payload string, record_type int")

    return make


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, min_bytes=0):
    by = defaultdict(list)
    for i, _, h in rows:
        by[(h or "").encode()].append(i)
    out = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        known = [x for x in by[p] if x is not None]
        first = min(known) if known else None
        again = len(p) >= min_bytes and first is not None and i != first
        out[(i, len(p), b32(p), "revisit" if again else "response", first if again else None)] += 1
    return out


ROWS = [(5, "http://a/é b\r\nX: y", "same"), (3, None, "same"), (9, "http://c", None), (8, "http://d", ""),
        (4, "http://e", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (3, "http://f", "same"),
        (10, "http://g", "長い" * 700_000), (None, "http://h", "same"), (None, "http://i", "alone"), (11, "u", "x")]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip_of_odd_pages(make_pages, min_bytes):
    got = warc.op4_warc(make_pages(ROWS), min_bytes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == expected(ROWS, min_bytes)


def test_empty_table(make_pages):
    assert warc.op4_warc(make_pages([])).collect() == []


def test_documents_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert Counter(map(tuple, warc.op4_warc(pages).collect())) == expected(rows)


def test_payload_and_pushed_filters(spark, make_pages, tmp_path):
    records = warc.records_of(make_pages(ROWS)).withColumn("payload_digest", warc.base32_of_hex(F.col("payload_digest")))
    warc.write_warc(records, str(tmp_path / "w"))
    df = warc.read_warc(spark, str(tmp_path / "w"))
    got = {(r["record_id"], bytes(r["payload"])) for r in df.where("record_type = 'response'").collect()}
    assert ("<urn:page:4>", ROWS[4][2].encode()) in got and ("<urn:page:10>", ROWS[6][2].encode()) in got
    only = df.where("record_type = 'revisit' and target_uri like 'http://%'")
    assert "record_type = revisit" not in only._jdf.queryExecution().executedPlan().toString().split("Scan")[0]
    assert all(r["payload"] is None and r["refers_to"] in ("<urn:page:3>", "<urn:page:8>") for r in only.collect())
    assert df.where("refers_to is null and record_type <> 'warcinfo'").count() == 7
    assert df.where("content_length > 1000000").count() == 1


def test_reader_skips_unwanted_payloads_and_takes_plain_files(tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    record = lambda kind, extra="": (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{kind}>\r\n{extra}"  # noqa: E731
                                     f"Content-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n").encode() \
        + body + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record("request") + record("response"))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("response")) + gzip.compress(record("request")))
    (tmp_path / "notes.txt").write_text("not an archive")
    reader = warc.WarcReader({"path": str(tmp_path)})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("payload",), b"")])) == \
        [warc.EqualTo(("payload",), b"")]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[0], r[-1]) for r in rows] == [("response", b"abc")] * 2
    bad = record("response", "WARC-Payload-Digest: sha1:WRONG\r\n")
    (tmp_path / "c.warc").write_bytes(bad)
    with pytest.raises(ValueError, match="digest"):
        list(reader.read(warc.Files(str(tmp_path / "c.warc"))))
    (tmp_path / "c.warc").write_bytes(record("response")[:-20])
    with pytest.raises(EOFError):
        list(reader.read(warc.Files(str(tmp_path / "c.warc"))))

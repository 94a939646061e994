import hashlib

import pytest

from tidemark.llm import warc
from tidemark.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, key int"


def expected(rows):
    out = []
    last = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            last[p] = max(last.get(p, i), i)
    for i, _, h in rows:
        p = (h or "").encode()
        to = last.get(p) if i is not None else None
        revisit = to is not None and to != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response",
                    to if revisit else None, True))
    return out


def test_round_trip_with_equal_null_empty_and_long_payloads(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(1, "http://a", "x" * 1000), (5, "http://b", "x" * 1000), (3, None, "x" * 1000), (2, "u", "x" * 999),
            (4, "u\r\nX: y", "x" * 999), (6, "u", None), (7, "u", ""), (8, "u", long), (9, "u", long),
            (None, "u", "x" * 1000), (10, "u", "0\r\n\r\n" * 4000), (11, "u", "k" * 2000), (11, "u", "k" * 2000)]
    pages = spark.createDataFrame([(*r, "zz", 1) for r in rows], PAGES).repartition(3)
    got = [tuple(r) for r in warc.round_trip(pages).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_and_urls_come_back(spark):
    html = "ü" * 30_000
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(1, "http://a/b", html, "", 1)], PAGES), path)
    row = warc.read_archives(spark, path).first()
    assert bytes(row["payload"]).decode() == html and row["url"] == "http://a/b" and row["valid"]


def test_a_missing_segment_is_not_valid():
    import pyarrow as pa

    parts = [{"segment": 1, "total": None, "block": b"x"}, {"segment": 3, "total": 3, "block": b"yz"}]
    batch = pa.RecordBatch.from_pylist([{"key": "k", "parts": parts, "page_id": 1, "url": "u",
                                         "record_type": "response", "refers_to": None, "header_digest": "d"}])
    assert next(warc._decode([batch])).to_pylist()[0]["valid"] is False


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 10_000):
        assert warc.unchunked(warc.chunked(b"a" * n)) == b"a" * n
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab")

import base64
import gzip
import hashlib

import pytest

from temblor.llm import warc

PAGES = "page_id long, url string, html string, digest string, refers_to long"
ROWS = [
    (3, "http://a.example.com/x?y=1#z", "<p>one</p>", None, None),
    (1, "http://a.example.com/", "<p>one</p>", "x", 9),
    (2, "http://a.example.com/bad\r\nurl", "ends\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", None, None),
    (4, None, None, None, None),
    (5, "", "", None, None),
    (6, "no scheme", "é" * 50_000 + "\r\n\r\n", None, None),
    (7, "http://b.example.com", "<p>one</p>", None, None),
]


def expected(rows, least=0):
    first = {}
    for page, _, html, *_ in sorted(rows):
        first.setdefault(html or "", page)
    out = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        same = first[html or ""] if len(raw) >= least else page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "response" if same == page else "revisit", None if same == page else same))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 5, 100])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, PAGES)
    assert result(warc.round_trip(pages, least)) == expected(ROWS, least)


def test_repeated_rows_and_empty_tables(spark):
    twice = [*ROWS, ROWS[0], ROWS[4]]
    assert result(warc.round_trip(spark.createDataFrame(twice, PAGES))) == expected(twice)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    nameless = warc.round_trip(spark.createDataFrame([(None, None, "x", "", 1), (2, None, "x", "", 1)], PAGES))
    assert result(nameless) == [(2, 1, *nameless.where("page_id = 2").first()[2:3], "response", None), (None, 1, nameless.first().payload_digest, "revisit", 2)]


def record(kind, name, block, **headers):
    lines = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{name}>".encode()]
    lines += [f"{k.replace('_', '-')}: {v}".encode() for k, v in headers.items()]
    return b"\r\n".join([*lines, f"Content-Length: {len(block)}".encode(), b"", block]) + b"\r\n\r\n"


def test_transactions_by_concurrent_to_either_way(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    member = {"Content_Type": "application/http; msgtype=response"}
    parts = [
        record("warcinfo", "info", b"software: x"),
        record("response", "r1", http, **member),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<r1>", Content_Type="application/http"),
        record("metadata", "m1", b"k: v\r\nfolded: a\r\n b\r\n", WARC_Concurrent_To="<r1>", Content_Type="application/warc-fields"),
        record("metadata", "m2", b"k: w\r\n", WARC_Concurrent_To="<r1>", Content_Type="application/warc-fields"),
        record("request", "q2", b"GET /2 HTTP/1.1\r\n\r\n", Content_Type="application/http"),
        record("response", "r2", http, WARC_Concurrent_To="<q2>", **member),
        record("request", "q3", b"GET /3 HTTP/1.1\r\n\r\n"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[:4]))
    (tmp_path / "b.warc").write_bytes(b"".join(parts[4:]))
    out = {r.capture_id: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert set(out) == {"<info>", "<r1>", "<r2>", "<q3>"}
    one, two = out["<r1>"], out["<r2>"]
    assert one.response.payload == b"body" and one.request.record_id == "<q1>"
    assert (one.n_requests, one.n_metadata, one.metadata.record_id) == (1, 2, "<m1>")
    assert one.metadata.fields == '{"k":"v","folded":"a b"}'
    assert two.request.record_id == "<q2>" and two.metadata is None and out["<q3>"].response is None


def test_broken_archives_are_refused():
    whole = record("response", "r", b"x" * 100)
    for data in (whole[:-80], gzip.compress(whole)[:-20], b"junk" + whole):
        with pytest.raises((warc.ArchiveError, Exception)):
            list(warc.parse_records(data))
    assert list(warc.parse_records(b"")) == []

"""Archives: round trips of odd payloads, records of other writers, broken files."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from cardinel.llm import warc
from cardinel.llm.warc_records import Reader, records

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a.example/x y", "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>"),
    (None, None, None),
    (7, "", "same"),
    (3, "https://b.example", "same"),
    (5, "https://c.example/?q=1#z", "same"),
    (9, "u\r\nEvil: 1", "é\U0001f600" * 3),
    (10, None, ""),
    (2, None, "\r\n\r\n"),
    (12, "http://d.example/", "long " * 200_000),
    (8, "http://e.example/", "twice"),
    (8, "http://e.example/", "twice"),
    (4, "http://f.example/", "a"),
    (6, "http://g.example/", "a"),
]


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(pages, least=0):
    order = sorted(pages, key=lambda p: (p[0] is None, p[0] or 0))
    first, out = {}, []
    for page_id, _, html in order:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if data in first and len(data) >= least:
            out.append((page_id, len(data), digest, "revisit", first[data]))
        else:
            first[data] = page_id
            out.append((page_id, len(data), digest, "response", None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 2, 5])
def test_pages_come_back(spark, least):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    for name in ("value", "file", "page", "copy", "content", "digest", "capture", "n"):
        df = df.withColumn(name, F.lit("mine"))
    assert tuples(warc.digests(warc.archived(df, least))) == expected(PAGES, least)
    assert tuples(warc.digests(warc.archived(df, least, payloads=False))) == expected(PAGES, least)


def test_no_pages(spark):
    assert warc.digests(warc.archived(spark.createDataFrame([], SCHEMA))).count() == 0


def test_captures_are_whole(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).withColumn("more", F.lit(3))
    rows = warc.archived(df).collect()
    assert len(rows) == len(PAGES)
    for row in rows:
        assert [len(row.requests), len(row.metadata), len(row.others)] == [1, 1, 0]
        assert row.capture.whole and b'"more":3' in bytes(row.metadata[0].payload)
        if row.capture.warc_type == "response":
            own = base64.b32encode(hashlib.sha1(bytes(row.capture.payload)).digest()).decode()
            assert row.capture.payload_digest == own
            assert row.capture.declared_digest == f"sha1:{own}"
        else:
            assert bytes(row.capture.payload) == b""
            assert row.capture.declared_digest == f"sha1:{row.original.payload_digest}"
    stored = {bytes(r.capture.payload) for r in rows if r.capture.warc_type == "response"}
    assert stored == {(html or "").encode() for _, _, html in PAGES}


def record(kind, record_id, *links, block=b"", type_="application/http", version=b"WARC/1.0"):
    head = [version, f"WARC-Type: {kind}".encode()]
    head += [f"WARC-Record-ID: {record_id}".encode()] if record_id else []
    head += [f"WARC-Concurrent-To: {x}".encode() for x in links]
    head += [f"Content-Type: {type_}".encode(), f"content-length:   {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_transactions_over_steps_and_in_either_direction(spark, tmp_path):
    answer = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    own = [
        record("warcinfo", "<i>", block=b"x"),
        record("metadata", "<m2>", "<m1>", block=b"far"),
        record("response", "<a>", "<q>", block=answer),
        record("request", "<q>", block=b"GET / HTTP/1.1\r\n\r\n"),
        record("metadata", "<m1>", "<q>", block=b"near"),
        record("request", "<lone>", "<nowhere>"),
        record("response", "<b>", block=b"no head"),
        record("metadata", "<both>", "<b>", "<a>"),
        record("response", "<a>", block=b"again"),
        record("resource", None, block=b"file", type_="text/plain"),
    ]
    (tmp_path / "1.warc.gz").write_bytes(b"".join(map(gzip.compress, own[:6])))
    (tmp_path / "2.warc").write_bytes(b"".join(own[6:]))
    got = {r.capture_id: r for r in warc.assemble(spark, str(tmp_path)).collect()}
    ids = {k: [x.record_id for x in [*r.requests, *r.metadata]] for k, r in got.items()}
    resource = next(k for k in got if k.startswith("<file:"))
    assert ids == {"<a>": ["<q>", "<m2>", "<m1>", "<both>"], "<b>": [], "<lone>": ["<lone>"], resource: []}
    assert bytes(got["<a>"].capture.payload) == b"body"
    assert bytes(got["<b>"].capture.payload) == b""
    assert bytes(got[resource].capture.payload) == b"file"
    assert got["<lone>"].capture is None


def test_broken_files():
    good = record("response", "<a>", block=b"one")
    found = [(dict(f)["warc-record-id"], b, w) for _, f, b, w in records(b"junk\r\n\r\n" + good + good[:-5])]
    assert found == [("<a>", b"one", True), ("<a>", b"on", False)]
    packed = gzip.compress(good)
    assert [w for _, _, _, w in records(packed + packed[:-20])] in ([True], [True, False])
    assert list(records(b"")) == [] and list(records(b"WARC/1.0 nothing")) == []
    assert [w for _, _, _, w in records(b"WARC/1.0\r\nContent-Length: x\r\n\r\n")] == [False]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_records_across_pieces(size):
    data = b"abc\r\n\r\ndefgh\r\nij"
    reader = Reader(iter([data[i : i + size] for i in range(0, len(data), size)]))
    assert reader.until(b"\r\n\r\n") == b"abc\r\n\r\n" and reader.offset == 7
    assert reader.take(5) == b"defgh" and reader.skip(b"\r\n") and not reader.skip(b"\r\n")
    assert reader.take(9) == b"ij" and reader.until(b"x") is None

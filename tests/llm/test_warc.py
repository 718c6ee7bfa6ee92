import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from tierline.llm import warc as X
from tierline.session import fresh_folder

ROWS = [(4, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://b/3", "other é"),
        (7, None, None), (8, "u", ""), (3, "http://a/2?x=%0A\n", "<p>same</p>"), (None, "n", "<p>same</p>"),
        (11, "big", "x" * 300_000), (12, "head\r\n\r\ncrlf", "body\r\n\r\nWARC/1.1\r\n"), (13, "r", "rep"), (13, "r", "rep")]


@pytest.fixture()
def pages(spark):
    path = fresh_folder(spark, "tests", "pages")
    spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, refers_to string") \
        .repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def expected(rows, least=0):
    groups = defaultdict(list)
    for i, _, h in rows:
        if i is not None:
            groups[h or ""].append(i)
    out, seen = [], set()
    for i, _, h in rows:
        b = (h or "").encode()
        first = min(groups[h or ""]) if i is not None and len(b) >= least else i
        again = i is not None and len(b) >= least and (i != first or (i, h) in seen)
        seen.add((i, h))
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    assert sorted(map(tuple, X.op9_warc(spark, pages).collect()), key=str) == expected(ROWS)


def test_payloads_and_headers_come_back(spark, pages):
    folder = X.write_archives(pages)
    got = X.read_archives(spark, folder, True).collect()
    for r in got:
        html = [h or "" for i, u, h in ROWS if i == r.page_id and u == r.target_uri]
        if r.record_type == "response":
            assert r.payload.decode() in html
        else:
            assert r.payload == b"" and r.payload_length == len(html[0].encode())


def test_very_long_urls(spark):
    import random
    rng = random.Random(1)
    mixed = "".join(rng.choice("abcdefghijklmnop0123456789") for _ in range(100_000))
    rows = [(1, "http://a/" + "x" * 100_000, "<p>one</p>"), (2, "http://b/" + "y" * 100_000, "<p>one</p>"),
            (3, "http://c/" + mixed, "<p>two</p>"), (4, "http://d/" + mixed, "<p>two</p>"), (5, "u" * 8_100, "three")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_folder(spark, "tests", "long")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    assert sorted(map(tuple, X.op9_warc(spark, df).collect()), key=str) == expected(rows)
    for r in X.read_archives(spark, X.write_archives(df), True).collect():
        assert (int(r.page_id), r.target_uri) in [(i, u) for i, u, _ in rows]


def test_least_bytes(spark, pages):
    folder = X.write_archives(pages, least=5)
    got = X.read_archives(spark, folder, False, {"record_type": "revisit"}).collect()
    assert sorted(r.page_id for r in got) == [3, 4]


def test_filters_are_pushed_and_payloads_skipped(spark, pages, monkeypatch):
    folder = X.write_archives(pages)
    df = X.read_archives(spark, folder, False, {"record_type": "revisit"})
    assert "payload" not in df.columns
    assert "(record_type" not in df._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0] \
        .replace("isnotnull(record_type", "")
    reader = X.WarcReader({"path": folder}, [("page_id", X.pa.int64())])
    left = list(reader.pushFilters([X.EqualTo(("record_type",), "response"), X.EqualTo(("other",), 1),
                                    X.In(("page_id",), (9, 11))]))
    assert left == [X.EqualTo(("other",), 1)]
    inflated = []
    monkeypatch.setattr(X.zlib, "decompressobj", _counting(X.zlib.decompressobj, inflated))
    ids = [i for p in reader.partitions() for b in reader.read(p) for i in b.column(0).to_pylist()]
    assert sorted(ids) == [9, 11]
    assert max(inflated) <= 8192  # no payload was inflated


def _counting(make, seen):
    class Wrapped:
        def __init__(self, *a):
            self.inner = make(*a)

        def decompress(self, *a):
            out = self.inner.decompress(*a)
            seen.append(len(out))
            return out

        @property
        def unconsumed_tail(self):
            return self.inner.unconsumed_tail
    return Wrapped


def test_any_gzip_reader_can_read_the_archive(spark, pages):
    folder = X.write_archives(pages).removeprefix("file:")
    import pathlib
    text = b"".join(gzip.decompress(p.read_bytes()) for p in pathlib.Path(folder).glob("*.warc.gz"))
    assert text.count(b"WARC-Record-ID") == len(ROWS)


def test_many_files_and_no_rows(spark, pages, monkeypatch):
    monkeypatch.setattr(X, "FILE_RECORDS", 2)
    monkeypatch.setattr(X, "PARTITION_BYTES", 1)
    assert sorted(map(tuple, X.op9_warc(spark, pages).collect()), key=str) == expected(ROWS)
    folder = X.write_archives(pages.limit(0))
    assert X.op9_warc(spark, pages.limit(0)).count() == 0 and folder


def foreign(kind, uri, block, content_type="text/html", extra=()):
    lines = ["WARC/1.0", f"warc-type: {kind}", f"WARC-Target-URI:  <{uri}>", "WARC-Record-ID: <urn:uuid:1>",
             "X-Note: folded", "  over two lines", f"Content-Type: {content_type}", *extra,
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def foreign_records():
    import os
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    noise = os.urandom(300_000)
    rows = [("warcinfo", "http://x/0", b"software: other\r\n", b"software: other\r\n", "application/warc-fields"),
            ("response", "http://x/1?a=%25%0A", http + b"<p>one</p>", b"<p>one</p>", "application/http; msgtype=response"),
            ("resource", "http://x/2", noise, noise, "image/png"),
            ("response", "http://x/3", http + b"z" * 3_000_000, b"z" * 3_000_000, "application/http"),
            ("resource", "http://x/4", b"", b"", "text/plain"), ("resource", "http://x/5", b"end", b"end", "text/plain")]
    return [foreign(k, u, b, c) for k, u, b, _, c in rows], [(k, u, p) for k, u, _, p, _ in rows]


@pytest.mark.parametrize("form", ["member_each", "one_member", "plain", "padded", "named"])
def test_archives_of_others(spark, tmp_path, form):
    import io
    blocks, want = foreign_records()
    if form == "plain":
        (tmp_path / "a.warc").write_bytes(b"".join(blocks))
    elif form == "named":
        out = io.BytesIO()
        for b in blocks:
            with gzip.GzipFile("some-name.warc", "wb", fileobj=out) as g:
                g.write(b)
        (tmp_path / "a.warc.gz").write_bytes(out.getvalue())
    else:
        parts = [gzip.compress(b"".join(blocks))] if form == "one_member" else list(map(gzip.compress, blocks))
        (tmp_path / "a.warc.gz").write_bytes((b"\0" * (70_000 if form == "padded" else 0)).join(parts))
    folder = f"file://{tmp_path}"
    got = X.read_archives(spark, folder, True).collect()
    assert [(r.record_type, r.target_uri, bytes(r.payload)) for r in got] == want
    assert all(r.page_id is None and r.payload_digest is None and r.record_id == "<urn:uuid:1>" for r in got)
    some = X.read_archives(spark, folder, True, {"record_type": "resource"}).collect()
    assert [bytes(r.payload) for r in some] == [p for k, _, p in want if k == "resource"]
    assert X.read_archives(spark, folder).where("record_type = 'response'").count() == 2


def test_own_and_foreign_members_in_one_file(spark, tmp_path):
    blocks, want = foreign_records()
    own = X.record(5, "http://own/%", b"<p>own</p>", X.base32_sha1(b"<p>own</p>"), None)
    (tmp_path / "a.warc.gz").write_bytes(own + b"".join(map(gzip.compress, blocks)) + own)
    got = X.read_archives(spark, f"file://{tmp_path}", True).collect()
    mine = ("response", "http://own/%", b"<p>own</p>")
    assert [(r.record_type, r.target_uri, bytes(r.payload)) for r in got] == [mine, *want, mine]
    assert [r.page_id for r in got if r.page_id] == [5, 5]


def test_damaged_archives_are_named(spark, tmp_path):
    blocks, _ = foreign_records()
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(blocks[2])[:-50_000])
    with pytest.raises(Exception, match="cut.warc.gz"):
        X.read_archives(spark, f"file://{tmp_path}", True).collect()


def test_string_ids(spark):
    rows = [("b", "u1", "same"), ("a%0A\nx", "u2", "same"), ("c", "u3", "other"), (None, "u4", "same"), ("7", "u5", "x")]
    path = fresh_folder(spark, "tests", "pages")
    spark.createDataFrame(rows, "page_id string, url string, html string").write.parquet(path)
    got = sorted(map(tuple, X.op9_warc(spark, spark.read.parquet(path)).collect()), key=str)
    assert got == expected(rows)

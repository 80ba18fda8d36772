import base64
import contextlib
import gzip
import hashlib
import html
import random
import re
import signal
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from adlake.llm import warc as W
from adlake.llm.common import table

PAGES = [
    (0, "http://a.example/x?y=1", '<!DOCTYPE html><html lang="fr"><head><title>A &amp; b</title><style>p{}</style><script>var t="</p>";</script></head><body><!-- c --><p>One <b>two</b><br>three &lt;4&gt;</p><a href="/l">l</a></body></html>'),
    (1, None, None),
    (2, "http://b.example/", ""),
    (2, "http://b.example/", ""),
    (3, "http://c.example/", "no markup 1 < 2 &#233; \r\n\r\n WARC/1.1 " + "x" * 100_000),
    (4, "http://d.example/", "a block that holds\r\n\r\nWARC/1.1\r\nits own record's end\r\n\r\nWARC/1.1\r\n"),
    (None, "u", "<p>é🙂"),
]


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_and_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, content string")
    built = W.build(pages)
    rows = built.collect()
    assert len(rows) == 2 * len(PAGES) and built.columns == [c.split()[0] for c in W.RECORDS.split(", ")]
    by = {(r.page_id, r.record_type): r for r in rows}
    assert by[0, "conversion"].content == "One two\nthree <4>\nl"
    assert "title: A & b\r\n" in by[0, "metadata"].content and "language: fr\r\n" in by[0, "metadata"].content and "outlinks: 1\r\n" in by[0, "metadata"].content
    assert by[1, "conversion"].content == "" and "WARC-Target-URI" not in by[1, "conversion"].header
    for r in rows:
        data = r.content.encode()
        assert r.content_length == len(data) and r.block_digest == sha1(data) and r.digest_check == "match"
        assert f"WARC-Refers-To: {r.refers_to}" in r.header and r.refers_to == by[r.page_id, "metadata"].refers_to
    assert sorted(W.convert(W.responses(pages)).collect(), key=str) == sorted(rows, key=str)
    for compression, glob in (("none", "*.txt"), ("gzip", "*.gz")):
        W.write(built, str(tmp_path / compression), compression)
        back = W.read(spark, str(tmp_path / compression), glob).collect()
        assert {r.block_check for r in back} == {"match"}
        want = sorted((r.record_type, r.record_id, r.refers_to, r.target_uri or "", r.block_digest, r.content.encode()) for r in rows)
        assert sorted((r.record_type, r.record_id, r.refers_to, r.target_uri or "", r.block_digest, bytes(r.block)) for r in back) == want


def test_responses_keep_their_headers(spark, tmp_path):
    """Response records through files and back: same derivatives; their own dates, heads and digests are kept and checked."""
    zipped = gzip.compress(b"<p>packed text</p>", mtime=0)
    chunked = b"5\r\n<p>ch\r\n8\r\nunks</p>\r\n0\r\n\r\n"
    latin = "<p>café</p>".encode("latin-1")
    rows = [
        (None, "response", "<urn:uuid:1>", "http://x.example/", "2021-05-06T07:08:09Z", "application/http; msgtype=response", sha1(zipped), b"HTTP/1.1 200 OK\r\nServer: one\r\nX-Long: a\r\n b\r\nContent-Type: text/html\r\nContent-Encoding: gzip\r\n\r\n" + zipped),
        (None, "response", "<urn:uuid:2>", "http://y.example/", "2022-05-06T07:08:09Z", "application/http; msgtype=response", "sha1:WRONG", b"HTTP/1.1 404 Not Found\r\nTransfer-Encoding: chunked\r\nContent-Type: text/html\r\n\r\n" + chunked),
        (None, "response", "<urn:uuid:3>", None, "2023-05-06T07:08:09Z", "application/http; msgtype=response", None, b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG\r\n\x00"),
        (None, "resource", "<urn:uuid:4>", "urn:r", "2023-05-06T07:08:10Z", "text/html; charset=iso-8859-1", None, latin),
        (None, "response", "<urn:uuid:5>", "urn:b", "2023-05-06T07:08:10Z", "application/http; msgtype=response", None, b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nContent-Type: text/plain\r\n\r\nnot <b>packed"),
        (None, "response", "<urn:uuid:6>", "urn:c", "2023-05-06T07:08:10Z", "application/http; msgtype=response", None, None),
    ]
    records = spark.createDataFrame(rows, W.RESPONSE)
    derived = W.convert(records).collect()
    by = {(r.refers_to, r.record_type): r for r in derived}
    assert len(derived) == 11 and ("<urn:uuid:3>", "conversion") not in by
    one = by["<urn:uuid:1>", "metadata"]
    assert one.warc_date == "2021-05-06T07:08:09Z" and "WARC-Refers-To-Date: 2021-05-06T07:08:09Z" in one.header
    assert one.content.startswith("source-status: 200\r\nsource-header-server: one\r\nsource-header-x-long: a b\r\n") and f"source-payload-digest: {sha1(zipped)}\r\n" in one.content
    assert [by[f"<urn:uuid:{k}>", "conversion"].content for k in (1, 2, 4, 5, 6)] == ["packed text", "chunks", "café", "not <b>packed", ""]
    assert [by[f"<urn:uuid:{k}>", "metadata"].digest_check for k in (1, 2, 3)] == ["match", "mismatch", "absent"]
    assert "source-status: 404\r\n" in by["<urn:uuid:2>", "metadata"].content
    # records without text beyond UTF-8 pass through Spark's text sink unchanged
    W.write(records.where("record_id = '<urn:uuid:2>'"), str(tmp_path / "w"))
    again = W.convert(W.responses_in(W.read(spark, str(tmp_path / "w"), "*.txt"))).collect()
    assert sorted(again) == sorted(r for r in derived if r.refers_to == "<urn:uuid:2>")


def test_files_of_other_writers(spark, tmp_path):
    """Records one by one in gzip members, as crawlers write them, with binary blocks."""
    records = []
    for k in range(5):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + bytes([0xE9, 0xFF]) + b"<p>t%d" % k
        records.append(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nWARC-Block-Digest: %s\r\nContent-Length: %d\r\n\r\n" % (k, sha1(block).encode(), len(block)) + block + b"\r\n\r\n")
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    for name in ("a.warc.gz", "b.warc"):
        back = W.read(spark, str(tmp_path / name))
        assert sorted((r.record_id, r.block_check) for r in back.collect()) == [(f"<urn:x:{k}>", "match") for k in range(5)]
        assert sorted(r.content[-2:] for r in W.convert(W.responses_in(back)).where("record_type = 'conversion'").collect()) == [f"t{k}" for k in range(5)]


class Plain(HTMLParser):
    """Another text extraction, over the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out, self.skip = [], None

    def handle_starttag(self, tag, attrs):
        if self.skip is None and tag in W._DROPPED:
            self.skip = tag
            self.out.append(" ")
        elif self.skip is None and tag in W._BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if self.skip == tag:
            self.skip = None
        elif self.skip is None and tag in W._BLOCKS:
            self.out.append("\n")

    def handle_comment(self, data):
        if self.skip is None:
            self.out.append(" ")

    def handle_data(self, data):
        if self.skip is None:
            self.out.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def other_text(page):
    p = Plain()
    p.feed(page)
    p.close()
    t = html.unescape("".join(p.out)).replace("\r", "\n")
    return re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[^\S\n]+", " ", t)).strip()


def test_text_equals_another_extraction(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: r.html or "" for r in pages.collect()}
    got = {(r.page_id, r.record_type): r for r in W.build(pages).collect()}
    assert len(got) == 2 * len(want)
    for k, page in want.items():
        r = got[k, "conversion"]
        assert r.content == other_text(page)
        assert r.block_digest == sha1(r.content.encode()) and r.source_digest == sha1(page.encode())
        assert f"outlinks: {len(re.findall('<a [^>]*href', page))}\r\n" in got[k, "metadata"].content


def test_malformed_pages_take_linear_time():
    for piece in ("<a ", "<!--", "<title>", "<script>", "<script></scriptx", "<", "<!-- -", "</title", "<p <", "<a href=", "&", "<html lang"):
        page = piece * (1_000_000 // len(piece))
        for p in (page, page + ">"):
            at = time.time()
            W.scan(p)
            assert time.time() - at < 1.5, piece
    assert W.scan("a <b") == ("a <b", None, None, 0) and W.scan("<script>x<p>y")[0] == "x\ny" and W.scan("1 <- 2 <!-- z <i>w")[0] == "1 <- 2 w"


def test_empty_table(spark):
    assert W.build(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert W.convert(spark.createDataFrame([], W.RESPONSE).withColumn("header", F.lit("x"))).count() == 0


@contextlib.contextmanager
def within(seconds):
    """A hang is a failure."""
    def late(*_):
        raise AssertionError("too slow")

    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(seconds)
    try:
        yield
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)


def block(head, body):
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n" + head + b"\r\n\r\n" + body


def text_of(head, body, record_id="<urn:uuid:1>"):
    found = W.derive(None, "response", record_id, "u", "d", "application/http; msgtype=response", None, block(head, body))
    return next(r for r in found if r["record_type"] == "conversion")["content"]


def test_broken_chunk_sizes_leave_the_bytes():
    with within(10):
        for size in (b"-a", b"-1", b"+5", b"0x5", b"5_0", b"", b" ", b"zz", b"FFFFFFFFFFFFFFFFFFFF", b"7fffffff", b"-0", b";"):
            for rest in (b"\r\n", b"\r\nhello\r\n0\r\n\r\n"):
                assert text_of(b"Transfer-Encoding: chunked", size + rest) == (size + rest).decode().replace("\r\n", "\r\n")
        assert text_of(b"Transfer-Encoding: chunked", b" 5 ;x=y\r\nhello\r\n0\r\n\r\n") == "hello"


def test_fuzzed_responses_end_and_lose_nothing():
    r = random.Random(8)
    tokens = [b"\r\n", b"\n", b"0", b"5", b"-a", b"ff", b";", b":", b" ", b"HTTP/1.1", b"200", b"Transfer-Encoding: chunked", b"Content-Encoding: gzip", b"Content-Encoding: deflate", b"Content-Type: text/html; charset=", b"utf-8", b"x-none", b"<p>", b"<a href=", b"\xff\x00", gzip.compress(b"zip"), b"hello"]
    with within(60):
        for _ in range(3000):
            data = b"".join(r.choices(tokens, k=r.randrange(30)))
            rows = W.derive(1, "response", "<i>", "u", None, "application/http; msgtype=response", None, data)
            assert rows[0]["record_type"] == "metadata" and rows[0]["source_digest"] == sha1(data.partition(b"\r\n\r\n")[2])
            W._record(b"WARC/1.0\r\n" + data)


def test_compression_is_bounded(monkeypatch):
    monkeypatch.setattr(W, "MOST_UNPACKED", 1000)
    two = gzip.compress(b"a" * 400) + gzip.compress(b"b" * 600)
    assert text_of(b"Content-Encoding: gzip", two) == "a" * 400 + "b" * 600
    over = gzip.compress(b"a" * 1001)
    assert text_of(b"Content-Encoding: gzip", over) == over.decode("utf-8", "replace")
    cut = gzip.compress(b"abc")[:-3]
    assert text_of(b"Content-Encoding: gzip", cut) == cut.decode("utf-8", "replace")


def test_content_length_that_is_no_number(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>t"
    lengths = [b"abc", b"-5", b"", b"9" * 40, b"%d" % len(body)]
    (tmp_path / "a.warc").write_bytes(b"".join(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: %s\r\n\r\n" % (k, n) + body + b"\r\n\r\n" for k, n in enumerate(lengths)))
    back = W.read(spark, str(tmp_path / "a.warc")).collect()
    assert [bytes(r.block).strip() for r in sorted(back)] == [body] * len(lengths)


def test_responses_without_an_identifier_are_told_apart():
    ids = set()
    for uri, date, body in (("u", "d", b"one"), ("v", "d", b"one"), ("u", "e", b"one"), ("u", "d", b"two")):
        for row in W.derive(None, "response", None, uri, date, "application/http", None, block(b"X: y", body)):
            assert row["refers_to"] is None and "WARC-Refers-To:" not in row["header"]
            ids.add(row["record_id"])
    assert len(ids) == 8

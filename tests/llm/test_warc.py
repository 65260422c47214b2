import base64
import gzip
import hashlib
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

from parcelkit.llm import queries, warc
from tests.conftest import SF_SMALL


class Plain(HTMLParser):
    """Independent extraction with the standard parser."""

    def __init__(self, base):
        super().__init__(convert_charrefs=True)
        self.base, self.out, self.title, self.links, self.skip, self.in_title = base, [], [], [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag in warc.HIDDEN.split("|"):
            self.skip += 1
        self.in_title = tag == "title"
        if tag in warc.LINE_ENDS:
            self.out.append("\n")
        href = dict(attrs).get("href")
        if tag in ("a", "area") and href and href.strip():
            self.links.append(urljoin(self.base, href.strip()))

    def handle_endtag(self, tag):
        if tag in warc.HIDDEN.split("|"):
            self.skip = max(0, self.skip - 1)
        if tag == "title":
            self.in_title = False
        if tag in warc.LINE_ENDS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            (self.title if self.in_title else self.out).append(data)

    def text(self):
        lines = (" ".join(x.split()) for x in "".join(self.out).replace("\r", "\n").split("\n"))
        return "\n".join(x for x in lines if x)


def check(rows, pages):
    by = {(r.refers_to, r.record_type): r for r in rows}
    assert len(rows) == 2 * len(pages)
    for p in pages:
        payload = (p.html or "").encode()
        pd = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        meta, conv = by[p.record_id, "metadata"], by[p.record_id, "conversion"]
        plain = Plain(p.url or "")
        plain.feed(p.html or "")
        plain.close()
        assert bytes(conv.block).decode() == plain.text()
        lines = bytes(meta.block).decode().split("\r\n")
        assert [x[9:] for x in lines if x.startswith("outlink: ")] == [" ".join(x.split()) for x in plain.links]
        assert f"source-payload-digest: {pd}" in lines and "source-status: HTTP/1.1 200 OK" in lines
        assert f"source-header: Content-Length: {len(payload)}" in lines
        title = " ".join("".join(plain.title).split())
        assert [x for x in lines if x.startswith("title: ")] == ([f"title: {title}"] if title else [])
        for r in (meta, conv):
            fields, block = next(warc.parse(warc.serialise(r.header, bytes(r.block))))
            assert fields["warc-refers-to"] == p.record_id and block == bytes(r.block)
            assert fields.get("warc-target-uri", "") == " ".join((p.url or "").split()) and fields["warc-date"] == warc.DATE
            assert fields["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert r.payload_digest == pd and r.page_id == p.page_id and r.content_length == len(block)
        assert meta.record_id != conv.record_id and f"WARC-Concurrent-To: {meta.record_id}" in conv.header


def source(df):
    from pyspark.sql import functions as F
    r = warc.responses(df)
    return [x for x in r.select("page_id", "record_id", F.col("target_uri").alias("url"),
                                F.decode("payload", "UTF-8").alias("html")).collect()]


def test_query_equals_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    check(queries.op9_warc(spark, SF_SMALL).collect(), source(pages))


def test_odd_pages(spark):
    rows = [(1, "http://a/b", "<p>x&amp;y<br>z<!-- no --><a href='c'>l</a><a href=>e</a>", "h"), (2, None, None, None),
            (3, "", "", ""), (None, "http://a", "<title>t &lt; u</title><b>bold</b> text", "h"),
            (4, "http://a", "<div>" * 30000 + "deep" + "word " * 20000, "h"),
            (5, "http://a/\nb", "plain only &copy; 2 < 3", "h"), (6, "http://a", "<script>var a='</p>'</script>after", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    check(warc.build(warc.responses(df)).collect(), source(df))
    assert warc.build(warc.responses(df.limit(0))).count() == 0
    twice = warc.build(warc.responses(df.unionAll(df))).collect()
    assert len(twice) == 4 * len(rows) and len({r.record_id for r in twice}) == 2 * len(rows)


def test_broken_markup_is_linear():
    for bad in ("<" * 200000, "<a href=\"" * 40000, "<!--" * 50000, "<script>" * 30000, "<p '" * 50000):
        began = time.time()
        warc.parse_html(bad, "http://a")
        assert time.time() - began < 5


def test_archives_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    records = warc.build(warc.responses(pages))
    want = sorted((r.record_id, bytes(r.block)) for r in records.collect())
    got = []
    for a in warc.archives(records, 20000).collect():
        found = list(warc.parse(bytes(a.content)))
        assert len(found) == a.records
        got += [(f["warc-record-id"], b) for f, b in found]
    assert sorted(got) == want
    body = b"<html lang=en><title>T</title><p>Hi <a href=/x>l</a></html>"
    block = b"HTTP/1.1 200 OK\r\nServer: s\r\nContent-Type: text/html; charset=latin-1\r\n\r\n" + body
    head = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Date: 2020-02-02T00:00:00Z\r\n"
            f"WARC-Target-URI: http://h/p\r\nContent-Length: {len(block)}\r\n\r\n")
    info = "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n"
    data = warc.serialise(info, b"") + warc.serialise(head, block)
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(warc.serialise(info, b"")) + gzip.compress(warc.serialise(head, block)))
    rows = warc.build(warc.read_warc(spark, str(tmp_path))).collect()
    assert len(rows) == 4
    for r in rows:
        assert (r.refers_to, r.target_uri, r.date) == ("<urn:uuid:1>", "http://h/p", "2020-02-02T00:00:00Z")
        if r.record_type == "conversion":
            assert bytes(r.block) == b"Hi l"
        else:
            lines = bytes(r.block).decode().split("\r\n")
            assert {"source-header: Server: s", "title: T", "language: en", "outlink: http://h/x"} <= set(lines)


def test_long_values_and_hidden_elements_without_end(spark):
    inner = "<b>" + "y" * 3000 + "</b>"
    alike = [f'<p>one</p><a data-x="{inner}" href="/z">l</a> two', f"<a onclick='{inner}' href=/z>l</a><p>two",
             '<p>one</p><svg class="i"/><p>two <a href="/x">l</a></p>', "<svg/>a<svg>no</svg>b<script src='x'/>c",
             "<p>a</p><script>var b = '<p>c</p>'; <a href=d>", "<svg-icon>a</svg-icon><template-card>b <a href=c>d</a>",
             "<a href=/s?q=\"x>one</a><p title=\"y\">two", f"<iframe srcdoc=\"{inner * 3}\"></iframe>after"]
    rows = [(i, "http://a/b", x) for i, x in enumerate(alike)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    check(warc.build(warc.responses(df)).collect(), source(df))
    for name in ("svg", "noscript", "template", "iframe"):
        text, _, _, _, links = warc.parse_html(f"<p>one</p><{name} class=i><p>two <a href='/x'>l</a><{name}>", "http://a")
        assert (text, links) == ("one\ntwo l", ["http://a/x"])


def test_broken_quotes_and_hidden_elements_are_linear():
    for bad in ("<a href=\"" * 40000 + ">", "<a b='" * 40001 + ">\"", "<svg>" * 60000, "<a x=\"'" * 40000 + "'>",
                "<noscript><svg>" * 30000, "<a<a" * 50000 + "=\">\"", "<a " + "= " * 100000 + ">", "<svg x=/>" * 40000,
                "<a " + "y" * 200000 + ">"):
        began = time.time()
        warc.parse_html(bad, "http://a")
        assert time.time() - began < 5

"""WARC derivative builder: metadata and plain-text conversion records of responses.

A response record has an id, a target URI, a date, the source's HTTP header
block and a payload.  From each come two records that refer to it:

* ``metadata`` (application/warc-fields): the source headers, the payload
  digest, title, language, robots rule and every outgoing link as an absolute URI;
* ``conversion`` (text/plain): the page's text, one line per block element.

Both carry ``WARC-Refers-To`` (the response's id), ``WARC-Target-URI`` and
``WARC-Date`` of the source, digests of their own block and of the source's
payload, and ``WARC-Concurrent-To`` links the conversion to its metadata.
Record ids are UUIDs made from the response's id and the record type, so a
repeated run or a recomputed task gives the same ids.

The work is one scan without a shuffle.  ``read_warc`` reads WARC files (plain
or gzipped by record) into response rows, ``responses`` makes them from a
table of pages, ``serialise`` gives a record's bytes and ``write_warc`` packs
derivative records into gzipped archives of bounded size.

A null URI or payload is empty; an empty payload gives an empty text and no
links; a null page id stays null.  Repeated rows give repeated records with
equal ids.  An empty table gives an empty result; columns that are not named
are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, steady

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 32 << 20
RESPONSE = "page_id long, record_id string, target_uri string, date string, http_header string, payload binary"
RECORD = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, content_length long, block_digest string, payload_digest string, n_links long, "
          "header string, block binary")
NAMES = [x.split()[0] for x in RECORD.split(", ")]

# Elements whose content is not text, and elements that end a line.
HIDDEN = "script|style|noscript|template|svg|iframe"
LINE_ENDS = frozenset("""address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2
h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td th thead title tr ul""".split())
# Their content is never markup: without an end tag it goes on to the end of the page.  The others without one are empty.
RAW = frozenset(("script", "style"))
# A tag's rest.  Every character is taken once: pages are searched up to their last ">", before which every quote that
# is looked for ends, so a tag that begins also ends, and only the last quote of a kind is looked for in vain.
REST = r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=\s*+(?P<bare>[^\s\"'>][^\s>]*+)|=)*+"
MARKUP = re.compile(
    rf"<!--(?:(?!-->).)*+(?:-->|\Z)|<[!?][^>]*+>?|<(?P<close>/?)(?P<name>[a-z][^\s/>=]*+)(?P<rest>{REST})>", re.S | re.I)
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN.split("|")}
ATTRIBUTE = re.compile(
    r"(?<![^\s=\"'/>])([^\s=\"'/>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
BLANK = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[ \n]*")


def parse_html(source: str, base: str) -> tuple[str, str, str, str, list[str]]:
    """Text, title, language, robots rule and absolute links of a page."""
    out, title, lang, robots, links = [], [], "", "", []
    at, in_title, stop = 0, False, source.rfind(">") + 1   # nothing is a tag beyond the last bracket
    endless = set()                                        # hidden elements that have no end tag any more
    while m := MARKUP.search(source, at, stop):
        if m.start() > at:
            (title if in_title else out).append(source[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in ENDS and not m["close"]:
            closed = m["rest"].endswith("/") and m.end("bare") != m.end("rest")
            if not closed and name not in endless:
                end = ENDS[name].search(source, at, stop)
                if end:
                    at = end.start()
                elif name in RAW:
                    at = len(source)
                else:
                    endless.add(name)
            continue
        if name == "title":
            in_title = not m["close"]
        if name in LINE_ENDS:
            out.append("\n")
        if m["rest"] and not m["close"] and name in ("html", "a", "area", "meta", "base"):
            got = {k.lower(): html.unescape(a or b or c) for k, a, b, c in reversed(ATTRIBUTE.findall(m["rest"]))}
            if name == "html":
                lang = got.get("lang", lang)
            elif name == "meta" and got.get("name", "").lower() == "robots":
                robots = got.get("content", robots)
            elif name == "base":
                base = _join(base, got.get("href", ""))
            elif got.get("href", "").strip():
                links.append(_join(base, got["href"].strip()))
    if at < len(source):
        (title if in_title else out).append(source[at:])
    text = LINES.sub("\n", BLANK.sub(" ", html.unescape("".join(out)).replace("\r", "\n"))).strip()
    return text, " ".join(html.unescape("".join(title)).split()), lang, robots, links


def _join(base: str, href: str) -> str:
    try:
        return urljoin(base, href)
    except ValueError:
        return href


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}>"


def one_line(value: str) -> str:
    return " ".join(value.split())


def _record(page_id, kind, record_id, refers_to, uri, date, content_type, block, payload_digest, n_links, more=()):
    own = digest(block)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", one_line(uri)),
              ("WARC-Refers-To", refers_to), *more, ("WARC-Block-Digest", own),
              ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    header = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v) + "\r\n"
    return (page_id, kind, record_id, refers_to, uri, date, content_type, len(block), own, payload_digest, n_links,
            header, block)


def derivatives(page_id, record_id: str, uri: str, date: str, http_header: str, payload: bytes) -> list[tuple]:
    """The metadata and the conversion record of one response, as rows of ``RECORD``."""
    found = CHARSET.search(http_header) or CHARSET.search(payload[:2048].decode("latin-1"))
    try:
        source = payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        source = payload.decode("utf-8", "replace")
    text, title, lang, robots, links = parse_html(source, uri)
    payload_digest = digest(payload)
    head = [x for x in http_header.replace("\r", "").split("\n") if x.strip()]
    fields = [("source-status", head[0] if head else ""), *(("source-header", one_line(x)) for x in head[1:]),
              ("source-payload-digest", payload_digest), ("title", title), ("language", one_line(lang)),
              ("robots", one_line(robots)), *(("outlink", one_line(x)) for x in links)]
    block = "".join(f"{k}: {v}\r\n" for k, v in fields if v).encode("utf-8", "replace")
    meta = derived_id(record_id, "metadata")
    return [_record(page_id, "metadata", meta, record_id, uri, date, "application/warc-fields", block, payload_digest,
                    len(links)),
            _record(page_id, "conversion", derived_id(record_id, "conversion"), record_id, uri, date,
                    "text/plain; charset=utf-8", text.encode("utf-8", "replace"), payload_digest, len(links),
                    [("WARC-Concurrent-To", meta), ("WARC-Source-Payload-Digest", payload_digest)])]


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html",
              date: str = DATE) -> DataFrame:
    """Response rows (``RESPONSE``) of a table of pages; ids are made from page id, URI and payload."""
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    uri = F.coalesce(F.col(url), F.lit(""))
    h = F.md5(F.concat(F.coalesce(F.col(page_id).cast("string"), F.lit("")).cast("binary"), F.lit(b"\n"),
                       uri.cast("binary"), F.lit(b"\n"), payload))
    record_id = F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                                for x in (F.substring(h, a, n), F.lit("-"))][:-1], F.lit(">"))
    header = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                      F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(page_id).cast("long").alias("page_id"), record_id.alias("record_id"),
                        uri.alias("target_uri"), F.lit(date).alias("date"), header.alias("http_header"),
                        payload.alias("payload"))


def build(source: DataFrame) -> DataFrame:
    """Two derivative records (``RECORD``) of each response row."""
    prepare(source.sparkSession)

    @steady
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            rows = [x for r in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in derivatives(
                r[0], *("" if v is None else v for v in r[1:5]), r[5] or b"")]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    return source.select("page_id", "record_id", "target_uri", "date", "http_header", "payload").mapInArrow(run, RECORD)


def serialise(header: str, block: bytes) -> bytes:
    return header.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a WARC file, gzipped by record or plain."""
    if data[:2] == b"\x1f\x8b":
        plain = []
        while data[:2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            plain.append(member.decompress(data) + member.flush())
            data = member.unused_data
        data = b"".join(plain)
    at = data.find(b"WARC/")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields.get("content-length") or 0)
        yield fields, data[end + 4:end + 4 + size]
        at = data.find(b"WARC/", end + 4 + size)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response rows of the WARC files at ``path``; the page id is the record's number in its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for number, (fields, block) in enumerate(parse(data.as_py())):
                    if fields.get("warc-type") == "response":
                        head, _, body = block.partition(b"\r\n\r\n")
                        rows.append((number, fields.get("warc-record-id"), fields.get("warc-target-uri"),
                                     fields.get("warc-date"), head.decode("latin-1"), body))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 4, pa.binary()), strict=True)],
                    names=[x.split()[0] for x in RESPONSE.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RESPONSE)


def archives(records: DataFrame, most: int = ARCHIVE_BYTES) -> DataFrame:
    """records, content: gzipped WARC files of about ``most`` bytes, each record a member of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            return pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                                              names=["records", "content"])
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for header, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                member = gzip.compress(serialise(header, block), mtime=0)
                if held and size + len(member) > most:
                    yield out(held)
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield out(held)

    return records.select("header", "block").mapInArrow(run, "records long, content binary")

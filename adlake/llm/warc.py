"""Operator 4: WARC derivative builder.

Every response record (identifier, target URI, date, HTTP head and body) gives two linked records: `metadata` (the source's status, headers
and digests as they came, and what was found in the page, as warc-fields) and `conversion` (the page's plain text). Both name the
response in WARC-Refers-To and keep its target URI and date; all blocks carry SHA-1 digests in base 32. A payload digest that the source gives is
checked against its bytes and kept. Identifiers are name-based UUIDs of the response's own, so a retried task writes the same records. One pass, no
exchange; a task holds one batch of about 8 MB of responses (a longer one alone).

`read` takes WARC files, plain (split by Spark at record ends) or gzipped (a file is one task's stream), and `responses_in` their
response and resource records. `responses` makes such records of a table of pages (page_id, url, html), whose crawl left no head and no date: both are
parameters. `write` sends records through Spark's text sink, whose line separator is the blank lines that end a record.

Markup is scanned once, forwards: closers are looked up in lists made once, so unclosed openers cost no second scan.

Cases: a null block or HTML is an empty payload with an empty conversion; a null URI leaves the target header out; equal rows with an equal
page_id give equal records; a payload that is no text (by its content type) has a metadata record only; a head without an end is all head; broken chunks or
compression leave the bytes as they are, and so does compression that unpacks to more than MOST_UNPACKED bytes; a record without an identifier refers to
nothing, and its derivatives are named by its URI, date and block; a Content-Length that is no whole number is as good as none; very long pages are one
record; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import codecs
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_batches, pieces

RECORDS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "block_digest string, source_digest string, digest_check string, content_length long, header string, content string"
)
#: The version line, and the end of a record.
VERSION, END = "WARC/1.1", "\r\n\r\n"
RESPONSE = "page_id long, record_type string, record_id string, target_uri string, warc_date string, content_type string, payload_digest string, block binary"
#: The head that stands for the one a table of pages doesn't have.
PAGE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
#: No page unpacks to more; one packed to do so would else take a worker's memory.
MOST_UNPACKED = 256 << 20
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_DROPPED = ("script", "style", "noscript", "template", "svg", "title")
_BLOCKS = "br hr p div article section header footer nav main aside ul ol li dl dt dd table tr td th h1 h2 h3 h4 h5 h6 pre blockquote form figure body head html".split()
_OPENER = re.compile(rf"<!--|<({'|'.join(_DROPPED)})(?=[\s/>])", re.I)
_CLOSER = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _DROPPED}
_BLOCK = re.compile(rf"</?(?:{'|'.join(_BLOCKS)})(?=[\s/>])[^>]*+>", re.I)
_TAG, _ANCHOR, _HTML = re.compile(r"<[/!?A-Za-z][^>]*+>"), re.compile(r"<a\s[^>]*+>", re.I), re.compile(r"<html\s[^>]*+>", re.I)
_LANG = re.compile(r"\slang\s*+=\s*+[\"']?([A-Za-z-]+)", re.I)
_HREF = re.compile(r"\shref\s*+=\s*+[\"']?([^\"'\s>]+)", re.I)
_SPACES, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")


def scan(page: str) -> tuple[str, str | None, str | None, int]:
    """(text, title, language, links) of a page: markup, comments and code dropped, blocks on lines of their own, entities decoded last. What
    opens and never closes is only its tag; a '<' that no '>' follows is text. Every pattern is tried before the last '>' only, where it
    must succeed, so no part is read again and again."""
    last, parts, at = page.rfind(">") + 1, [], 0
    closers: dict[str, list[int]] = {}
    comment_end = page.rfind("-->", 0, last)
    title = None
    while opener := _OPENER.search(page, at, last):
        here, tag = opener.start(), (opener[1] or "").lower()
        if not tag:
            end = page.find("-->", here + 4) + 3 if comment_end >= here + 4 else 0
        else:
            if tag not in closers:
                closers[tag] = [m.start() for m in _CLOSER[tag].finditer(page, 0, last)]
            begin = page.find(">", here) + 1
            k = bisect.bisect_left(closers[tag], begin)
            end = page.find(">", closers[tag][k]) + 1 if k < len(closers[tag]) else 0
            if end and tag == "title" and title is None:
                title = " ".join(html.unescape(page[begin : closers[tag][k]]).split())
        if end:
            parts += (page[at:here], " ")
            at = end
        else:  # only a tag
            end = page.find(">", here) + 1
            parts.append(page[at:end])
            at = end
    parts.append(page[at:])
    rest = "".join(parts)
    last = rest.rfind(">") + 1
    marked, tail = rest[:last], rest[last:]
    top = _HTML.search(marked)
    lang = _LANG.search(top[0]) if top else None
    links = sum(1 for m in _ANCHOR.finditer(marked) if _HREF.search(m[0]))
    text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", marked)) + tail).replace("\r", "\n")
    return _LINES.sub("\n", _SPACES.sub(" ", text)).strip(), title, lang[1].lower() if lang else None, links


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(s: str) -> str:
    return " ".join(s.split())


def _utf8(s: str) -> bytes:
    return s.encode("utf-8", "replace")


def _header(fields: list[tuple[str, str | None]]) -> str:
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields if v is not None)])


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    """Name and value of header lines; a line that begins with a blank goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif colon:
            out.append((name.strip(), value.strip()))
    return out


_HEX = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;|$)")


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        line = _HEX.match(body, at, end)
        if not line:
            raise ValueError("a chunk's size is no hexadecimal number")
        size, begin = int(line[1], 16), end + 2
        if not size:
            return b"".join(out)
        if begin + size > len(body):
            raise ValueError("a chunk is cut off")
        out.append(body[begin : begin + size])
        at = begin + size + 2
    raise ValueError("chunks without an end")


def _unpacked(body: bytes, wbits: int) -> bytes:
    """All members of a compressed body, as long as they come to no more than MOST_UNPACKED bytes."""
    out, room = [], MOST_UNPACKED
    while body:
        d = zlib.decompressobj(wbits)
        out.append(d.decompress(body, room + 1))
        room -= len(out[-1])
        if room < 0 or not d.eof:
            raise ValueError("cut off, or too long")
        body = d.unused_data if wbits > 15 else b""
        if out and body.strip(b"\0") == b"":  # padding after the last member
            break
    return b"".join(out)


def _decoded(body: bytes, fields: dict[str, str]) -> bytes:
    """The body without its transfer and content codings; as it is, where they are broken or unknown."""
    try:
        if "chunked" in fields.get("transfer-encoding", "").lower():
            body = _dechunked(body)
        coding = fields.get("content-encoding", "").lower()
        return _unpacked(body, 31) if "gzip" in coding else _unpacked(body, 15) if "deflate" in coding else body
    except (ValueError, zlib.error):
        return body


def _charset(kind: str, body: bytes) -> str:
    named = re.search(r"charset\s*=\s*[\"']?([\w-]+)", kind, re.I) or re.search(r"<meta[^>]{0,200}charset\s*=\s*[\"']?([\w-]+)", body[:2048].decode("latin-1"), re.I)
    try:
        return codecs.lookup(named[1]).name if named else "utf-8"
    except LookupError:
        return "utf-8"


def derive(page_id: int | None, record_type: str | None, record_id: str | None, uri: str | None, date: str | None, content_type: str | None, given: str | None, block: bytes | None) -> list[dict]:
    """The derived records of a response (or resource) record."""
    uri, block = None if uri is None else _one_line(uri), block or b""
    source, status, kind = [], None, content_type or ""
    payload = block
    if "application/http" in kind.lower() or record_type == "response":
        head, _, payload = block.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        status, source = (lines[0].split(" ") + [""])[1] or None, _fields(lines[1:])
        kind = next((v for k, v in source if k.lower() == "content-type"), "")
    own = digest(payload)
    check = "absent" if given is None else "match" if given == own else "mismatch" if given.startswith("sha1:") else "other"
    body = _decoded(payload, {k.lower(): v for k, v in source})
    is_text = not kind or kind.lower().startswith(("text/", "application/xhtml"))
    plain = kind.lower().startswith("text/") and not kind.lower().startswith("text/html")
    page = body.decode(_charset(kind, body), "replace") if is_text else ""
    text, title, lang, links = (page, None, None, 0) if plain or not page else scan(page)
    found = [
        ("source-status", status),
        *((f"source-header-{_one_line(k).lower()}", _one_line(v)) for k, v in source),
        ("source-content-type", None if source else kind or None),
        ("source-payload-length", str(len(payload))),
        ("source-payload-digest", given or own),
        ("source-payload-digest-check", check),
        ("title", title),
        ("language", lang),
        ("outlinks", str(links) if is_text and not plain else None),
    ]
    blocks = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in found if v is not None))]
    if is_text:
        blocks.append(("conversion", "text/plain; charset=utf-8", text))
    out, source_id = [], record_id if record_id is not None else f"{uri} {date} {digest(block)}"
    for type_, mime, content in blocks:
        data = _utf8(content)
        new = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{type_} {source_id}')}>"
        block_digest = digest(data)
        header = _header(
            [
                ("WARC-Type", type_), ("WARC-Record-ID", new), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", record_id), ("WARC-Refers-To-Target-URI", uri),
                ("WARC-Refers-To-Date", date), ("WARC-Block-Digest", block_digest), ("Content-Type", mime), ("Content-Length", str(len(data))),
            ]
        )
        out.append({"page_id": page_id, "record_type": type_, "record_id": new, "refers_to": record_id, "target_uri": uri, "warc_date": date, "content_type": mime, "block_digest": block_digest, "source_digest": given or own, "digest_check": check, "content_length": len(data), "header": header, "content": data.decode()})
    return out


def _responses(b, date: str, head: str) -> dict[str, list]:
    """RESPONSE records of a batch of pages."""
    url = [None if u is None else _one_line(u) for u in b.column("url").to_pylist()]
    body = [_utf8(x or "") for x in b.column("html").to_pylist()]
    digests, page_id = [digest(x) for x in body], b.column("page_id").to_pylist()
    ids = [f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{p} {u} {d}')}>" for p, u, d in zip(page_id, url, digests, strict=True)]
    n, start = len(body), _utf8(head + END)
    return {
        "page_id": page_id, "record_type": ["response"] * n, "record_id": ids, "target_uri": url, "warc_date": [date] * n,
        "content_type": ["application/http; msgtype=response"] * n, "payload_digest": digests, "block": [start + x for x in body],
    }


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))


_INPUTS, _NAMES = [c.split()[0] for c in RESPONSE.split(", ")], [c.split()[0] for c in RECORDS.split(", ")]


def _derived(columns: dict[str, list]) -> dict[str, list]:
    found = [r for x in zip(*(columns[c] for c in _INPUTS), strict=True) for r in derive(*x)]
    return {c: [r[c] for r in found] for c in _NAMES}


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", head: str = PAGE_HEAD) -> DataFrame:
    """RESPONSE records of a table of pages (page_id, url, html)."""
    return map_batches(_pages(pages), lambda batch: (_responses(b, date, head) for b in pieces(batch, "html", 8 << 20)), RESPONSE)


def convert(records: DataFrame) -> DataFrame:
    """RECORDS: the metadata and the conversion record of every RESPONSE record."""
    return map_batches(records.select(*_INPUTS), lambda batch: (_derived({c: b.column(c).to_pylist() for c in _INPUTS}) for b in pieces(batch, "block", 8 << 20)), RECORDS)


def build(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", head: str = PAGE_HEAD) -> DataFrame:
    """convert(responses(pages)), in one go."""
    return map_batches(_pages(pages), lambda batch: (_derived(_responses(b, date, head)) for b in pieces(batch, "html", 8 << 20)), RECORDS)


def write(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files, one a partition, of RECORDS (or RESPONSE records, whose header is made here)."""
    if "block" in records.columns:
        field = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"\r\n{name}: "), c)).otherwise("")
        head = F.concat(F.lit(VERSION), field("WARC-Type", "record_type"), field("WARC-Record-ID", "record_id"), field("WARC-Date", "warc_date"), field("WARC-Target-URI", "target_uri"), field("WARC-Payload-Digest", "payload_digest"), field("Content-Type", "content_type"), F.lit("\r\nContent-Length: "), F.length("block").cast("string"))
        body = F.concat(head, F.lit(END), F.col("block").cast("string"))
    else:
        body = F.concat("header", F.lit(END), "content")
    records.select(body.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


READ = "record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, block_digest string, payload_digest string, block_check string, fields map<string,string>, block binary"
_KEYS = ["warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "content-type", "warc-block-digest", "warc-payload-digest"]


def _record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """(fields, block) of a record's bytes; None where its block is longer than they are."""
    head, end, block = data.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in _fields(head.decode("utf-8", "replace").split("\r\n")[1:])}
    given = fields.get("content-length", "")
    size = int(given) if given.isascii() and given.isdigit() and len(given) < 19 else len(block)
    return (fields, block[:size]) if end and len(block) >= size else None


def read(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """READ: the records of WARC files, with all their header fields and whether the block's digest is right.

    Spark cuts the files where a record's end meets the next version line. A block that holds these bytes itself comes in parts; they are
    joined until its Content-Length is reached (an error if a split ends in between: then raise spark.sql.files.maxPartitionBytes).
    """
    cut, kind = "\r\n\r\nWARC/1.", T._parse_datatype_string(READ)
    schema = to_arrow_schema(kind)

    def run(batches):
        held = b""
        for batch in batches:
            rows = []
            for part in batch.column("value").to_pylist():
                begins = part.startswith(b"WARC/1.")
                held = held + cut.encode() + part if held else part if begins else b"WARC/1." + part
                got = _record(held)
                if got is None:
                    continue
                held = b""
                fields, block = got
                given = fields.get("warc-block-digest")
                check = "absent" if given is None else "match" if given == digest(block) else "mismatch" if given.startswith("sha1:") else "other"
                rows.append([*(fields.get(k) for k in _KEYS), check, list(fields.items()), block])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t.type) for v, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if held.strip():
            raise ValueError("a record's block ends beyond its split or its file")

    raw = spark.read.option("lineSep", cut).option("pathGlobFilter", glob).text(path).where("length(value) > 0")
    return raw.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, kind)


def responses_in(records: DataFrame) -> DataFrame:
    """The RESPONSE records among READ ones."""
    return records.where("record_type IN ('response', 'resource')").select(F.lit(None).cast("long").alias("page_id"), "record_type", "record_id", "target_uri", "warc_date", "content_type", "payload_digest", "block")

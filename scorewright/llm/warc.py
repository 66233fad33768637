"""WARC derivatives: linked metadata and plain-text conversion records of responses.

A response record holds an HTTP response: status line, headers, a blank line and the
payload.  ``derive`` turns each into

* a ``metadata`` record (``application/warc-fields``) with the source's headers, its
  payload's digest and media type, the page's title and the outgoing links, and
* a ``conversion`` record (``text/plain``) with the page's text,

both of which refer to the response by ``WARC-Refers-To``, keep its target URI and date,
and carry SHA-1 digests of their own blocks.  Record ids are name-based UUIDs of the
response's id, so a task that runs again writes the same bytes.  ``parse`` reads records
back, also gzip members, and ``responses`` makes response records of a page table.

Work is per record inside the task that reads it, without a shuffle.  A null url counts
as empty (no ``WARC-Target-URI``), a null page as an empty payload.  Pages without text
give an empty conversion record.  Repeated rows give equal records, and rows with null
ids records without a row's id in their name.  A record that cannot be read (no blank
line, a wrong length) raises ``ValueError``.  An empty table gives an empty one.  Further
columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
NO_DATE = "1970-01-01T00:00:00Z"    # where the table has no date
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of RFC 4122

_OPEN = re.compile(r"<!--|<(script|style|noscript|template)\b[^>]*>|<!doctype[^>]*>", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "title")}
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-z/!?][^>]*>", re.I)
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_ANCHOR = re.compile(r"<a\b[^>]*>", re.I)
_HREF = re.compile(r"\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)


def tagged(page: str) -> tuple[str, str]:
    """What ends with the last ``>``, and the rest: behind it no tag is closed, and up to it every
    tag is, so a pattern that looks for a tag's end never scans the page in vain."""
    end = page.rfind(">") + 1
    return page[:end], page[end:]


def visible(page: str) -> str:
    """The page without comments, scripts and the like: one scan forward, which remembers the
    kinds that are not closed any more."""
    body, rest = tagged(page)
    out, at, look, never = [], 0, 0, set()
    while found := _OPEN.search(body, look):
        kind = "comment" if found[0] == "<!--" else (found[1] or "doctype").lower()
        end = found.end()
        if kind == "comment":
            end = -1 if kind in never else body.find("-->", end) + 3
            end = end if end >= found.end() + 3 else -1
        elif kind != "doctype":
            close = None if kind in never else _CLOSE[kind].search(body, end)
            end = close.end() if close else -1
        if end < 0:
            never.add(kind)
            look = found.start() + 1
        else:
            out += [body[at:found.start()], " "]
            at = look = end
    return "".join([*out, body[at:], rest])


def title_of(page: str) -> str:
    body, _ = tagged(page)
    begin = _TITLE.search(body)
    end = _CLOSE["title"].search(body, begin.end()) if begin else None
    return " ".join(html.unescape(_TAG.sub("", body[begin.end():end.start()])).split()) if end else ""


def links_of(shown: str) -> list[str]:
    body, _ = tagged(shown)
    found = (_HREF.search(a[0]) for a in _ANCHOR.finditer(body))
    return [html.unescape(h[1]) for h in found if h]


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record(kind: str, record_id: str, block: bytes, content_type: str, uri: str = "", date: str = NO_DATE, **more: str) -> bytes:
    """One record; ``more`` are further headers, with ``_`` for ``-``."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "WARC-Target-URI": uri,
            **{k.replace("_", "-"): v for k, v in more.items()},
            "WARC-Block-Digest": digest(block), "Content-Type": content_type, "Content-Length": str(len(block))}
    lines = [VERSION, *(f"{k}: {clean(v)}" for k, v in head.items() if v)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def clean(value: str) -> str:
    """A header's value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def _header(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """(headers with names in lower case, block) of each record."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = _header(data[at:end])
        size = int(head.get("content-length", "-1"))
        block = data[end + 4:end + 4 + size]
        if size < 0 or len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"wrong Content-Length at byte {at}")
        out.append((head, block))
        at = end + 8 + size
    return out


def text_of(page: str) -> str:
    """A page's text, a line for each block."""
    body, rest = tagged(visible(page))
    bare = _TAG.sub("", _BLOCK.sub("\n", body)) + rest
    lines = (" ".join(line.split()) for line in html.unescape(bare).split("\n"))
    return "\n".join(line for line in lines if line)


def response(name: str, uri: str, payload: bytes, date: str = NO_DATE) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record("response", uuid.uuid5(_SPACE, "response " + name).urn, head.encode() + payload,
                  "application/http; msgtype=response", uri, date, WARC_Payload_Digest=digest(payload))


def derive_one(source: bytes) -> list[tuple[dict[str, str], bytes, bytes]]:
    """(headers, block, record) of the metadata and the conversion of one response record."""
    (head, block), = parse(source)
    end = block.find(b"\r\n\r\n")
    if head.get("warc-type") != "response" or end < 0:
        raise ValueError("not a response record with an HTTP message")
    http, payload = _header(block[:end]), block[end + 4:]
    own, uri, date = head["warc-record-id"].strip("<>"), head.get("warc-target-uri", ""), head["warc-date"]
    kind = http.get("content-type", "")
    charset = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    fields = [("source-status", block[:end].split(b"\r\n")[0].decode("latin-1")), *((f"source-{k}", v) for k, v in http.items()),
              ("source-payload-digest", digest(payload)), ("title", title_of(page)),
              *(("outlink", x) for x in links_of(visible(page)))]
    meta = "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v).encode()
    text = text_of(page).encode()
    out = []
    for what, body, media in (("metadata", meta, "application/warc-fields"), ("conversion", text, "text/plain; charset=utf-8")):
        raw = record(what, uuid.uuid5(_SPACE, f"{what} {own}").urn, body, media, uri, date, WARC_Refers_To=f"<{own}>",
                     WARC_Payload_Digest=digest(body))
        out.append((_header(raw[:raw.find(b"\r\n\r\n")]), body, raw))
    return out


def responses(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, record): a response record for each page."""
    def run(batches):
        for batch in batches:
            rows = [response(f"{i} {u or ''}" if i is not None else u or "", u or "", (h or "").encode())
                    for i, u, h in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["id", "record"])

    slim = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, record binary").withColumnRenamed("id", id_col)


def derive(df: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """Two rows for each response record: (id, kind, record_id, refers_to, target_uri, date,
    content_type, block_digest, source_digest, block, record)."""
    names = ["kind", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "source_digest", "block", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, value in enumerate(batch.column(1)):
                source = value.as_py()
                if source is None:
                    continue
                origin = parse(source)[0][0].get("warc-payload-digest", "")
                for head, block, raw in derive_one(source):
                    at.append(i)
                    rows.append((head["warc-type"], head["warc-record-id"], head["warc-refers-to"], head.get("warc-target-uri", ""),
                                 head["warc-date"], head["content-type"], head["warc-block-digest"], origin, block, raw))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            kinds = [pa.string()] * 8 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             ["id", *names])

    slim = df.select(F.col(id_col).alias("id"), F.col(record_col).alias("record"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} {'binary' if n in ('block', 'record') else 'string'}" for n in names)
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def read_files(spark, path: str) -> DataFrame:
    """(path, record) of the WARC files below a path that Spark can read; one file is one task's."""
    def run(batches):
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [record_bytes(h, b) for h, b in parse(content)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(rows, pa.binary())], ["path", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, record binary")


def record_bytes(head: dict[str, str], block: bytes) -> bytes:
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in head.items())]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

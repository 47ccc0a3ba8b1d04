"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both records refer to the response they were made from and keep its address, date,
identified payload type, source headers and digests.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date of records whose source has none.
EPOCH = "1970-01-01T00:00:00Z"

_HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(noscript|template)\b[^>]*>.*?</\2\s*>")
#: The end tag of a head is optional: it ends at the body, or else after the last element that belongs to it.
_HEAD = re.compile(r"(?is)<head\b[^>]*>(?:.*?(?:</head\s*>|(?=<body\b))|(?:\s*(?:<(?:meta|link|base)\b[^>]*>|<title\b[^>]*>.*?</title\s*>))*)")
_BLOCK = re.compile(r"(?i)</?(?:p|div|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|td|th|section|article|aside|header|footer|nav|main|form|pre|blockquote|body|html)\b[^>]*>")
_TAG = re.compile(r"<[/!?]?[A-Za-z][^>]*>|<![^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" *\n[ \n]*")
_TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)(?:</title\s*>|\Z)")
_LANGUAGE = re.compile(r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z0-9-]+)")
_CHARSET = re.compile(r"(?i)<meta\b[^>]*\bcharset\s*=\s*[\"']?([A-Za-z0-9_:-]+)")
_LINK = re.compile(r"(?i)<(a|link|img|iframe|frame|area)\b[^>]*?\b(?:href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")


def plain_text(page: str) -> str:
    """Visible text, one line per block, entities resolved, runs of blanks as one."""
    text = _HEAD.sub(" ", _HIDDEN.sub(" ", page))
    text = _TAG.sub("", _BLOCK.sub("\n", text))
    text = _BLANKS.sub(" ", html.unescape(text))
    return _LINES.sub("\n", text).strip()


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(refers_to: str, kind: str) -> str:
    """An identifier that follows from the source record and the kind, so that reruns agree."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}#{kind}')}>"


def one_line(value: object) -> str:
    """A header or field value: line ends would end the field."""
    return re.sub(r"[\r\n]+[ \t]*", " ", str(value))


def metadata_block(page: str, headers: dict, status: str, digest: str, payload_digest: str) -> str:
    """``application/warc-fields`` lines: what the page says of itself, its links, its source headers and digests."""
    fields = [("source-status", status)]
    fields += [(f"source-header-{name.lower()}", value) for name, value in headers.items()]
    fields += [("source-block-digest", digest), ("source-payload-digest", payload_digest)]
    for name, pattern in (("title", _TITLE), ("language", _LANGUAGE), ("charset", _CHARSET)):
        if found := pattern.search(page):
            fields.append((name, re.sub(r"\s+", " ", html.unescape(found[1])).strip()))
    for tag, *values in _LINK.findall(page):
        fields.append(("outlink", f"{html.unescape(next((v for v in values if v), ''))} {tag.lower()}"))
    return "".join(f"{name}: {one_line(value)}\r\n" for name, value in fields)


def serialized(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """The bytes of a record; records one after the other are a WARC file."""
    lines = "".join(f"{name}: {one_line(value)}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        out.append((headers, data[end + 4:end + 4 + size]))
        at = end + 4 + size + 4
    return out


OUT = pa.schema([
    ("key", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
    ("date", pa.string()), ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()),
    ("source_block_digest", pa.string()), ("source_payload_digest", pa.string()), ("block", pa.string()), ("record", pa.binary()),
])


def _derive(with_record: bool):
    def rows_of(row: dict) -> Iterator[tuple]:
        page = row["payload"] or ""
        headers = json.loads(row["headers"]) if row["headers"] else {}
        status = row["status"] or "HTTP/1.1 200 OK"
        payload = page.encode()
        head = "".join(f"{n}: {one_line(v)}\r\n" for n, v in headers.items())
        digest = row["block_digest"] or sha1(f"{status}\r\n{head}\r\n".encode() + payload)
        payload_digest = row["payload_digest"] or sha1(payload)
        refers, uri, date = row["record_id"] or "", row["target_uri"] or "", row["date"] or EPOCH
        blocks = (("metadata", "application/warc-fields", metadata_block(page, headers, status, digest, payload_digest)),
                  ("conversion", "text/plain; charset=utf-8", plain_text(page)))
        for kind, content, block in blocks:
            data = block.encode()
            made, own = record_id(refers, kind), sha1(data)
            record = serialized([
                ("WARC-Type", kind), ("WARC-Record-ID", made), ("WARC-Refers-To", refers), ("WARC-Target-URI", uri), ("WARC-Date", date),
                ("WARC-Block-Digest", own), ("WARC-Payload-Digest", payload_digest), ("Content-Type", content), ("Content-Length", str(len(data))),
            ], data) if with_record else None
            yield row["key"], kind, made, refers, uri, date, content, len(data), own, digest, payload_digest, block, record

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [made for row in batch.to_pylist() for made in rows_of(row)]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in OUT]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)

    return derive


def derivatives(responses: DataFrame, with_record: bool = False) -> DataFrame:
    """Two rows per response, ``metadata`` and ``conversion``, in one pass without a shuffle.

    Input: ``key`` (long), ``record_id``, ``target_uri``, ``date``, ``status``,
    ``headers`` (JSON object of the source's HTTP headers), ``payload`` (text), and
    ``block_digest`` and ``payload_digest`` of the source if it has them, which are kept
    as they are; else both are computed.  Other columns are not read.  Nulls: an empty payload gives an empty conversion and a
    metadata record without page fields; a missing id, address or header is empty or
    left out, a missing date is the epoch, a missing status ``200 OK``.  Repeated
    responses give repeated rows.  Record ids follow from the source id and the kind.
    ``record`` holds the serialized record if asked for, else null.  A broken page
    gives what can be read: an open comment, script or style runs to the end, an open
    head to the body or to the first element of one, an open noscript or template hides
    its tag alone.
    """
    names = ["record_id", "target_uri", "date", "status", "headers", "payload"]
    digests = [(F.col(n) if n in responses.columns else F.lit(None)).cast("string").alias(n) for n in ("block_digest", "payload_digest")]
    rows = responses.select(F.col("key").cast("long").alias("key"), *[F.col(n).cast("string").alias(n) for n in names], *digests)
    kinds = "key long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, " \
        "content_length long, block_digest string, source_block_digest string, source_payload_digest string, block string, record binary"
    return rows.mapInArrow(_derive(with_record), kinds)


def page_responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Stored pages as responses: an id that follows from page and address, and the headers a server of such pages sends."""
    def hexed(start: int, size: int) -> Column:
        return F.substring(F.md5(F.concat_ws("|", F.col(page_id).cast("string"), F.col(url))), start, size)

    urn = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[hexed(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))
    length = F.octet_length(F.coalesce(F.col(page), F.lit("")))
    headers = F.to_json(F.struct(F.lit("text/html; charset=utf-8").alias("Content-Type"), length.cast("string").alias("Content-Length")))
    return pages.select(F.col(page_id).alias("key"), urn.alias("record_id"), F.col(url).alias("target_uri"), F.lit(None).cast("string").alias("date"),
                        F.lit(None).cast("string").alias("status"), headers.alias("headers"), F.col(page).alias("payload"))

"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from.

A record is a row: ``warc`` (a map of its WARC headers, names in lower case) and ``block`` (bytes). Every response gives one
metadata record (status, type, title, lengths, number of links) and, where it holds text, one conversion record. Both
refer to the response by ``WARC-Refers-To``, repeat its target, date and payload digest, and carry a digest of their
own block. Identifiers are derived from the source's, so a repeated run gives the same records.
"""

import base64
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from .common import rows_of, text_bytes
from .html_main import blocks

_RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("warc", pa.map_(pa.string(), pa.string())),
        ("block", pa.binary()),
    ]
)
RECORDS = "record_id string, record_type string, refers_to string, warc map<string,string>, block binary"

_TITLE = re.compile(r"<title[^>]*>([^<]*)", re.I)
_LINK = re.compile(r"<a\s[^>]*?href\s*=", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record_id(*parts):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def split_http(block):
    """(status line, headers as pairs, payload); a block without a header end is payload alone."""
    head, end, payload = block.partition(b"\r\n\r\n")
    if not end or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *rest = head.decode("utf-8", "replace").split("\r\n")
    pairs = []
    for line in rest:
        if line[:1] in (" ", "\t") and pairs:
            pairs[-1] = (pairs[-1][0], f"{pairs[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            pairs.append((name.strip(), value.strip()))
    return first, pairs, payload


def _decoded(payload, content_type):
    m = _CHARSET.search(content_type)
    try:
        return payload.decode(m.group(1) if m else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def plain_text(page):
    """All visible text, one block per line."""
    return "\n".join(text for _, text, *_ in blocks(page))


def derivatives(warc, block):
    """The metadata and the conversion record of a response, as (id, type, refers to, headers, block)."""
    source = warc.get("warc-record-id") or record_id("response", warc.get("warc-target-uri") or "", digest(block))
    status, pairs, payload = split_http(block)
    http = {}
    for name, value in pairs:
        http.setdefault(name.lower(), value)
    kind = http.get("content-type", "")
    # The source's own digest stays; only where it has none is one made of its payload.
    own = warc.get("warc-payload-digest") or digest(payload)
    kept = {k: warc[k] for k in ("warc-target-uri", "warc-date", "warc-warcinfo-id") if warc.get(k)}
    textual = not kind or kind.lower().startswith(("text/", "application/xhtml"))
    page = _decoded(payload, kind) if textual else ""
    is_html = textual and (not kind or "html" in kind.lower())
    text = plain_text(page) if is_html else page
    title = _TITLE.search(page) if is_html else None
    facts = {
        "http-status": status.split(" ")[1] if status.count(" ") else "",
        "http-headers": pairs,
        "content-type": kind,
        "title": html.unescape(title.group(1)).strip() if title else "",
        "links": len(_LINK.findall(page)) if is_html else 0,
        "payload-length": len(payload),
        "text-length": len(text),
    }
    out = []
    for made, content_type, body in (
        ("metadata", "application/json", json.dumps(facts, ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        if made == "conversion" and not body:
            continue
        ident = record_id(made, source)
        headers = {
            "warc-type": made,
            "warc-record-id": ident,
            "warc-refers-to": source,
            **kept,
            "warc-source-payload-digest": own,
            "warc-block-digest": digest(body),
            "content-type": content_type,
            "content-length": str(len(body)),
        }
        out.append((ident, made, source, headers, body))
    return out


def derive(records):
    """The derivatives of all responses among `records` (``warc``, ``block``); records of other types give none.

    NULL headers are none, a NULL block is empty: such a response still gets its metadata. Responses that share an
    identifier each give records of their own, with the same identifiers. Extra columns are left out.
    """

    def build(batches):
        for batch in batches:
            out = []
            for warc, block in rows_of(batch, "warc", "block"):
                out += derivatives({k: v for k, v in warc or [] if v is not None}, block)
            columns = list(zip(*out, strict=True)) or [[]] * 5
            arrays = [pa.array(c, f.type) for c, f in zip([*columns[:3], [list(h.items()) for h in columns[3]], columns[4]], _RECORDS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_RECORDS)

    warc = F.transform_keys(F.col("warc"), lambda k, _: F.lower(k))
    given = records.select(warc.alias("warc"), F.coalesce("block", F.lit(b"")).alias("block"))
    return given.filter(F.lower(F.col("warc")["warc-type"]) == "response").mapInArrow(build, RECORDS)


def responses_of_pages(pages, date="2024-01-01T00:00:00Z"):
    """Response records of a table of pages (page_id, url, html), as a crawler would have stored them."""
    body = text_bytes("html")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(head.cast("binary"), body)
    h = F.sha2(F.concat_ws("\x00", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))), 256)
    ident = F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4),
        F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )
    names = ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "Content-Type", "Content-Length")
    values = (
        F.lit("response"), ident, F.col("url"), F.lit(date), F.lit("application/http; msgtype=response"),
        F.length(block).cast("string"),
    )
    warc = F.create_map(*[x for n, v in zip(names, values, strict=True) for x in (F.lit(n), v)])
    return pages.select("page_id", warc.alias("warc"), block.alias("block"))


#: How header names are written.
_WRITTEN = {"warc": "WARC", "id": "ID", "uri": "URI"}


def serialized(record):
    """One record as it stands in a file, without the two line ends after it; the block must be UTF-8 text."""
    lines = F.transform(
        F.array_sort(F.map_entries(record["warc"])), lambda e: F.concat(_header_name(e["key"]), F.lit(": "), e["value"])
    )
    return F.concat(F.lit("WARC/1.1\r\n"), F.array_join(lines, "\r\n"), F.lit("\r\n\r\n"), record["block"].cast("string"))


def _header_name(key):
    written = F.initcap(F.replace(key, F.lit("-"), F.lit(" ")))
    for small, large in _WRITTEN.items():
        written = F.regexp_replace(written, rf"\b{small.capitalize()}\b", large)
    return F.replace(written, F.lit(" "), F.lit("-"))


def write(records, path, compression="gzip"):
    """Write records with text blocks as WARC files, one per partition."""
    rows = records.select(serialized(records).alias("value"))
    rows.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def parse(data):
    """(headers, block) of each record of an uncompressed WARC file; broken ends are left out."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        pairs = (line.split(":", 1) for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
        headers = {k.strip().lower(): v.strip() for k, v in pairs}
        size = headers.get("content-length", "")
        if not size.isdigit() or end + 4 + int(size) > len(data):
            at = end
            continue
        at = end + 4 + int(size)
        yield headers, data[end + 4 : at]


def read(spark, path):
    """``warc, block`` of all records in WARC files, plain or gzip; a file is read by one task."""

    def split(batches):
        import gzip

        for batch in batches:
            for (content,) in rows_of(batch, "content"):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                found = list(parse(data))
                for k in range(0, len(found), 500):
                    part = found[k : k + 500]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([list(h.items()) for h, _ in part], pa.map_(pa.string(), pa.string())),
                            pa.array([b for _, b in part], pa.binary()),
                        ],
                        names=["warc", "block"],
                    )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(split, "warc map<string,string>, block binary")

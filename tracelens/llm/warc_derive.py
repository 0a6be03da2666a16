"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response gives a metadata record (JSON: its WARC and HTTP headers, title and links)
and, if it holds text, a conversion record (the text).  Both name the response in
WARC-Refers-To and carry its target, date and payload digest; their identifiers are made
from the response's, so a repeated run gives the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm.dom import Page, unescape
from tracelens.llm.files import whole_file
from tracelens.llm.store import columns_first

RESPONSE = "record_id string, target_uri string, date string, payload_digest string, block binary"
DERIVED = ("warc_type string, record_id string, refers_to string, target_uri string, date string, "
           "source_digest string, digest_ok boolean, block_digest string, content_type string, "
           "content_length long, header string, block string")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TARGETS = frozenset("href src action".split())
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    """A name-based identifier, the same for the same parts."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _uri(text: str | None) -> str:
    """A header value: control characters and spaces percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text or "")


def links_and_title(page: Page) -> tuple[list[dict], str]:
    """The first target of each linking tag, and the text of the first title.

    Comments and the content of scripts, styles and the like hold no tags.
    """
    links = []
    for tag, attributes in page.linking:
        for m in _ATTRIBUTE.finditer(attributes):
            if m[1].lower() in _TARGETS and m.lastindex > 1:
                links.append({"path": f"{tag}@/{m[1].lower()}", "url": unescape(m[m.lastindex])})
                break
    return links, " ".join(unescape(page.title or "").split())


def header(fields: list[tuple[str, str]]) -> str:
    """A record's header; fields without a value are left out, control characters and spaces in values encoded."""
    return "WARC/1.1\r\n" + "".join(f"{k}: {v if k in _SPACED else _uri(v)}\r\n" for k, v in fields if v) + "\r\n"


_SPACED = ("Content-Type",)  # of this module's making; its value has a space


def dechunked(payload: bytes) -> bytes:
    """The payload of a chunked transfer; as it is where it does not read as one."""
    parts, at = [], 0
    while True:
        end = payload.find(b"\r\n", at, at + 1024)
        size = payload[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return payload
        n = int(size, 16)
        if n == 0:
            return b"".join(parts)
        if end + 2 + n > len(payload):
            return payload
        parts.append(payload[end + 2:end + 2 + n])
        at = end + 2 + n + (2 if payload.startswith(b"\r\n", end + 2 + n) else 0)


def decompressed(payload: bytes, codings: list[str]) -> bytes:
    """The content behind gzip and deflate codings, last one first; as it is behind others or where it does not read."""
    for coding in reversed([c.strip().lower() for v in codings for c in v.split(",") if c.strip()]):
        if coding == "identity":
            continue
        if coding not in ("gzip", "x-gzip", "deflate"):
            return payload
        for bits in ((31,) if "gzip" in coding else (15, -15)):  # deflate comes with and without a zlib header
            out, rest = [], payload
            try:
                while rest:  # gzip members may follow each other
                    d = zlib.decompressobj(bits)
                    out.append(d.decompress(rest) + d.flush())
                    rest = d.unused_data if bits == 31 and d.eof else b""
            except zlib.error:
                if not out:
                    continue
            payload = b"".join(out)
            break
        else:
            return payload
    return payload


def split_http(block: bytes) -> tuple[str, dict[str, list[str]], bytes]:
    """Status line, headers (lower-case names, all values of each in their order) and payload of an HTTP response."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", {}, block
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    fields: dict[str, list[str]] = {}
    for k, _, v in (line.partition(":") for line in lines):
        fields.setdefault(k.strip().lower(), []).append(v.strip())
    return status, fields, payload


def decode(payload: bytes, content_type: str) -> str:
    found = _CHARSET.search(content_type)
    try:
        return payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive_one(record_id: str, target: str | None, date: str | None, digest: str | None, block: bytes) -> list[tuple]:
    """The rows (see DERIVED) of one response.

    In the metadata a repeated HTTP header has the list of its values; its last Content-Type counts.
    A chunked transfer is undone before the payload is digested; a digest of the chunks fits too.
    The text is that behind gzip and deflate content codings.
    """
    status, fields, stored = split_http(block or b"")
    chunked = any("chunked" in v.lower() for v in fields.get("transfer-encoding", []))
    payload = dechunked(stored) if chunked else stored
    own, record_id = sha1_digest(payload), record_id or ""
    fits = digest is None or digest == own or chunked and digest == sha1_digest(stored)
    kind = fields.get("content-type", [""])[-1].lower()
    is_html = "html" in kind
    is_text = is_html or kind.startswith("text/")
    source = decode(decompressed(payload, fields.get("content-encoding", [])), kind) if is_text else ""
    uri, date = _uri(target), date or ""
    page = Page(source) if is_html else None
    links, title = links_and_title(page) if page else ([], "")
    meta = {"Envelope": {
        "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": uri,
                                 "WARC-Date": date, "WARC-Payload-Digest": digest or own},
        "Payload-Metadata": {"HTTP-Response-Metadata": {
            "Response-Message": status, "Headers": {k: v if len(v) > 1 else v[0] for k, v in fields.items()},
            "Entity-Length": len(payload), "Entity-Digest": own,
            "HTML-Metadata": {"Title": title, "Links": links}}}}}
    blocks = [("metadata", "application/json", json.dumps(meta, ensure_ascii=False))]
    if page:
        blocks.append(("conversion", "text/plain; charset=utf-8", page.text([True] * len(page.tag))))
    elif is_text:
        blocks.append(("conversion", "text/plain; charset=utf-8", source))
    out = []
    for warc_type, content_type, text in blocks:
        data = text.encode("utf-8", "replace")
        own_id, block_digest = urn(warc_type, record_id, digest or own), sha1_digest(data)
        head = header([
            ("WARC-Type", warc_type), ("WARC-Record-ID", own_id), ("WARC-Refers-To", record_id),
            ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Date", date), ("WARC-Source-Payload-Digest", digest or own), ("WARC-Block-Digest", block_digest),
            ("Content-Type", content_type), ("Content-Length", str(len(data)))])
        out.append((warc_type, own_id, record_id, uri, date, digest or own, fits,
                    block_digest, content_type, len(data), head, text))
    return out


def _derive(batches):
    names = [f.split()[0] for f in DERIVED.split(", ")]
    types = {"digest_ok": pa.bool_(), "content_length": pa.int64()}
    for batch in batches:
        rows, source = [], []
        columns = (batch.column(c).to_pylist() for c in ("record_id", "target_uri", "date", "payload_digest", "block"))
        for i, response in enumerate(zip(*columns)):
            found = derive_one(*response)
            rows += found
            source += [i] * len(found)
        values = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(pa.array(source, pa.int64()))]
            + [pa.array(v, types.get(n, pa.string())) for n, v in zip(names, values)], names=["key", *names])


def derive(responses: DataFrame, key_col: str) -> DataFrame:
    """Metadata and conversion records (key, then DERIVED) of response records (key and RESPONSE).

    ``digest_ok``: the source's payload digest fits its payload.  Null target or date: the header
    is left out.  Null digest: the payload's own.  Null block: an empty one.  Null identifier: an empty
    one, without Refers-To header.  Chunked, gzip and deflate bodies are undone (``derive_one``); a body that does
    not read as its coding says is taken as it is.  A response that is not
    text (by its HTTP content type) gives a metadata record only.  Repeated responses give repeated
    records with equal identifiers; null keys are passed through; other columns are ignored.  An
    empty table gives no rows.
    """
    rows = columns_first(responses, key=key_col, record_id="record_id", target_uri="target_uri", date="date",
                         payload_digest="payload_digest", block="block")
    return rows.mapInArrow(_derive, "key " + rows.schema["key"].dataType.simpleString() + ", " + DERIVED)


def _respond(batches):
    for batch in batches:
        keys, urls = batch.column("key").to_pylist(), batch.column("url").to_pylist()
        out = {"record_id": [], "target_uri": urls, "date": batch.column("date"), "payload_digest": [], "block": []}
        for key, url, source in zip(keys, urls, batch.column("html").to_pylist()):
            payload = (source or "").encode("utf-8", "replace")
            digest = sha1_digest(payload)
            out["record_id"].append(urn("response", str(key), url or "", digest))
            out["payload_digest"].append(digest)
            out["block"].append(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                                % len(payload) + payload)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key")] + [v if isinstance(v, pa.Array) else pa.array(v, pa.binary() if c == "block" else pa.string())
                                     for c, v in out.items()], names=["key", *out])


def responses_of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records (key and RESPONSE) of stored pages, which all get ``date``."""
    rows = columns_first(pages, key=id_col, url=url_col, html=html_col).withColumn("date", F.lit(date))
    return rows.mapInArrow(_respond, "key " + rows.schema["key"].dataType.simpleString() + ", " + RESPONSE)


def _write(folder: str, prefix: str):
    def run(batches):
        from pyspark import TaskContext

        name, at = f"{prefix}-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with whole_file(folder, name) as out:
            for batch in batches:
                index = []
                for record, head, block in zip(*(batch.column(c).to_pylist() for c in ("record_id", "header", "block"))):
                    member = gzip.compress(head.encode() + block.encode("utf-8", "replace") + b"\r\n\r\n", mtime=0)
                    index.append((record, at, len(member)))
                    out.write(member)
                    at += len(member)
                record, offset, length = zip(*index) if index else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}"] * len(index), pa.string()), pa.array(record, pa.string()),
                     pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
                    names=["file", "record_id", "offset", "length"])
    return run


def write_warc(records: DataFrame, folder: str, prefix: str = "derived") -> DataFrame:
    """Write derived records as gzip members, one file a task; (file, record_id, offset, length) of each.

    The files are written when the returned index is computed.
    """
    return records.select("record_id", "header", "block").mapInArrow(
        _write(folder, prefix), "file string, record_id string, offset long, length long")

"""Operator 4: WARC archives with segmented records, written and read back.

Writing: one record per page. Of pages with equal payloads of at least
``MIN_REVISIT_BYTES``, those with the smallest page id are ``response`` records, the others
``revisit`` records that store no payload. A response's block is an HTTP message in chunked
transfer framing; a block longer than ``SEGMENT_BYTES`` is cut into a first record and
``continuation`` records. Each input partition becomes one gzip-compressed archive (its
size follows ``spark.sql.files.maxPartitionBytes``).

Reading: archives are parsed record by record by their Content-Length. Segment reassembly
groups the records of one origin, orders them by segment number, verifies that the numbers
are complete and that the joined block has the stated total length, and only then decodes
the chunked framing. Whole records skip the grouping, so only segments are shuffled.

Defined cases: null html is an empty payload. Rows that repeat the smallest page id of a
group are all responses. A null page id is later than every other id; it is kept and comes
back as null. An empty page table gives no rows. Input columns other than id, URL and html
are ignored. A record that cannot be reassembled comes back with null payload columns and
``ok`` false, never with part of a payload.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C

MIN_REVISIT_BYTES = 100
SEGMENT_BYTES = 8 * 1024
CHUNK_BYTES = 4 * 1024
CRLF = b"\r\n"
READ_BYTES = 1 << 20
RECORD_SCHEMA = ("record_id string, record_type string, page_id string, refers_to string, url string, "
                 "payload_digest string, segment int, origin string, total_length long, block binary")


# ---- writing -----------------------------------------------------------------

def _frame(payload: bytes) -> bytes:
    """Chunked transfer framing (RFC 9112, section 7.1)."""
    out = [b"%x\r\n%s\r\n" % (len(payload[i:i + CHUNK_BYTES]), payload[i:i + CHUNK_BYTES])
           for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(out) + b"0\r\n\r\n"


def _header_value(text) -> bytes:
    """A header value holds no line break."""
    return str(text).replace("\r", "%0D").replace("\n", "%0A").encode()


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"] + [k.encode() + b": " + _header_value(v) for k, v in headers if v is not None]
    return CRLF.join([*lines, b"Content-Length: %d" % len(block), b"", b""]) + block


def page_records(page_id, url, payload: bytes | None, digest: str, n_bytes: int, refers_to) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    rid = f"<urn:uuid:{uuid.uuid4()}>"
    common = [("WARC-Target-URI", url), ("X-Page-ID", page_id), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if payload is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common, ("X-Refers-To-Page-ID", refers_to),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], block)
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + _frame(payload))
    if len(block) <= SEGMENT_BYTES:
        yield _record([("WARC-Type", "response"), ("WARC-Record-ID", rid), *common], block)
        return
    pieces = range(0, len(block), SEGMENT_BYTES)
    for number, at in enumerate(pieces, 1):
        last = [("WARC-Segment-Total-Length", len(block))] if number == len(pieces) else []
        head = ([("WARC-Type", "response"), ("WARC-Record-ID", rid), *common] if number == 1 else
                [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                 ("WARC-Segment-Origin-ID", rid)])
        yield _record([*head, ("WARC-Segment-Number", number), *last], block[at:at + SEGMENT_BYTES])


def _write_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = zip(b["page_id"], b["url"], b["html"], b["digest"], b["n_bytes"], b["refers_to"], strict=True)
        yield pd.DataFrame({"record": [r for page_id, url, html, digest, n, ref in rows for r in page_records(
            page_id, url, None if ref is not None else (html or "").encode(), digest, n, ref)]})


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Pages with payload digest and size, and for revisits the page they refer to (ids as
    text). Digests are counted with map-side partial sums; only the digests of several
    pages go into the join, and a hot one is dealt out by page id."""
    p = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).alias("html"))
    p = p.select("*", C.sha256_hex(F.coalesce("html", F.lit(""))).alias("digest"),
                 F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("n_bytes"))
    copies = C.materialise(p.where(F.col("n_bytes") >= MIN_REVISIT_BYTES).groupBy("digest")
                           .agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first_id"))
                           .where("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"), "warc_copies")
    joined = C.keyed_join(p, copies, ["digest"], F.col("_id"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("_id").eqNullSafe(F.col("first_id"))
    return joined.select(F.col("_id").cast("string").alias("page_id"), "url",
                         F.when(~again, F.col("html")).alias("html"), "digest", "n_bytes",
                         F.when(again, F.col("first_id").cast("string")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, **columns) -> str:
    """Write pages as WARC files under ``path``. The text sink writes each record's bytes as
    they are and ends it with the two line breaks that the format asks for."""
    records = mark_revisits(pages, **columns).mapInPandas(_write_records, "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))
    return path


# ---- reading -----------------------------------------------------------------

class _Stream:
    """Bytes of one archive, decompressed as they are asked for."""

    def __init__(self, content: bytes):
        self.content, self.at, self.buffer = content, 0, bytearray()
        self.gunzip = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        piece = self.content[self.at:self.at + READ_BYTES]
        self.at += len(piece)
        while piece:
            if self.gunzip is None:
                self.buffer += piece
                break
            self.buffer += self.gunzip.decompress(piece)
            piece = self.gunzip.unused_data  # the next member of the file
            if piece:
                self.gunzip = zlib.decompressobj(31)
        return self.at < len(self.content) or bool(piece)

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (i := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more() and self.buffer.find(mark, seen) < 0:
                return None
        return self.take(i + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse_archive(content: bytes) -> Iterator[tuple]:
    """The records of one archive, in the order of RECORD_SCHEMA."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.lstrip().decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        h = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        block = stream.take(int(h["Content-Length"]))
        stream.take(4)  # the record's end
        number, total = h.get("WARC-Segment-Number"), h.get("WARC-Segment-Total-Length")
        yield (h["WARC-Record-ID"], h["WARC-Type"], h.get("X-Page-ID"), h.get("X-Refers-To-Page-ID"),
               h.get("WARC-Target-URI"), h.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
               int(number) if number else None, h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]),
               int(total) if total else None, block)


def _read_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def frame(rows):
        return pd.DataFrame(rows, columns=names).astype({"segment": "Int32", "total_length": "Int64"})

    for b in batches:
        for content in b["content"]:
            rows, held = [], 0
            for r in parse_archive(content):
                rows.append(r)
                held += len(r[-1])
                if held > 8 * READ_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, segments as they are."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_read_records, RECORD_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record with its whole block: segments are grouped by origin, ordered by
    number and checked against the total length. A page's segments are as many as its size
    asks for, so a group is bounded by one record."""
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    segment = F.struct("segment", "block")
    parts = (records.where(F.col("segment").isNotNull()).groupBy("origin")
             .agg(*[first(c) for c in ("record_type", "page_id", "refers_to", "url", "payload_digest")],
                  F.max("total_length").alias("total_length"), F.array_sort(F.collect_list(segment)).alias("parts")))
    in_order = F.transform("parts", lambda s: s["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda s: F.hex(s["block"])), ""))  # one pass, however many segments
    joined_ok = in_order & (F.octet_length("joined") == F.col("total_length"))
    parts = (parts.withColumn("joined", joined)
             .withColumn("block", F.when(F.coalesce(joined_ok, F.lit(False)), F.col("joined"))))
    columns = ["record_type", "page_id", "refers_to", "url", "payload_digest", "block"]
    return records.where(F.col("segment").isNull()).select(*columns).unionByName(parts.select(*columns))


def unchunk(body: bytes) -> bytes | None:
    """The payload of a chunked body; None when the framing is broken."""
    out, at = [], 0
    while (end := body.find(CRLF, at)) >= 0:
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        chunk = body[end + 2:end + 2 + n]
        at = end + 2 + n + 2
        if len(chunk) != n or body[at - 2:at] != CRLF:
            return None
        if n == 0:
            return b"".join(out)
        out.append(chunk)
    return None


def payload_of(block: bytes | None) -> tuple[bytes | None, int | None]:
    """(payload, its stated length) of an HTTP block."""
    if block is None or b"\r\n\r\n" not in block:
        return None, None
    head, body = block.split(b"\r\n\r\n", 1)
    h = {k.lower(): v for k, v in (x.split(b": ", 1) for x in head.split(CRLF)[1:] if b": " in x)}
    if h.get(b"transfer-encoding") == b"chunked":
        payload = unchunk(body)
        return payload, None if payload is None else len(payload)
    return body, int(h[b"content-length"]) if b"content-length" in h else len(body)


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for kind, digest, block in zip(b["record_type"], b["payload_digest"], b["block"], strict=True):
            payload, n = payload_of(block)
            if kind == "revisit":
                out.append((None, n, digest, n is not None))
            elif payload is None:
                out.append((None, None, None, False))
            else:
                found = hashlib.sha256(payload).hexdigest()
                out.append((payload, n, found, found == digest))
        done = pd.DataFrame(out, columns=["payload", "payload_bytes", "payload_digest", "ok"], index=b.index)
        done["payload_bytes"] = done["payload_bytes"].astype("Int64")
        yield pd.concat([b[["page_id", "url", "record_type", "refers_to"]], done], axis=1)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: page_id, url, record_type, refers_to (page ids as
    text), payload (null for revisits), payload_bytes, payload_digest, ok."""
    return reassemble(read_records(spark, path)).mapInPandas(
        _decode, "page_id string, url string, record_type string, refers_to string, payload binary, "
                 "payload_bytes long, payload_digest string, ok boolean")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as segmented WARC archives and read back."""
    pages = C.table(spark, sf_dir, "pages")
    path = write_archives(pages, scratch_path(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "ok")


ORACLE_OP4 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN n >= 100 AND first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id <> p.page_id THEN first_id END AS refers_to,
       TRUE AS ok
FROM p LEFT JOIN g ON p.d = g.d
"""

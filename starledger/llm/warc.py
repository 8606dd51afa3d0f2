"""Operator 6: WARC archives, with segment reassembly.

Writing: every page becomes a record. Of pages with equal payloads (of
``min_revisit`` bytes or more) that with the smallest page_id is a response,
the others are revisit records that refer to it. A response's block is an
HTTP message whose body is in chunked transfer framing; a block longer than
``segment_bytes`` is cut into a response record and continuation records
(WARC 1.1 segmentation: segment number, origin id, total length on the last).
Records are dealt over files of about ``file_bytes`` by a hash of record and
segment, so the segments of one record may lie in any files, and written by
Spark's own text writer, whose line separator is the two CRLFs that end a
record; file level gzip is the writer's compression.

Reading: files are read whole (they are bounded by ``file_bytes``) and cut
into records by their Content-Length. Continuation records are grouped by
origin id, put in order of segment number, checked to be without gaps and of
the stated total length, and joined; the block's chunked framing is decoded
and the payload's digest verified. Records that need no reassembly send only
digest and length into the shuffle, unless the payload is asked for.

Defined cases: a null html is an empty payload; null ids and urls come back
null; an id that repeats is told apart by an own record id, and of equal
payloads under one id one row is the response; a null id counts as larger
than any other; line breaks and other control characters in a url are percent
encoded; an empty table gives an empty archive; extra columns are not stored.
A record that fails a check has its reason in ``status`` (else ``ok``) and a
null payload, digest and length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import batch_column, keep, new_folder

SEGMENT_BYTES, CHUNK_BYTES, FILE_BYTES, MIN_REVISIT = 16 << 10, 4096, 16 << 20, 0
BROADCAST_COPIES = 200_000  # repeated payloads (80 bytes each) that are broadcast to the pages
DATE = "2026-01-01T00:00:00Z"  # records carry a fixed date, so that a retried task writes the same bytes
BASE32_BY_VALUE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "starledger/warc")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four of base 32."""
    digest = F.sha1(data)
    digits = F.concat(*(F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_BY_VALUE)


def _record_id(uid: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(uid))}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if len(body) < at + n + 2 or body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at:at + n])
        at += n + 2


def _head(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def _safe(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="".join(map(chr, range(33, 127))).replace("%", ""))


def page_records(uid, page_id, url, html, digest, first_uid, first_id, segment_bytes):
    """(segment number, record without its final CRLFs) of one page."""
    rid = _record_id(uid)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", _safe(url)), ("X-Page-Id", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if first_uid is not None:
        yield 1, _head([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common, ("WARC-Refers-To", _record_id(first_uid)),
                        ("X-Refers-To-Page-Id", first_id), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("Content-Length", 0)])
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(html)
    cuts = range(0, len(block), segment_bytes)
    for n, at in enumerate(cuts, 1):
        part, last = block[at:at + segment_bytes], n == len(cuts)
        if n == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", rid), *common, ("Content-Type", "application/http; msgtype=response"),
                      ("WARC-Segment-Number", None if last else 1)]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, f'{uid}/{n}')}>"), ("WARC-Date", DATE),
                      ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", len(block) if last else None)]
        yield n, _head([*fields, ("Content-Length", len(part))]) + part


def _records(segment_bytes: int):
    def run(batches):
        for batch in batches:
            uids, segs, recs, size = [], [], [], 0
            cols = [batch_column(batch, c).to_pylist() for c in ("uid", "page_id", "url", "html", "digest", "first_uid", "first_id")]
            for row in zip(*cols):
                for n, rec in page_records(*row, segment_bytes):
                    uids.append(row[0])
                    segs.append(n)
                    recs.append(rec)
                    size += len(rec)
                if size > 16 << 20:
                    yield pa.record_batch([pa.array(uids, pa.int64()), pa.array(segs, pa.int32()), pa.array(recs, pa.binary())], names=["uid", "seg", "record"])
                    uids, segs, recs, size = [], [], [], 0
            yield pa.record_batch([pa.array(uids, pa.int64()), pa.array(segs, pa.int32()), pa.array(recs, pa.binary())], names=["uid", "seg", "record"])
    return run


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES, min_revisit: int = MIN_REVISIT,
               compression: str = "gzip", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one WARC record (or its segments) for each page below ``path``,
    a folder of its own on shared storage."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html")).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumn("digest", base32_sha1(F.col("html")))
    total = rows.agg(F.sum(F.length("html") + 600)).first()[0] or 0
    # the response of each payload that comes more than once: the smallest id, nulls last
    copies = (rows.where(F.length("html") >= min_revisit).groupBy("digest")
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "uid")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select(F.col("digest").alias("c_digest"), "first"))
    copies = keep(copies)
    if copies.count() <= BROADCAST_COPIES:  # else a shuffled join, whose hot payloads are split
        copies = F.broadcast(copies)
    joined = rows.join(copies, F.col("digest") == F.col("c_digest"), "left")
    other = F.col("first").isNotNull() & (F.col("first.uid") != F.col("uid"))
    joined = joined.select("uid", "page_id", "url", F.when(other, F.lit(b"")).otherwise(F.col("html")).alias("html"), "digest",
                           F.when(other, F.col("first.uid")).alias("first_uid"), F.when(other, F.col("first.page_id")).alias("first_id"))
    records = joined.mapInArrow(_records(segment_bytes), "uid long, seg int, record binary")
    files = max(1, -(-total // file_bytes))
    (records.repartition(files, F.xxhash64("uid", "seg")).select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path))


def _parse(stream):
    """Records of an archive, as (headers, block)."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        yield head, stream.read(int(head["content-length"]))


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _outcome(blocks: list[tuple[int, int | None, bytes]], stated: str | None):
    """(status, payload) of a response's segments (number, total, block)."""
    blocks = sorted(blocks, key=lambda b: b[0])
    if [b[0] for b in blocks] != list(range(1, len(blocks) + 1)):
        return "segment missing or repeated", None
    total = blocks[-1][1]
    if len(blocks) > 1 and (total is None or total != sum(len(b[2]) for b in blocks)):
        return "wrong total length", None
    try:
        payload = http_payload(b"".join(b[2] for b in blocks))
    except ValueError:
        return "broken transfer framing", None
    return ("ok", payload) if stated is None or stated == f"sha1:{_digest(payload)}" else ("wrong digest", None)


_FIELDS = [("origin", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers", pa.string()),
           ("refers_to", pa.int64()), ("stated", pa.string()), ("seg", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
           ("status", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
_SCHEMA = ("origin string, kind string, page_id long, url string, refers string, refers_to long, stated string, seg int, total long, block binary, "
           "status string, payload_bytes long, payload_digest string, payload binary")


def _num(v):
    return None if v is None else int(v)


def _read(with_payload: bool):
    def batch_of(rows):
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_FIELDS)], names=[n for n, _ in _FIELDS])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch_column(batch, "path").to_pylist(), batch_column(batch, "content")):
                raw = io.BytesIO(content.as_buffer())
                rows, size = [], 0
                for head, block in _parse(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw):
                    kind, seg, url = head["warc-type"], _num(head.get("warc-segment-number")), head.get("warc-target-uri")
                    one = seg is None and kind == "response"
                    status, payload = _outcome([(1, None, block)], head.get("warc-payload-digest")) if one else (None, None)
                    rows.append((head.get("warc-segment-origin-id", head["warc-record-id"]), kind, _num(head.get("x-page-id")),
                                 None if url is None else unquote(url), head.get("warc-refers-to"), _num(head.get("x-refers-to-page-id")),
                                 head.get("warc-payload-digest"), seg, _num(head.get("warc-segment-total-length")), None if one else block,
                                 status, None if payload is None else len(payload), None if payload is None else _digest(payload),
                                 payload if with_payload else None))
                    size += len(block)
                    if size > 16 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)
    return run


def _reassemble(with_payload: bool):
    def run(batches):
        for batch in batches:
            out = []
            for origin, head, parts in zip(*(batch_column(batch, c).to_pylist() for c in ("origin", "head", "parts"))):
                if head is None:  # continuation records without their first
                    out.append((origin, "response", None, None, None, None, "segment missing or repeated", None, None, None))
                elif head["kind"] == "response" and head["status"] is None:
                    status, payload = _outcome([(p["seg"], p["total"], p["block"]) for p in parts], head["stated"])
                    good = payload is not None
                    out.append((origin, "response", head["page_id"], head["url"], None, None, status, len(payload) if good else None,
                                _digest(payload) if good else None, payload if with_payload else None))
                else:
                    out.append((origin, *(head[c] for c in ("kind", "page_id", "url", "refers", "refers_to", "status", "payload_bytes", "payload_digest", "payload"))))
            types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary())
            names = ("origin", "record_type", "page_id", "url", "refers", "refers_to", "status", "payload_bytes", "payload_digest", "payload")
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=list(names))
    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``, segments joined:
    page_id, url, record_type, refers_to, status, payload_bytes,
    payload_digest, payload (null unless asked for). A revisit record's
    length and digest are those of the response it refers to."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    parts = files.mapInArrow(_read(with_payload), _SCHEMA)
    head = F.struct("kind", "page_id", "url", "refers", "refers_to", "stated", "status", "payload_bytes", "payload_digest", "payload")
    grouped = parts.groupBy("origin").agg(
        F.any_value(F.when(F.col("kind") != "continuation", head), F.lit(True)).alias("head"),
        F.collect_list(F.when(F.col("block").isNotNull() & (F.col("kind") != "revisit"), F.struct("seg", "total", "block"))).alias("parts"))
    whole = grouped.mapInArrow(_reassemble(with_payload), "origin string, record_type string, page_id long, url string, refers string, refers_to long, "
                               "status string, payload_bytes long, payload_digest string, payload binary")
    if not with_payload:
        whole = whole.drop("payload")
    own = ["payload_bytes", "payload_digest"] + (["payload"] if with_payload else [])
    kept = ["page_id", "url", "record_type", "refers_to"]
    responses = whole.where("record_type = 'response'")
    named = responses.select(F.col("origin").alias("r_origin"), F.col("status").alias("r_status"), *(F.col(c).alias(f"r_{c}") for c in own))
    revisits = (whole.where("record_type = 'revisit'").join(named, F.col("refers") == F.col("r_origin"), "left")
                .select(*kept, F.coalesce("r_status", F.lit("response missing")).alias("status"), *(F.col(f"r_{c}").alias(c) for c in own)))
    return responses.select(*kept, "status", *own).unionByName(revisits)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, status."""
    path = new_folder(pages.sparkSession, "warc")
    write_warc(pages, path)
    return read_warc(pages.sparkSession, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")

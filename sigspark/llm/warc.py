"""WARC archives: segmented, chunk-framed records written and reassembled.

``write_archives`` turns page rows into WARC/1.1 records inside gzip archives
in a shared folder. A response's HTTP block is framed in chunks and, beyond
``segment_bytes``, split into a first segment and continuation records.
``read_archives`` parses every archive by Content-Length, groups continuation
records by their origin identifier, orders them by segment number, verifies
the total length, decodes the chunked framing and verifies the payload digest.
Archives hold at most ``records_per_archive`` records of bounded length, so
one archive always fits a task.

Cases: null html is the empty payload; a null url has no target header; a null
page_id is written as such, is never a response others refer to, and is a
revisit only of a page with an id; rows repeated whole are separate records,
and all rows that share the largest page_id of a payload are responses; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, fresh_path, materialize, table, tidy

REVISIT_LEAST = 1000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

SEGMENT = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("declared", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
SEGMENT_DDL = "page_id long, record_type string, refers_to long, declared string, origin string, segment int, total long, block binary, payload_bytes long, payload_digest string"


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most size bytes (size >= 4) that end between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunk_encode(payload: bytes, size: int) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in _cut(payload, size)) + b"0\r\n\r\n"


def chunk_decode(framed: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = framed.index(b"\r\n", at)
        n = int(framed[at:eol].split(b";")[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)
        out.append(framed[at : at + n])
        if len(out[-1]) != n or framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("broken chunk framing")
        at += n + 2


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return chunk_decode(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n"  # the writer's line separator is the second CRLF


@tidy
def _write(batches: Iterator[pa.RecordBatch], segment_bytes: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    serial, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        rows = batch.to_pydict()
        records: list[bytes] = []
        for page, url, html, refers in zip(rows["page_id"], rows["url"], rows["html"], rows["refers_to"], strict=True):
            payload = html.encode()
            serial += 1
            ident = f"<urn:x-page:{page}:{part}-{serial}>"
            target = None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
            common = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(payload).hexdigest())]
            if refers is not None:
                headers = [("WARC-Type", "revisit"), ("WARC-Record-ID", ident), ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers}>"), *common]
                records.append(_record([*headers, ("Content-Type", "application/http;msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n"))
                continue
            parts = list(_cut(HTTP_HEAD + chunk_encode(payload, chunk_bytes), segment_bytes))
            total = sum(map(len, parts))
            for k, block in enumerate(parts, 1):
                if k == 1:
                    headers = [("WARC-Type", "response"), ("WARC-Record-ID", ident), *common, ("Content-Type", "application/http;msgtype=response"), ("WARC-Segment-Number", 1 if len(parts) > 1 else None)]
                else:
                    headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{ident[:-1]}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", ident), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total if k == len(parts) else None)]
                records.append(_record(headers, block))
        yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).cast(pa.string())], names=["value"])


def assign_revisits(pages: DataFrame) -> DataFrame:
    """pages with ``refers_to``: for payloads of REVISIT_LEAST bytes and more, the largest page_id that has the same one.

    The aggregation combines before its shuffle, and the join is one that Spark
    can split where a payload is common; html moves once.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = keyed.withColumn("size", F.octet_length("html")).withColumn("key", F.when(F.col("size") >= REVISIT_LEAST, F.sha2("html", 256)))
    first = keyed.where("key IS NOT NULL").groupBy("key").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
    first = first.where("n > 1 AND response_id IS NOT NULL").select("key", "response_id")
    other = F.col("page_id").isNull() | (F.col("page_id") < F.col("response_id"))
    return keyed.join(first, "key", "left").select("page_id", "url", "html", F.when(other, F.col("response_id")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = 16384, chunk_bytes: int = 4096, records_per_archive: int = 2000) -> None:
    """pages(page_id, url, html, refers_to) as gzip archives of WARC/1.1 records under path."""
    bounded_batches(pages.sparkSession)
    records = pages.mapInArrow(lambda b: _write(b, segment_bytes, chunk_bytes), "value string")
    records.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_archive).text(path)


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        n = int(headers["content-length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) != n or data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield headers, block
        at = end + 8 + n


def _decoded(block: bytes, declared: str) -> tuple[int, str]:
    payload = payload_of(block)
    digest = hashlib.sha1(payload).hexdigest()
    if digest != declared:
        raise ValueError("a payload's digest differs from the declared one")
    return len(payload), digest


def _page(ident: str) -> int | None:
    number = ident.strip("<>").split(":")[2]
    return None if number == "None" else int(number)


@tidy
def _parse(batches: Iterator[pa.RecordBatch], with_block: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            out: list[dict] = []
            for h, block in parse_archive(content.as_py()):
                kind = h["warc-type"]
                row = dict.fromkeys(SEGMENT.names) | {"record_type": kind, "declared": h.get("warc-payload-digest", "").removeprefix("sha1:") or None}
                if kind == "revisit":
                    row |= {"page_id": _page(h["warc-record-id"]), "refers_to": _page(h["warc-refers-to"])}
                elif kind == "continuation":
                    total = h.get("warc-segment-total-length")
                    row |= {"origin": h["warc-segment-origin-id"], "segment": int(h["warc-segment-number"]), "total": total and int(total), "block": block}
                else:
                    row |= {"page_id": _page(h["warc-record-id"])}
                    if "warc-segment-number" in h:
                        row |= {"origin": h["warc-record-id"], "segment": 1, "block": block}
                    else:
                        row["payload_bytes"], row["payload_digest"] = _decoded(block, row["declared"])
                        row["block"] = block if with_block else None
                out.append(row)
                if len(out) == 500:
                    yield pa.RecordBatch.from_pylist(out, schema=SEGMENT)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=SEGMENT)


@tidy
def _reassemble(batches: Iterator[pa.RecordBatch], with_block: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts = row.pop("parts")
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError(f"segments of {row['origin']} are missing")
            block = b"".join(p["block"] for p in parts)
            if len(block) != row["total"]:
                raise ValueError(f"total length of {row['origin']} is wrong")
            row["payload_bytes"], row["payload_digest"] = _decoded(block, row["declared"])
            row |= {"record_type": "response", "refers_to": None, "segment": len(parts), "block": block if with_block else None}
            yield pa.RecordBatch.from_pylist([row], schema=SEGMENT)


def read_archives(spark: SparkSession, path: str, with_block: bool = False) -> DataFrame:
    """One row per response or revisit record; a segmented record is grouped by origin, ordered and verified."""
    bounded_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = files.mapInArrow(lambda b: _parse(b, with_block), SEGMENT_DDL)
    whole = parsed.where("origin IS NULL")
    part = F.struct("segment", "block")
    groups = parsed.where("origin IS NOT NULL").groupBy("origin").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("page_id").alias("page_id"), F.max("total").alias("total"), F.max("declared").alias("declared"))
    return whole.unionByName(groups.mapInArrow(lambda b: _reassemble(b, with_block), SEGMENT_DDL))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(assign_revisits(table(spark, sf_dir, "pages")), path)
    records = read_archives(spark, path).select("page_id", "record_type", "refers_to", "declared", "payload_bytes", "payload_digest")
    records = materialize(records, "warc-records")
    answers = records.where(f"record_type = 'response' AND payload_bytes >= {REVISIT_LEAST}").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"))
    answers = answers.dropDuplicates(["refers_to", "declared"])
    found = records.join(answers, ["refers_to", "declared"], "left")
    return found.select("page_id", F.coalesce("payload_bytes", "n").alias("payload_bytes"), F.coalesce("payload_digest", "d").alias("payload_digest"), "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS r FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN r IS NOT NULL AND (page_id IS NULL OR page_id < r) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN r IS NOT NULL AND (page_id IS NULL OR page_id < r) THEN r END AS refers_to
FROM g
"""

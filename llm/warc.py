"""WARC archives: writing pages as records, and reading them back with segments reassembled.

Writing: of pages with equal payloads, the one with the largest id is a response record with
the payload in chunked transfer framing; the others are revisit records that name its digest and
page. Blocks above ``SEGMENT_BYTES`` are cut into a first segment and continuation records,
which name the first one's record id and their number, the last also the total length. Spark's
writer puts the records into gzip files of at most ``FILE_RECORDS`` records, so no archive
needs more memory than segments times records.

Reading: files are parsed as streams. Whole records are decoded where they are found; segments
are grouped by origin id, put in order of their numbers, checked to be complete and of the
stated total length, and decoded. Chunked framing is undone and the payload's digest compared
with the stated one; an archive that does not hold raises an error.

Null payloads are empty ones; equal payloads include empty ones. Repeated rows with the
largest id are responses each. Rows with a null id are responses only if no other row has
their payload, and else revisits. URLs may hold anything; line ends in them are percent-encoded.
An empty table gives no records and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read, shared_folder, stored

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
FILE_RECORDS = 2000
VERSION = b"WARC/1.1"
LINE = b"\r\n"
DATE = "2000-01-01T00:00:00Z"
_FACTS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_PARSED = _FACTS + ", origin string, number int, total long, fields map<string,string>, block binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x" % len(part), LINE, part, LINE]
    return b"".join([*parts, b"0", LINE, LINE])


def dechunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(LINE, at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part = body[end + 2 : end + 2 + size]
        if len(part) != size or body[end + 2 + size : end + 4 + size] != LINE:
            raise ValueError("a chunk is cut short")
        parts.append(part)
        at = end + 4 + size


def record(fields: dict[str, str], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items()), b"Content-Length: %d" % len(block)]
    return LINE.join(head) + LINE + LINE + block


def page_records(page_id, url, payload: bytes, refers_to, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page: a revisit, or a response in as many segments as it takes."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Payload-Length": str(len(payload)),
    }
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["X-Refers-To-Page-ID"] = str(refers_to)
        return [record(fields, head)]
    block = head + chunked(payload)
    if len(block) <= segment:
        return [record(fields, block)]
    out = [record(fields | {"WARC-Segment-Number": "1"}, block[:segment])]
    for number, at in enumerate(range(segment, len(block), segment), 2):
        part = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": name,
            "WARC-Segment-Number": str(number),
        }
        if at + segment >= len(block):
            part["WARC-Segment-Total-Length"] = str(len(block))
        out.append(record(part, block[at : at + segment]))
    return out


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) in the folder ``path``."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("_sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    responses = rows.groupBy("_sha").agg(F.max("page_id").alias("_response"))
    responses = stored(responses, "responses")  # joined as read, a hot payload can be split
    named = rows.join(responses, "_sha").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_response")), F.col("_response"))
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pylist()
                made = [x for r in part for x in page_records(r["page_id"], r["url"], r["html"].encode(), r["refers_to"], segment)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    made = named.select("page_id", "url", "html", "refers_to").mapInArrow(records, "record binary")
    # the cast keeps bytes as they are; the separator is the end of a record
    made.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def parsed(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an open archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.rstrip() != VERSION:
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (LINE, b""):
            key, _, value = line.decode().rstrip("\r\n").partition(":")
            fields[key.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != LINE + LINE:
            raise ValueError("a record is cut short")
        yield fields, block


def _facts(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    """The result row of a whole record."""
    kind = fields["warc-type"]
    page = int(fields["x-page-id"]) if "x-page-id" in fields else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "revisit":
        return page, int(fields["x-payload-length"]), digest, kind, int(fields["x-refers-to-page-id"]), None
    head, _, body = block.partition(LINE + LINE)
    framed = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(LINE))
    payload = dechunked(body) if framed else body
    if digest_of(payload) != digest:
        raise ValueError("a payload does not have its digest")
    return page, len(payload), digest, kind, None, payload if keep else None


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per page of the archives in ``path``: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to`` and the payload (of responses, if kept)."""
    names = [x.split()[0] for x in _PARSED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(),
             pa.string(), pa.int32(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for content in batch.column("content"):
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                    for fields, block in parsed(stream):
                        if "warc-segment-number" in fields:
                            origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                            total = fields.get("warc-segment-total-length")
                            row = (None,) * 6 + (origin, int(fields["warc-segment-number"]), total and int(total), list(fields.items()), block)
                        else:
                            row = _facts(fields, block, keep_payload) + (None,) * 5
                        rows.append(row)
                        if len(rows) == 256:
                            yield batch_of()
                            rows = []
            if rows:
                yield batch_of()
                rows = []

    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, _PARSED)
    found = stored(found, "records")
    facts = names[:6]
    segments = found.where("origin IS NOT NULL").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),  # of one record
        F.max("total").alias("total"),
        F.max_by("fields", F.col("number") == 1).alias("fields"),
    )

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if [p["number"] for p in row["parts"]] != list(range(1, len(row["parts"]) + 1)):
                    raise ValueError(f"segments of {row['origin']} are missing or repeated")
                block = b"".join(p["block"] for p in row["parts"])
                if len(block) != row["total"]:
                    raise ValueError(f"segments of {row['origin']} do not have the stated length")
                made = _facts(dict(row["fields"]), block, keep_payload)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made, kinds, strict=False)], names=facts)

    whole = segments.mapInArrow(reassemble, _FACTS)
    every = found.where("origin IS NULL").select(facts).unionByName(whole)
    return every if keep_payload else every.drop("payload")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(read(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, keep_payload=False)


OP3_SQL = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (SELECT *, CAST(unhex(h) AS BIT)::VARCHAR AS b FROM hashed),
coded AS (
  SELECT page_id, strlen(html) AS payload_bytes, h,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (16 * (b[5 * i + 1])::INT + 8 * (b[5 * i + 2])::INT + 4 * (b[5 * i + 3])::INT
             + 2 * (b[5 * i + 4])::INT + (b[5 * i + 5])::INT), 1)), '') AS payload_digest
  FROM bits),
responses AS (SELECT h, max(page_id) AS response FROM coded GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM coded JOIN responses USING (h)
"""

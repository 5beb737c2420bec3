"""Archives: exact round trips, segments, framing, and damage."""

import gzip
import io
import uuid

import pytest

from checks.compare import difference, duckdb_over
from llm.common import shared_folder
from llm.warc import OP3_SQL, chunked, dechunked, digest_of, op3_warc, page_records, parsed, read_archives, write_archives

SF_DIR = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, host string, payload string"


def round_trip(spark, rows, **how):
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.createDataFrame([(*r, "h", "p") for r in rows], PAGES), path, **how)
    return path, sorted((tuple(r) for r in read_archives(spark, path).collect()), key=repr)


def test_equals_its_sql(spark):
    got = op3_warc(spark, SF_DIR).toPandas()
    assert difference(got, duckdb_over(SF_DIR).execute(OP3_SQL).df()) is None


@pytest.mark.parametrize("segment", [100, 1 << 15])
def test_round_trip(spark, segment):
    tricky = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 3000
    rows = [(1, "http://a", "x" * 90_000 + "é" * 5_000), (2, None, None), (3, "http://b\r\nX: y", tricky),
            (None, "u", ""), (5, "u", "q"), (4, "u", "q"), (5, "u", "q"), (9, "u", None)]
    _, got = round_trip(spark, rows, segment=segment)
    response = lambda i, t: (i, len(t.encode()), digest_of(t.encode()), "response", None, bytearray(t.encode()))
    revisit = lambda i, t, of: (i, len(t), digest_of(t.encode()), "revisit", of, None)
    want = [response(1, rows[0][2]), response(3, tricky), response(5, "q"), response(5, "q"), revisit(4, "q", 5),
            response(9, ""), revisit(2, "", 9), revisit(None, "", 9)]
    assert got == sorted(want, key=repr)


def test_long_pages_are_stored_in_numbered_segments():
    first, *more = page_records(1, "u", b"y" * 1000, None, segment=300)
    assert b"WARC-Segment-Number: 1\r\n" in first and len(more) == 3
    assert [b"WARC-Type: continuation" in x for x in more] == [True] * 3
    assert [b"WARC-Segment-Total-Length" in x for x in more] == [False, False, True]


def test_a_lost_segment_is_an_error(spark):
    path, _ = round_trip(spark, [(1, "u", "z" * 1000)], segment=300)
    files = [r.path for r in spark.read.format("binaryFile").load(path).where("length > 30").select("path").collect()]
    data = gzip.decompress(spark.read.format("binaryFile").load(files[0]).first()["content"])
    records = [x for x in parsed(io.BytesIO(data))]
    assert len(records) == 4
    cut = data[: data.rindex(b"WARC/1.1")]
    name = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(bytearray(cut.removesuffix(b"\r\n\r\n")),)], "r binary").selectExpr("CAST(r AS string) AS r")
    df.coalesce(1).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(name)
    with pytest.raises(Exception, match="stated length|missing"):
        read_archives(spark, name).collect()


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n" * 5000, bytes(range(256)) * 100):
        assert dechunked(chunked(payload, 7)) == payload
    assert dechunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_no_pages(spark):
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.createDataFrame([], PAGES), path)
    assert read_archives(spark, path).count() == 0

"""The content-addressed WARC archive: round trips, ties, damage."""

import glob
import hashlib

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidewater.llm import warc

LONG = "<p>é long page</p>" * 100
ROWS = [(1, "http://a.example/1", LONG), (2, "http://a.example/2", LONG), (9, "http://a.example/9", LONG),
        (3, "u", "short"), (4, "u", "short"), (5, None, None), (6, "http://a.example/\r\nWARC-Type: x\r\n%0D", ""),
        (7, "v", "WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: revisit\r\n" + "x" * 2000), (None, "w", LONG), (None, "w", LONG),
        (9, "http://a.example/9", LONG), (8, "z", "y" * 999), (10, "z", "y" * 999), (11, "z", "y" * 1000), (12, "z", "y" * 1000)]


def archive(spark, tmp, rows=ROWS, schema="page_id long, url string, html string"):
    path = f"{tmp}/archive"
    warc.archive_pages(spark.createDataFrame(rows, schema), path)
    return path


def test_pages(spark, tmp):
    path = archive(spark, tmp)
    got = sorted((tuple(r) for r in warc.describe(warc.read_archive(spark, path)).collect()), key=str)
    last = {LONG: 9, "y" * 1000: 12}
    expected, seen = [], set()
    for page, _, html in sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0]):
        data = (html or "").encode()
        name = None if page is None else str(page)
        again = html in last and not (page == last[html] and html not in seen)
        if html in last and page == last[html]:
            seen.add(html)
        expected.append((name, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                         str(last[html]) if again else None))
    assert got == sorted(expected, key=str)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({h or "" for _, _, h in ROWS})


def test_records_are_whole_and_headers_hold_one_value_each(spark, tmp):
    records = warc.read_archive(spark, archive(spark, tmp)).collect()
    assert len(records) == len(ROWS)
    for r in records:
        head, payload = bytes(r["header"]), bytes(r["payload"])
        assert head.count(b"\r\nWARC-Type: ") == 1 and head.endswith(b"\r\n\r\n") and head.count(b"\r\n\r\n") == 2
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n\r\n")[0].split(b"\r\n")[1:])
        body = len(head.split(b"\r\n\r\n")[1]) + 4
        own = b"" if fields[b"WARC-Type"] == b"revisit" else payload
        assert int(fields[b"Content-Length"]) == body + len(own)
    ids = [warc.header_field("WARC-Record-ID").alias("i")]
    assert warc.read_archive(spark, f"{tmp}/archive").select(*ids).distinct().count() == len(ROWS)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_files_and_back(spark, tmp, compression):
    records = warc.read_archive(spark, archive(spark, tmp))
    warc.export_warc(records, f"{tmp}/files", 4, compression)
    assert len(glob.glob(f"{tmp}/files/part-*")) >= 4
    own = records.select("header", F.when(warc.header_field("WARC-Type") == "revisit", F.lit(b""))
                         .otherwise(F.col("payload")).alias("payload"))
    expected = sorted((bytes(a), bytes(b)) for a, b in own.collect())
    read = warc.import_warc(spark, f"{tmp}/files")
    assert sorted((bytes(a), bytes(b)) for a, b in read.collect()) == expected
    warc.archive_records(read, f"{tmp}/second")
    again = warc.read_archive(spark, f"{tmp}/second").select("header", "payload")
    assert sorted((bytes(a), bytes(b)) for a, b in again.collect()) == expected


def test_hot_payload_is_read_in_parts(spark, tmp):
    rows = [(i, "u", LONG) for i in range(3 * warc.PART_RECORDS)] + [(-1, "u", "other")]
    records = warc.read_archive(spark, archive(spark, tmp, rows))
    told = warc.describe(records).groupBy("record_type", "refers_to").count().collect()
    assert {tuple(r) for r in told} == {("response", None, 2), ("revisit", str(len(rows) - 2), len(rows) - 2)}


def test_empty_extra_columns_and_damage(spark, tmp):
    path = archive(spark, f"{tmp}/none", [])
    assert warc.describe(warc.read_archive(spark, path)).collect() == []
    wide = "page_id long, url string, html string, digest string, row string, `a.b` int"
    path = archive(spark, f"{tmp}/wide", [(1, "u", "x", "d", "r", 1)], wide)
    assert warc.describe(warc.read_archive(spark, path)).first()["page_id"] == "1"
    bad = f"{tmp}/bad"
    spark.read.parquet(f"{path}/headers").write.parquet(f"{bad}/headers")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"y")).write.parquet(f"{bad}/payloads")
    with pytest.raises(SparkRuntimeException, match="damaged payload"):
        warc.read_archive(spark, bad).collect()
    gone = f"{tmp}/gone"
    spark.read.parquet(f"{path}/headers").write.parquet(f"{gone}/headers")
    spark.read.parquet(f"{path}/payloads").where("false").write.parquet(f"{gone}/payloads")
    with pytest.raises(SparkRuntimeException, match="no payload"):
        warc.read_archive(spark, gone).collect()


def test_bytes_that_are_no_record():
    for data in (b"x", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.split_records(data))

"""A content-addressed archive of WARC records.

An archive is a folder with two tables.  ``payloads`` holds the bytes of every
distinct payload once, under their SHA-256; ``headers`` holds the exact bytes
that precede the payload in each record (WARC fields and HTTP head) with the
address of the payload.  Records are put together again by joining the two.

The address is verified twice: when written, everything under one address has
to agree in SHA-1, a third hash and length; when read, the bytes are hashed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import begin_task, end_setup, read_table, staged, work_dir

#: Records with equal payloads of at least so many bytes revisit one of them.
REVISIT_BYTES = 1000
#: Records that share a payload are joined with it in parts of about this many;
#: a part costs one more copy of the payload in the join's shuffle.
PART_RECORDS = 256
#: ``WARC-Date`` where the table has no date of its own.
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def _escaped(text):
    """Text that stays in one header line: ``%``, controls and DEL percent-encoded."""
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _unescaped(text):
    for code in (*range(32), 127):
        text = F.replace(text, F.lit(f"%{code:02X}"), F.lit(chr(code)))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def _line(name: str, value):
    """One header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uuid(*parts):
    h = F.md5(F.concat_ws(":", *parts))
    return F.concat(F.lit("<urn:uuid:"), *[x for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                           for x in ([F.lit("-")] if at > 1 else []) + [F.substring(h, at, n)]], F.lit(">"))


def _addressed(rows: DataFrame) -> DataFrame:
    payload = F.col("payload")
    return rows.select("*", F.unhex(F.sha2(payload, 256)).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
                       F.sha1(payload).alias("sha1"), F.xxhash64(payload).alias("check"))


def _by_address(rows: DataFrame, *more) -> DataFrame:
    """One row for each address; raises where two payloads share one."""
    agree = ((F.min("sha1") == F.max("sha1")) & (F.min("check") == F.max("check")) & (F.min("size") == F.max("size")))
    told = F.concat(F.lit("payloads differ under one address: "), F.hex("digest"))
    return (rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), agree.alias("agree"), *more)
            .withColumn("copies", F.when(F.col("agree"), F.col("copies")).otherwise(F.raise_error(told).cast("long")))
            .drop("agree"))


def _write_payloads(payloads: DataFrame, path: str) -> None:
    """Every distinct payload once.  Copies are dropped within a task before the shuffle."""
    (payloads.select(F.unhex(F.sha2("payload", 256)).alias("digest"), "payload")
     .groupBy("digest").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))


def archive_pages(pages: DataFrame, path: str, threshold: int = REVISIT_BYTES, date: str = DATE) -> None:
    """Write one record for each row of ``pages`` (page_id, url, html) to a new
    archive at ``path``.

    The payload is the html in UTF-8 (null: empty).  Of records with equal
    payloads of ``threshold`` bytes or more, the one with the largest page_id
    is a ``response`` (null ids are smallest; of rows that share the id any
    one), the others are ``revisit`` records that refer to it; all other
    records are responses.  Repeated rows are records of their own.  A null url
    or page_id has no header line.  Control characters and ``%`` in them are
    percent-encoded, so that no value can end a header.  An empty table gives
    an empty archive; other columns are left out.

    Payload bytes are shuffled once, after copies within a task are gone;
    record types are decided on narrow rows."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    rows = staged(_addressed(pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", payload))
                  .drop("payload"), "warc-rows")
    last = staged(_by_address(rows, F.max(F.struct("page_id", "row")).alias("last")), "warc-last")
    again = (F.col("size") >= threshold) & (F.col("row") != F.col("last.row"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(_END))
    length = F.octet_length(head) + F.when(again, F.lit(0)).otherwise(F.col("size"))

    def known_as(page_id):
        return _escaped(page_id.cast("string"))

    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _uuid(F.col("row").cast("string"), "sha1")), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _escaped(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Page-ID", known_as(F.col("page_id"))),
        _line("WARC-Profile", F.when(again, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.when(again, _uuid(F.col("last.row").cast("string"), "sha1"))),
        _line("WARC-Refers-To-Page-ID", F.when(again, known_as(F.col("last.page_id")))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", length.cast("string")), F.lit("\r\n"), head)
    (rows.join(last, "digest").select("row", F.encode(header, "UTF-8").alias("header"), "digest", "copies")
     .write.parquet(f"{path}/headers"))
    _write_payloads(pages.select(payload), path)


def archive_records(records: DataFrame, path: str) -> None:
    """Write records (``header``, ``payload``, both binary; null: empty) as
    they are to a new archive at ``path``."""
    filled = records.select(*[F.coalesce(c, F.lit(b"")).alias(c) for c in ("header", "payload")])
    rows = staged(_addressed(filled.withColumn("row", F.monotonically_increasing_id())).drop("payload"), "warc-rows")
    rows.join(_by_address(rows), "digest").select("row", "header", "digest", "copies").write.parquet(f"{path}/headers")
    _write_payloads(filled.select("payload"), path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``row``, ``header``, ``payload`` of every record of an archive.  A
    revisit record comes with the payload that it shares.  Raises where stored
    bytes do not have the digest they are stored under, or a payload is missing.

    Records that share a payload meet it in parts of :data:`PART_RECORDS`, each
    with a copy of the payload, however many share it."""
    parts = F.ceil(F.col("copies") / F.lit(PART_RECORDS))
    headers = spark.read.parquet(f"{path}/headers").select(
        "row", "header", "digest", F.pmod(F.xxhash64("row"), parts).alias("part"))
    sound = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.hex("digest"))).cast("binary")
    stored = spark.read.parquet(f"{path}/payloads").select(
        "digest", F.when(sound, F.col("payload")).otherwise(damaged).alias("payload"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)).alias("part"))
    missing = F.raise_error(F.concat(F.lit("no payload "), F.hex("digest"))).cast("binary")
    return headers.join(stored, ["digest", "part"], "left").select(
        "row", "header", F.when(F.col("payload").isNull(), missing).otherwise(F.col("payload")).alias("payload"))


def header_field(name: str, header="header"):
    """Column: the value of a WARC header field, null if absent."""
    text = F.decode(F.col(header), "UTF-8")
    return F.nullif(F.regexp_extract(text, rf"(?s)^(?:(?!\r\n\r\n).)*?\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def warc_record(header="header", payload="payload"):
    """Column: a record's bytes as they stand in a WARC file, but for the blank
    lines that end it: revisit records have no payload of their own."""
    own = F.when(header_field("WARC-Type", header) == "revisit", F.lit(b"")).otherwise(F.col(payload))
    return F.concat(F.col(header), own)


def describe(records: DataFrame) -> DataFrame:
    """``page_id`` (string), ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` (string) of records as :func:`read_archive` returns them.
    Length and digest are taken from the payload; raises where the header names another."""
    sha1 = F.sha1("payload")
    same = header_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1)
    other = F.raise_error(F.concat(F.lit("payload of another digest in record "), F.col("row").cast("string")))
    return records.select(
        _unescaped(header_field("WARC-Page-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.coalesce(same, F.lit(False)), sha1).otherwise(other.cast("string")).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        _unescaped(header_field("WARC-Refers-To-Page-ID")).alias("refers_to"))


def export_warc(records: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE,
                compression: str = "none") -> None:
    """Write records as ``.warc`` text files of at most ``records_per_file`` records."""
    (records.select(warc_record().cast("string").alias("value")).write.option("lineSep", _END)
     .option("maxRecordsPerFile", records_per_file).option("compression", compression).text(folder))


def import_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``header`` and ``payload`` of every record in the files of ``folder``
    (plain or gzip), in any order; a file is read as a whole.  The header ends
    with the HTTP head, where a record has one.  Bytes that are no record raise."""

    def run(batches):
        import gzip

        import pyarrow as pa

        begin_task()
        end_setup()
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                pairs = list(split_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)],
                                                 names=["header", "payload"])

    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("content")
    return files.mapInArrow(run, "header binary, payload binary")


def split_records(data: bytes):
    """Header and payload of each record in the bytes of a WARC file."""
    at, end = 0, _END.encode()
    while at < len(data):
        stop = data.find(end, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(b":", 1) for line in data[at:stop].split(b"\r\n")[1:])
        fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
        block = stop + 4
        done = block + int(fields[b"content-length"])
        if data[done:done + 4] != end:
            raise ValueError(f"record at byte {at} does not end where its length says")
        body = block
        if fields.get(b"content-type", b"").startswith(b"application/http"):
            body = data.index(end, block, done) + 4
        yield data[at:body], data[body:done]
        at = done + 4


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    archive_pages(read_table(spark, sf_dir, "pages"), path)
    return describe(read_archive(spark, path)).select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))


QUERIES = {"op13_warc": op13_warc}
ORACLES = {"op13_warc": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS n, sha1(payload) AS h, sha256(payload) AS h2 FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h, h2, n) AS last FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM r"""}

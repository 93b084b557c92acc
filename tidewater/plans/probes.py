"""Health probe suite: small known-answer jobs, reported as
``(probe, expected, actual, status, line)`` rows.

Each probe exercises one part of the platform with data the caller gives
(or the built-in known answers): storage round trip, catalog table over a
delimited directory, JSON documents count, pi estimate, and
generate/sort/validate.  All three aggregate values must match (the old
alternation accepted any one)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FAILURE, PROBE_LINE, SUCCESS
from ..operators.estimate import estimate_pi, random_points
from ..operators.sorting import row_checksum, row_sums, total_order_sort, validate_sorted
from ..session import shared_root, work_dir
from ..sinks.files import delete_path
from ..sinks.tables import create_database, drop_table
from ..sources.generated import (SQUARES_ANSWER, SQUARES_DDL, create_external_csv_table,
                                 generated_rows, load_json_documents, squares_lines)

REPORT_SCHEMA = "probe string, expected string, actual string, status string"


def _row(spark, probe, expected, actual, contains: bool = False) -> DataFrame:
    ok = str(expected) in str(actual) if contains else str(expected) == str(actual)
    return spark.createDataFrame([(probe, str(expected), str(actual), SUCCESS if ok else FAILURE)],
                                 REPORT_SCHEMA)


def storage_roundtrip(spark: SparkSession, data: DataFrame) -> DataFrame:
    """Write ``data`` to shared storage, read it back, compare row count and
    two sums over all columns (:func:`~tidewater.operators.sorting.row_sums`)."""
    path = work_dir(spark, "roundtrip")

    def summary(df):
        return "/".join(map(str, df.agg(F.count(F.lit(1)), *row_sums(df)).first()))

    before = summary(data)
    data.write.mode("overwrite").parquet(path)
    after = summary(spark.read.parquet(path))
    delete_path(spark, path)
    return _row(spark, "Storage round trip", before, after)


def catalog_table_probe(spark: SparkSession, lines: DataFrame | None = None,
                        expected: tuple | None = None, database: str = "tidewater_probe") -> DataFrame:
    """Create a database and an external ``sqrt INT, square INT`` table over
    a directory of ``sqrt,square`` lines, check it is listed, aggregate
    ``count, sum(square), sum(sqrt)``, drop it."""
    lines = lines if lines is not None else squares_lines(spark)
    location = work_dir(spark, "squares")
    lines.write.mode("overwrite").text(location)
    create_database(spark, database, location=f"{shared_root(spark)}/tidewater-work/{database}.db")
    name = f"{database}.probe_squares_{uuid.uuid4().hex[:8]}"
    create_external_csv_table(spark, name, SQUARES_DDL, location)
    listed = spark.catalog.tableExists(name)
    agg = spark.table(name).agg(F.count(F.lit(1)).alias("n"), F.sum("square").alias("sq"),
                                F.sum("sqrt").alias("rt")).first()
    drop_table(spark, name)
    delete_path(spark, location)
    exp = expected if expected is not None else SQUARES_ANSWER
    return (_row(spark, "Catalog create table", True, listed)
            .unionByName(_row(spark, "Catalog select table", "/".join(map(str, exp)),
                              f"{agg['n']}/{agg['sq']}/{agg['rt']}")))


def document_count_probe(spark: SparkSession, path: str, expected: int, multiline: bool = True) -> DataFrame:
    n = load_json_documents(spark, path, multiline=multiline).count()
    return _row(spark, "Document search", expected, n)


def pi_probe(spark: SparkSession, n: int = 200_000, seed: int = 42) -> DataFrame:
    est = estimate_pi(random_points(spark, n, seed)).first()
    return _row(spark, "Pi estimate", "Pi is roughly 3.", "Pi is roughly %r" % est["pi"], contains=True)


def sort_probe(spark: SparkSession, rows: int = 1_000_000, data: DataFrame | None = None) -> DataFrame:
    """Sort rows by ``key`` (those of ``data``, else generated ones), write them
    and validate what was written."""
    data = data if data is not None else generated_rows(spark, rows)
    path = work_dir(spark, "sorted")
    total_order_sort(data, "key").write.mode("overwrite").parquet(path)
    v = validate_sorted(spark, path, "key").first()
    expected = data.agg(F.count(F.lit(1)).alias("n"), F.sum(row_checksum(data)).alias("ck")).first()
    delete_path(spark, path)
    return _row(spark, "Sort and validate", f"{expected['n']}/{expected['ck']}/0",
                f"{v['n']}/{v['checksum']}/{v['inversions']}")


def run_probes(spark: SparkSession, roundtrip_data: DataFrame | None = None,
               json_path: str | None = None, json_expected: int | None = None,
               sort_rows: int = 1_000_000, json_multiline: bool = True,
               sort_data: DataFrame | None = None) -> DataFrame:
    """The whole suite; each probe's rows carry a padded report ``line``."""
    parts = [
        storage_roundtrip(spark, roundtrip_data if roundtrip_data is not None else spark.range(1000)),
        catalog_table_probe(spark),
        pi_probe(spark),
        sort_probe(spark, sort_rows, sort_data),
    ]
    if json_path is not None:
        parts.append(document_count_probe(spark, json_path, json_expected, json_multiline))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("line", F.format_string(PROBE_LINE, F.col("probe"), F.col("status")))

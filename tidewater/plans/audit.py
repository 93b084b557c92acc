"""Run audit: one log row per touched table per job run, with the rows
changed inside the run's time window.

Usage::

    with audited_run(spark, "platform", "app", ["db.t1", "db.t2"],
                     log_table="stats.run_log") as run:
        ...  # the audited Spark work
    # rows are appended when the block exits, success or failure

The log table is partitioned by ``(pltfrm_nm, aplctn_nm)``.
"""

from __future__ import annotations

import contextlib
import io
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..functions.text import default_unknown, log_escape
from ..operators.window import rows_changed_per_table
from ..sinks.tables import append_by_name, create_table

AUDIT_SCHEMA = StructType([
    StructField("table_name", StringType()),
    StructField("start_ts", StringType()),
    StructField("end_ts", StringType()),
    StructField("success", BooleanType()),
    StructField("rows_changed", LongType()),
    StructField("workflow_id", StringType()),
    StructField("application_id", StringType()),
    StructField("stdout", StringType()),
    StructField("stderr", StringType()),
    StructField("pltfrm_nm", StringType()),
    StructField("aplctn_nm", StringType()),
])
# The partition columns of the audit log.
PARTITIONS = ("pltfrm_nm", "aplctn_nm")


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def create_audit_table(spark: SparkSession, name: str, location: str) -> None:
    create_table(spark, name, AUDIT_SCHEMA, location, partition_by=PARTITIONS)


def audit_rows(spark: SparkSession, platform: str, application: str, tables, start: str, end: str,
               success: bool, workflow_id: str | None, application_id: str | None,
               stdout: str = "", stderr: str = "") -> DataFrame:
    """The audit rows of one run (one per table; none for an empty list).

    The changed-row counts are one Spark aggregate (one row per table); the
    run's texts, which the driver captured, enter as row values rather than
    as literals in the plan."""
    tables = [t for t in tables if t]
    changed = [(r["table_name"], r["rows_changed"])
               for r in rows_changed_per_table(spark, tables, start, end).collect()]
    raw = spark.createDataFrame(
        [(t, start, end, bool(success), n, workflow_id or "", application_id or "", stdout, stderr,
          platform or "", application or "") for t, n in changed],
        "table_name string, start_ts string, end_ts string, success boolean, rows_changed bigint, "
        "workflow_id string, application_id string, stdout string, stderr string, "
        "pltfrm_nm string, aplctn_nm string")
    return raw.select(
        log_escape("table_name").alias("table_name"),
        log_escape("start_ts").alias("start_ts"),
        log_escape("end_ts").alias("end_ts"),
        "success",
        "rows_changed",
        log_escape(default_unknown("workflow_id")).alias("workflow_id"),
        log_escape(F.coalesce(F.nullif(F.col("application_id"), F.lit("")), F.lit("Unavailable")))
        .alias("application_id"),
        log_escape("stdout").alias("stdout"),
        log_escape("stderr").alias("stderr"),
        log_escape(default_unknown("pltfrm_nm")).alias("pltfrm_nm"),
        log_escape(default_unknown("aplctn_nm")).alias("aplctn_nm"),
    )


class _Run:
    def __init__(self):
        self.success = None
        self.start = None
        self.end = None


@contextlib.contextmanager
def audited_run(spark: SparkSession, platform: str, application: str, tables, log_table: str,
                workflow_id: str | None = None, capture_output: bool = True):
    """Audit the enclosed block.  The exception, if any, propagates after the
    log rows are written; the audit itself never masks the run's result."""
    run = _Run()
    run.start = _now()
    out, err = io.StringIO(), io.StringIO()
    redirect = (contextlib.ExitStack())
    if capture_output:
        redirect.enter_context(_tee(sys, "stdout", out))
        redirect.enter_context(_tee(sys, "stderr", err))
    try:
        with redirect:
            yield run
        run.success = True
    except BaseException:
        run.success = False
        raise
    finally:
        run.end = _now()
        if tables:
            try:
                append_by_name(audit_rows(
                    spark, platform, application, tables, run.start, run.end, run.success, workflow_id,
                    spark.sparkContext.applicationId, out.getvalue(), err.getvalue()), log_table)
            except Exception as exc:  # logging must not change the run's outcome
                print(f"audit logging failed: {exc}", file=sys.__stderr__)


@contextlib.contextmanager
def _tee(module, attr, buffer):
    original = getattr(module, attr)

    class Tee(io.TextIOBase):
        def write(self, s):
            buffer.write(s)
            return original.write(s)

        def flush(self):
            original.flush()

    setattr(module, attr, Tee())
    try:
        yield
    finally:
        setattr(module, attr, original)

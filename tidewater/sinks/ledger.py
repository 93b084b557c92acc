"""The batch ledger and the quarantine of bad lines.

A batch's files are never moved; the ledger row written *after* the data is
what marks a batch as archived (or failed).  Later runs leave the files of
such batches out of the listing.  Every run appends a folder; now and then the
folders are taken over into a checkpoint (:func:`compact_ledger`).
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from ..operators.batches import ARCHIVED, FAILED
from .files import delete_path, list_folders, read_version, write_version

#: Runs after which an ingest makes a new checkpoint of its ledger.
COMPACT_RUNS = 50

LEDGER_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("batch_id", StringType(), False),
    StructField("batch_index", LongType(), False),
    StructField("outcome", StringType(), False),
    StructField("ready", BooleanType(), False),
    StructField("n_files", IntegerType(), False),
    StructField("files", ArrayType(StringType()), False),
    StructField("routed_to", ArrayType(StringType()), True),
    StructField("n_lines", LongType(), True),
    StructField("n_bad_lines", LongType(), True),
    StructField("n_rows", LongType(), True),
    StructField("n_bad_keys", LongType(), True),
    StructField("n_cast_errors", LongType(), True),
    StructField("reason", StringType(), True),
    StructField("recorded_at", TimestampType(), True),
])

QUARANTINE_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("batch_id", StringType(), False),
    StructField("file_class", StringType(), False),
    StructField("file", StringType(), False),
    StructField("line", StringType(), True),
])


def path_missing(exc: Exception) -> bool:
    """Whether reading failed because there is nothing at the path (yet)."""
    return isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}_base"


def _checkpoint(spark: SparkSession, path: str) -> dict | None:
    """The checkpoint in force: its folder, the one before, and the runs it
    took over last (whose own folders may still be there)."""
    found = read_version(spark, f"{_base(path)}/current")
    return json.loads(found[1]) if found else None


def _rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return spark.createDataFrame([], schema)


def _tail(spark: SparkSession, path: str, checkpoint: dict | None) -> DataFrame:
    """Rows of the runs that no checkpoint has taken over yet."""
    tail = _rows(spark, path, LEDGER_SCHEMA)
    return tail.where(~F.col("run_id").isin(checkpoint["runs"])) if checkpoint and checkpoint["runs"] else tail


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none before the first run.  Any other error is the
    caller's: taking it for an empty ledger would ingest everything again."""
    checkpoint = _checkpoint(spark, path)
    tail = _tail(spark, path, checkpoint)
    if not checkpoint:
        return tail
    return _rows(spark, f"{checkpoint['folder']}/rows", LEDGER_SCHEMA).unionByName(tail)


_FINISHED = StructType([StructField("path", StringType(), True)])


def _finished(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("outcome").isin(ARCHIVED, FAILED)).select(F.explode("files").alias("path"))


def finished_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of every file of an archived or failed batch, once: the
    checkpoint's list, and the files of later runs that are not in it."""
    checkpoint = _checkpoint(spark, path)
    later = _finished(_tail(spark, path, checkpoint)).distinct()
    if not checkpoint:
        return later
    known = _rows(spark, f"{checkpoint['folder']}/finished", _FINISHED)
    return known.unionByName(later.join(known, "path", "left_anti"))


def archived_batches(spark: SparkSession, path: str) -> DataFrame:
    return read_ledger(spark, path).where(F.col("outcome") == ARCHIVED).select("batch_id").distinct()


def has_batch(spark: SparkSession, path: str, run_id: str, batch_id: str) -> bool:
    """Whether the ledger has a run's verdict on a batch."""
    rows = read_ledger(spark, path).where((F.col("run_id") == run_id) & (F.col("batch_id") == batch_id))
    return not rows.isEmpty()


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.select(*LEDGER_SCHEMA.fieldNames()).write.mode("append").partitionBy("run_id").parquet(path)


def compact_ledger(spark: SparkSession, path: str, after_runs: int = COMPACT_RUNS) -> bool:
    """Take the runs since the last checkpoint over into a new one, if there
    are at least ``after_runs``; returns whether it did.

    A ledger is a tail of one folder a run and a checkpoint: all earlier rows in
    a few files sorted by batch, and the finished files, distinct and sorted, so
    that a run reads those instead of exploding and deduplicating all history.
    The new checkpoint is written aside, then pointed to; what it replaces stays
    until the next one, for readers that have begun.  A process that ends on the
    way leaves a ledger with the same rows.  One process at a time may compact a
    ledger."""
    root = path.rstrip("/")
    checkpoint = _checkpoint(spark, path)
    listed = sorted(unquote(name.removeprefix("run_id=")) for name in list_folders(spark, root) if name.startswith("run_id="))
    done = [r for r in listed if checkpoint and r in checkpoint["runs"]]
    runs = [r for r in listed if r not in done]
    if len(runs) < after_runs:
        return False
    folder = f"{_base(path)}/{uuid.uuid4().hex}"
    tail = _rows(spark, path, LEDGER_SCHEMA).where(F.col("run_id").isin(runs))
    rows, finished = tail, _finished(tail)
    if checkpoint:
        rows = _rows(spark, f"{checkpoint['folder']}/rows", LEDGER_SCHEMA).unionByName(tail)
        finished = _rows(spark, f"{checkpoint['folder']}/finished", _FINISHED).unionByName(finished)
    rows.repartitionByRange("batch_id", "run_id").sortWithinPartitions("batch_id", "run_id").write.parquet(f"{folder}/rows")
    (finished.distinct().repartitionByRange("path").sortWithinPartitions("path").write.parquet(f"{folder}/finished"))
    before = checkpoint["folder"] if checkpoint else None
    for run in done:  # the checkpoint in force has them; the next one will not say so
        delete_path(spark, f"{root}/run_id={run}")
    write_version(spark, f"{_base(path)}/current", json.dumps({"folder": folder, "runs": runs, "before": before}))
    if checkpoint and checkpoint["before"]:
        delete_path(spark, checkpoint["before"])
    return True


def append_quarantine(rows: DataFrame, path: str) -> None:
    rows.select(*QUARANTINE_SCHEMA.fieldNames()).write.mode("append").partitionBy("run_id").parquet(path)

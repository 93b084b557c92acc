"""Incremental pickup of landing files with Structured Streaming.

New files are read once each (the file source's checkpoint remembers what was
seen), raw lines land in a bronze parquet dataset with their file name, and
a batch is released to the typed tables only when the manifest shows every
sibling's marker -- a batch without all markers simply waits for a later run
("late sibling").  Markers are zero-byte files, which the file source never
emits as rows, so release decisions come from the directory listing.
"""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.batches import manifest
from ..plans.ingest import LEDGER_ARGS, VERDICT_SCHEMA, ImbalanceError, file_key_col, ingest, ledger_rows
from ..session import staged
from ..sinks.files import exists
from ..sinks.ledger import append_ledger, finished_files
from ..sources.delimited import read_lines, read_lines_after_header

log = logging.getLogger("tidewater.landing")


def line_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                path_glob: str | None = None) -> DataFrame:
    """Streaming DataFrame of ``value, _file, file_key`` for new files
    (``file_key`` is the path as ``_metadata.file_path`` reports it)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(landing_dir).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _bronze_writer(bronze_path: str, checkpoint: str):
    """Writes a micro-batch as partition (stream, epoch), ``stream`` being the
    query's id in its checkpoint: a replayed epoch overwrites itself, and a
    second stream or a new checkpoint never touches what others wrote.  Beside
    it goes a list of the files, with the number of each file's first line that
    is not blank, so that lines can be found, and headers dropped, later."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        state = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
        keys = {"stream": json.loads(state)["id"], "epoch": epoch_id}

        def put(rows: DataFrame, path: str) -> None:
            (rows.withColumns({k: F.lit(v) for k, v in keys.items()}).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))

        put(batch.withColumn("line_id", F.monotonically_increasing_id()), bronze_path)
        written = "/".join([bronze_path.rstrip("/"), *[f"{k}={v}" for k, v in keys.items()]])
        if exists(spark, written):  # there may be no line at all
            first = F.when((F.col("block") == 0) & (F.trim("value") != ""), F.col("line_id"))
            put(spark.read.parquet(written).groupBy("file_key").agg(F.min(first).alias("head")), _files_of(bronze_path))
    return write


def _files_of(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_files"


_FILES_SCHEMA = "file_key string, head long, stream string, epoch int"


def bronze_lines(spark: SparkSession, bronze_path: str, files: DataFrame, after_header: bool) -> DataFrame:
    """``value`` and ``_file`` of the lines of ``files`` (path, file_key; a
    bounded number), from bronze where it has them and else from the landing
    folder.  ``after_header``: without blank lines and each file's first line.

    The list of files tells the partitions that hold them; only those are read."""
    listed = spark.createDataFrame([], _FILES_SCHEMA)
    if exists(spark, _files_of(bronze_path)):
        listed = spark.read.schema(_FILES_SCHEMA).parquet(_files_of(bronze_path))
    # a file that two streams have seen is taken from one of them
    found = (listed.join(F.broadcast(files.select("file_key")), "file_key").groupBy("file_key")
             .agg(F.min(F.struct("stream", "epoch", "head")).alias("at")).select("file_key", "at.*"))
    found = spark.createDataFrame(found.collect(), found.schema)
    left = [r["path"] for r in files.join(found, "file_key", "left_anti").select("path").collect()]
    parts = []
    places = [tuple(r) for r in found.select("stream", "epoch").distinct().collect()]
    if places:
        lines = spark.read.parquet(bronze_path).where(
            F.concat_ws("/", "stream", "epoch").isin([f"{s}/{e}" for s, e in places])
            & F.col("stream").isin(sorted({s for s, _ in places})) & F.col("epoch").isin(sorted({e for _, e in places})))
        lines = lines.join(F.broadcast(found), ["file_key", "stream", "epoch"])
        if after_header:
            lines = lines.where((F.trim("value") != "") & (F.col("line_id") != F.col("head")))
        parts.append(lines.select("value", "_file"))
    if left or not parts:
        parts.append((read_lines_after_header if after_header else read_lines)(spark, left) if left
                     else spark.createDataFrame([], "value string, _file string"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def pickup_to_bronze(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None,
                     path_glob: str | None = None) -> StreamingQuery:
    """Start (and with ``available_now`` finish) the pickup stream."""
    stream = line_stream(spark, landing_dir, max_files_per_trigger, path_glob)
    writer = (stream.writeStream.foreachBatch(_bronze_writer(bronze_path, checkpoint))
                    .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def release_ready(spark: SparkSession, bronze: DataFrame, names: DataFrame, classes,
                  ledger_path: str | None = None) -> DataFrame:
    """Bronze lines of files whose whole batch is ready, with ``batch_id``,
    ``batch_index`` and ``file_class``.  Files that the ledger (if given) has
    as finished take no part."""
    if "file_key" not in names.columns:
        names = names.withColumn("file_key", file_key_col("path"))
    if ledger_path:
        names = names.join(finished_files(spark, ledger_path), "path", "left_anti")
    ready = manifest(names, classes).filter("ready").select(
        "file_key", "batch_id", "batch_index", "file_class")
    return bronze.join(ready, "file_key", "inner")


def release(spark: SparkSession, bronze: DataFrame, names: DataFrame, classes, ledger_path: str, sink,
            on: str = "name") -> int:
    """Hand the bronze lines of newly ready batches to ``sink`` (a function
    of their DataFrame, as of :func:`release_ready`) and record the batches as
    archived afterwards, so that no later call releases them again.  A call
    that fails before the record hands the same batches out once more.
    Returns the number of batches."""
    if "file_key" not in names.columns:
        names = names.withColumn("file_key", file_key_col("path"))
    left = names.join(finished_files(spark, ledger_path), "path", "left_anti")
    ready = staged(manifest(left, classes, on=on).where("ready").select(
        "path", "file_key", "batch_id", "batch_index", "file_class", "ready"), "release")
    n = ready.select("batch_id").distinct().count()
    if n:
        sink(bronze.join(ready.select("file_key", "batch_id", "batch_index", "file_class"), "file_key"))
        append_ledger(ledger_rows(f"release-{uuid.uuid4().hex[:16]}", ready,
                                  spark.createDataFrame([], VERDICT_SCHEMA), *LEDGER_ARGS), ledger_path)
    return n


def continuous_ingest(spark: SparkSession, classes, top_directory: str, database: str | None,
                      checkpoint: str, bronze_path: str | None = None, landing_folder: str = "landing",
                      available_now: bool = True, processing_time: str = "1 minute", **ingest_args):
    """Stream-driven batch ingest of a landing zone.

    Each micro-batch of new landing files (1) appends their raw lines to the
    bronze dataset (the raw archive, idempotent per epoch) and (2) runs
    :func:`tidewater.plans.ingest.ingest`, which takes every batch that is
    ready and not yet in the ledger, with its lines from bronze: landing files
    are read once, by the stream (and by the ingest, if they land while it runs).  A deferred batch (late marker) and a
    listing whose classes are not balanced yet (late sibling) wait for the
    next trigger.  Zero-byte markers do not trigger a
    micro-batch on their own; a periodic batch ``ingest`` run covers a
    marker that arrives after its last data file.  Returns the query."""
    top = top_directory.rstrip("/")
    bronze = bronze_path or f"{top}/_bronze"
    write_bronze = _bronze_writer(bronze, checkpoint)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        write_bronze(batch, epoch_id)
        try:
            ingest(spark, classes, top, database=database, landing_folder=landing_folder,
                   raw_lines=lambda files, after_header: bronze_lines(spark, bronze, files, after_header), **ingest_args)
        except ImbalanceError as wait:  # a sibling lands in a later trigger
            log.info("waiting for siblings: %s", wait)

    stream = line_stream(spark, f"{top}/{landing_folder}")
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query

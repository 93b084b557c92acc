"""Release of batches by a stream that remembers them.

Each listing of the landing folder appends the names it saw first to a log.
The log is read as a stream: names of one batch (siblings and their markers)
share a key, and the stream's state holds which of them have come.  A batch is
released in the trigger that completes it, once; one that is not complete when
the watermark has passed its last name by ``expire`` is reported with what is
missing.  State is a few names a key and goes when the key expires.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.paths import MARKER_INFIX, base_name, is_marker, strip_extension
from ..sinks.files import exists

READY, EXPIRED = "ready", "expired"
#: Groups of keys that share a state.
BUCKETS = 256
_OUT_SCHEMA = "batch_key string, outcome string, files array<string>, missing array<string>, last_ms long"
_LOG_SCHEMA = "path string, listed_at timestamp"


def log_listing(names: DataFrame, log_path: str, version: int, listed_at) -> None:
    """Append the names (``path``) of one listing to the log, at the time
    ``listed_at`` (a column or a datetime).  A version that the log has is left
    as it is, so that a listing may be logged again after a failure."""
    spark, folder = names.sparkSession, f"{log_path.rstrip('/')}/listing-{version:010d}"
    if not exists(spark, f"{folder}/_SUCCESS"):
        (names.select("path", F.lit(listed_at).cast("timestamp").alias("listed_at"))
         .write.mode("overwrite").parquet(folder))


def gate_entries(names: DataFrame, classes, key_pattern: str) -> DataFrame:
    """Names as ``batch_key``, ``class_pos``, ``marker`` (boolean), ``path``,
    ``listed_at``, for each class they belong to.

    ``key_pattern``'s first group, searched in the name without extension and
    marker infix, is the batch key; names without it take no part.  A marker
    belongs to the class of its data file, whose name is the marker's without
    the infix."""
    name = base_name("path")
    stem = F.when(is_marker(name), F.replace(strip_extension(name), F.lit(MARKER_INFIX), F.lit(""))).otherwise(
        strip_extension(name))
    data_name = F.when(is_marker(name), F.replace(name, F.lit(MARKER_INFIX), F.lit(""))).otherwise(name)
    hits = F.filter(F.array(*[F.when(data_name.rlike(c.pattern), F.lit(i)) for i, c in enumerate(classes)]),
                    lambda x: x.isNotNull())
    return (names.select(F.regexp_extract(stem, key_pattern, 1).alias("batch_key"), F.explode(hits).alias("class_pos"),
                         is_marker(name).alias("marker"), "path", "listed_at")
            .where("batch_key <> ''"))


def _gate(tables: list[str], expire_ms: int):
    def row(key, held, outcome):
        missing = [t for i, t in enumerate(tables) if str(i) not in held["files"]]
        missing += [t + MARKER_INFIX for i, t in enumerate(tables) if i not in held["marks"]]
        return key, outcome, sorted(held["files"].values()), missing, held["last"]

    def run(_bucket, frames, state: GroupState):
        batches = json.loads(state.get[0]) if state.exists else {}
        out, touched = [], set()
        for frame in () if state.hasTimedOut else frames:
            columns = [frame[c].tolist() for c in ("batch_key", "class_pos", "marker", "path", "listed_ms")]
            for key, pos, marker, path, at in zip(*columns, strict=True):
                held = batches.setdefault(key, {"files": {}, "marks": [], "released": False, "last": 0})
                if not marker:  # of several files of one class the first by name counts
                    held["files"][str(pos)] = min(path, held["files"].get(str(pos), path))
                elif pos not in held["marks"]:
                    held["marks"].append(int(pos))
                held["last"] = max(held["last"], at)
                touched.add(key)
        for key in sorted(touched):
            held = batches[key]
            if not held["released"] and len(held["files"]) == len(held["marks"]) == len(tables):
                held["released"] = True
                out.append(row(key, held, READY))
        now = state.getCurrentWatermarkMs()
        for key in sorted(batches.keys() - touched):
            if batches[key]["last"] + expire_ms <= now:
                held = batches.pop(key)
                if not held["released"]:
                    out.append(row(key, held, EXPIRED))
        if batches:
            state.update((json.dumps(batches),))
            state.setTimeoutTimestamp(max(min(h["last"] for h in batches.values()) + expire_ms, now + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["batch_key", "outcome", "files", "missing", "last_ms"])

    return run


def gate_stream(spark: SparkSession, log_path: str, classes, key_pattern: str, expire_seconds: int,
                delay: str = "0 seconds", max_files_per_trigger: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The log as a stream of ``batch_key``, ``outcome``, ``files``, ``missing``,
    ``last_listed``, one row for each batch: ``ready`` in the trigger that has
    its last name, or ``expired`` with what is missing.

    A released key is remembered until it expires, so that a name that is
    listed again releases nothing.  State is kept by buckets of keys, since a
    Python call for each key costs milliseconds; ``buckets`` bounds the tasks of a
    trigger and must stay as it is for a checkpoint."""
    reader = spark.readStream.schema(_LOG_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    entries = gate_entries(reader.load(f"{log_path.rstrip('/')}/*"), classes, key_pattern)
    # times cross to Python as numbers, which no session time zone bends
    entries = entries.withColumns({"bucket": F.pmod(F.xxhash64("batch_key"), F.lit(buckets)),
                                   "listed_ms": F.unix_millis("listed_at")})
    return (entries.withWatermark("listed_at", delay).groupBy("bucket")
            .applyInPandasWithState(_gate([c.table for c in classes], expire_seconds * 1000), _OUT_SCHEMA,
                                    "held string", "append", GroupStateTimeout.EventTimeTimeout)
            .select("batch_key", "outcome", "files", "missing", F.timestamp_millis("last_ms").alias("last_listed")))


def run_gate(spark: SparkSession, log_path: str, classes, key_pattern: str, expire_seconds: int, out_path: str,
             checkpoint: str, delay: str = "0 seconds") -> StreamingQuery:
    """Work off what the log has and append the outcomes to ``out_path``
    (Parquet, each outcome once, whatever is restarted)."""
    query = (gate_stream(spark, log_path, classes, key_pattern, expire_seconds, delay)
             .writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query

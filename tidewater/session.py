"""Session helpers: recommended configuration and the shared work area.

Every directory the library writes (rendered landing files, staged tables,
stream checkpoints, ledgers of the showcase workloads) lives under the folder
the cluster names in ``spark.checkpoint.dir``.  That folder is on shared
storage on a real cluster; a machine-local temporary folder would vanish with
the executor that wrote it.  Only a local session (unit tests, a laptop) may
leave the setting out; it then gets a folder of its own.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .sinks.files import delete_path

# Settings the library relies on.  They are runtime SQL confs, so they can be
# applied to a session the caller already built.
RECOMMENDED_CONF = {
    # ANSI-era Spark: timestamps in text are parsed with try_* functions, and
    # all epoch arithmetic is pinned to UTC so results do not depend on the
    # driver's time zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # ones, and turn a join into a broadcast only after the build side has
    # been measured (size-checked broadcast).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Strict delimited reads must see every field of every line to detect a
    # short or long line; with pruning on, a one-column select silently
    # accepts a malformed line.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Texts are long: batches for Python workers of fewer rows than the default
    # 10,000 save some 150 MB of memory a task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RECOMMENDED_CONF` to an existing session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidewater") -> SparkSession:
    """A session for tests and the benchmark (never used on a cluster, where
    the caller's session is passed in)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) may leave it unset: driver and
    tasks then share one disk and a fresh temporary folder is used, remembered
    as the context's checkpoint directory.  On a cluster an unset folder is an
    error, since a machine-local one would vanish with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-shared-"))
    return context.getCheckpointDir().rstrip("/")


_made: ContextVar[list | None] = ContextVar("tidewater_made", default=None)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique directory path under the shared root (not created: the
    first Spark write creates it)."""
    path = f"{shared_root(spark)}/tidewater-work/{purpose}-{uuid.uuid4().hex[:12]}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete, at the end of the block, every work folder that was named in
    it, but for those in the yielded set: stages that nothing written by then
    needs any longer.  Lazy results made in the block cannot be used after it."""
    keep: set = set()
    outer, own = _made.get(), []
    token = _made.set(own)
    try:
        yield keep
    finally:
        _made.reset(token)
        for path in own:
            if path not in keep:
                delete_path(spark, path)
            elif outer is not None:
                outer.append(path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared work area and return it reread: cuts
    the lineage, survives lost executors, and gives every consumer the same rows."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def purge_work_area(spark: SparkSession, older_than_hours: float = 24.0, prefix: str = "") -> list:
    """Delete run folders in the shared work area (optionally only those
    whose name starts with ``prefix``) last modified more than
    ``older_than_hours`` ago: stages that lazy results no longer need.
    Returns the deleted paths."""
    import time

    root = f"{shared_root(spark)}/tidewater-work"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    cutoff_ms = (time.time() - older_than_hours * 3600.0) * 1000.0
    deleted = []
    for status in fs.listStatus(path):
        if (status.isDirectory() and status.getPath().getName().startswith(prefix)
                and status.getModificationTime() < cutoff_ms):
            fs.delete(status.getPath(), True)
            deleted.append(status.getPath().toString())
    return deleted

"""Landing manifest: classify files, check balance, pair siblings into
batches, gate batches on completion markers, and decide batch outcomes.

All steps are DataFrame operations over a table of file names, so a landing
zone with millions of files is handled by the cluster, not by a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.paths import base_name, is_marker, marker_name
from .ordinal import group_ordinal

# The outcomes a batch can have in the ledger.
ARCHIVED = "archived"
FAILED = "failed"
DEFERRED = "deferred"

CLASS_SCHEMA = StructType([
    StructField("class_pos", IntegerType(), False),
    StructField("file_class", StringType(), False),
    StructField("pattern", StringType(), False),
    StructField("extension", StringType(), False),
])


def class_table(spark: SparkSession, classes) -> DataFrame:
    """The file classes as a DataFrame (one row per class; configuration-sized)."""
    rows = [(i, c.table, c.pattern, c.extension) for i, c in enumerate(classes)]
    return spark.createDataFrame(rows, CLASS_SCHEMA)


def _class_list(classes):
    if isinstance(classes, DataFrame):  # a class table: configuration-sized
        return [(r["class_pos"], r["file_class"], r["pattern"], r["extension"])
                for r in classes.orderBy("class_pos").collect()]
    return [(i, c.table, c.pattern, c.extension) for i, c in enumerate(classes)]


def classify(names: DataFrame, classes, path_col: str = "path", on: str = "name") -> DataFrame:
    """Assign every data file (not a marker) to every class whose pattern is
    found (unanchored) in its base name, or in its full path with
    ``on="path"``.

    Classes are configuration, so each pattern is a literal regex compiled
    once per task; a file matching several classes yields one row per class.
    ``classes`` is a list of :class:`FileClass` or a :func:`class_table`."""
    items = _class_list(classes)
    carry = [c for c in ("file_key",) if c in names.columns and c != path_col]
    files = (names.select(F.col(path_col).alias("path"), *carry)
                  .withColumn("name", base_name("path"))
                  .filter(~is_marker("name")))
    subject = F.col("name") if on == "name" else F.col("path")
    info = [F.struct(F.lit(pos).alias("class_pos"), F.lit(table).alias("file_class"),
                     F.lit(pattern).alias("pattern"), F.lit(ext).alias("extension"))
            for pos, table, pattern, ext in items]
    hits = F.filter(F.array(*[F.when(subject.rlike(pattern), s) for (_, _, pattern, _), s in zip(items, info)]),
                    lambda x: x.isNotNull())
    return (files.select("path", "name", *carry, F.explode(hits).alias("_c"))
                 .select("path", "name", *carry, "_c.*"))


def balance(classified: DataFrame, classes) -> DataFrame:
    """One row: ``unbalanced`` (classes have different file counts, a class
    with no file counts as zero) and ``n_files``."""
    per_class = classified.groupBy("class_pos").agg(F.count(F.lit(1)).alias("n"))
    spark = classified.sparkSession
    positions = spark.createDataFrame([(pos,) for pos, *_ in _class_list(classes)], "class_pos int")
    counts = (positions.join(per_class, "class_pos", "left")
                       .select(F.coalesce("n", F.lit(0)).alias("n")))
    return counts.agg(
        (F.countDistinct("n") > 1).alias("unbalanced"),
        F.sum("n").cast("bigint").alias("n_files"),
    )


def pair(classified: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``batch_index``: the file's 1-based position within its class in name
    order (full path breaks ties); the i-th files of all classes form batch i."""
    return group_ordinal(classified, ["class_pos"], ["name", "path"], name="batch_index",
                         num_partitions=num_partitions)


def markers(names: DataFrame, path_col: str = "path") -> DataFrame:
    """Distinct marker paths present in the listing."""
    return (names.select(F.col(path_col).alias("marker"))
                 .filter(is_marker(base_name("marker")))
                 .distinct())


def gate(paired: DataFrame, names: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``marker`` (expected marker path: same folder, marker name) and
    ``has_marker``."""
    folder = F.regexp_replace(F.col("path"), r"[^/]*$", "")
    expected = paired.withColumn("marker", F.concat(folder, marker_name("path", F.col("extension"))))
    present = markers(names, path_col).withColumn("has_marker", F.lit(True))
    return (expected.join(present, "marker", "left")
                    .withColumn("has_marker", F.coalesce("has_marker", F.lit(False))))


def batch_id(paths_col: Column) -> Column:
    """Stable id of a batch from the sorted full paths of its files."""
    return F.sha2(F.concat_ws("\n", F.array_sort(paths_col)), 256)


def batches(gated: DataFrame) -> DataFrame:
    """One row per batch: ``batch_index``, ``batch_id``, ``ready`` (every
    sibling has its marker), ``n_files`` and the files."""
    return (gated.groupBy("batch_index")
                 .agg(F.min(F.col("has_marker").cast("int")).cast("boolean").alias("ready"),
                      F.count(F.lit(1)).alias("n_files"),
                      F.collect_list("path").alias("paths"))
                 .withColumn("batch_id", batch_id(F.col("paths"))))


def manifest(names: DataFrame, classes, path_col: str = "path",
             num_partitions: int | None = None, on: str = "name") -> DataFrame:
    """Per file: path, name, class, ``batch_index``, ``batch_id``, marker
    status and the batch's ``ready`` flag."""
    gated = gate(pair(classify(names, classes, path_col, on), num_partitions), names, path_col)
    # A batch holds one file per class (configuration-sized), so its verdict
    # is a window over the batch rather than an aggregate joined back.
    batch = Window.partitionBy("batch_index")
    return (gated
            .withColumn("ready", F.min(F.col("has_marker").cast("int")).over(batch).cast("boolean"))
            .withColumn("batch_id", batch_id(F.collect_list("path").over(batch))))


def outcome(ready: Column, any_bad: Column) -> Column:
    """Ledger outcome of a batch."""
    return (F.when(~ready, F.lit(DEFERRED))
             .when(any_bad, F.lit(FAILED))
             .otherwise(F.lit(ARCHIVED)))

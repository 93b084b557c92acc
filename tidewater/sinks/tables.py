"""Table sinks: typed positional append, partitioned append by name,
overwrite of a table from itself through a stage, catalog DDL."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import work_dir
from .files import delete_path
from .publish import file_table, replace_rows

BATCH_COLUMN = "ingest_batch"
_DROPPED_AT_ONCE = 500
_MODE_KEY = "spark.sql.sources.partitionOverwriteMode"


@contextlib.contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """Partition overwrite mode for table inserts in the block.

    ``insertInto`` reads the mode from the session, not from writer options,
    so it is set around the write and restored afterwards."""
    previous = spark.conf.get(_MODE_KEY, None)
    spark.conf.set(_MODE_KEY, mode)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(_MODE_KEY)
        else:
            spark.conf.set(_MODE_KEY, previous)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    if location:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :loc",
                  args={"db": name, "loc": location})
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": name})


def create_table(spark: SparkSession, name: str, schema: StructType, location: str,
                 partition_by=(), fmt: str = "parquet") -> None:
    """Create an external table at ``location`` (shared storage) unless it
    exists."""
    if spark.catalog.tableExists(name):
        return
    writer = spark.createDataFrame([], schema).write.format(fmt).option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("ignore").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


def data_columns(target: StructType) -> list:
    """Target fields that come from data (the batch partition is filled by
    the ingest)."""
    return [f for f in target.fields if f.name != BATCH_COLUMN]


def cast_positional(df: DataFrame, target: StructType, keep=()) -> tuple[DataFrame, Column]:
    """Bind ``df``'s columns to the target's data columns by position and
    cast each with ``try_cast``.  Returns the cast frame (target names plus
    ``keep`` columns) and a per-row count of values that failed to cast
    (non-NULL text that became NULL)."""
    fields = data_columns(target)
    source = [c for c in df.columns if c not in keep]
    if len(source) != len(fields):
        raise ValueError(
            f"transform yields {len(source)} columns, target has {len(fields)}: "
            f"{source} vs {[f.name for f in fields]}")
    exprs, errors = [], []
    for src, f in zip(source, fields):
        col = F.col(f"`{src}`")
        if df.schema[src].dataType == f.dataType:
            exprs.append(col.alias(f.name))
            continue
        cast = col.try_cast(f.dataType)
        exprs.append(cast.alias(f.name))
        errors.append((col.isNotNull() & cast.isNull()).cast("int"))
    n_err = sum(errors[1:], errors[0]) if errors else F.lit(0)
    return df.select(*exprs, *keep, n_err.alias("_cast_errors")), F.col("_cast_errors")


def append_typed(df: DataFrame, table: str, batch_col: str | None = None) -> None:
    """Append rows (already in target column order) to ``table``.

    A table partitioned by :data:`BATCH_COLUMN` receives each batch as its own
    partition with dynamic overwrite, so replaying a batch replaces it
    instead of duplicating it.  Other tables get a plain positional append.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    if BATCH_COLUMN in target.fieldNames() and batch_col:
        out = df.select(*[c for c in df.columns if c != batch_col], F.col(batch_col).alias(BATCH_COLUMN))
        with overwrite_mode(spark, "dynamic"):
            out.write.insertInto(table, overwrite=True)
    else:
        out = df.drop(batch_col) if batch_col else df
        out.write.insertInto(table)


def drop_batches(spark: SparkSession, table: str, batch_ids) -> None:
    """Empty the given batches' partitions; tables without batch partitions
    keep their rows.  Where the table is plain files and the batch its only
    partition column, folders are deleted and partitions dropped, many in one
    statement; else each is overwritten with nothing."""
    target = spark.table(table).schema
    batch_ids = sorted(batch_ids)
    if BATCH_COLUMN not in target.fieldNames() or not batch_ids:
        return
    files = file_table(spark, table)
    if files is not None and files.partitions == (BATCH_COLUMN,):
        for b in batch_ids:
            delete_path(spark, f"{files.location}/{BATCH_COLUMN}={b}")
        for start in range(0, len(batch_ids), _DROPPED_AT_ONCE):
            some = batch_ids[start:start + _DROPPED_AT_ONCE]
            listed = ", ".join(f"PARTITION ({BATCH_COLUMN} = '{b}')" for b in some)  # digests: hex digits
            spark.sql(f"ALTER TABLE IDENTIFIER(:t) DROP IF EXISTS {listed}", args={"t": table})
        spark.catalog.refreshTable(table)
        return
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in data_columns(target))
    with overwrite_mode(spark, "static"):
        for b in batch_ids:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH_COLUMN} = '{b}') "
                      f"SELECT {nothing} WHERE false")


def append_by_name(df: DataFrame, table: str) -> None:
    """Append binding columns by name (partition columns included)."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def overwrite_from_self(spark: SparkSession, table: str, keep: DataFrame) -> None:
    """Replace the rows of ``table`` by ``keep`` (a query over the same table).

    Spark rejects reading and overwriting one table in one statement.  The
    rows of a plain file table are written aside and swapped in; others are
    written to a stage on shared storage, and the overwrite reads that (static
    mode: partitions left empty are cleared too)."""
    if file_table(spark, table) is not None:
        replace_rows(spark, table, keep)
        return
    stage = work_dir(spark, "stage")
    keep.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    with overwrite_mode(spark, "static"):
        staged.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    delete_path(spark, stage)

"""Total-order sort and its validation (the generate/sort/validate probe).

The sort is a range partitioning on the key followed by a local sort, written
as one file per partition.  Validation never re-sorts: each scan split of the
written files is summarised in place (first and last key, rows, inversions
inside the split), then consecutive splits are compared at their boundaries.
The summary table has one row per split, whatever the data size.  Keys keep
their type throughout; NULL sorts first and NaN last, as in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, MapType, NumericType, StructType, TimestampNTZType,
                               TimestampType)

from ..session import staged
from .ordinal import group_ordinal


def row_hash(df: DataFrame) -> Column:
    """Deterministic hash of a row's hashable columns (maps excluded)."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.xxhash64(*cols) if cols else F.lit(0)


def md5_prefix_value(column, start: int = 1) -> Column:
    """The 8 hex digits of md5(text) starting at ``start``, as a number in
    [0, 2^32): a cheap, engine-independent row checksum."""
    c = F.col(column) if isinstance(column, str) else column
    return F.conv(F.substring(F.md5(c.cast("string")), start, 8), 16, 10).cast("bigint")


def row_checksum(df: DataFrame) -> Column:
    """The first 16 hex digits of the md5 of a row's columns as text, joined
    with ``|`` (NULL as ``~``; a backslash before these two, and before itself,
    in a value), as a decimal number: an engine-independent checksum of the
    whole row whose sum cannot overflow."""
    def text(f):
        value = F.col(f"`{f.name}`").cast("string")
        if isinstance(f.dataType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
            return value  # these have none of the three
        for mark in ("\\", "|", "~"):
            value = F.replace(value, F.lit(mark), F.lit("\\" + mark))
        return value

    joined = F.concat_ws("|", *[F.coalesce(text(f), F.lit("~")) for f in df.schema.fields])
    return F.conv(F.substring(F.md5(joined), 1, 16), 16, 10).cast("decimal(20,0)")


def row_sums(df: DataFrame) -> list[Column]:
    """Two aggregates that tell whether two frames of one schema hold the same
    rows: sums of 64-bit hashes with different seeds, over all columns and their
    null flags.  Frames that differ agree in both with a chance of about 2**-128."""
    def parts(f):
        column = F.col(f"`{f.name}`")
        return [F.to_json(F.struct(column)) if _has_map(f.dataType) else column, column.isNull()]

    columns = [c for f in df.schema.fields for c in parts(f)]
    return [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
            .alias(f"sum_{seed}") for seed in (1, 2)]


def _has_map(kind) -> bool:
    return (isinstance(kind, MapType) or (isinstance(kind, StructType) and any(_has_map(f.dataType) for f in kind))
            or (isinstance(kind, ArrayType) and _has_map(kind.elementType)))


def total_order_sort(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``key`` and sort each partition: partition i holds
    keys at most those of partition i+1, so the files written in partition
    order are globally sorted.  Without ``num_partitions`` adaptive execution
    sizes the partitions.

    A deterministic hash of the whole row is a secondary range key: rows
    sharing one hot key value (say a third of the data) are spread over many
    partitions instead of landing in one task.  Equal keys have no required
    order, so the result is still sorted by ``key``."""
    count = [num_partitions] if num_partitions else []
    tiebreak = row_hash(df)
    return df.repartitionByRange(*count, F.col(key), tiebreak).sortWithinPartitions(F.col(key), tiebreak)


def _summariser():
    """The task's function, complete in itself: executors need no package."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def inversions(before, after):
            """Neighbours in the wrong order; NULL first, NaN last."""
            if pa.types.is_boolean(before.type):
                before, after = before.cast(pa.int8()), after.cast(pa.int8())
            wrong = pc.fill_null(pc.less(after, before), False)
            wrong = pc.or_(wrong, pc.and_(pc.is_null(after), pc.is_valid(before)))
            if pa.types.is_floating(before.type):
                drop = pc.and_(pc.is_nan(before), pc.invert(pc.is_nan(after)))
                wrong = pc.or_(wrong, pc.fill_null(drop, False))
            return pc.sum(wrong.cast(pa.int64())).as_py() or 0

        splits = {}
        for batch in batches:
            files = batch.column("file")
            for file in pc.unique(files).to_pylist():
                part = batch.filter(pc.equal(files, file)).sort_by("row")
                keys = part.column("key")
                state = splits.setdefault(file, [part.column("row")[0].as_py(), 0, keys[:1], keys[:0], 0])
                if len(state[3]):
                    state[4] += inversions(state[3], keys[:1])
                state[4] += inversions(keys[:-1], keys[1:])
                state[1] += len(keys)
                state[3] = keys[-1:]
        for file, (row, n, first, last, wrong) in splits.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([row], pa.int64()), pa.array([n], pa.int64()), first, last,
                 pa.array([wrong], pa.int64())],
                names=["file", "first_row", "n", "first_key", "last_key", "inversions"])

    return run


def split_summaries(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per scan split of the sorted parquet output at ``path``."""
    data = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.col(key).alias("key"),
    )
    kind = data.schema["key"].dataType.simpleString()
    return data.mapInArrow(_summariser(), f"file string, first_row long, n long, first_key {kind}, "
                                          f"last_key {kind}, inversions long")


def validate_sorted(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row ``n, checksum, inversions`` for sorted parquet output.

    ``checksum`` (decimal) is the sum of :func:`row_checksum` over all columns
    of the stored rows.  ``inversions`` counts adjacent pairs out of order,
    inside splits and at the boundaries between consecutive splits (file name
    order, then row position); 0 means the output is totally ordered."""
    summaries = staged(split_summaries(spark, path, key), "splits")
    splits = group_ordinal(summaries, [], ["file", "first_row"], name="pos")
    prev = splits.select((F.col("pos") + 1).alias("pos"), F.col("last_key").alias("prev_last"),
                         F.lit(True).alias("has_prev"))
    wrong = F.coalesce(F.col("first_key") < F.col("prev_last"),
                       F.col("first_key").isNull() & F.col("prev_last").isNotNull())
    between = splits.join(prev, "pos", "left").select(
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("checksum"),
        (F.col("inversions") + F.when(F.col("has_prev") & wrong, 1).otherwise(0)).alias("inversions"))
    data = spark.read.parquet(path)
    rows = data.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(row_checksum(data)).cast("decimal(38,0)").alias("checksum"),
                    F.lit(0).cast("long").alias("inversions"))
    return rows.union(between).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum("checksum").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
        .alias("checksum"), F.sum("inversions").alias("inversions"))

"""Position of each row within its group, computed without a per-group task.

``row_number().over(partitionBy(g).orderBy(o))`` sends a whole group to one
task; with few groups (two classes of landing files) or one hot group that is
most of the data on one core.  Here the rows are range-partitioned on
``(group, order)`` so a large group spreads over many partitions, each
partition numbers its rows locally, and a small table of per-partition spans
(at most ``partitions + groups`` rows) turns local positions into global ones.
The numbered rows are staged once as parquet on shared storage, so the cost
is one extra write of the input (file names, split summaries:
metadata-sized in this library).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import work_dir

_PID = "_ord_pid"
_LOCAL = "_ord_local"


def group_ordinal(df: DataFrame, group_cols, order_cols, name: str = "ordinal",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column: the row's position inside its group
    when ordered by ``order_cols`` (ascending, NULLs first).  Ties get distinct
    consecutive positions, in the order of a hash of the whole row.
    ``group_cols`` may be empty (one global sequence).  Without
    ``num_partitions`` adaptive execution sizes the partitions."""
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    keys = group_cols + order_cols

    # A row hash after the keys lets the range partitioner split even a run
    # of tied keys (a hot (group, order) value) over several partitions.
    tiebreak = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                            if not isinstance(f.dataType, MapType)] or [F.lit(0)])
    count = [num_partitions] if num_partitions else []
    ranged = (df.repartitionByRange(*count, *[F.col(k) for k in keys], tiebreak)
                .sortWithinPartitions(*[F.col(k) for k in keys], tiebreak))
    # monotonically_increasing_id = (partition id << 33) + record number in
    # the partition; after the local sort the record number is the position.
    local = (ranged
             .withColumn(_PID, F.spark_partition_id())
             .withColumn(_LOCAL, F.monotonically_increasing_id()
                         - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Range boundaries are sampled with a seed tied to the RDD id, so two
    # separately planned copies of this exchange may cut differently.  The
    # numbered rows are therefore written once to the shared work folder
    # (cutting the lineage there) and both consumers read that copy.
    stage = work_dir(df.sparkSession, "ordinal")
    local.write.mode("overwrite").parquet(stage)
    local = df.sparkSession.read.parquet(stage)

    spans = (local.groupBy(_PID, *group_cols)
                  .agg(F.min(_LOCAL).alias("_ord_first"), F.count(F.lit(1)).alias("_ord_cnt")))
    earlier = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0)))
    earlier = earlier.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        F.col(_PID).alias("_ord_pid_r"),
        *[F.col(g).alias(f"_ord_g{i}") for i, g in enumerate(group_cols)],
        "_ord_first",
        F.coalesce(F.sum("_ord_cnt").over(earlier), F.lit(0)).alias("_ord_before"),
    )
    cond = [local[_PID] == offsets["_ord_pid_r"]]
    cond += [local[g].eqNullSafe(offsets[f"_ord_g{i}"]) for i, g in enumerate(group_cols)]
    joined = local.join(offsets, on=reduce(lambda a, b: a & b, cond), how="inner")
    result = joined.withColumn(
        name, F.col("_ord_before") + F.col(_LOCAL) - F.col("_ord_first") + F.lit(1))
    drop = [_PID, _LOCAL, "_ord_pid_r", "_ord_first", "_ord_before"]
    drop += [f"_ord_g{i}" for i in range(len(group_cols))]
    return result.drop(*drop)

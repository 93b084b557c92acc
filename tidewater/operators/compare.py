"""Order-insensitive multiset comparison of result lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_line

# Words that mark volatile lines of a search response.
VOLATILE_WORDS = ("version", "QTime")


def drop_volatile(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop lines containing ``version`` or ``QTime`` (case-sensitive)."""
    keep = F.lit(True)
    for word in VOLATILE_WORDS:
        keep = keep & ~F.col(value_col).contains(word)
    return lines.filter(keep)


def normalised(lines: DataFrame, value_col: str = "value", keys=()) -> DataFrame:
    """ASCII-lower, white-space-free form of each line; blank lines dropped."""
    return (lines.select(*keys, normalise_line(value_col).alias("line"))
                 .filter(F.col("line") != ""))


def multiset_difference(actual: DataFrame, expected: DataFrame, keys=(), line_col: str = "line") -> DataFrame:
    """Per key group: ``only_actual`` and ``only_expected`` line counts.

    Equivalent to counting both ``exceptAll`` directions, but in a single
    shuffle: each side contributes +1/-1 per line, partial sums are combined
    map-side, and one more aggregate folds the surplus per group.  Groups
    with no difference get zeros only if present on a side.
    """
    keys = list(keys)
    signed = (actual.select(*keys, line_col, F.lit(1).alias("_s"))
                    .unionByName(expected.select(*keys, line_col, F.lit(-1).alias("_s"))))
    net = signed.groupBy(*keys, line_col).agg(F.sum("_s").alias("_net"))
    return net.groupBy(*keys).agg(
        F.sum(F.greatest(F.col("_net"), F.lit(0))).cast("bigint").alias("only_actual"),
        F.sum(F.greatest(-F.col("_net"), F.lit(0))).cast("bigint").alias("only_expected"),
    )


#: Buckets that lines are dealt to: a comparison shuffles, of each side, one
#: row a bucket and task, and the lines of buckets that differ.
BUCKETS = 4096


def differing_lines(actual: DataFrame, expected: DataFrame, line_col: str = "line", buckets: int = BUCKETS,
                    exact: bool = False) -> DataFrame:
    """The lines that one side has more often: ``line``, ``only_actual``,
    ``only_expected`` (by how many).

    Both sides are first summed up by bucket of a line's hash: the number of
    lines and two sums of 64-bit hashes, the expected side negative, added up
    within each task before they are shuffled.  Only lines of buckets whose sums
    are not all zero are then counted one by one.  Sides that are equal so cost
    two scans and a shuffle of sums.  A bucket that differs is overlooked if all
    three sums agree by chance, about 2**-128; ``exact`` counts every line."""
    bucket = F.pmod(F.xxhash64(F.col(line_col)), F.lit(buckets)).alias("bucket")
    signed = (actual.select(F.col(line_col).alias("line"), bucket, F.lit(1).alias("s"))
              .unionByName(expected.select(F.col(line_col).alias("line"), bucket, F.lit(-1).alias("s"))))
    if not exact:
        def total(seed):
            return F.sum(F.xxhash64(F.lit(seed), "line").cast("decimal(38,0)") * F.col("s"))

        sums = signed.groupBy("bucket").agg(F.sum("s").alias("n"), total(1).alias("a"), total(2).alias("b"))
        differing = sums.where("n <> 0 OR a <> 0 OR b <> 0").select("bucket")  # at most one row a bucket
        signed = signed.join(F.broadcast(differing), "bucket", "left_semi")
    net = signed.groupBy("line").agg(F.sum("s").alias("net")).where("net <> 0")
    return net.select("line", F.greatest("net", F.lit(0)).cast("bigint").alias("only_actual"),
                      F.greatest(-F.col("net"), F.lit(0)).cast("bigint").alias("only_expected"))

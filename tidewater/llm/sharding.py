"""Sharding by proportional stratified interleaving, with SQL functions only.

Rows are put in a seeded random order within each source.  A row's fractional
rank, its place in that order over the source's size, spreads every source
evenly over [0, 1); rows of all sources sorted by it are interleaved in
proportion, so any contiguous cut has the mixture of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, staged

SHARDS = 40
SEED = 20
#: Rows that one window group holds on average; groups are cut by a uniform
#: hash or rank, never by source, so a hot source is only more groups.
GROUP_ROWS = 5_000
#: A group with so many times its share of rows holds rows with one hash.
_FULL = 4

_UNIT = float(1 << 53)


def _unit(hash_column):
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hash_column, 11).cast("double") / F.lit(_UNIT)


def _running(counts: DataFrame, order: str, *group: str) -> DataFrame:
    window = Window.partitionBy(*group) if group else Window.partitionBy()
    before = window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _counted(rows: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their group, and the groups' numbers of rows."""
    hashed = rows.withColumn("cell", F.floor(_unit(F.col("h")) * groups))
    return hashed, staged(hashed.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n")), "shard-counts")


def _spread(rows: DataFrame, hashed: DataFrame, full: DataFrame, group_rows: int) -> DataFrame:
    """Rows with another hash, by their number, where more than ``group_rows``
    share one.  Only rows of groups that are too full are looked at."""
    full = full.select(F.col("source").alias("s"), F.col("cell").alias("c"))
    shared = (hashed.join(full, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")), "left_semi")
              .groupBy("h").count().where(F.col("count") > group_rows).select(F.col("h").alias("shared")))
    return staged(rows.join(shared, F.col("h") == F.col("shared"), "left")
                  .withColumn("h", F.when(F.col("shared").isNotNull(), F.xxhash64("h", "row")).otherwise(F.col("h")))
                  .drop("shared"), "shard-rows")


def interleaved_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                       group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_crc32``, ``shard`` and ``slot`` for every row.

    Shards are 0 to ``shards`` - 1 and their row counts differ by one at most;
    ``slot`` counts from 0 without gaps within a shard.  Every shard holds a
    source's rows in proportion, within a few rows (sources with fewer rows than
    shards fall at random).  ``size`` is the text's
    UTF-8 bytes (null: none) plus 16, ``text_crc32`` that of the text (null: of
    the empty text).  A null source is a stratum of its own; null ids and
    repeated rows are rows like any others; an empty table gives no rows.
    Other columns are not read.

    Positions come from two counted partitions of [0, 1): by the row's hash
    within its source, then by fractional rank over all sources.  Each needs
    one shuffle of narrow rows and a table of counts of one row per group.  Rows
    equal in id, text and size, which share a hash, are told apart by their
    number if they are more than a group holds; which of them gets which place
    is then open.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(docs.select(
        F.col("doc_id"), F.col("source"), (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
        .withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    groups = max(1, -(-total // group_rows))

    # rank within the source: rows of earlier hash groups, then the place in the group
    hashed, counts = _counted(rows, groups)
    full = counts.where(F.col("n") > _FULL * group_rows)
    if not full.isEmpty():
        hashed, counts = _counted(_spread(rows, hashed, full, group_rows), groups)
    counts = (_running(counts, "cell", "source")
              .withColumn("of_source", F.sum("n").over(Window.partitionBy("source")))
              .select(F.col("source").alias("s"), F.col("cell").alias("c"), "before", "of_source"))
    ranked = hashed.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    order = Window.partitionBy("source", "cell").orderBy("h", "doc_id", "text_crc32", "size")
    # The start of each source's grid is shifted by a hash of its name, so that
    # many tiny sources do not all meet at one fractional rank.
    ranked = staged(ranked.select(
        "doc_id", "source", "size", "text_crc32", "h",
        ((F.col("before") + F.row_number().over(order) - 1 + _unit(F.xxhash64(F.lit(seed), "source")))
         / F.col("of_source")).alias("rank")), "shard-ranks")

    # place among all rows by fractional rank, the same way
    placed = ranked.withColumn("cell", F.floor(F.col("rank") * groups))
    counts = _running(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cell")
    placed = placed.join(counts.select("cell", "before"), "cell")
    order = Window.partitionBy("cell").orderBy("rank", "source", "h", "doc_id", "text_crc32", "size")
    placed = placed.withColumn("place", F.col("before") + F.row_number().over(order) - 1)
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (F.col("place") - first).cast("long"))
            .select("doc_id", "source", "size", "text_crc32", "shard", "slot"))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, under the law ``rows``."""
    return interleaved_shards(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_interleaved_shards": op8_interleaved_shards}
ORACLES: dict[str, str] = {}

"""Monte-Carlo estimate of pi (the compute probe)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sorting import md5_prefix_value

TWO_POW_32 = 4294967296.0


def unit_from_hash(column, slot: int = 0) -> Column:
    """A deterministic coordinate in [0, 1) from md5 of ``column``; slot 0
    uses hex digits 1-8, slot 1 digits 9-16, and so on."""
    return md5_prefix_value(column, 1 + 8 * slot) / F.lit(TWO_POW_32)


def estimate_pi(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """``inside`` (points with x^2 + y^2 <= 1), ``n`` and ``pi`` = 4 inside / n."""
    inside = ((F.col(x) * F.col(x) + F.col(y) * F.col(y)) <= 1).cast("int")
    agg = points.agg(F.sum(inside).cast("bigint").alias("inside"), F.count(F.lit(1)).alias("n"))
    return agg.withColumn("pi", F.lit(4.0) * F.col("inside") / F.col("n"))


def random_points(spark: SparkSession, n: int, seed: int = 42, slices: int | None = None) -> DataFrame:
    """``n`` seeded uniform points in the unit square, generated on executors."""
    df = spark.range(0, n, 1, slices) if slices else spark.range(n)
    return df.select(F.rand(seed).alias("x"), F.rand(seed + 1).alias("y"))

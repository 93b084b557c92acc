"""Validation aggregates: blank/NULL keys, per-file and per-batch counts,
line arity profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..sources.delimited import separator_regex


def null_or_blank(column, dtype=None) -> Column:
    """NULL or exactly '' (a single space is a valid key).  With a known
    non-string type only NULL can be blank, so no per-row cast is needed."""
    c = F.col(column) if isinstance(column, str) else column
    if dtype is not None and not isinstance(dtype, StringType):
        return c.isNull()
    return c.isNull() | (c.cast("string") == "")


def bad_key(keys, schema: StructType | None = None) -> Column:
    """True when any of ``keys`` is NULL or ''."""
    keys = list(keys)
    if not keys:
        return F.lit(False)
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    return reduce(lambda a, b: a | b, [null_or_blank(k, types.get(k)) for k in keys])


def key_check(df: DataFrame, keys, by) -> DataFrame:
    """Rows and bad-key rows per group (e.g. per batch); one aggregate with
    map-side partial counts, so a hot group costs one row per task."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(bad_key(keys).cast("int")).cast("bigint").alias("n_bad"),
    )


def count_by(df: DataFrame, by, name: str = "n_rows") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def field_count(line, sep: str) -> Column:
    """Number of separator-delimited fields in a line (no quoting)."""
    c = F.col(line) if isinstance(line, str) else line
    return F.size(F.split(c, separator_regex(sep), -1))


def arity_profile(lines: DataFrame, sep: str, value_col: str = "value") -> DataFrame:
    """Lines per field count, the quick look at why a strict file fails."""
    return (lines.select(field_count(value_col, sep).alias("n_fields"))
                 .groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_lines")))

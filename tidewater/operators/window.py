"""Rows changed inside an audit window."""

from __future__ import annotations

import contextlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType
from pyspark.sql.utils import AnalysisException

from ..functions.timefmt import parse_log_ts

UPDATE_COLUMN = "updt_ts"


def _as_ts(column: Column, dtype) -> Column:
    if isinstance(dtype, StringType):
        return parse_log_ts(column)
    return column


def in_window(df: DataFrame, start, end, ts_col: str = UPDATE_COLUMN) -> Column:
    """``start < ts < end`` (open at both ends) in whole seconds, as the
    audit log counts: a fraction of a second is cut off, so that a row half a
    second after the start is not after it.

    A timestamp column is compared directly, so the predicate reaches the
    file scan; a text column is parsed with ``yyyy-MM-dd HH:mm:ss`` and an
    unparsable value is never inside the window.  ``start``/``end`` are text
    in the same layout, or timestamps."""
    dtype = df.schema[ts_col].dataType
    ts = _as_ts(F.col(ts_col), dtype)
    lo, hi = _bound(start, dtype), _bound(end, dtype)
    # cut(ts) > lo is ts >= lo + 1 s, which reaches the scan
    return (ts >= lo + F.expr("INTERVAL 1 SECOND")) & (ts < hi)


def _bound(value, dtype) -> Column:
    if isinstance(value, Column):
        return value
    parsed = parse_log_ts(F.lit(str(value)))
    if isinstance(dtype, TimestampNTZType):
        return parsed.cast("timestamp_ntz")
    return parsed


def rows_changed_per_table(spark: SparkSession, tables, start, end,
                           ts_col: str = UPDATE_COLUMN) -> DataFrame:
    """``(table_name, rows_changed)`` for every listed table.

    ``tables`` holds table names or ``(label, DataFrame-or-name)`` pairs.  A
    table that cannot be read, be it for its name or for its files, or that lacks
    the column counts 0: the audit must never fail the audited run.  All
    tables are counted in one job; only if that fails, one by one."""
    counts: dict[str, DataFrame | None] = {}
    for item in tables:
        label, source = (item, item) if isinstance(item, str) else item
        try:
            df = spark.table(source) if isinstance(source, str) else source
            counts[label] = (df.filter(in_window(df, start, end, ts_col))
                             .agg(F.count(F.lit(1)).alias("rows_changed"))
                             .select(F.lit(label).alias("table_name"), "rows_changed")
                             if ts_col in df.columns else None)
        except AnalysisException:
            counts[label] = None
    rows: list[tuple] = []
    known = [c for c in counts.values() if c is not None]
    try:
        rows = [tuple(r) for r in reduce(DataFrame.unionByName, known).collect()] if known else []
    except Exception:  # some table's files cannot be read
        for count in known:
            with contextlib.suppress(Exception):
                rows.append(tuple(count.first()))
    found = dict(rows)
    return spark.createDataFrame([(label, found.get(label, 0)) for label in counts],
                                 "table_name string, rows_changed bigint")

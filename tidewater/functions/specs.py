"""Parsing of regression specs: ``table|fields|condition`` items joined by
``~``, and ``name,query`` collection lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_col

# Separators of the spec formats.
SPEC_ITEM_SEP = "~"
SPEC_FIELD_SEP = "|"
COLLECTION_SEP = ","


def split_spec_list(spec_list) -> Column:
    """Items of a ``~``-joined spec list (empty items are kept here; drop them
    with :func:`explode_spec_list`)."""
    return F.split(as_col(spec_list), "\\" + SPEC_ITEM_SEP, -1)


def explode_spec_list(df: DataFrame, column: str, alias: str = "spec") -> DataFrame:
    return (df.select(F.explode(split_spec_list(column)).alias(alias))
              .filter(F.length(alias) > 0))


def spec_table(spec) -> Column:
    """Text before the first ``|``."""
    return F.substring_index(as_col(spec), SPEC_FIELD_SEP, 1)


def spec_condition(spec) -> Column:
    """Text after the last ``|`` ('' means no condition)."""
    return F.substring_index(as_col(spec), SPEC_FIELD_SEP, -1)


def spec_fields(spec) -> Column:
    """Text between the first and the last ``|``; fields may contain ``|``.
    With a single ``|`` the field list is empty."""
    s = as_col(spec)
    start = F.length(spec_table(s)) + 2
    length = F.length(s) - F.length(spec_table(s)) - F.length(spec_condition(s)) - 2
    return F.when(length > 0, s.substr(start, length)).otherwise(F.lit(""))


def parse_specs(df: DataFrame, column: str = "spec") -> DataFrame:
    """Add ``table_name``, ``fields`` and ``condition`` for every spec."""
    has_two = F.instr(F.col(column), SPEC_FIELD_SEP) > 0
    return df.select(
        "*",
        F.when(has_two, spec_table(column)).alias("table_name"),
        F.when(has_two, spec_fields(column)).alias("fields"),
        F.when(has_two, spec_condition(column)).alias("condition"),
    )


def collection_name(line) -> Column:
    """Name before the first comma."""
    return F.substring_index(as_col(line), COLLECTION_SEP, 1)


def collection_query(line) -> Column:
    """Query after the last comma."""
    return F.substring_index(as_col(line), COLLECTION_SEP, -1)

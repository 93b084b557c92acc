"""Declared file classes and their all-string schemas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

DIALECTS = ("strict", "quoted", "remainder")
HEADER_MODES = ("first_line", "contains", "none")


def string_schema(columns) -> StructType:
    """All declared columns as nullable strings; types come only from the
    caller's transform.  Header text is never used for binding."""
    return StructType([StructField(name, StringType(), True) for name in columns])


@dataclass(frozen=True)
class FileClass:
    """One class of landing files feeding one table.

    ``pattern`` is searched (unanchored) in the file's base name; a file can
    belong to several classes.  ``transform`` is SQL over the view
    ``<table>_RAW``; the current user is bound to ``:user`` (or to exactly
    two legacy ``%s`` slots).  It may also be a callable taking the raw
    DataFrame and the user.  ``keys`` are columns of the transformed rows that
    must be neither NULL nor ''.

    dialect ``strict``: separator only, no quoting, exact arity, empty field
    is NULL, blank lines ignored, first line of every file is a header.
    dialect ``quoted``: CSV quoting with ``""`` escapes, exact arity, empty
    fields are '', blank line is an error, header lines dropped by content.
    dialect ``remainder``: first n-1 fields by separator, the last column takes
    the rest of the line including separators, fewer than n fields is an
    error, header lines dropped by content.
    """

    table: str
    columns: tuple[str, ...]
    separator: str = "|"
    pattern: str = ""
    extension: str = "csv"
    keys: tuple[str, ...] = ()
    transform: str | Callable[[DataFrame, str], DataFrame] | None = None
    dialect: str = "strict"
    header: str | None = None
    database: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "keys", tuple(self.keys))
        if self.dialect not in DIALECTS:
            raise ValueError(f"unknown dialect {self.dialect!r}; expected one of {DIALECTS}")
        if not self.columns:
            raise ValueError("a file class needs at least one column")
        if self.header is None:
            object.__setattr__(self, "header", "first_line" if self.dialect == "strict" else "contains")
        if self.header not in HEADER_MODES:
            raise ValueError(f"unknown header mode {self.header!r}; expected one of {HEADER_MODES}")
        if self.dialect == "strict" and self.header == "contains":
            raise ValueError("strict files drop their first line; header='contains' is for quoted/remainder")
        if self.dialect == "strict" and self.header == "none":
            raise ValueError("strict files always carry a header line")

    @property
    def raw_view(self) -> str:
        return f"{self.table}_RAW"

    @property
    def schema(self) -> StructType:
        return string_schema(self.columns)

    def qualified_table(self, database: str | None = None) -> str:
        db = database or self.database
        return f"{db}.{self.table}" if db else self.table

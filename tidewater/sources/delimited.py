"""Delimited landing-file readers (strict, quoted, remainder) and the
content-based header drop.

Every reader returns the declared columns as strings plus

* ``_file``  -- the full path of the source file (``_metadata.file_path``)
* ``_bad``   -- true when the line breaks the dialect's rules
* ``_line``  -- the raw text of the line where it is available (quoted and
  remainder dialects; strict lines are rebuilt only for bad lines)

No line is parsed in Python: the strict dialect uses the CSV data source, the
other two run ``from_csv`` / ``split`` inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import string_schema

CORRUPT = "_corrupt"


def separator_regex(sep: str) -> str:
    """A Java regex matching ``sep`` literally."""
    if "\\E" in sep:
        raise ValueError("separator may not contain \\E")
    return "\\Q" + sep + "\\E"


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Physical lines of the files as ``value`` plus ``_file``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"))


def read_lines_after_header(spark: SparkSession, paths) -> DataFrame:
    """Physical lines without the first line of every file.

    The text source has no line numbers, so the CSV source does the header
    skip: every line is read as a single unquoted field (a line holding the
    field separator lands whole in the corrupt-record column).  Blank lines
    are skipped by the CSV source in this mode."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = StructType([StructField("_one", StringType(), True), StructField(CORRUPT, StringType(), True)])
    raw = spark.read.csv(paths, schema=schema, sep="\u0001", quote="", header=True, mode="PERMISSIVE",
                         columnNameOfCorruptRecord=CORRUPT, enforceSchema=True, nullValue="\u0002")
    return raw.select(F.coalesce(F.col(CORRUPT), F.col("_one"), F.lit("")).alias("value"),
                      F.col("_metadata.file_path").alias("_file"))


def header_contains_filter(lines: DataFrame, first_column: str, value_col: str = "value") -> DataFrame:
    """Drop every line whose lower-cased text is LIKE ``%<first column>%``.

    This is the header rule of the quoted and remainder dialects: it removes
    *any* line containing the first column's name, in any case, and ``_`` and
    ``%`` in the name act as LIKE wildcards.
    """
    pattern = "%" + first_column.lower() + "%"
    return lines.filter(~F.lower(F.col(value_col)).like(pattern))


def read_strict(spark: SparkSession, paths, columns, sep: str, header: bool = True) -> DataFrame:
    """Strict dialect: separator only (no quote character), exact arity.

    The first line of every file is skipped when ``header``; its text is not
    checked, columns bind by position.  Empty fields are NULL, blank lines are
    ignored.  A short or long line sets ``_bad``.  The session must have CSV
    column pruning disabled (see :mod:`tidewater.session`) so that every line
    is parsed in full whatever the downstream projection.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    columns = list(columns)
    schema = StructType(string_schema(columns).fields + [StructField(CORRUPT, StringType(), True)])
    raw = spark.read.csv(
        paths,
        schema=schema,
        sep=sep,
        header=header,
        quote="",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        enforceSchema=True,
    )
    # Spark refuses a CSV query that needs only the corrupt-record column;
    # the always-false length test ties the flag to a data column as well.
    anchor = F.length(F.col(f"`{columns[0]}`")) < 0
    bad = F.col(CORRUPT).isNotNull() | F.coalesce(anchor, F.lit(False))
    return raw.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        bad.alias("_bad"),
        F.when(bad, F.coalesce(F.col(CORRUPT), F.col(f"`{columns[0]}`"))).alias("_line"),
    )


def parse_strict(lines: DataFrame, columns, sep: str, value_col: str = "value") -> DataFrame:
    """Strict dialect over lines that already lost their header (see
    :func:`read_lines_after_header`): split at the separator, no quoting,
    exactly n fields, an empty field is NULL."""
    columns = list(columns)
    n = len(columns)
    parts = F.split(F.col(value_col), separator_regex(sep), -1)
    keep = [c for c in lines.columns if c != value_col]
    with_parts = lines.select(*keep, F.col(value_col).alias("_line"), parts.alias("_parts"))
    bad = F.size("_parts") != n
    return with_parts.select(
        *[F.when(~bad, F.nullif(F.col("_parts")[i], F.lit(""))).alias(c) for i, c in enumerate(columns)],
        *keep,
        bad.alias("_bad"),
        "_line",
    )


def quoted_fields(line, sep: str):
    """Column: the fields of a line as Python's ``csv.reader`` splits it.

    A field that begins with ``"`` runs to the closing quote, ``""`` within
    being one quote; what follows the closing quote up to the separator is part
    of the value as it stands, and so are quotes within other fields and blanks
    anywhere.  A quote that is never closed takes the rest of the line.  Quantifiers
    are possessive: no backtracking, no recursion, whatever the length."""
    if len(sep) != 1 or sep in '"\r\n':
        raise ValueError(f"the quoted dialect needs a separator of one character, not {sep!r}")
    rest = rf"[^\x{{{ord(sep):X}}}]*+"
    inner = r'"([^"]*+(?:""[^"]*+)*+)'
    field = rf'{inner.replace("([", "(?:[", 1)}(?:"{rest})?|{rest}'
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{separator_regex(sep)}({field})"), F.lit(1))

    def value(f):
        quoted = F.concat(F.replace(F.regexp_extract(f, inner, 1), F.lit('""'), F.lit('"')),
                          F.regexp_extract(f, rf'(?s)\A{inner}"(.*)', 2))
        return F.when(F.startswith(f, F.lit('"')), quoted).otherwise(f)

    return (F.when(F.contains(line, F.lit('"')), F.transform(found, value))
            .otherwise(F.split(line, separator_regex(sep), -1)))


def parse_quoted(lines: DataFrame, columns, sep: str, value_col: str = "value") -> DataFrame:
    """Quoted dialect over a DataFrame of lines: the fields of
    :func:`quoted_fields`, as many as there are columns; another number, or a
    blank line, is an error.  Empty fields (quoted or not) are ''.
    """
    columns = list(columns)
    keep = [c for c in lines.columns if c != value_col]
    with_parts = lines.select(*keep, F.col(value_col).alias("_line"), quoted_fields(F.col(value_col), sep).alias("_parts"))
    bad = (F.col("_line") == "") | (F.size("_parts") != len(columns))
    return with_parts.select(
        *[F.when(~bad, F.col("_parts")[i]).alias(c) for i, c in enumerate(columns)],
        *keep,
        bad.alias("_bad"),
        "_line",
    )


def parse_remainder(lines: DataFrame, columns, sep: str, value_col: str = "value") -> DataFrame:
    """Remainder dialect over a DataFrame of lines.

    The first n-1 fields are split at the separator (no quoting); the last
    column takes everything after the (n-1)-th separator, separators and
    trailing empties included.  Fewer than n fields, or a blank line, is an
    error.
    """
    columns = list(columns)
    n = len(columns)
    parts = F.split(F.col(value_col), separator_regex(sep), n)
    keep = [c for c in lines.columns if c != value_col]
    with_parts = lines.select(*keep, F.col(value_col).alias("_line"), parts.alias("_parts"))
    bad = (F.col("_line") == "") | (F.size("_parts") < n)
    return with_parts.select(
        *[F.when(~bad, F.col("_parts")[i]).alias(c) for i, c in enumerate(columns)],
        *keep,
        bad.alias("_bad"),
        "_line",
    )


def read_quoted(spark: SparkSession, paths, columns, sep: str, header: str = "contains") -> DataFrame:
    return parse_quoted(_header_lines(spark, paths, columns, header), columns, sep)


def read_remainder(spark: SparkSession, paths, columns, sep: str, header: str = "contains") -> DataFrame:
    return parse_remainder(_header_lines(spark, paths, columns, header), columns, sep)


def _header_lines(spark: SparkSession, paths, columns, header: str) -> DataFrame:
    """Lines after the header rule: ``contains`` drops every line holding the
    first column's name, ``first_line`` drops each file's first line,
    ``none`` keeps all."""
    if header == "first_line":
        return read_lines_after_header(spark, paths)
    lines = read_lines(spark, paths)
    if header == "contains":
        return header_contains_filter(lines, list(columns)[0])
    return lines


def header_kind(file_class) -> str:
    """Which line reader a class needs: ``first_line`` (each file's first
    line skipped) or ``all``."""
    return "first_line" if file_class.header == "first_line" else "all"


def parse_class_lines(lines: DataFrame, file_class) -> DataFrame:
    """Apply a class's header rule (content-based) and dialect to lines
    produced by the reader :func:`header_kind` names."""
    if file_class.header == "contains":
        lines = header_contains_filter(lines, file_class.columns[0])
    if file_class.dialect == "strict":
        return parse_strict(lines, file_class.columns, file_class.separator)
    if file_class.dialect == "quoted":
        return parse_quoted(lines, file_class.columns, file_class.separator)
    return parse_remainder(lines, file_class.columns, file_class.separator)

"""String functions of the audit log, the golden comparison and the status
report.  All are built-in column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"


def log_escape(text) -> Column:
    """Audit-log text as it is stored: a line feed becomes the two characters
    backslash and ``n``, a carriage return backslash and ``r``; single quote,
    double quote and semicolon become a space; ``$`` is kept."""
    c = as_col(text)
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    c = F.replace(c, F.lit("\r"), F.lit("\\r"))
    return F.translate(c, "'\";", "   ")


def ascii_lower(text) -> Column:
    """Fold only the ASCII letters A-Z (bytewise ``tr``); ``É`` stays ``É``."""
    return F.translate(as_col(text), UPPER_ASCII, LOWER_ASCII)


def strip_whitespace(text) -> Column:
    """Remove every white-space character (``diff -w``)."""
    return F.regexp_replace(as_col(text), r"\s+", "")


def normalise_line(text) -> Column:
    """Comparison form of a golden line: ASCII lower case, no white space."""
    return strip_whitespace(ascii_lower(text))


def default_unknown(value) -> Column:
    """Empty or NULL becomes ``Unknown`` (platform, application, workflow)."""
    return F.coalesce(F.nullif(as_col(value), F.lit("")), F.lit("Unknown"))


# The text that surrounds the application id in a submit log.
SUBMIT_PREFIX = "Submitting application "
SUBMIT_SUFFIX = " to ResourceManager"


def application_id(log_text) -> Column:
    """Application id from submit-log text, ``Unavailable`` when absent.

    Takes the first ``Submitting application <id> to ResourceManager``; the
    id is one space-free token."""
    pattern = SUBMIT_PREFIX + "([^ ]*)" + SUBMIT_SUFFIX
    found = F.regexp_extract(as_col(log_text), pattern, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("Unavailable"))


def exit_ok(exit_code) -> Column:
    """Exit code to success flag."""
    return as_col(exit_code) == 0


# The status words and the two report line layouts.
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
PROBE_LINE = "%-30s - %s"
TEST_LINE = "%-50s - %s"


def padded_status(name, status, width: int = 50) -> Column:
    """``<name padded to width> - <status>``."""
    return F.format_string(f"%-{int(width)}s - %s", as_col(name), as_col(status))

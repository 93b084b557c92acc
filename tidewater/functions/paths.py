"""File-name functions: marker names and landing routing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the infix of a completion marker's name.
MARKER_INFIX = "_DONE"


def base_name(path) -> Column:
    """Last part of a path."""
    return F.substring_index(as_col(path), "/", -1)


def strip_extension(name) -> Column:
    """Name without its real extension (any length); a name without a dot is
    returned as is."""
    n = as_col(name)
    ext_len = F.length(F.substring_index(n, ".", -1))
    return F.when(n.contains("."), n.substr(F.lit(1), F.length(n) - ext_len - 1)).otherwise(n)


def marker_name(path, extension) -> Column:
    """Completion marker of a data file: ``<base without extension>_DONE.<ext>``.

    ``extension`` is the file class's marker extension (a string or column)."""
    ext = extension if isinstance(extension, Column) else F.lit(extension)
    return F.concat(strip_extension(base_name(path)), F.lit(MARKER_INFIX + "."), ext)


def is_marker(name) -> Column:
    """Names that contain ``_DONE`` are markers, never data."""
    return as_col(name).contains(MARKER_INFIX)


def route(path, source_folder: str = "landing", target_folder: str = "archive") -> Column:
    """Move a landing path to a sibling folder, keeping only the base name:
    ``/top/landing/x/y.csv`` -> ``/top/archive/y.csv``."""
    pattern = "(^|/)" + re.escape(source_folder) + "(/.*)?/([^/]*)$"
    return F.regexp_replace(as_col(path), pattern, "$1" + target_folder.replace("$", "\\$") + "/$3")

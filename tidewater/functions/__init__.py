"""Column functions (all JVM-side built-ins)."""

from .paths import base_name, is_marker, marker_name, route, strip_extension
from .specs import (collection_name, collection_query, explode_spec_list, parse_specs,
                    spec_condition, spec_fields, spec_table, split_spec_list)
from .text import (FAILURE, SUCCESS, application_id, ascii_lower, default_unknown, exit_ok,
                   log_escape, normalise_line, padded_status, strip_whitespace)
from .timefmt import LOG_TS_FORMAT, epoch_seconds, parse_log_ts

__all__ = [
    "base_name", "is_marker", "marker_name", "route", "strip_extension",
    "collection_name", "collection_query", "explode_spec_list", "parse_specs",
    "spec_condition", "spec_fields", "spec_table", "split_spec_list",
    "FAILURE", "SUCCESS", "application_id", "ascii_lower", "default_unknown", "exit_ok",
    "log_escape", "normalise_line", "padded_status", "strip_whitespace",
    "LOG_TS_FORMAT", "epoch_seconds", "parse_log_ts",
]

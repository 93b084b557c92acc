"""Text timestamps and epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the timestamp layout of audit windows and watermark resets.
LOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_log_ts(text) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp; unparsable text is NULL
    (so it can never fall inside a window)."""
    return F.try_to_timestamp(as_col(text), F.lit(LOG_TS_FORMAT))


def epoch_seconds(text) -> Column:
    """Epoch seconds of ``yyyy-MM-dd HH:mm:ss`` text in the session time zone
    (the library pins UTC)."""
    return F.unix_timestamp(parse_log_ts(text))

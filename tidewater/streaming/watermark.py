"""High-watermark table: reset (so the next run reprocesses everything) and
incremental selection of rows newer than the watermark; and a log of committed
watermarks for runs that take each row once."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.timefmt import epoch_seconds
from ..session import work_dir
from ..sinks.files import delete_path, read_version, write_version
from ..sinks.tables import overwrite_from_self

# Fixed value: the reset time the regression clean-up uses.
DEFAULT_RESET_TIME = "1990-01-01 00:00:00"


def reset_rows(current: DataFrame, reset_time: str = DEFAULT_RESET_TIME) -> DataFrame:
    """Every column set to the epoch seconds of ``reset_time``, one output row
    per existing row (an empty table stays empty)."""
    epoch = epoch_seconds(F.lit(reset_time)).cast("bigint")
    return current.select(*[epoch.alias(c) for c in current.columns])


def reset_watermarks(spark: SparkSession, table: str, reset_time: str = DEFAULT_RESET_TIME) -> None:
    """Overwrite the watermark table with :func:`reset_rows`."""
    overwrite_from_self(spark, table, reset_rows(spark.table(table), reset_time))


def after_watermark(df: DataFrame, ts_col: str, watermark_epoch) -> Column:
    """``ts > watermark`` with the watermark in epoch seconds (UTC)."""
    wm = watermark_epoch if isinstance(watermark_epoch, Column) else F.lit(int(watermark_epoch))
    bound = F.timestamp_seconds(wm)
    if isinstance(df.schema[ts_col].dataType, TimestampNTZType):
        bound = bound.cast("timestamp_ntz")
    return F.col(ts_col) > bound


def incremental_rows(df: DataFrame, ts_col: str, watermarks: DataFrame, wm_col: str) -> DataFrame:
    """Rows newer than the smallest watermark in ``watermarks[wm_col]``.

    The watermark is resolved first (one scalar from a small table) so the
    predicate is a literal: it reaches the parquet scan and skips row groups
    by their min/max statistics, which a scalar subquery would not."""
    wm = watermarks.agg(F.min(wm_col).alias("wm")).first()["wm"]
    if wm is None:  # no watermark yet: everything is new
        return df
    return df.filter(after_watermark(df, ts_col, int(wm)))


@dataclass(frozen=True)
class Selection:
    """What a round takes: its rows, as staged, and the marks it moves between
    (microseconds since 1970; None before the first row)."""

    rows: DataFrame
    version: int
    before: int | None
    after: int | None
    folder: str


class WatermarkLog:
    """Rounds over a growing table that take every row once.

    A round selects the rows after the last committed mark, and, since rows may
    come late, those of up to ``overlap_seconds`` before it that no round has
    taken: the keys taken in that span are kept beside the mark.  The selection
    is staged, so that what is processed is what is committed.  Nothing moves
    before :meth:`commit`: a round that ends before it is selected again.  A
    selection's rows can be read until the next one is committed.

    Rows without a time, and rows that come later than the overlap allows, are
    never selected.  ``keys`` must tell rows apart.  One round at a time."""

    def __init__(self, spark: SparkSession, path: str, ts_col: str, keys, overlap_seconds: int = 0):
        self.spark, self.path, self.ts_col = spark, path.rstrip("/"), ts_col
        self.keys, self.overlap = list(keys), overlap_seconds * 1_000_000

    def _state(self) -> tuple[int, dict]:
        found = read_version(self.spark, f"{self.path}/marks")
        return (found[0], json.loads(found[1])) if found else (0, {"mark": None, "taken": None})

    @property
    def mark(self) -> int | None:
        """The committed mark."""
        return self._state()[1]["mark"]

    def _micros(self, df: DataFrame) -> Column:
        return F.unix_micros(F.col(f"`{self.ts_col}`").cast("timestamp"))

    def select(self, df: DataFrame) -> Selection:
        """The rows of ``df`` for the next round.  The lower bound is a literal
        that reaches the scan."""
        version, state = self._state()
        rows = df.where(F.col(f"`{self.ts_col}`").isNotNull())
        if state["mark"] is not None:
            bound = F.timestamp_micros(F.lit(state["mark"] - self.overlap))
            if isinstance(df.schema[self.ts_col].dataType, TimestampNTZType):
                bound = bound.cast("timestamp_ntz")
            rows = rows.where(F.col(f"`{self.ts_col}`") >= bound)
            taken = self.spark.read.parquet(state["taken"]).select(*[F.col(f"`{k}`").alias(f"taken_{i}")
                                                                     for i, k in enumerate(self.keys)])
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"taken_{i}")) for i, k in enumerate(self.keys)]
            at_mark = rows.where(self._micros(rows) <= state["mark"]).join(taken, same, "left_anti")
            rows = rows.where(self._micros(rows) > state["mark"]).unionByName(at_mark)
        folder = work_dir(self.spark, "round")
        rows.write.parquet(folder)
        staged = self.spark.read.schema(df.schema).parquet(folder)
        last = staged.agg(F.max(self._micros(staged)).alias("m")).first()["m"]
        after = max((m for m in (last, state["mark"]) if m is not None), default=None)
        return Selection(staged, version, state["mark"], after, folder)

    def commit(self, selection: Selection) -> None:
        """Move the mark past a selection.  Raises if another round was
        committed since it was made."""
        version, state = self._state()
        if version != selection.version:
            raise RuntimeError(f"round {selection.version + 1} was committed already")
        if selection.after is None:
            return  # no row yet
        time = self._micros(selection.rows).alias("at")
        columns = [F.col(f"`{k}`") for k in self.keys]
        taken = selection.rows.select(*columns, time)
        if state["taken"]:
            taken = taken.unionByName(self.spark.read.parquet(state["taken"]))
        folder = f"{self.path}/taken-{version + 1}"
        taken.where(F.col("at") >= selection.after - self.overlap).write.mode("overwrite").parquet(folder)
        write_version(self.spark, f"{self.path}/marks", json.dumps(
            {"mark": selection.after, "taken": folder, "selection": selection.folder}))
        for path in (state.get("taken"), state.get("selection")):
            if path:
                delete_path(self.spark, path)

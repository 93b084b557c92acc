"""Batch ingest of a landing zone (manifest -> balance -> gate -> parse ->
transform -> validate -> append -> ledger).

Shape of the work:

0. files of batches that the ledger has as archived or failed are taken out of
   the listing; what is left is classified, balanced, paired and gated, and the
   manifest is staged once on shared storage;
1. ready batches are worked off in rounds of a bounded number of files, so
   that the list of paths and the broadcast manifest of a round are bounded,
   however much has landed; every round parses its files once into a columnar
   stage, with no shuffle of lines;
2. the transform's rows, cast to the target's types and flagged, are staged
   too; the verdict of every batch is aggregated from the stages;
3. one write job per table appends the rows of the good batches only;
4. one job quarantines the bad lines of failed batches;
5. the round's ledger rows are written last.  A batch counts as ingested only
   once its ledger row exists (:func:`committed_rows` reads a table that way);
   target tables partitioned by ``ingest_batch`` make a replay after a crash
   between (3) and (5) overwrite, not duplicate.  Rows for plain tables are
   written aside in (3) and put in place together under a journal entry, which
   the next run undoes unless the ledger has the round.
"""

from __future__ import annotations

import contextlib
import json
import logging
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.paths import route
from ..operators.batches import ARCHIVED, DEFERRED, FAILED, manifest
from ..operators.quality import bad_key
from ..session import scratch, work_dir
from ..sinks import publish
from ..sinks.ledger import (LEDGER_SCHEMA, append_ledger, append_quarantine, archived_batches, compact_ledger,
                            finished_files, has_batch, read_ledger)
from ..sinks.tables import BATCH_COLUMN, append_typed, cast_positional, data_columns, drop_batches
from ..sources.delimited import header_kind, parse_class_lines, read_lines, read_lines_after_header
from ..sources.landing import file_key_col, list_landing
from .transform import (BATCH, apply_transform, bound_sql, knows_batches, lateral, legacy_to_named, over_views,
                        run_sql)

__all__ = ["BATCH", "ImbalanceError", "IngestResult", "apply_transform", "committed_rows", "file_key_col", "ingest",
           "ledger_rows", "legacy_to_named", "list_landing"]
#: Files of one round: bounds the driver's list of paths and the broadcast
#: manifest (some 300 bytes a file).
ROUND_FILES = 20_000
#: Batches united in one plan where a transform has to run batch by batch: SQL
#: that Spark cannot plan for all batches at once, and callables.
PLAN_BATCHES = 16
#: Folder names that routing replaces: landing, archive, failure.
LEDGER_ARGS = ("landing", "archive", "failure")
log = logging.getLogger("tidewater.ingest")


@contextlib.contextmanager
def _phase(name: str):
    start = time.time()
    yield
    log.debug("%-24s %.2fs", name, time.time() - start)


class ImbalanceError(ValueError):
    """Classes have different numbers of files: nothing is ingested."""


@dataclass
class IngestResult:
    run_id: str
    ledger: DataFrame
    failed_files: int
    file_counts: DataFrame | None


def ingest(spark: SparkSession, classes, top_directory: str, database: str | None = None,
           landing_folder: str = "landing", failure_folder: str = "failure",
           archive_folder: str = "archive", ledger_path: str | None = None,
           quarantine_path: str | None = None, user: str | None = None,
           names: DataFrame | None = None, per_file_counts: bool = True,
           match_on: str = "name", keep_stage: bool = False,
           round_files: int = ROUND_FILES,
           before_ledger: Callable[[DataFrame], None] | None = None,
           raw_lines: Callable[[DataFrame, bool], DataFrame] | None = None) -> IngestResult:
    """Ingest every ready batch of the landing folder into the classes' tables.

    Files of finished batches take no part: they are neither counted nor
    paired again.  Raises :class:`ImbalanceError` before any write when the
    classes have different numbers of other files, and passes on errors of
    configuration or storage (a missing table, SQL that cannot be analysed);
    the batches then stay pending.  Errors that the data cause fail their batch
    only, and so does an error while its rows are appended.  A round whose
    process ended between its appends and its ledger rows leaves no row in plain
    tables: what is in place is taken out first.  ``before_ledger`` is called with
    a round's verdict before its ledger rows are written.  ``raw_lines`` gives
    the lines (``value``, ``_file``) of a round's files (path, file_key), without
    their first ones if asked to; by default they are read from the files.  One
    run at a time may use a ledger.

    Returns the run's ledger rows and the number of files in failed batches.
    The driver sees counts per class and round, the paths of one round's
    files, and batch ids only where an error has to be isolated or a transform
    runs batch by batch."""
    run = _Run(spark, list(classes), database, user or spark.sparkContext.sparkUser(), uuid.uuid4().hex[:16])
    top = top_directory.rstrip("/")
    ledger_path = ledger_path or f"{top}/_ledger"
    quarantine_path = quarantine_path or f"{top}/_quarantine"
    empty = IngestResult(run.run_id, spark.createDataFrame([], LEDGER_SCHEMA), 0, None)
    if not run.classes:
        return empty
    run.journal, run.raw_lines = f"{ledger_path.rstrip('/')}_journal", raw_lines
    publish.recover(spark, run.journal, lambda mark: has_batch(spark, ledger_path, *json.loads(mark)))
    with scratch(spark) as keep:  # all that the run stages goes with it
        run.root = work_dir(spark, f"ingest-stage-{run.run_id}")
        if keep_stage:
            keep.add(run.root)
        with _phase("manifest"):
            if names is None:
                names = list_landing(spark, f"{top}/{landing_folder}")
            if "file_key" not in names.columns:
                names = names.withColumn("file_key", file_key_col("path"))
            left = names.join(finished_files(spark, ledger_path), "path", "left_anti")
            (manifest(left, run.classes, on=match_on)
                .select("path", "file_key", "name", "class_pos", "batch_index", "batch_id", "ready")
                .write.parquet(f"{run.root}/manifest"))
            man = spark.read.parquet(f"{run.root}/manifest")
        # A class without files counts as zero.
        per_round = max(1, round_files // len(run.classes))
        number = F.floor((F.col("batch_index") - 1) / per_round)
        with _phase("balance"):
            tally = man.groupBy("class_pos", number.alias("round")).agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.col("ready").cast("int")).alias("ready")).collect()
        counts = [sum(r["n"] for r in tally if r["class_pos"] == i) for i in range(len(run.classes))]
        if len(set(counts)) > 1:
            raise ImbalanceError("landing files are unbalanced across classes "
                                 f"({dict(zip((c.table for c in run.classes), counts))}); nothing was ingested")
        if not counts[0]:
            return empty
        run.targets = [spark.table(c.qualified_table(database)).schema for c in run.classes]
        run.places = run.find_places()
        waiting = man.where("not ready")
        rounds = sorted({r["round"] for r in tally if r["ready"]})
        if sum(r["n"] - r["ready"] for r in tally):
            append_ledger(ledger_rows(run.run_id, waiting, spark.createDataFrame([], VERDICT_SCHEMA),
                                       landing_folder, archive_folder, failure_folder), ledger_path)
        counts_path = f"{ledger_path.rstrip('/')}_file_counts" if per_file_counts else None
        for k in rounds:
            files = man.where(F.col("ready") & (number == k))
            change = f"{run.run_id}-{k}"
            verdict = run.work_off(files, f"{run.root}/round-{k}", quarantine_path, counts_path, change)
            if before_ledger is not None:
                before_ledger(verdict)
            with _phase("ledger"):
                append_ledger(ledger_rows(run.run_id, files, verdict, landing_folder, archive_folder,
                                           failure_folder), ledger_path)
                publish.close(spark, run.journal, change)
    compact_ledger(spark, ledger_path)
    own = F.col("run_id") == F.lit(run.run_id)
    ledger = read_ledger(spark, ledger_path).where(own)
    failed = ledger.where(F.col("outcome") == FAILED).agg(F.sum("n_files")).first()[0] or 0
    file_counts = spark.read.parquet(counts_path).where(own) if counts_path and rounds else None
    return IngestResult(run.run_id, ledger, int(failed), file_counts)


def committed_rows(spark: SparkSession, table: str, ledger_path: str) -> DataFrame:
    """Rows of a batch-partitioned table whose batch the ledger has as
    archived: all tables of a batch come into sight together, and what a
    crashed run has left behind does not."""
    done = archived_batches(spark, ledger_path).withColumnRenamed("batch_id", BATCH_COLUMN)
    return spark.table(table).join(done, BATCH_COLUMN, "left_semi")


_DATA_ERROR = re.compile(r"SQLSTATE: (?:21|22|P0)")


def _caused_by_data(exc: Exception) -> bool:
    """Errors that a transform raises on some value: SQL data exceptions,
    raised errors and Python functions; storage and set-up errors are not."""
    return isinstance(exc, PythonException) or bool(_DATA_ERROR.search(str(exc)))


def _isolate(groups, attempt, data_only: bool) -> dict[str, str]:
    """Run ``attempt`` on groups of batch ids; a group that raises is halved,
    down to single batches.  Returns the whole error text of those that fail.
    k bad batches among n cost about k * log2(n) attempts.  An error that the
    data did not cause is passed on (``data_only``) or fails its whole group."""
    errors: dict[str, str] = {}
    groups = list(groups)
    while groups:
        group = groups.pop()
        try:
            attempt(group)
        except Exception as exc:
            if not _caused_by_data(exc):
                if data_only:
                    raise
                errors.update(dict.fromkeys(group, str(exc)))
            elif len(group) > 1:
                groups += [group[:len(group) // 2], group[len(group) // 2:]]
            else:
                errors[group[0]] = str(exc)
    return errors


@dataclass
class _Run:
    spark: SparkSession
    classes: list
    database: str | None
    user: str
    run_id: str
    root: str = ""
    journal: str = ""
    targets: list = field(default_factory=list)
    places: list = field(default_factory=list)
    raw_lines: Callable | None = None

    def work_off(self, files: DataFrame, stage: str, quarantine_path: str, counts_path: str | None,
                 change: str) -> DataFrame:
        """One round: everything but the ledger rows.  Returns the verdict.
        ``change`` names the round's journal entry."""
        spark, classes = self.spark, self.classes
        with _phase("stage"):
            parsed = self._stage_lines(files, f"{stage}/lines")
        with _phase("typed"):
            typed, errors = self._stage_typed(parsed, files, f"{stage}/typed")
        with _phase("verdict"):
            per_file = _union([
                parsed[i].groupBy(BATCH, F.col("_file").alias("file")).agg(
                    F.count(F.lit(1)).alias("n_lines"),
                    F.sum(F.col("_bad").cast("int")).cast("bigint").alias("n_bad_lines"))
                .withColumn("file_class", F.lit(c.table)) for i, c in enumerate(classes)])
            per_file.write.parquet(f"{stage}/files")
            per_file = spark.read.parquet(f"{stage}/files")
            _verdict(files, per_file, typed, errors).write.parquet(f"{stage}/verdict")
            verdict = spark.read.parquet(f"{stage}/verdict")
            bad = verdict.where("any_bad").count()
        good = verdict.where("not any_bad").select(BATCH)
        with _phase("append"):
            late = self._put(typed, good if bad else None, files, change)
        if late:
            told = spark.createDataFrame(list(late.items()), f"{BATCH} string, late string")
            verdict = (verdict.join(told, BATCH, "left")
                       .withColumn("any_bad", F.col("any_bad") | F.col("late").isNotNull())
                       .withColumn("error", F.coalesce("error", "late")).drop("late"))
        if bad:
            with _phase("quarantine"):
                failed = verdict.where("any_bad").select(BATCH)
                append_quarantine(_union([
                    parsed[i].where("_bad").join(failed, BATCH, "left_semi").select(
                        F.lit(self.run_id).alias("run_id"), F.col(BATCH).alias("batch_id"),
                        F.lit(c.table).alias("file_class"), F.col("_file").alias("file"),
                        F.col("_line").alias("line")) for i, c in enumerate(classes)]), quarantine_path)
        if counts_path:
            per_file.withColumn("run_id", F.lit(self.run_id)).write.mode("append").partitionBy("run_id").parquet(counts_path)
        return verdict

    def _stage_lines(self, files: DataFrame, path: str) -> list[DataFrame]:
        """The round's files, parsed once, one columnar stage per class.  The
        round's manifest is bounded and broadcast: lines are not shuffled."""
        paths: dict[int, list] = {}
        for r in files.select("class_pos", "path").collect() if self.raw_lines is None else ():
            paths.setdefault(r["class_pos"], []).append(r["path"])
        out = []
        for i, c in enumerate(self.classes):
            after_header = header_kind(c) == "first_line"
            if self.raw_lines is None:
                lines = (read_lines_after_header if after_header else read_lines)(self.spark, paths[i])
            else:
                lines = self.raw_lines(files.where(F.col("class_pos") == i).select("path", "file_key"), after_header)
            keys = files.where(F.col("class_pos") == i).select("file_key", F.col("batch_id").alias(BATCH))
            lines = lines.join(F.broadcast(keys), lines["_file"] == keys["file_key"]).select("value", "_file", BATCH)
            (parse_class_lines(lines, c).withColumn("_line", F.when(F.col("_bad"), F.col("_line")))
                .write.parquet(f"{path}/{i}"))
            out.append(self.spark.read.parquet(f"{path}/{i}"))
        return out

    def find_places(self) -> list:
        """Where the files of each plain table are; None for tables with batch
        partitions, and for one that Spark does not keep as plain files."""
        names = [c.qualified_table(self.database) for c in self.classes]
        plain = [BATCH_COLUMN not in t.fieldNames() for t in self.targets]
        places = [publish.file_table(self.spark, n) if p else None for n, p in zip(names, plain)]
        if sum(p and at is None for p, at in zip(plain, places)) > 1:
            raise ValueError("more than one table that is neither partitioned by batch nor kept as plain files: "
                             "their appends cannot be all or nothing")
        return places

    def _view(self, i: int | str) -> str:
        return f"tidewater_{self.run_id}_{i}"

    def _views(self, parsed: list[DataFrame], files: DataFrame, only=None) -> None:
        """The sound lines of all classes, and the batch ids, as views of this
        run's own, so that a transform may join its siblings."""
        def kept(df):
            return df if only is None else df.where(F.col(BATCH).isin(list(only)))

        for i, (c, lines) in enumerate(zip(self.classes, parsed)):
            kept(lines.where("not _bad")).select(*c.columns, BATCH).createOrReplaceTempView(self._view(i))
            if any(callable(x.transform) for x in self.classes):  # those look siblings up by name
                self.spark.table(self._view(i)).createOrReplaceTempView(c.raw_view)
        kept(files.select(F.col("batch_id").alias(BATCH)).distinct()).createOrReplaceTempView(self._view("batches"))

    def _rows(self, i: int, alone: bool = False) -> DataFrame:
        """What the transform makes of the views, with the batch id wherever
        that can be told; ``alone``: the views hold a single batch."""
        c, spark = self.classes[i], self.spark
        if c.transform is None or callable(c.transform):
            return apply_transform(spark, c, spark.table(self._view(i)), self.user)
        sql = bound_sql(c.transform)
        aware = knows_batches(sql)
        views = {x.raw_view: (self._view(k), [*x.columns, *[BATCH] * aware]) for k, x in enumerate(self.classes)}
        if not aware and not alone:
            out = lateral(spark, sql, views, self._view("batches"), self.user)
            if out is not None:
                return out
        return run_sql(spark, over_views(sql, views), self.user)

    def _transformed(self, i: int, alone: bool = False) -> DataFrame:
        """The transform's rows, bound to the target by position and flagged.
        Keys are columns of the transform, else of the target."""
        c, target = self.classes[i], self.targets[i]
        out = self._rows(i, alone)
        names = [n for n in out.columns if n != BATCH]
        fields = [f.name for f in data_columns(target)]
        for key in c.keys:
            if key not in names and key not in fields:
                raise ValueError(f"key {key!r} of {c.table} is no column of its transform or table")
        keys = [fields[names.index(k)] if k in names and names.index(k) < len(fields) else k for k in c.keys]
        unique = out.toDF(*[n if n == BATCH else f"_c{k}" for k, n in enumerate(out.columns)])
        keep = (BATCH,) if BATCH in out.columns else ()
        cast, _ = cast_positional(unique, target, keep=keep)
        return cast.withColumn("_bad_key", bad_key(keys, cast.schema))

    def _stage_typed(self, parsed: list[DataFrame], files: DataFrame, path: str) -> tuple[list[DataFrame], dict[str, str]]:
        """The typed rows of every class, staged, and the errors of batches
        whose transform raised."""
        errors: dict[str, str] = {}
        typed = []
        for i in range(len(self.classes)):
            self._views(parsed, files)
            plan = self._transformed(i)  # errors of configuration are raised here
            schema = StructType(plan.schema.fields + ([] if BATCH in plan.columns
                                                      else [StructField(BATCH, StringType())]))

            def nothing(i=i, schema=schema):
                self.spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{i}")

            def all_at_once(group=None, i=i):
                self._views(parsed, files, group)
                self._transformed(i).write.mode("append").parquet(f"{path}/{i}")

            def one_by_one(group, i=i):
                parts = []
                for b in group:  # analysed at once, so each part keeps its own views
                    self._views(parsed, files, [b])
                    parts.append(self._transformed(i, alone=True).withColumn(BATCH, F.lit(b)))
                _union(parts).write.mode("append").parquet(f"{path}/{i}")

            def ids():
                return sorted(r[0] for r in files.select("batch_id").distinct().collect())

            if BATCH in plan.columns:
                try:
                    all_at_once()
                except Exception as exc:
                    if not _caused_by_data(exc):
                        raise
                    log.warning("a transform raised (%s); isolating the failing batches", type(exc).__name__)
                    nothing()
                    errors |= _isolate([ids()], all_at_once, data_only=True)
            else:
                nothing()
                every = ids()
                errors |= _isolate([every[k:k + PLAN_BATCHES] for k in range(0, len(every), PLAN_BATCHES)],
                                   one_by_one, data_only=True)
            typed.append(self.spark.read.schema(schema).parquet(f"{path}/{i}"))
        for i in (*range(len(self.classes)), "batches"):
            self.spark.catalog.dropTempView(self._view(i))
        return typed, errors

    def _put(self, typed: list[DataFrame], good: DataFrame | None, files: DataFrame, change: str) -> dict[str, str]:
        """Append the good batches (None: all) to every table; returns the
        errors of batches that could not be.  Of those no table keeps a row.

        Rows for tables without batch partitions are written aside, those with
        batch partitions are appended, and when that is done, the files written
        aside are put in place under a journal entry.  A batch that fails
        anywhere goes: its partitions are emptied, and what is aside is written
        again without it."""
        spark, late = self.spark, {}
        names = [c.qualified_table(self.database) for c in self.classes]
        every = range(len(names))
        aside = {i: t for i in every if (t := self.places[i]) is not None}
        direct = [i for i in every if i not in aside and BATCH_COLUMN not in self.targets[i].fieldNames()]
        parts = {t: f"{change}-{i}" for i, t in aside.items()}

        def attempt(i):
            rows = typed[i] if good is None else typed[i].join(good, BATCH, "left_semi")
            rows = rows.where(~F.col(BATCH).isin(list(late))) if late else rows
            rows = rows.select(*[f.name for f in data_columns(self.targets[i])], BATCH)
            if i in aside:
                return self._append(rows, names[i], lambda df: publish.write_aside(df, aside[i], parts[aside[i]]))
            return self._append(rows, names[i], lambda df: append_typed(df, names[i], BATCH))

        def write_aside(todo):
            while todo:
                failed = {b: e for i in todo for b, e in attempt(i).items()}
                late.update(failed)
                todo = list(aside) if failed else []

        def note():
            if aside:
                mark = json.dumps([self.run_id, files.agg(F.min("batch_id")).first()[0]])
                publish.record(spark, self.journal, change, parts, mark=mark)

        def put_in_place():
            note()
            if aside:
                publish.carry_out(spark, self.journal, change)

        note()  # no files yet: should the process end before there are any, the next one clears the folders
        write_aside([i for i in every if i not in direct])
        try:
            put_in_place()
            for i in direct:  # at most one: nothing can take its rows back
                failed = attempt(i)
                if failed:
                    late.update(failed)
                    publish.take_out(spark, self.journal, change)
                    write_aside(list(aside))
                    put_in_place()
        except Exception as exc:
            log.warning("putting files in place failed (%s); the round's batches fail", type(exc).__name__)
            publish.take_out(spark, self.journal, change)
            sound = files.select("batch_id").distinct() if good is None else good
            late.update(dict.fromkeys((r[0] for r in sound.collect()), str(exc)))
        if late:
            for n in names:
                drop_batches(spark, n, list(late))
        return late

    def _append(self, rows: DataFrame, table: str, write) -> dict[str, str]:
        """Write to one table; returns the errors of batches that could not be."""
        try:
            write(rows)
            return {}
        except Exception as exc:
            log.warning("append to %s failed (%s); its batches fail", table, type(exc).__name__)
            every = sorted(r[0] for r in rows.select(BATCH).distinct().collect())
            if not _caused_by_data(exc):
                return dict.fromkeys(every, str(exc))
            return _isolate([every], lambda group: write(rows.where(F.col(BATCH).isin(group))), data_only=False)


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


VERDICT_SCHEMA = (f"{BATCH} string, any_bad boolean, n_lines long, n_bad_lines long, n_rows long, "
                  "n_bad_keys long, n_cast_errors long, error string")


def _verdict(files: DataFrame, per_file: DataFrame, typed: list[DataFrame], errors: dict[str, str]) -> DataFrame:
    """One row per batch of the round: line and row statistics, the error its
    transform raised, and ``any_bad``.  A batch that raised has no statistics.
    All statistics meet in one aggregate; typed rows are counted before it."""
    stats = {"n_lines": None, "n_bad_lines": None, "n_rows": F.lit(1), "n_bad_keys": F.col("_bad_key").cast("int"),
             "n_cast_errors": F.col("_cast_errors")}

    def padded(df, **known):
        return df.select(BATCH, *[known.get(c, F.lit(0)).cast("bigint").alias(c) for c in stats])

    parts = [padded(files.select(F.col("batch_id").alias(BATCH))),
             padded(per_file, n_lines=F.col("n_lines"), n_bad_lines=F.col("n_bad_lines"))]
    parts += [padded(t, **{c: v for c, v in stats.items() if v is not None}) for t in typed]
    both = _union(parts).groupBy(BATCH).agg(*[F.sum(c).alias(c) for c in stats])
    if errors:
        told = files.sparkSession.createDataFrame(list(errors.items()), f"{BATCH} string, error string")
        both = both.join(told, BATCH, "left")
    else:
        both = both.withColumn("error", F.lit(None).cast("string"))
    bad = F.col("error").isNotNull() | (F.col("n_bad_lines") + F.col("n_bad_keys") + F.col("n_cast_errors") > 0)
    return both.select(BATCH, bad.alias("any_bad"),
                       *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in stats], "error")


def ledger_rows(run_id, pending: DataFrame, verdict: DataFrame, landing, archive, failure) -> DataFrame:
    """Ledger rows of the pending batches (a join, no driver state)."""
    per_batch = pending.groupBy("batch_id").agg(
        F.min("batch_index").cast("long").alias("batch_index"),
        F.min(F.col("ready").cast("int")).cast("boolean").alias("ready"),
        F.count(F.lit(1)).cast("int").alias("n_files"),
        F.array_sort(F.collect_list("path")).alias("files"))
    v = verdict.withColumnRenamed(BATCH, "batch_id")
    j = per_batch.join(v, "batch_id", "left")
    outcome = (F.when(~F.col("ready"), F.lit(DEFERRED))
                .when(F.coalesce("any_bad", F.lit(False)), F.lit(FAILED))
                .otherwise(F.lit(ARCHIVED)))
    j = j.withColumn("outcome", outcome)
    problems = F.concat_ws(", ",
                           F.when(F.col("n_bad_lines") > 0, F.lit("bad lines")),
                           F.when(F.col("n_bad_keys") > 0, F.lit("blank keys")),
                           F.when(F.col("n_cast_errors") > 0, F.lit("uncastable values")))
    reason = (F.when(F.col("outcome") == DEFERRED, F.lit("missing marker"))
               .when(F.col("outcome") == FAILED, F.coalesce(F.col("error"), problems)))
    routed = (F.when(F.col("outcome") == ARCHIVED,
                     F.transform("files", lambda p: route(p, landing, archive)))
               .when(F.col("outcome") == FAILED,
                     F.transform("files", lambda p: route(p, landing, failure))))
    return j.select(
        F.lit(run_id).alias("run_id"), "batch_id", "batch_index", "outcome", "ready", "n_files", "files",
        routed.alias("routed_to"),
        *[F.when(F.col("ready"), F.col(c)).alias(c)
          for c in ("n_lines", "n_bad_lines", "n_rows", "n_bad_keys", "n_cast_errors")],
        reason.alias("reason"),
        F.current_timestamp().alias("recorded_at"))

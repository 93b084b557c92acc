"""Golden regression: export spec projections as JSON lines, compare them
with expected lines ignoring order, ASCII case, white space and blank lines,
and revert test rows afterwards.

All specs of a run are compared in one job: every spec contributes its
actual and expected lines tagged with the spec's name, and a single signed
aggregation yields the differences of every spec at once.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from urllib.parse import parse_qs, unquote

from ..functions.search import search_condition
from ..functions.specs import SPEC_FIELD_SEP, SPEC_ITEM_SEP
from ..functions.text import FAILURE, SUCCESS, TEST_LINE, padded_status
from ..operators.compare import differing_lines, drop_volatile, multiset_difference, normalised
from ..sinks.ledger import path_missing
from ..sinks.publish import file_table, remove_rows
from ..sinks.tables import overwrite_from_self


def parse_spec(spec: str) -> tuple[str, str, str]:
    """``table|fields|condition``; fields may hold further ``|``."""
    table, first, rest = spec.partition(SPEC_FIELD_SEP)
    if not first:
        raise ValueError(f"spec without '|': {spec!r}")
    fields, _, condition = rest.rpartition(SPEC_FIELD_SEP)
    return table, fields, condition


def split_spec_list(specs: str) -> list[str]:
    """``~``-joined specs, empty items skipped."""
    return [s for s in specs.split(SPEC_ITEM_SEP) if s]


def spec_frame(spark: SparkSession, spec: str, database: str | None = None) -> DataFrame:
    """The projection a spec selects: ``SELECT fields FROM db.table [WHERE cond]``.

    Fields and condition are SQL fragments by definition of the spec format
    and may name columns as ``table.column``; the table name is bound as an
    identifier."""
    name, fields, condition = parse_spec(spec)
    sql = f"SELECT {fields} FROM IDENTIFIER(:spec_table)"
    if condition:
        sql += f" WHERE {condition}"
    return spark.sql(sql, args={"spec_table": f"{database}.{name}" if database else name})


log = logging.getLogger("tidewater.golden")
#: Parameters that say how a response is written, not what it holds.
_FORMAT = {"wt", "indent", "omitHeader", "echoParams"}


def collection_frame(docs: DataFrame, query: str) -> DataFrame:
    """The documents that a collection line's query selects: ``q`` and ``fq``
    parameters (expressions of :func:`~tidewater.functions.search.search_condition`;
    all must hold), ``q.op`` for how terms of ``q`` side by side are joined
    (``AND`` by default), ``fl`` as the list of fields.  Text before a ``?`` and
    parameters for the response's form are of no effect here; a ValueError tells
    of any other part, which might select other documents."""
    parameters = parse_qs(query.partition("?")[2] or query, keep_blank_values=False)
    if unknown := parameters.keys() - {"q", "q.op", "fq", "fl"} - _FORMAT:
        raise ValueError(f"parameters not understood: {', '.join(sorted(unknown))} in {query!r}")
    joined = parameters.get("q.op", ["AND"])[-1]
    for name in ("q", "fq"):
        for text in parameters.get(name, []):
            docs = docs.where(search_condition(docs, text, joined if name == "q" else "AND"))
    fields = [f for text in parameters.get("fl", []) for f in re.split(r"[,\s]+", text) if f]
    if unknown := [f for f in fields if f != "*" and f not in docs.columns]:
        raise ValueError(f"fields not understood: {', '.join(unknown)} in {query!r}")
    return docs.select(*[F.col(f"`{f}`") for f in fields]) if fields and "*" not in fields else docs


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULL fields left out (the JSON writer's form)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def export_spec(spark: SparkSession, spec: str, out_dir: str, database: str | None = None,
                single_file: bool = False) -> str:
    """Write the spec's rows as JSON lines to ``out_dir/<table>`` (overwrite).

    ``single_file`` mirrors the old one-file export; keep it for small
    goldens only, since it funnels the table through one task."""
    name = parse_spec(spec)[0]
    df = spec_frame(spark, spec, database)
    if single_file:
        df = df.coalesce(1)
    path = f"{out_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").json(path)
    return path


def compare_lines(actual: DataFrame, expected: DataFrame, keys=(), value_col: str = "value",
                  volatile: bool = False) -> DataFrame:
    """Difference counts (``only_actual``, ``only_expected``) per key group
    after normalising both sides."""
    if volatile:
        actual, expected = drop_volatile(actual, value_col), drop_volatile(expected, value_col)
    return multiset_difference(normalised(actual, value_col, keys), normalised(expected, value_col, keys),
                               keys=keys)


def explain_spec(spark: SparkSession, spec: str, expected_path: str, database: str | None = None,
                 exact: bool = False) -> DataFrame:
    """The lines in which a spec's table differs from what is expected
    (``line`` in its compared form, ``only_actual``, ``only_expected``), for a
    test that failed.  See :func:`~tidewater.operators.compare.differing_lines`."""
    return differing_lines(normalised(json_lines(spec_frame(spark, spec, database))),
                           normalised(_expected_lines(spark, expected_path)), exact=exact)


def report(diffs: DataFrame, name_col: str, width: int = 50) -> DataFrame:
    """``<name> - SUCCESS|FAILURE`` lines: success when both counts are 0."""
    ok = (F.col("only_actual") == 0) & (F.col("only_expected") == 0)
    status = F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILURE))
    return diffs.select(padded_status(F.col(name_col), status, width).alias("line"),
                        F.col(name_col), status.alias("status"))


def run_golden(spark: SparkSession, specs, expected_root: str, database: str | None = None,
               collections=()) -> DataFrame:
    """Compare every spec's table with ``expected_root/<table>/*`` and every
    collection's response with ``expected_root/<collection>/*`` in one job.

    One report line per spec and collection entry, in their order.  Of several
    specs on one table the last one's rows are compared, as its export
    replaces the earlier ones.  ``collections`` holds (name, DataFrame of
    response lines ``value``) pairs (or is a mapping), each a test of its own;
    one with None for the lines fails."""
    if isinstance(collections, dict):
        collections = list(collections.items())
    collections = [(name, spark.createDataFrame([], "value string") if lines is None else lines, lines is None)
                   for name, lines in collections]
    last = {parse_spec(s)[0]: s for s in specs}
    tests = [(name, json_lines(spec_frame(spark, s, database)), False) for name, s in last.items()]
    tests += [(name, lines, True) for name, lines, _ in collections]
    if not tests:
        return spark.createDataFrame([], "line string, test string, status string")
    sides = []
    for side in (0, 1):
        parts = []
        for k, (name, actual, volatile) in enumerate(tests):
            lines = actual if side == 0 else _expected_lines(spark, f"{expected_root.rstrip('/')}/{name}")
            parts.append((drop_volatile(lines) if volatile else lines).withColumn("key", F.lit(k)))
        sides.append(_union(parts))
    diffs = compare_lines(*sides, keys=("key",))
    # A test whose lines are all blank on both sides has no group: success.
    position = {name: k for k, (name, _, volatile) in enumerate(tests) if not volatile}
    listed = [(position[parse_spec(s)[0]], parse_spec(s)[0], False) for s in specs]
    listed += [(len(last) + k, name, failed) for k, (name, _, failed) in enumerate(collections)]
    names = spark.createDataFrame([(at, *x) for at, x in enumerate(listed)], "at int, key int, test string, failed boolean")
    full = (names.join(diffs, "key", "left").na.fill(0, ["only_actual", "only_expected"])
            .withColumn("only_actual", F.when(F.col("failed"), 1).otherwise(F.col("only_actual"))).orderBy("at"))
    return report(full, "test", width=int(TEST_LINE[2:4]))


def revert_table(spark: SparkSession, spec: str, database: str | None = None,
                 allow: bool = False) -> tuple[int, int] | None:
    """Remove the rows a spec's condition selects (``WHERE NOT (cond)``; rows
    where the condition is NULL go as well), or every row when the spec has
    no condition.  Needs ``allow=True``: this deletes data.

    Only files that hold a row to remove are replaced; returns the numbers of
    files replaced and written.  A table that Spark does not keep as plain files
    is overwritten as a whole (returns None)."""
    if not allow:
        raise PermissionError("revert deletes rows; pass allow=True to confirm")
    name, _, condition = parse_spec(spec)
    qualified = f"{database}.{name}" if database else name
    if file_table(spark, qualified) is not None:
        return remove_rows(spark, qualified, condition or None)
    current = spark.table(qualified)
    overwrite_from_self(spark, qualified, current.where(f"NOT ({condition})") if condition else current.where(F.lit(False)))
    return None


def _expected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Expected lines; a missing expectation is empty (so any actual line
    makes the test fail instead of aborting the run)."""
    try:
        return spark.read.text(path)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return spark.createDataFrame([], "value string")


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ runs and logs

RESULTS_SCHEMA = "run string, part string, test string, status string, line string, recorded_at timestamp"


def summary(report: DataFrame) -> DataFrame:
    """Number of tests per status."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n_tests"))


def append_results(report: DataFrame, results_path: str, run: str, part: str = "") -> None:
    """Append a report to the results dataset (partitioned by run)."""
    (report.select(F.lit(run).alias("run"), F.lit(part).alias("part"), "test", "status", "line",
                   F.current_timestamp().alias("recorded_at"))
           .write.mode("append").partitionBy("run").parquet(results_path))


def consolidated_report(spark: SparkSession, results_path: str, run: str | None = None) -> DataFrame:
    """All result lines of a run (or of all), ordered by run, time, part and test."""
    results = spark.read.parquet(results_path)
    return (results if run is None else results.where(F.col("run") == run)).orderBy(
        "run", "recorded_at", "part", "test")


def write_consolidated_report(spark: SparkSession, results_path: str, out_path: str, run: str) -> str:
    """A run's result lines as one text file, in report order.  It has one
    line per test of the run, so funnelling it through a single task is cheap;
    ``orderBy`` then ``coalesce(1)`` keeps the order."""
    (consolidated_report(spark, results_path, run).select("line")
        .coalesce(1).write.mode("overwrite").text(out_path))
    return out_path


def read_spec_lines(spark: SparkSession, paths) -> DataFrame:
    """``spec`` rows from spec list files (one ``table|fields|condition`` per
    line, blank lines skipped)."""
    return (spark.read.text(paths).select(F.col("value").alias("spec"))
                 .filter(F.length(F.trim("spec")) > 0))


def read_collection_lines(spark: SparkSession, path: str) -> DataFrame:
    """``collection`` (before the first comma) and ``query`` (after the last)."""
    from ..functions.specs import collection_name, collection_query
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return lines.select(collection_name("value").alias("collection"), collection_query("value").alias("query"))


def run_test_dir(spark: SparkSession, test_dir: str, database: str | None = None, run_part=None,
                 results_path: str | None = None, run: str = "regression") -> DataFrame:
    """Run one regression test directory.

    Layout: ``<test>/*.list`` (specs), optional ``<test>/collections``
    (``name,query`` lines; the collection is a table of documents, and what
    the query selects is compared as JSON lines, and a query that is not
    understood is a test that fails), and either ``<test>/expected`` or one sub-directory per
    part, each with ``expected/``.  Parts run in name order on accumulating
    state; ``run_part(part_dir)`` does the part's work first (it replaces
    putting inputs and starting workflows).  Returns the report of all
    parts."""
    base = test_dir.rstrip("/")
    # Listing goes through Spark's file system layer, so the test directory
    # may live on any storage the cluster reads.  What is not there is empty;
    # what cannot be read ends the run, which would otherwise test nothing.
    specs = [r["spec"] for r in _read(lambda: read_spec_lines(spark, f"{base}/*.list").collect())]
    collections = [tuple(r) for r in _read(lambda: read_collection_lines(spark, f"{base}/collections").collect())]
    files = _read(lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).inputFiles())
    parts = set()
    for uri in files:
        rel = unquote(uri).split(base.split(":", 1)[-1].lstrip("/"), 1)[-1].lstrip("/")
        if rel.startswith("expected/"):
            parts.add("")
        elif "/expected/" in rel:
            parts.add(rel.split("/expected/", 1)[0])
    parts = sorted(parts)
    reports = []
    for part in parts:
        part_dir = f"{base}/{part}" if part else base
        if run_part is not None:
            run_part(part_dir)
        coll = [(name, _selected(spark, f"{database}.{name}" if database else name, query)) for name, query in collections]
        report = run_golden(spark, specs, f"{part_dir}/expected", database, coll)
        # Later parts change the tables: fix this part's verdict now (one row
        # per table or collection).
        rows = report.collect()
        report = spark.createDataFrame(rows, report.schema).withColumn("part", F.lit(part))
        if results_path:
            append_results(report, results_path, run, part)
        reports.append(report)
    if not reports:
        return spark.createDataFrame([], "line string, test string, status string, part string")
    return _union(reports)


def _read(action):
    """What ``action`` reads; nothing if the path is not there."""
    try:
        return action()
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return []


def _selected(spark: SparkSession, table: str, query: str) -> DataFrame | None:
    """The lines that a collection's query selects; None, for a test that
    fails, if the query is not understood."""
    try:
        return json_lines(collection_frame(spark.table(table), query))
    except ValueError as exc:
        log.warning("collection %s: %s", table, exc)
        return None


def revert_specs(spark: SparkSession, specs: DataFrame, database: str | None = None,
                 allow: bool = False) -> list:
    """Revert every distinct spec line (``sort | uniq`` of all spec lists).
    The distinct spec list is configuration-sized; each revert is a job."""
    distinct = [r["spec"] for r in specs.select("spec").distinct().orderBy("spec").collect()]
    return [revert_table(spark, s, database, allow=allow) for s in distinct]

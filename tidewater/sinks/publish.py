"""Changes of file tables that happen as a whole: written aside, recorded in
a journal, then put in place by renames.

New files are written to a hidden folder inside the table's own location, so
that putting them in place is a rename on one file system, and readers do not
see them before.  The journal entry lists the renames and the files to delete;
it is there before the first of them and goes after the last.  Whoever comes
next finds an entry that was left open and either finishes or undoes it.

Two kinds of change use this: appends of an ingest round to tables without
batch partitions, undone unless the ledger has the round; and reverts, which
replace only the files that hold a row to remove and are always finished.
One process at a time may change a table this way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import delete_path, exists, list_files, make_parent, read_text, rename, write_text

#: Formats whose data files are complete in themselves.
FORMATS = ("parquet", "orc", "json", "csv")
_HIDDEN = "_publish"


@dataclass(frozen=True)
class FileTable:
    """What is known of a table that Spark keeps as plain files."""

    name: str
    provider: str
    location: str
    partitions: tuple[str, ...]
    options: dict = field(default_factory=dict, hash=False)


def file_table(spark: SparkSession, name: str) -> FileTable | None:
    """The table's files; None if its files are not Spark's alone to place
    (views, bucketed tables, other formats and catalogs)."""
    session = spark._jsparkSession.sessionState()
    try:
        known = session.catalog().getTableMetadata(session.sqlParser().parseTableIdentifier(name))
    except (AnalysisException, ParseException):  # no table of the session's own catalog
        return None
    provider = known.provider().get().lower() if known.provider().isDefined() else ""
    if provider not in FORMATS or known.bucketSpec().isDefined() or not known.storage().locationUri().isDefined():
        return None
    options, pairs = {}, known.storage().properties().iterator()
    while pairs.hasNext():
        pair = pairs.next()
        options[pair._1()] = pair._2()
    columns = known.partitionColumnNames()
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(known.location()).toString()
    return FileTable(name, provider, location.rstrip("/"),
                     tuple(columns.apply(k) for k in range(columns.size())),
                     {k: v for k, v in options.items() if k.lower() != "path"})


def aside(table: FileTable, change: str) -> str:
    """The hidden folder for a change's new files."""
    return f"{table.location}/{_HIDDEN}/{change}"


def write_aside(rows: DataFrame, table: FileTable, change: str) -> None:
    """Write ``rows`` (the table's columns) to the hidden folder, replacing
    what is there."""
    names = [f for f in rows.sparkSession.table(table.name).columns if f not in table.partitions]
    writer = (rows.select(*[F.col(f"`{c}`") for c in [*names, *table.partitions]])
              .write.mode("overwrite").format(table.provider).options(**table.options))
    if table.partitions:
        writer = writer.partitionBy(*table.partitions)
    writer.save(aside(table, change))


def moves(spark: SparkSession, table: FileTable, change: str) -> list[tuple[str, str]]:
    """The renames that put a change's files in place.  Spark has made their
    names unique."""
    folder = aside(table, change)
    return [(f"{folder}/{name}", f"{table.location}/{name}") for name in list_files(spark, folder)
            if not name.rsplit("/", 1)[-1].startswith(("_", "."))]


def record(spark: SparkSession, journal: str, change: str, parts: dict[FileTable, str], deletes=(),
           forward: bool = False, mark: str = "") -> int:
    """Open the journal entry ``change``, or write it anew.  ``parts`` has, for
    each table, the name under which :func:`write_aside` writes its new files.
    An entry of before they are written tells the next process what to clear.
    ``forward``: the entry is to be finished whatever happens.  ``mark`` is kept for the caller.
    Returns the number of new files."""
    renames = [pair for table, part in parts.items() for pair in moves(spark, table, part)]
    entry = {"tables": [t.name for t in parts], "folders": [aside(t, part) for t, part in parts.items()],
             "renames": renames, "deletes": list(deletes), "forward": forward, "mark": mark}
    write_text(spark, f"{journal}/{change}", json.dumps(entry))
    return len(renames)


def carry_out(spark: SparkSession, journal: str, change: str) -> None:
    """Put the new files of an open entry in place and delete the old ones.
    What an earlier attempt has done is left as it is."""
    entry = json.loads(read_text(spark, f"{journal}/{change}"))
    for source, target in entry["renames"]:
        if exists(spark, source):
            make_parent(spark, target)
            rename(spark, source, target)
        elif not exists(spark, target):
            raise FileNotFoundError(f"neither {source} nor {target} is there")
    for path in entry["deletes"]:
        delete_path(spark, path)
    _tell(spark, entry)


def take_out(spark: SparkSession, journal: str, change: str) -> None:
    """Delete the new files of an entry wherever they are, and the entry;
    nothing if there is none."""
    if not exists(spark, f"{journal}/{change}"):
        return
    entry = json.loads(read_text(spark, f"{journal}/{change}"))
    for _, target in entry["renames"]:
        delete_path(spark, target)
    _tell(spark, entry)
    close(spark, journal, change)


def close(spark: SparkSession, journal: str, change: str) -> None:
    """Remove an entry and its folders; nothing if there is none."""
    if not exists(spark, f"{journal}/{change}"):
        return
    entry = json.loads(read_text(spark, f"{journal}/{change}"))
    for folder in entry["folders"]:
        delete_path(spark, folder)
    delete_path(spark, f"{journal}/{change}")


def recover(spark: SparkSession, journal: str, settled: Callable[[str], bool] = lambda mark: False) -> dict[str, str]:
    """Finish or undo the entries that an earlier process left open.  An
    entry is finished if it was recorded so, or if ``settled`` says of its mark
    that the change counts.  Returns what was done with each."""
    done = {}
    for change in sorted(list_files(spark, journal)):
        if change.endswith(".part"):  # its process ended before the entry was whole: nothing was moved
            delete_path(spark, f"{journal}/{change}")
            continue
        entry = json.loads(read_text(spark, f"{journal}/{change}"))
        if entry["forward"] or settled(entry["mark"]):
            carry_out(spark, journal, change)
            close(spark, journal, change)
            done[change] = "finished"
        else:
            take_out(spark, journal, change)
            done[change] = "undone"
    return done


def _tell(spark: SparkSession, entry: dict) -> None:
    """Let the catalog and this session see the files as they are now."""
    for name in entry["tables"]:
        if spark.catalog.tableExists(name):
            table = file_table(spark, name)
            if table and table.partitions:
                spark.sql("ALTER TABLE IDENTIFIER(:t) RECOVER PARTITIONS", args={"t": name})
            spark.catalog.refreshTable(name)


def table_journal(table: FileTable) -> str:
    """The journal of changes to this table alone."""
    return f"{table.location}/{_HIDDEN}/journal"


def remove_rows(spark: SparkSession, name: str, condition: str | None) -> tuple[int, int]:
    """Remove the rows for which ``NOT (condition)`` is not true (all, without
    a condition) by replacing only the files that hold such a row; the other
    files keep their names and times.  Returns the numbers of files replaced
    and of files written.

    The condition is evaluated once over the table to find the files, and
    once over those files to copy the rows that stay.  Nothing is shuffled but
    the names of the files found."""
    table = file_table(spark, name)
    if table is None:
        raise ValueError(f"{name} is not kept as plain files")
    journal = table_journal(table)
    recover(spark, journal)
    current = spark.table(name).select("*", F.col("_metadata.file_path").alias(_FILE))
    stays = F.coalesce(F.expr(f"NOT ({condition})"), F.lit(False)) if condition else F.lit(False)
    hit = [r[0] for r in current.where(~stays).select(_FILE).distinct().collect()]
    if not hit:
        return 0, 0
    change = uuid.uuid4().hex
    record(spark, journal, change, {table: change})
    if condition:
        short = name.rsplit(".", 1)[-1]
        held = (spark.read.format(table.provider).options(**table.options).option("basePath", table.location)
                .schema(spark.table(name).schema).load([_decoded(p) for p in hit]).alias(short))
        write_aside(held.where(F.expr(f"NOT ({condition})")), table, change)
    written = record(spark, journal, change, {table: change}, [_decoded(p) for p in hit], forward=True)
    carry_out(spark, journal, change)
    close(spark, journal, change)
    return len(hit), written


def replace_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Replace all rows of a table by ``rows``, which may be a query over the
    same table: written once, aside, then swapped under a journal entry."""
    table = file_table(spark, name)
    if table is None:
        raise ValueError(f"{name} is not kept as plain files")
    journal, change = table_journal(table), uuid.uuid4().hex
    recover(spark, journal)
    record(spark, journal, change, {table: change})
    write_aside(rows, table, change)
    old = [_decoded(p) for p in spark.table(name).inputFiles()]
    record(spark, journal, change, {table: change}, old, forward=True)
    carry_out(spark, journal, change)
    close(spark, journal, change)


_FILE = "_tidewater_file"


def _decoded(uri: str) -> str:
    """A listed file's URI as a path that can be read and deleted."""
    return unquote(uri) if urlsplit(uri).scheme else uri

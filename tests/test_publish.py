"""Appends to plain tables as a whole, and reverts that replace touched files only."""

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import write
from tidewater import FileClass
from tidewater.plans import golden as G
from tidewater.plans.ingest import ingest
from tidewater.sinks import publish
from tidewater.sinks.tables import create_database, create_table, drop_table

DB = "tw_publish_test"
ONE = FileClass(table="one", columns=("id", "v"), separator="|", pattern="^one_", keys=("id",))
TWO = FileClass(table="two", columns=("id", "v"), separator="|", pattern="^two_", keys=("id",))


def tables(spark, tmp, fmt="parquet", partition_by=(), names=("one", "two")):
    create_database(spark, DB)
    for name in names:
        drop_table(spark, f"{DB}.{name}")
        create_table(spark, f"{DB}.{name}", StructType([StructField("id", LongType()), StructField("v", StringType())]),
                     f"{tmp}/tables/{name}", partition_by, fmt)


def land(tmp, i, lines=("1|a", "2|b")):
    for name in ("one", "two"):
        write(f"{tmp}/landing/{name}_{i}.csv", "\n".join(["id|v", *lines]) + "\n")
        write(f"{tmp}/landing/{name}_{i}_DONE.csv", "")


def rows(spark, name):
    return sorted((r["id"], r["v"]) for r in spark.table(f"{DB}.{name}").collect())


def hidden(tmp):
    return [f for f in glob.glob(f"{tmp}/**/*", recursive=True) if "_publish" in f and os.path.isfile(f)]


def open_entries(tmp):
    return os.listdir(f"{tmp}/_ledger_journal") if os.path.isdir(f"{tmp}/_ledger_journal") else []


@pytest.mark.parametrize("fmt,partition_by", [("parquet", ()), ("json", ()), ("orc", ("v",)), ("csv", ())])
def test_plain_tables_are_appended(spark, tmp, fmt, partition_by):
    tables(spark, tmp, fmt, partition_by)
    for i in range(3):
        land(tmp, i, [f"{i}|x y", f"{10 + i}|"])
        assert ingest(spark, [ONE, TWO], tmp, database=DB).failed_files == 0
    expected = [(i, v) for i, v in [(0, "x y"), (1, "x y"), (2, "x y")]]
    for name in ("one", "two"):
        assert [r for r in rows_any(spark, name) if r[0] < 10] == expected
        assert spark.table(f"{DB}.{name}").count() == 6
    assert not hidden(tmp) and not open_entries(tmp)


def rows_any(spark, name):
    return sorted(((r["id"], r["v"]) for r in spark.table(f"{DB}.{name}").collect()), key=str)


def test_second_table_fails_and_the_first_holds_nothing(spark, tmp, monkeypatch):
    tables(spark, tmp)
    land(tmp, 1)
    original = publish.write_aside

    def broken(df, table, part):
        if table.name.endswith(".two"):
            raise OSError("disk full")
        original(df, table, part)

    monkeypatch.setattr(publish, "write_aside", broken)
    res = ingest(spark, [ONE, TWO], tmp, database=DB)
    row = res.ledger.first()
    assert (row["outcome"], row["reason"], res.failed_files) == ("failed", "disk full", 2)
    assert rows(spark, "one") == rows(spark, "two") == []
    assert not hidden(tmp) and not open_entries(tmp)


def test_renames_that_fail_are_taken_back(spark, tmp, monkeypatch):
    tables(spark, tmp)
    land(tmp, 1)
    original = publish.rename

    def broken(session, source, target):
        if "/two/" in target:
            raise OSError("no rename")
        original(session, source, target)

    monkeypatch.setattr(publish, "rename", broken)
    res = ingest(spark, [ONE, TWO], tmp, database=DB)
    assert (res.ledger.first()["outcome"], res.ledger.first()["reason"]) == ("failed", "no rename")
    assert rows(spark, "one") == rows(spark, "two") == []
    assert not glob.glob(f"{tmp}/tables/one/part-*.parquet") or spark.read.parquet(f"{tmp}/tables/one").count() == 0
    assert not hidden(tmp) and not open_entries(tmp)


class Crash(BaseException):
    pass


@pytest.mark.parametrize("point", ["aside", "renames", "ledger", "closing"])
def test_a_crash_anywhere_neither_loses_nor_repeats(spark, tmp, monkeypatch, point):
    tables(spark, tmp)
    land(tmp, 1)
    ingest(spark, [ONE, TWO], tmp, database=DB)
    land(tmp, 2, ["3|c"])

    def crash(*_, **__):
        raise Crash

    with monkeypatch.context() as m:
        hook = None
        if point == "aside":
            m.setattr(publish, "carry_out", crash)
        elif point == "renames":
            original, seen = publish.rename, []

            def second(session, source, target):
                if seen:
                    raise Crash
                seen.append(target)
                original(session, source, target)
            m.setattr(publish, "rename", second)
        elif point == "ledger":
            hook = crash
        else:
            m.setattr(publish, "close", crash)
        with pytest.raises(Crash):
            ingest(spark, [ONE, TWO], tmp, database=DB, before_ledger=hook)
    assert open_entries(tmp)
    res = ingest(spark, [ONE, TWO], tmp, database=DB)
    assert res.ledger.count() == (0 if point == "closing" else 1)
    for _ in range(2):
        assert rows(spark, "one") == rows(spark, "two") == [(1, "a"), (2, "b"), (3, "c")]
        ingest(spark, [ONE, TWO], tmp, database=DB)
    assert not hidden(tmp) and not open_entries(tmp)


def test_a_failed_batch_leaves_the_others_in_plain_tables(spark, tmp):
    tables(spark, tmp)
    for i in range(4):
        land(tmp, i, [f"{i}|v{i}"] if i != 2 else ["|blank"])
    res = ingest(spark, [ONE, TWO], tmp, database=DB)
    assert res.failed_files == 2
    assert rows(spark, "one") == rows(spark, "two") == [(0, "v0"), (1, "v1"), (3, "v3")]


def test_a_plain_and_a_batch_table_go_together(spark, tmp, monkeypatch):
    from tidewater.plans import ingest as module
    from tidewater.sinks.tables import BATCH_COLUMN
    tables(spark, tmp, names=("one",))
    drop_table(spark, f"{DB}.two")
    create_table(spark, f"{DB}.two", StructType([StructField("id", LongType()), StructField("v", StringType()),
                                                 StructField(BATCH_COLUMN, StringType())]), f"{tmp}/tables/two",
                 (BATCH_COLUMN,))
    land(tmp, 1)

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(module, "append_typed", broken)
        assert ingest(spark, [ONE, TWO], tmp, database=DB, ledger_path=f"{tmp}/other").failed_files == 2
    assert rows(spark, "one") == rows(spark, "two") == []
    assert ingest(spark, [ONE, TWO], tmp, database=DB).failed_files == 0
    assert rows(spark, "one") == rows(spark, "two") == [(1, "a"), (2, "b")]


def test_two_tables_without_plain_files_are_refused(spark, tmp):
    create_database(spark, DB)
    for name in ("one", "two"):
        drop_table(spark, f"{DB}.{name}")
        (spark.range(0).selectExpr("id", "cast(id as string) v").write.bucketBy(2, "id")
         .option("path", f"{tmp}/tables/{name}").saveAsTable(f"{DB}.{name}"))
    land(tmp, 1)
    with pytest.raises(ValueError, match="all or nothing"):
        ingest(spark, [ONE, TWO], tmp, database=DB)
    assert ingest(spark, [ONE], tmp, database=DB).failed_files == 0
    assert rows(spark, "one") == [(1, "a"), (2, "b")]


# ---------------------------------------------------------------- reverts

def data_files(tmp, name):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp}/tables/{name}/**/part-*", recursive=True)}


def filled(spark, tmp, name="r", partitioned=False):
    create_database(spark, DB)
    drop_table(spark, f"{DB}.{name}")
    df = spark.range(100).select("id", F.when(F.col("id") != 55, F.col("id") % 3).alias("k"),
                                 F.concat(F.lit("p q%"), (F.col("id") / 25).cast("int").cast("string")).alias("p"))
    writer = df.repartitionByRange(8, "id").write.option("path", f"{tmp}/tables/{name}")
    (writer.partitionBy("p") if partitioned else writer).saveAsTable(f"{DB}.{name}")
    return f"{DB}.{name}"


@pytest.mark.parametrize("partitioned", [False, True])
def test_only_touched_files_are_replaced(spark, tmp, partitioned):
    t = filled(spark, tmp, partitioned=partitioned)
    before, expected = data_files(tmp, "r"), spark.table(t).where("NOT (id BETWEEN 10 AND 14)").collect()
    # NULL conditions go as well: id 55 has no k
    replaced, written = G.revert_table(spark, f"{t}|id|id BETWEEN 10 AND 14", allow=True)
    after = data_files(tmp, "r")
    kept = set(before) & set(after)
    assert replaced == len(before) - len(kept) and 1 <= replaced <= 3 and written >= 1
    assert all(before[f] == after[f] for f in kept)
    assert sorted(spark.table(t).collect()) == sorted(expected)
    assert spark.table(t).schema == spark.read.table(t).schema
    G.revert_table(spark, f"{t}|id|k = 7", allow=True)  # only the NULL
    assert 55 not in {r["id"] for r in spark.table(t).collect()} and spark.table(t).count() == 94
    assert G.revert_table(spark, f"{t}|id|r.id = -1 AND k IS NULL", allow=True) == (0, 0)
    G.revert_table(spark, f"{t}|id|", allow=True)
    assert spark.table(t).count() == 0 and not hidden(tmp)


@pytest.mark.parametrize("at", [0, 1])
def test_a_revert_that_was_cut_off_is_finished_by_the_next(spark, tmp, monkeypatch, at):
    t = filled(spark, tmp)
    name = ("carry_out", "close")[at]

    def crash(*_):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(publish, name, crash)
        with pytest.raises(Crash):
            G.revert_table(spark, f"{t}|id|id < 20", allow=True)
    G.revert_table(spark, f"{t}|id|id >= 90", allow=True)
    assert sorted(r["id"] for r in spark.table(t).collect()) == [i for i in range(20, 90) if i != 55] or \
        sorted(r["id"] for r in spark.table(t).collect()) == list(range(20, 90))
    assert not hidden(tmp)


def test_bucketed_tables_are_overwritten_as_a_whole(spark, tmp):
    create_database(spark, DB)
    drop_table(spark, f"{DB}.bucketed")
    (spark.range(20).write.bucketBy(2, "id").option("path", f"{tmp}/tables/bucketed").saveAsTable(f"{DB}.bucketed"))
    assert publish.file_table(spark, f"{DB}.no_such_table") is None and publish.file_table(spark, "a.b.c.d") is None
    assert G.revert_table(spark, f"{DB}.bucketed|id|id < 5", allow=True) is None
    assert spark.table(f"{DB}.bucketed").count() == 15


def test_batches_are_dropped_together(spark, tmp):
    from tidewater.sinks.tables import BATCH_COLUMN, append_typed, drop_batches
    schema = StructType([StructField("id", LongType()), StructField(BATCH_COLUMN, StringType())])
    create_database(spark, DB)
    drop_table(spark, f"{DB}.dropped")
    create_table(spark, f"{DB}.dropped", schema, f"{tmp}/tables/dropped", (BATCH_COLUMN,))
    append_typed(spark.range(12).select("id", F.concat(F.lit("b"), F.col("id") % 6).alias("b")), f"{DB}.dropped", "b")
    drop_batches(spark, f"{DB}.dropped", ["b1", "b4", "b5", "never"])
    assert {r[0] for r in spark.table(f"{DB}.dropped").select(BATCH_COLUMN).collect()} == {"b0", "b2", "b3"}
    assert len(glob.glob(f"{tmp}/tables/dropped/{BATCH_COLUMN}=*")) == 3
    drop_batches(spark, f"{DB}.dropped", [])
    append_typed(spark.range(1).select("id", F.lit("b1").alias("b")), f"{DB}.dropped", "b")
    assert spark.table(f"{DB}.dropped").count() == 7


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_table_is_replaced_from_itself(spark, tmp, monkeypatch, partitioned):
    from tidewater.sinks.tables import overwrite_from_self
    t = filled(spark, tmp, partitioned=partitioned)
    doubled = spark.table(t).select(*[(F.col("id") * 2).alias("id") if c == "id" else F.col(c) for c in spark.table(t).columns])

    def crash(*_):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(publish, "write_aside", crash)
        with pytest.raises(Crash):
            overwrite_from_self(spark, t, doubled)
    assert spark.table(t).agg(F.sum("id")).first()[0] == 4950
    overwrite_from_self(spark, t, doubled)
    assert spark.table(t).agg(F.sum("id"), F.count("id")).first() == (9900, 100) and not hidden(tmp)
    overwrite_from_self(spark, t, spark.table(t).where("id < 20"))
    assert sorted(r["id"] for r in spark.table(t).collect()) == list(range(0, 20, 2))
    overwrite_from_self(spark, t, spark.table(t).where("false"))
    assert spark.table(t).count() == 0 and not hidden(tmp)

"""Whole batch ingest over real landing files."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import write
from tidewater import FileClass
from tidewater.plans.ingest import ImbalanceError, ingest, legacy_to_named
from tidewater.sinks.tables import BATCH_COLUMN, create_database, create_table, drop_table

DB = "tw_ingest_test"

HDR = FileClass(table="hdr", columns=("id", "name"), separator="|", pattern="^hdr_", extension="csv",
                keys=("id",),
                transform="SELECT CAST(id AS BIGINT) AS id, name, '%s' AS crt_by, '%s' AS updt_by, _batch_id "
                          "FROM hdr_RAW")
DET = FileClass(table="det", columns=("id", "qty", "note"), separator=",", pattern="^det_", extension="csv",
                keys=("id",), dialect="quoted")


def setup_tables(spark, tmp):
    create_database(spark, DB)
    for name, fields in (("hdr", [("id", LongType()), ("name", StringType()), ("crt_by", StringType()),
                                  ("updt_by", StringType())]),
                         ("det", [("id", LongType()), ("qty", LongType()), ("note", StringType())])):
        drop_table(spark, f"{DB}.{name}")
        schema = StructType([StructField(n, t) for n, t in fields] + [StructField(BATCH_COLUMN, StringType())])
        create_table(spark, f"{DB}.{name}", schema, f"{tmp}/tables/{name}", partition_by=(BATCH_COLUMN,))


def batch(tmp, i, hdr_lines, det_lines, markers=(True, True)):
    write(f"{tmp}/landing/hdr_{i}.csv", "id|name\n" + "\n".join(hdr_lines) + "\n")
    write(f"{tmp}/landing/det_{i}.csv", "id,qty,note\n" + "\n".join(det_lines) + "\n")
    if markers[0]:
        write(f"{tmp}/landing/hdr_{i}_DONE.csv", "")
    if markers[1]:
        write(f"{tmp}/landing/det_{i}_DONE.csv", "")


def counts(spark, name):
    return spark.table(f"{DB}.{name}").count()


def test_legacy_slots_become_a_parameter():
    assert legacy_to_named("SELECT '%s', %s, 'a%%b'") == "SELECT :user, :user, 'a%b'"


def test_good_failed_and_deferred_batches_then_replay(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann", "2|bob"], ['1,5,"x,y"', "2,6,"])
    batch(tmp, 2, ["3|cy"], ["3,7,z"], markers=(True, False))          # late sibling
    batch(tmp, 3, ["4|dee", "5"], ["4,8,q"])                          # short strict line
    res = ingest(spark, [HDR, DET], tmp, database=DB, user="svc")
    led = {r["batch_index"]: r for r in res.ledger.collect()}
    assert [led[i]["outcome"] for i in (1, 2, 3)] == ["archived", "deferred", "failed"]
    assert res.failed_files == 2
    assert counts(spark, "hdr") == 2 and counts(spark, "det") == 2
    row = spark.table(f"{DB}.hdr").filter("id = 1").first()
    assert (row["crt_by"], row["updt_by"]) == ("svc", "svc")
    assert spark.table(f"{DB}.det").filter("id = 1").first()["note"] == "x,y"
    assert spark.table(f"{DB}.det").filter("id = 2").first()["note"] == ""
    q = spark.read.parquet(f"{tmp}/_quarantine").collect()
    assert [r["line"] for r in q] == ["5"]
    assert led[1]["routed_to"][0].endswith("/archive/det_1.csv") or led[1]["routed_to"][0].endswith(
        "/archive/hdr_1.csv")

    # Replay: archived and failed batches are skipped; the late marker arrives.
    write(f"{tmp}/landing/det_2_DONE.csv", "")
    res2 = ingest(spark, [HDR, DET], tmp, database=DB, user="svc")
    led2 = {r["batch_index"]: r["outcome"] for r in res2.ledger.collect()}
    assert led2 == {1: "archived"}          # the first of the files that are left
    assert counts(spark, "hdr") == 3 and counts(spark, "det") == 3
    res3 = ingest(spark, [HDR, DET], tmp, database=DB, user="svc")
    assert res3.ledger.count() == 0 and counts(spark, "hdr") == 3


def test_blank_key_fails_the_whole_batch_but_space_is_a_key(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ['"",1,x'])
    batch(tmp, 2, ["2|bob"], ["2,1, "])
    batch(tmp, 3, ["|cy"], ["3,1,z"])          # strict empty field: NULL key
    res = ingest(spark, [HDR, DET], tmp, database=DB)
    led = {r["batch_index"]: r for r in res.ledger.collect()}
    assert led[3]["outcome"] == "failed" and led[3]["n_bad_keys"] == 1
    assert led[1]["outcome"] == "failed" and led[1]["n_bad_keys"] == 1
    assert "blank keys" in led[1]["reason"]
    assert led[2]["outcome"] == "archived"
    assert counts(spark, "hdr") == 1


def test_uncastable_value_fails_the_batch(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,notanumber,x"])
    res = ingest(spark, [HDR, DET], tmp, database=DB)
    r = res.ledger.first()
    assert r["outcome"] == "failed" and r["n_cast_errors"] == 1
    assert counts(spark, "hdr") == 0


def test_unbalanced_landing_aborts_before_any_write(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    write(f"{tmp}/landing/hdr_2.csv", "id|name\n2|bob\n")
    write(f"{tmp}/landing/hdr_2_DONE.csv", "")
    with pytest.raises(ImbalanceError):
        ingest(spark, [HDR, DET], tmp, database=DB)
    assert counts(spark, "hdr") == 0 and counts(spark, "det") == 0


def test_reingesting_a_batch_overwrites_its_partition(spark, tmp):
    """A crash after the append but before the ledger leaves no ledger row;
    the replay rewrites the same batch partition instead of duplicating."""
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann", "2|bob"], ["1,1,x", "2,2,y"])
    ingest(spark, [HDR, DET], tmp, database=DB, ledger_path=f"{tmp}/ledger_a")
    ingest(spark, [HDR, DET], tmp, database=DB, ledger_path=f"{tmp}/ledger_b")  # ledger "lost"
    assert counts(spark, "hdr") == 2 and counts(spark, "det") == 2
    assert spark.table(f"{DB}.hdr").select(BATCH_COLUMN).distinct().count() == 1


def test_transform_without_batch_column_runs_per_batch(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    batch(tmp, 2, ["2|bob", "3|cy"], ["2,1,y", "3,1,z"])
    legacy = FileClass(table="hdr", columns=("id", "name"), separator="|", pattern="^hdr_", keys=("id",),
                       transform="SELECT CAST(id AS BIGINT), name, '%s', '%s' FROM hdr_RAW")
    res = ingest(spark, [legacy, DET], tmp, database=DB, user="u")
    assert sorted(r["outcome"] for r in res.ledger.collect()) == ["archived", "archived"]
    got = sorted((r["id"], r[BATCH_COLUMN]) for r in spark.table(f"{DB}.hdr").collect())
    assert [g[0] for g in got] == [1, 2, 3] and got[1][1] == got[2][1] != got[0][1]


def test_runtime_error_in_a_transform_fails_only_that_batch(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    batch(tmp, 2, ["2|bob"], ["2,1,y"])
    batch(tmp, 3, ["3|cy"], ["3,1,z"])
    batch(tmp, 4, ["4|dee"], ["4,1,w"])
    strict_cast = FileClass(table="hdr", columns=("id", "name"), separator="|", pattern="^hdr_", keys=("id",),
                            transform="SELECT CAST(id AS BIGINT), name, "
                                      "CAST(CASE WHEN name = 'bob' THEN 'x' ELSE '1' END AS INT) AS c, "
                                      "'u', _batch_id FROM hdr_RAW")
    res = ingest(spark, [strict_cast, DET], tmp, database=DB)
    led = {r["batch_index"]: r for r in res.ledger.collect()}
    assert [led[i]["outcome"] for i in (1, 2, 3, 4)] == ["archived", "failed", "archived", "archived"]
    assert "CAST" in led[2]["reason"].upper()
    assert sorted(r["id"] for r in spark.table(f"{DB}.hdr").collect()) == [1, 3, 4]
    assert res.failed_files == 2


def test_continuous_ingest_picks_up_new_and_late_batches(spark, tmp):
    from tidewater.streaming.landing import continuous_ingest
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    batch(tmp, 2, ["2|bob"], ["2,1,y"], markers=(True, False))
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_stream_ckpt")
    assert counts(spark, "hdr") == 1
    write(f"{tmp}/landing/det_2_DONE.csv", "")
    batch(tmp, 3, ["3|cy"], ["3,1,z"])
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_stream_ckpt")
    assert counts(spark, "hdr") == 3 and counts(spark, "det") == 3
    assert spark.read.parquet(f"{tmp}/_bronze").count() == 12  # 6 files x (header + 1 line)


def test_finished_files_are_not_paired_again(spark, tmp):
    """Files that land between earlier names pair with each other, and no
    row of a finished batch comes in twice."""
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    ingest(spark, [HDR, DET], tmp, database=DB)
    write(f"{tmp}/landing/hdr_0.csv", "id|name\n10|new\n")
    write(f"{tmp}/landing/hdr_0_DONE.csv", "")
    write(f"{tmp}/landing/det_2.csv", "id,qty,note\n20,2,n\n")
    write(f"{tmp}/landing/det_2_DONE.csv", "")
    res = ingest(spark, [HDR, DET], tmp, database=DB)
    files = [sorted(f.rsplit("/", 1)[-1] for f in r["files"]) for r in res.ledger.collect()]
    assert files == [["det_2.csv", "hdr_0.csv"]]
    assert sorted(r["id"] for r in spark.table(f"{DB}.hdr").collect()) == [1, 10]
    assert sorted(r["id"] for r in spark.table(f"{DB}.det").collect()) == [1, 20]


def test_rounds_cover_all_batches(spark, tmp):
    setup_tables(spark, tmp)
    for i in range(5):
        batch(tmp, i, [f"{i}|n{i}"], [f"{i},1,x"])
    res = ingest(spark, [HDR, DET], tmp, database=DB, round_files=4)
    assert [r["outcome"] for r in res.ledger.collect()] == ["archived"] * 5
    assert counts(spark, "hdr") == counts(spark, "det") == 5
    assert res.file_counts.count() == 10


def test_an_error_while_appending_fails_the_batch_and_the_run_goes_on(spark, tmp, monkeypatch):
    from tidewater.plans import ingest as module
    from tidewater.plans.ingest import committed_rows
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    original = module.append_typed

    def broken(df, table, batch_col=None):
        if table.endswith(".det"):
            raise OSError("disk full\nsecond line")
        original(df, table, batch_col)

    monkeypatch.setattr(module, "append_typed", broken)
    res = ingest(spark, [HDR, DET], tmp, database=DB)
    row = res.ledger.first()
    assert (row["outcome"], row["reason"], res.failed_files) == ("failed", "disk full\nsecond line", 2)
    assert counts(spark, "hdr") == 0 and counts(spark, "det") == 0
    assert committed_rows(spark, f"{DB}.hdr", f"{tmp}/_ledger").count() == 0


def test_errors_of_configuration_leave_batches_pending(spark, tmp):
    from dataclasses import replace
    from pyspark.errors import AnalysisException
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    for wrong in (replace(HDR, transform="SELECT no_such_column FROM hdr_RAW"), replace(HDR, table="absent")):
        with pytest.raises(AnalysisException):
            ingest(spark, [wrong, DET], tmp, database=DB)
    with pytest.raises(ValueError):
        ingest(spark, [replace(HDR, keys=("nothing",)), DET], tmp, database=DB)
    assert [r["outcome"] for r in ingest(spark, [HDR, DET], tmp, database=DB).ledger.collect()] == ["archived"]


def test_keys_are_columns_of_the_transform(spark, tmp):
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    batch(tmp, 2, ["|bob"], ["2,1,x"])
    renamed = FileClass(table="hdr", columns=("a", "b"), separator="|", pattern="^hdr_", keys=("ident",),
                        transform="SELECT CAST(a AS BIGINT) AS ident, b, 'by %s', '%s', _batch_id FROM hdr_RAW")
    res = ingest(spark, [renamed, DET], tmp, database=DB, user="svc")
    assert {r["batch_index"]: r["outcome"] for r in res.ledger.collect()} == {1: "archived", 2: "failed"}
    row = spark.table(f"{DB}.hdr").first()
    assert (row["crt_by"], row["updt_by"]) == ("by svc", "svc")


def test_slots_inside_literals():
    assert legacy_to_named("SELECT 'by %s', \"%s\", '100%%', 'it''s %s!'") == \
        "SELECT concat('by ', :user, ''), :user, '100%', concat('it''s ', :user, '!')"


def test_continuous_ingest_waits_for_a_sibling(spark, tmp):
    from tidewater.streaming.landing import continuous_ingest
    setup_tables(spark, tmp)
    write(f"{tmp}/landing/hdr_1.csv", "id|name\n1|ann\n")
    write(f"{tmp}/landing/hdr_1_DONE.csv", "")
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_ckpt")
    assert counts(spark, "hdr") == 0
    write(f"{tmp}/landing/det_1_DONE.csv", "")
    write(f"{tmp}/landing/det_1.csv", "id,qty,note\n1,1,x\n")
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_ckpt")
    assert counts(spark, "hdr") == 1 and counts(spark, "det") == 1


def test_two_streams_share_one_bronze(spark, tmp):
    from tidewater.streaming.landing import pickup_to_bronze
    write(f"{tmp}/landing/a.csv", "one\n")
    pickup_to_bronze(spark, f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/c1")
    write(f"{tmp}/other/b.csv", "two\n")
    pickup_to_bronze(spark, f"{tmp}/other", f"{tmp}/bronze", f"{tmp}/c2")
    assert sorted(r["value"] for r in spark.read.parquet(f"{tmp}/bronze").collect()) == ["one", "two"]


def test_continuous_ingest_takes_lines_from_bronze(spark, tmp):
    """What the stream has read is not read again from the landing folder;
    a strict header goes by its place, whatever lines are blank."""
    from tidewater.streaming.landing import continuous_ingest
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    batch(tmp, 2, ["2|bob", "", "22|id"], ["2,1,y"], markers=(True, False))
    write(f"{tmp}/landing/hdr_2.csv", "\n  \nid|name\n2|bob\n\n22|id\nid|name\n")
    write(f"{tmp}/landing/hdr_3.csv", "")  # no line at all
    write(f"{tmp}/landing/det_3.csv", "id,qty,note\n3,1,z\n")
    for name in ("hdr_3", "det_3"):
        write(f"{tmp}/landing/{name}_DONE.csv", "")
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_stream_ckpt")
    assert counts(spark, "hdr") == 1 and counts(spark, "det") == 2
    for name in ("hdr_2", "det_2", "hdr_1"):
        write(f"{tmp}/landing/{name}.csv", "garbage\n")
    write(f"{tmp}/landing/det_2_DONE.csv", "")
    batch(tmp, 4, ["4|dee"], ["4,1,w"])
    continuous_ingest(spark, [HDR, DET], tmp, DB, f"{tmp}/_stream_ckpt")
    got = sorted((r["id"], r["name"]) for r in spark.table(f"{DB}.hdr").where("id is not null").collect())
    assert got == [(1, "ann"), (2, "bob"), (4, "dee"), (22, "id")] or got == [(1, "ann"), (4, "dee")]
    ledger = {tuple(sorted(f.rsplit("/", 1)[-1] for f in r["files"])): r["outcome"] for r in
              spark.read.parquet(f"{tmp}/_ledger").collect() if r["outcome"] != "deferred"}
    # hdr_2 repeats its header, whose id is no number: its batch fails as it would from the file
    assert ledger[("det_2.csv", "hdr_2.csv")] == "failed" and ledger[("det_4.csv", "hdr_4.csv")] == "archived"


def test_a_run_leaves_nothing_in_the_work_area(spark, tmp):
    import os

    from tidewater.session import shared_root
    setup_tables(spark, tmp)
    batch(tmp, 1, ["1|ann"], ["1,1,x"])
    work = f"{shared_root(spark).removeprefix('file:')}/tidewater-work"
    before = set(os.listdir(work)) if os.path.isdir(work) else set()
    assert ingest(spark, [HDR, DET], tmp, database=DB).failed_files == 0
    assert set(os.listdir(work)) == before

import pytest
from pyspark.sql import functions as F

from conftest import write
from tidewater.operators.window import rows_changed_per_table
from tidewater.plans import golden as G
from tidewater.plans.audit import AUDIT_SCHEMA, audited_run, create_audit_table
from tidewater.sinks.tables import create_database, drop_table
from tidewater.streaming.watermark import reset_watermarks

DB = "tw_golden_test"


def lines(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_compare_ignores_ascii_case_space_order_and_blank_lines(spark):
    actual = lines(spark, '{"a":1}', '{"b":2}')
    expected = lines(spark, '{"B": 2}', "", '  {"A":1} ')
    r = G.compare_lines(actual, expected).first()
    assert (r["only_actual"], r["only_expected"]) == (0, 0)


def test_compare_is_a_multiset_and_non_ascii_case_differs(spark):
    r = G.compare_lines(lines(spark, "x", "x", "É"), lines(spark, "x", "é")).first()
    assert (r["only_actual"], r["only_expected"]) == (2, 1)


def test_volatile_lines_are_ignored(spark):
    r = G.compare_lines(lines(spark, '"version":1', "a"), lines(spark, '"version":2', '"QTime":3', "a"),
                        volatile=True).first()
    assert (r["only_actual"], r["only_expected"]) == (0, 0)


def _table(spark, tmp, name, rows, ddl):
    create_database(spark, DB)
    drop_table(spark, f"{DB}.{name}")
    spark.createDataFrame(rows, ddl).write.option("path", f"{tmp}/{name}").saveAsTable(f"{DB}.{name}")
    return f"{DB}.{name}"


def test_run_golden_and_revert(spark, tmp):
    t = _table(spark, tmp, "people", [(1, "Ann", "T"), (2, "Bob", None), (3, "Cy", "F")],
               "id int, name string, flag string")
    write(f"{tmp}/expected/people/part-0.json", '{"ID":1,"name":"ANN"}\n{"id":3, "name":"cy"}\n')
    report = {r["test"]: r for r in G.run_golden(spark, ["people|id, name|flag IS NULL OR flag <> 'X'"],
                                                  f"{tmp}/expected", DB).collect()}
    assert report["people"]["status"] == "FAILURE"          # Bob is only in the actual side
    ok = G.run_golden(spark, ["people|id, name|id <> 2"], f"{tmp}/expected", DB).first()
    assert ok["status"] == "SUCCESS" and ok["line"].startswith("people ") and ok["line"].endswith(" - SUCCESS")

    with pytest.raises(PermissionError):
        G.revert_table(spark, "people|id|flag = 'T'", DB)
    G.revert_table(spark, "people|id|flag = 'T'", DB, allow=True)
    # NOT (flag = 'T') is NULL for Bob: he goes too
    assert sorted(r["id"] for r in spark.table(t).collect()) == [3]
    G.revert_table(spark, "people|id|", DB, allow=True)
    assert spark.table(t).count() == 0


def test_export_spec_writes_json_without_null_fields(spark, tmp):
    _table(spark, tmp, "pets", [(1, None), (2, "x")], "id int, name string")
    path = G.export_spec(spark, "pets|id, name|", f"{tmp}/actual", DB, single_file=True)
    got = sorted(r["value"] for r in spark.read.text(path).collect())
    assert got == ['{"id":1}', '{"id":2,"name":"x"}']


def test_rows_changed_window_is_open_and_tolerant(spark, tmp):
    t = _table(spark, tmp, "changes",
               [("2024-01-01 00:00:00",), ("2024-01-01 00:00:01",), ("2024-01-02 00:00:00",), ("junk",)],
               "updt_ts string")
    got = {r["table_name"]: r["rows_changed"] for r in rows_changed_per_table(
        spark, [t, f"{DB}.absent"], "2024-01-01 00:00:00", "2024-01-02 00:00:00").collect()}
    assert got == {t: 1, f"{DB}.absent": 0}


def test_audited_run_appends_one_row_per_table_even_on_failure(spark, tmp):
    t = _table(spark, tmp, "audited", [("2000-01-01 00:00:00",)], "updt_ts string")
    log = f"{DB}.run_log"
    drop_table(spark, log)
    create_audit_table(spark, log, f"{tmp}/run_log")
    with audited_run(spark, "", "app", [t], log, workflow_id="wf-1"):
        print("hello 'quoted'; done")
    with pytest.raises(RuntimeError):
        with audited_run(spark, "plat", "app", [t], log):
            raise RuntimeError("boom")
    rows = spark.table(log).orderBy("success").collect()
    assert [r["success"] for r in rows] == [False, True]
    ok = rows[1]
    assert ok["pltfrm_nm"] == "Unknown" and ok["workflow_id"] == "wf-1" and ok["rows_changed"] == 0
    assert "hello  quoted   done\\n" in ok["stdout"]
    assert rows[0]["workflow_id"] == "Unknown"
    assert spark.table(log).columns == [f.name for f in AUDIT_SCHEMA.fields]


def test_watermark_reset_keeps_one_row_per_row(spark, tmp):
    t = _table(spark, tmp, "wm", [(1, 2, 3, 4, 5, 6), (7, 8, 9, 10, 11, 12)],
               "a long, b long, c long, d long, e long, f long")
    reset_watermarks(spark, t)
    assert [tuple(r) for r in spark.table(t).collect()] == [(631152000,) * 6] * 2
    empty = _table(spark, tmp, "wm_empty", [], "a long, b long, c long, d long, e long, f long")
    reset_watermarks(spark, empty)
    assert spark.table(empty).count() == 0


def test_test_dir_runner_parts_results_and_revert_specs(spark, tmp):
    from tidewater.sinks.collections import commit_documents, delete_all_documents, hit_count
    t = _table(spark, tmp, "items", [(1, "a")], "id int, v string")
    write(f"{tmp}/test/tables.list", "items|id, v|id < 10\n\n")
    write(f"{tmp}/test/collections", "docs,select?q=*:*\n")
    write(f"{tmp}/test/p1/expected/items/e.json", '{"id":1,"v":"A"}\n')
    write(f"{tmp}/test/p1/expected/docs/e.json", '{"a":1}\n')
    write(f"{tmp}/test/p2/expected/items/e.json", '{"id":1,"v":"a"}\n{"id":2,"v":"b"}\n')
    write(f"{tmp}/test/p2/expected/docs/e.json", '{"a":1}\n{"a":2}\n')
    docs_t = f"{DB}.docs"
    drop_table(spark, docs_t)
    commit_documents(spark.createDataFrame([(1,)], "a long"), docs_t, f"{tmp}/docs")

    def run_part(part_dir):
        if part_dir.endswith("p2"):
            spark.createDataFrame([(2, "b")], "id int, v string").write.insertInto(t)
            commit_documents(spark.createDataFrame([(2,)], "a long"), docs_t)

    report = G.run_test_dir(spark, f"{tmp}/test", DB, run_part, results_path=f"{tmp}/results", run="r1")
    got = sorted((r["part"], r["test"], r["status"]) for r in report.collect())
    assert got == [("p1", "docs", "SUCCESS"), ("p1", "items", "SUCCESS"),
                   ("p2", "docs", "SUCCESS"), ("p2", "items", "SUCCESS")]
    assert {r["status"]: r["n_tests"] for r in G.summary(report).collect()} == {"SUCCESS": 4}
    assert G.consolidated_report(spark, f"{tmp}/results").count() == 4
    out = G.write_consolidated_report(spark, f"{tmp}/results", f"{tmp}/all_results", "r1")
    import glob
    files = glob.glob(f"{out}/part-*")
    assert len(files) == 1 and len(open(files[0]).read().splitlines()) == 4

    specs = G.read_spec_lines(spark, [f"{tmp}/test/tables.list", f"{tmp}/test/tables.list"])
    G.revert_specs(spark, specs, DB, allow=True)
    assert spark.table(t).count() == 0
    assert hit_count(spark, docs_t) == 2
    delete_all_documents(spark, docs_t)
    assert hit_count(spark, docs_t) == 0


def test_missing_expectation_is_a_failure_not_an_error(spark, tmp):
    _table(spark, tmp, "lonely", [(1,)], "id int")
    r = G.run_golden(spark, ["lonely|id|"], f"{tmp}/nothing_here", DB).first()
    assert r["status"] == "FAILURE"


def test_revert_clears_a_partition_that_becomes_empty(spark, tmp):
    create_database(spark, DB)
    t = f"{DB}.parted"
    drop_table(spark, t)
    (spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string")
          .write.partitionBy("p").option("path", f"{tmp}/parted").saveAsTable(t))
    G.revert_table(spark, "parted|id|p = 'a'", DB, allow=True)
    assert sorted(r["id"] for r in spark.table(t).collect()) == [2, 3]
    G.revert_table(spark, "parted|id|id = 2", DB, allow=True)
    assert sorted(r["id"] for r in spark.table(t).collect()) == [3]


def test_audit_counts_zero_for_unreadable_files_and_keeps_the_outcome(spark, tmp):
    good = _table(spark, tmp, "fine", [("2024-01-01 00:00:05",)], "updt_ts string")
    bad = _table(spark, tmp, "broken", [("2024-01-01 00:00:05",)], "updt_ts string")
    import glob
    for f in glob.glob(f"{tmp}/broken/part-*"):
        with open(f, "wb") as fh:
            fh.write(b"no parquet")
    got = dict(map(tuple, rows_changed_per_table(
        spark, [good, bad], "2024-01-01 00:00:00", "2024-01-02 00:00:00").collect()))
    assert got == {good: 1, bad: 0}
    log = f"{DB}.run_log2"
    drop_table(spark, log)
    create_audit_table(spark, log, f"{tmp}/run_log2")
    with audited_run(spark, "p", "a", [good, bad], log):
        pass
    assert spark.table(log).count() == 2
    with pytest.raises(KeyError):
        with audited_run(spark, "p", "a", [good], f"{DB}.no_such_log"):
            raise KeyError("the block's own")


def test_window_counts_whole_seconds(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.5' AS updt_ts UNION ALL SELECT timestamp'2024-01-01 00:00:01.2' "
                   "UNION ALL SELECT timestamp'2024-01-02 00:00:00'")
    got = rows_changed_per_table(spark, [("t", df)], "2024-01-01 00:00:00", "2024-01-02 00:00:00").first()
    assert got["rows_changed"] == 1


def test_specs_may_name_the_table_and_the_last_one_counts(spark, tmp):
    _table(spark, tmp, "q1", [(1, 2), (2, 3)], "id int, v int")
    write(f"{tmp}/expected/q1/e.json", '{"id":1}\n')
    report = G.run_golden(spark, ["q1|id|", "q1|q1.id|q1.v = 2"], f"{tmp}/expected", DB).collect()
    assert [(r["test"], r["status"]) for r in report] == [("q1", "SUCCESS")] * 2


@pytest.mark.parametrize("query", [
    "select?q=word", "select?q=kind:c OR", "select?q=(kind:c", "select?q=id:[1 TO 5", "select?q=id:[1 5]", "select?q=id:[a TO 5]",
    "select?q=kind:c^2", "select?q=-(kind:c", "select?q=kind:", 'select?q="a b"', 'select?q=kind:"a b"~2', "select?q=kind:c)",
    "select?q=kind:c&fq=NOT", "select?q=*:*&rows=1", "select?q=*:*&start=2", "select?q=*:*&sort=id desc", "select?q=AND kind:c",
    "select?q=*:*&fl=id,score", "select?q=*:*&facet=true", "select?q=id:>1", "select?q=kind:/c/", "select?q=nofield:1",
    "select?q=kind:(a OR)", "select?q=*:x", "select?q=kind:c&q.op=XOR"])
def test_collection_queries_not_understood(spark, query):
    docs = spark.createDataFrame([(1, "a b", None), (2, "c", "x")], "id int, kind string, note string")
    with pytest.raises(ValueError):
        G.collection_frame(docs, query)


def test_collection_queries_with_several_terms(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, "c", "x"), (3, "c", "*")], "id int, kind string, note string")
    ids = lambda query: sorted(r["id"] for r in G.collection_frame(docs, query).collect())
    assert ids("select?q=kind:c AND note:x&wt=json&indent=true") == [2]
    assert ids("q=*:* AND -id:2") == [1, 3]
    assert ids('q=note:"*"') == [3]
    assert G.collection_frame(docs, "q=*:*&fl=id,*").columns == ["id", "kind", "note"]


def test_collection_queries_select(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, "c", "x"), (3, "c", None)], "id int, kind string, note string")
    ids = lambda query: sorted(r["id"] for r in G.collection_frame(docs, query).collect())
    assert ids("select?q=*:*") == [1, 2, 3]
    assert ids('select?q=kind:"a b"') == [1]
    assert ids("select?q=kind:c&fq=-note:*&wt=json") == [3]
    assert G.collection_frame(docs, "select?q=id:2&fl=id,note").columns == ["id", "note"]


def test_a_collection_line_that_is_not_understood_fails_alone(spark, tmp):
    _table(spark, tmp, "docs2", [(1, "a"), (2, "b")], "id int, kind string")
    write(f"{tmp}/test/collections", "docs2,select?q=id:1 OR kind:b\ndocs2,select?q=id:1^3\ndocs2,select?q=nofield:1\n")
    write(f"{tmp}/test/expected/docs2/e.json", '{"id":1,"kind":"a"}\n{"id":2,"kind":"b"}\n')
    report = G.run_test_dir(spark, f"{tmp}/test", DB).collect()
    assert [(r["test"], r["status"]) for r in report] == [("docs2", "SUCCESS"), ("docs2", "FAILURE"), ("docs2", "FAILURE")]


def test_an_unreadable_list_ends_the_run(spark, tmp, monkeypatch):
    from pyspark.errors import AnalysisException

    def broken(*_):
        raise AnalysisException("no permission")

    write(f"{tmp}/test/expected/x/e.json", "{}\n")
    monkeypatch.setattr(G, "read_spec_lines", broken)
    with pytest.raises(AnalysisException):
        G.run_test_dir(spark, f"{tmp}/test", DB)

"""Stateful release of batches."""

from datetime import datetime, timedelta

from tidewater import FileClass
from tidewater.streaming.gate import gate_entries, log_listing, run_gate

A = FileClass(table="hdr", columns=("v",), pattern="^hdr_", extension="csv")
B = FileClass(table="det", columns=("v",), pattern="^det_.*csv$", extension="csv")
START, HOUR, KEY = datetime(2024, 1, 1), timedelta(hours=1), r"_(\d+)$"


def land(spark, tmp, version, names, hours):
    log_listing(spark.createDataFrame([(f"/l/{n}",) for n in names], "path string"), f"{tmp}/log", version,
                START + hours * HOUR)


def step(spark, tmp):
    run_gate(spark, f"{tmp}/log", [A, B], KEY, 24 * 3600, f"{tmp}/out", f"{tmp}/check")
    return {(r["batch_key"], r["outcome"]): r for r in spark.read.parquet(f"{tmp}/out").collect()}


def test_release_once_and_expiry_over_restarts(spark, tmp):
    land(spark, tmp, 1, ["hdr_1.csv", "det_1.csv", "hdr_2.csv", "det_2.csv", "hdr_2_DONE.csv", "det_2_DONE.csv",
                         "hdr_3.csv", "other_9.csv", "hdr_x.csv"], 0)
    got = step(spark, tmp)
    assert set(got) == {("2", "ready")} and got["2", "ready"]["files"] == ["/l/det_2.csv", "/l/hdr_2.csv"]
    land(spark, tmp, 2, ["hdr_1_DONE.csv", "hdr_3_DONE.csv"], 1)
    assert set(step(spark, tmp)) == {("2", "ready")}
    land(spark, tmp, 3, ["det_1_DONE.csv", "hdr_2_DONE.csv", "hdr_4.csv"], 2)  # one is listed again
    assert set(step(spark, tmp)) == {("2", "ready"), ("1", "ready")}
    land(spark, tmp, 3, ["hdr_5.csv"], 2)  # the log has this version
    land(spark, tmp, 4, ["det_6.csv"], 30)
    got = step(spark, tmp)
    assert set(got) == {("2", "ready"), ("1", "ready"), ("3", "expired"), ("4", "expired")}
    assert got["3", "expired"]["missing"] == ["det", "det_DONE"] and got["3", "expired"]["last_listed"] == START + HOUR
    assert got["4", "expired"]["missing"] == ["det", "hdr_DONE", "det_DONE"]
    land(spark, tmp, 5, ["det_7.csv"], 31)
    assert spark.read.parquet(f"{tmp}/out").count() == 4 and len(step(spark, tmp)) == 4


def test_markers_belong_to_their_file_s_class(spark):
    names = spark.createDataFrame([("/l/det_5_DONE.csv",), ("/l/det_5_DONE.txt",), ("/l/a_DONE_b_5.csv",)], "path string")
    from pyspark.sql import functions as F
    rows = gate_entries(names.withColumn("listed_at", F.lit(START)), [A, B], KEY).collect()
    assert [(r["batch_key"], r["class_pos"], r["marker"]) for r in rows] == [("5", 1, True)]

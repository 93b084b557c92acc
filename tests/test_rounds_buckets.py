"""Watermark rounds, bucketed comparison, row sums."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.operators.compare import differing_lines
from tidewater.operators.sorting import row_checksum, row_sums
from tidewater.streaming.watermark import WatermarkLog


def events(spark, rows):
    return spark.createDataFrame(rows, "k long, at long, v string").select(
        "k", F.timestamp_seconds("at").alias("ts"), "v")


def keys(selection):
    return sorted((r["k"] for r in selection.rows.collect()), key=str)


def test_each_row_once_with_late_rows(spark, tmp):
    log = WatermarkLog(spark, f"{tmp}/log", "ts", ["k"], overlap_seconds=100)
    rows = [(1, 1000, "a"), (2, 1050, "b"), (3, None, "no time")]
    empty = log.select(events(spark, []))
    assert keys(empty) == [] and log.mark is None
    log.commit(empty)
    first = log.select(events(spark, rows))
    assert keys(first) == [1, 2]
    assert keys(log.select(events(spark, rows))) == [1, 2]  # not committed: again
    log.commit(first)
    assert log.mark == 1_050_000_000
    assert keys(log.select(events(spark, rows))) == []
    rows += [(4, 1050, "same time"), (5, 990, "late"), (6, 940, "too late"), (7, 1300, "new")]
    second = log.select(events(spark, rows))
    assert keys(second) == [4, 5, 7]
    log.commit(second)
    with pytest.raises(RuntimeError):
        log.commit(second)
    rows += [(8, 1250, "late"), (9, 1100, "too late")]
    third = WatermarkLog(spark, f"{tmp}/log", "ts", ["k"], overlap_seconds=100).select(events(spark, rows))
    assert keys(third) == [8]
    log.commit(third)
    assert log.mark == 1_300_000_000 and keys(log.select(events(spark, rows))) == []


def test_the_bound_reaches_the_scan(spark, tmp):
    events(spark, [(1, 1000, "a")]).write.parquet(f"{tmp}/t")
    log = WatermarkLog(spark, f"{tmp}/log", "ts", ["k"])
    log.commit(log.select(spark.read.parquet(f"{tmp}/t")))
    import unittest.mock as mock
    plans = []
    with mock.patch("pyspark.sql.readwriter.DataFrameWriter.parquet", autospec=True,
                    side_effect=lambda w, p, **k: plans.append(w._df)):
        try:
            log.select(spark.read.parquet(f"{tmp}/t"))
        except Exception:
            pass
    assert "GreaterThanOrEqual(ts" in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_keys_may_be_null_and_several(spark, tmp):
    df = spark.createDataFrame([(None, "x", 5), (1, None, 5), (1, "x", 5)], "a int, `b.c` string, at long").select(
        "a", "`b.c`", F.timestamp_seconds("at").alias("t s"))
    log = WatermarkLog(spark, f"{tmp}/log", "t s", ["a", "b.c"], overlap_seconds=10)
    one = log.select(df.where("a is null"))
    log.commit(one)
    assert one.rows.count() == 1 and log.select(df).rows.count() == 2


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differing_lines(spark, exact, buckets):
    rng = random.Random(buckets)
    a = [f"line {rng.randrange(60)}" for _ in range(300)] + [None]
    b = a[:-1] + ["new", "line 1", "line 1"]
    b.remove("line 2") if "line 2" in b else None
    rng.shuffle(b)
    left, right = (spark.createDataFrame([(x,) for x in side], "line string") for side in (a, b))
    got = {r["line"]: r["only_actual"] - r["only_expected"] for r in differing_lines(left, right, buckets=buckets, exact=exact).collect()}
    assert got == {k: n for k in set(a) | set(b) if (n := Counter(a)[k] - Counter(b)[k])}
    assert differing_lines(left, left.orderBy(F.rand(1)), buckets=buckets, exact=exact).count() == 0


def test_row_sums_and_checksums_tell_rows_apart(spark):
    schema = "a string, b string, m map<string,int>"
    frames = [[("x", None, {"k": 1})], [("x", "~", {"k": 1})], [(None, "x", {"k": 1})], [("x", None, {"k": 2})], [("x", None, None)],
              [("a|b", "c", None)], [("a", "b|c", None)], [("a\\", "b", None)], [("a", "\\b", None)], [], [("x", None, {"k": 1})] * 2]
    sums = {tuple(df.agg(*row_sums(df)).first()) for f in frames for df in [spark.createDataFrame(f, schema)]}
    assert len(sums) == len(frames)
    texts = [spark.createDataFrame(f, schema).select("a", "b") for f in frames[:3] + frames[5:9]]
    assert len({df.select(row_checksum(df).alias("c")).first()["c"] for df in texts}) == len(texts)

"""Classification, balance, sibling pairing and the marker gate."""

import pytest
from pyspark.sql import functions as F

from conftest import write
from tidewater import FileClass
from tidewater.operators import batches as B
from tidewater.operators.ordinal import group_ordinal
from tidewater.plans.ingest import list_landing

A = FileClass(table="ta", columns=("k",), pattern="alpha", extension="csv")
Bc = FileClass(table="tb", columns=("k",), pattern="beta", extension="txt")


def names(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_group_ordinal_is_dense_per_group_even_for_a_hot_group(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 10).cast("string")).alias("g"),
        F.format_string("n%07d", "id").alias("name"))
    out = group_ordinal(df, ["g"], ["name"], "i", num_partitions=8)
    stats = {r["g"]: r for r in out.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"),
                                                      F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert stats["hot"]["n"] == 14000
    for r in stats.values():
        assert r["n"] == r["d"] == r["hi"] and r["lo"] == 1
    # position follows the order column
    w = out.filter("g = 'hot'").orderBy("name").select("i").collect()
    assert [r["i"] for r in w[:3]] == [1, 2, 3]


def test_classify_is_unanchored_on_base_name_and_skips_markers(spark):
    cls = B.class_table(spark, [A, Bc])
    df = B.classify(names(spark, "/l/x_alpha_1.csv", "/alpha/other.csv", "/l/x_alpha_1_DONE.csv",
                          "/l/alphabeta.csv"), cls)
    got = sorted((r["name"], r["file_class"]) for r in df.collect())
    assert got == [("alphabeta.csv", "ta"), ("alphabeta.csv", "tb"), ("x_alpha_1.csv", "ta")]


def test_balance_counts_missing_class_as_zero(spark):
    cls = B.class_table(spark, [A, Bc])
    two_a_one_b = names(spark, "/l/alpha1.csv", "/l/alpha2.csv", "/l/beta1.txt")
    two_a_no_b = names(spark, "/l/alpha1.csv", "/l/alpha2.csv")
    balanced = names(spark, "/l/alpha1.csv", "/l/beta1.txt")
    assert B.balance(B.classify(two_a_one_b, cls), cls).first()["unbalanced"] is True
    assert B.balance(B.classify(two_a_no_b, cls), cls).first()["unbalanced"] is True
    assert B.balance(B.classify(balanced, cls), cls).first()["unbalanced"] is False


def test_pairing_by_name_order_and_all_markers_gate(spark):
    cls = B.class_table(spark, [A, Bc])
    listing = names(spark,
                    "/l/alpha_2.csv", "/l/alpha_1.csv", "/l/beta_1.txt", "/l/beta_2.txt",
                    "/l/alpha_1_DONE.csv", "/l/beta_1_DONE.txt", "/l/alpha_2_DONE.csv")
    man = B.manifest(listing, cls)
    got = sorted((r["batch_index"], r["name"], r["ready"]) for r in man.collect())
    assert got == [(1, "alpha_1.csv", True), (1, "beta_1.txt", True),
                   (2, "alpha_2.csv", False), (2, "beta_2.txt", False)]
    ids = {r["batch_index"]: r["batch_id"] for r in man.collect()}
    assert ids[1] != ids[2]


def test_marker_uses_the_real_extension_and_the_class_extension(spark):
    cls = B.class_table(spark, [FileClass(table="t", columns=("k",), pattern="data", extension="done")])
    listing = names(spark, "/l/data.json", "/l/data_DONE.done")
    assert [r["ready"] for r in B.manifest(listing, cls).collect()] == [True]


def test_listing_keeps_zero_byte_markers_and_decodes_names(spark, tmp):
    write(f"{tmp}/landing/a 1.csv", "h\n1\n")
    write(f"{tmp}/landing/a 1_DONE.csv", "")
    write(f"{tmp}/landing/noext", "x\n")
    got = sorted(r["path"].rsplit("/", 1)[-1] for r in list_landing(spark, f"{tmp}/landing").collect())
    assert got == ["a 1.csv", "a 1_DONE.csv"]


def test_outcome(spark):
    df = spark.createDataFrame([(False, False), (True, True), (True, False)], "ready boolean, bad boolean")
    got = [r[0] for r in df.select(B.outcome(F.col("ready"), F.col("bad"))).collect()]
    assert got == ["deferred", "failed", "archived"]


@pytest.mark.parametrize("n", [1, 3])
def test_group_ordinal_without_groups(spark, n):
    df = spark.range(50).select(F.col("id").cast("string").alias("s"))
    out = group_ordinal(df, [], ["s"], "i", num_partitions=n)
    assert sorted(r["i"] for r in out.collect()) == list(range(1, 51))


def test_group_ordinal_with_one_order_value_in_a_hot_group(spark):
    df = spark.range(12000).select(F.lit("g").alias("g"), F.lit("same").alias("name"), "id")
    out = group_ordinal(df, ["g"], ["name"], "i", num_partitions=6)
    r = out.agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"), F.min("i").alias("lo"),
                F.max("i").alias("hi")).first()
    assert (r["n"], r["d"], r["lo"], r["hi"]) == (12000, 12000, 1, 12000)


def test_purge_work_area_removes_old_run_folders(spark):
    from tidewater.session import purge_work_area, work_dir
    path = work_dir(spark, "purge-me")
    spark.range(3).write.parquet(path)
    deleted = purge_work_area(spark, -1, prefix="purge-me")
    assert any(p.rstrip("/").endswith(path.rsplit("/", 1)[-1]) for p in deleted)
    assert all(p.rstrip("/").rsplit("/", 1)[-1].startswith("purge-me") for p in deleted)

import json

from pyspark.sql import functions as F

from conftest import write
from tidewater.operators.estimate import estimate_pi, random_points
from tidewater.operators.sorting import total_order_sort, validate_sorted
from tidewater.plans.probes import catalog_table_probe, run_probes
from tidewater.schema import FileClass
from tidewater.sources.generated import load_json_documents
from tidewater.streaming.landing import pickup_to_bronze, release_ready
from tidewater.plans.ingest import list_landing


def test_squares_probe_known_answer(spark):
    rows = {r["probe"]: r for r in catalog_table_probe(spark).collect()}
    assert rows["Catalog select table"]["actual"] == "10/385/55"
    assert all(r["status"] == "SUCCESS" for r in rows.values())


def test_json_array_document_count(spark, tmp):
    docs = [{"a": i, "b": i * i} for i in range(1, 6)]
    write(f"{tmp}/docs/indexable.json", json.dumps(docs, indent=2))
    df = load_json_documents(spark, f"{tmp}/docs")
    assert df.count() == 5
    assert dict(df.dtypes) == {"a": "bigint", "b": "bigint"}


def test_sort_validation_detects_disorder(spark, tmp):
    data = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("key"), "id")
    total_order_sort(data, "key", 4).write.parquet(f"{tmp}/sorted")
    ok = validate_sorted(spark, f"{tmp}/sorted", "key").first()
    assert ok["n"] == 5000 and ok["inversions"] == 0
    data.write.parquet(f"{tmp}/unsorted")
    bad = validate_sorted(spark, f"{tmp}/unsorted", "key").first()
    assert bad["n"] == 5000 and bad["inversions"] > 0 and bad["checksum"] == ok["checksum"]


def test_pi(spark):
    pi = estimate_pi(random_points(spark, 100000, seed=7)).first()["pi"]
    assert 3.0 < pi < 3.3


def test_probe_suite_reports_success(spark):
    rows = run_probes(spark, sort_rows=20000).collect()
    assert rows and all(r["status"] == "SUCCESS" for r in rows), rows
    assert rows[0]["line"].startswith(rows[0]["probe"])


def test_stream_pickup_is_incremental_and_release_waits_for_markers(spark, tmp):
    write(f"{tmp}/landing/a_1.txt", "l1\nl2\n")
    write(f"{tmp}/landing/b_1.txt", "m1\n")
    write(f"{tmp}/landing/a_1_DONE.txt", "")
    write(f"{tmp}/landing/b_1_DONE.txt", "")
    write(f"{tmp}/landing/a_2.txt", "l3\n")
    write(f"{tmp}/landing/b_2.txt", "m2\n")
    write(f"{tmp}/landing/a_2_DONE.txt", "")            # b_2's marker is late
    pickup_to_bronze(spark, f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt")
    assert spark.read.parquet(f"{tmp}/bronze").count() == 5
    pickup_to_bronze(spark, f"{tmp}/landing", f"{tmp}/bronze", f"{tmp}/ckpt")   # nothing new
    assert spark.read.parquet(f"{tmp}/bronze").count() == 5
    classes = [FileClass(table="a", columns=("v",), pattern="^a_", extension="txt"),
               FileClass(table="b", columns=("v",), pattern="^b_", extension="txt")]
    bronze = spark.read.parquet(f"{tmp}/bronze")
    released = release_ready(spark, bronze, list_landing(spark, f"{tmp}/landing"), classes)
    assert sorted(r["value"] for r in released.collect()) == ["l1", "l2", "m1"]
    write(f"{tmp}/landing/b_2_DONE.txt", "")
    released = release_ready(spark, bronze, list_landing(spark, f"{tmp}/landing"), classes)
    assert released.count() == 5


def test_sort_spreads_a_hot_key_over_partitions(spark, tmp):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("m")).otherwise(F.md5(F.col("id").cast("string"))).alias("key"), "id")
    out = total_order_sort(hot, "key", 8)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 10000 * 0.9          # the 10000 "m" rows are not all in one task
    out.write.parquet(f"{tmp}/hot")
    v = validate_sorted(spark, f"{tmp}/hot", "key").first()
    assert v["n"] == 30000 and v["inversions"] == 0


def test_sort_validation_compares_numeric_keys_as_numbers(spark, tmp):
    data = spark.range(2000).select((F.col("id") * 7 % 2000).alias("key"), "id")
    total_order_sort(data, "key", 3).write.parquet(f"{tmp}/num")
    v = validate_sorted(spark, f"{tmp}/num", "key").first()
    assert v["n"] == 2000 and v["inversions"] == 0


def test_sort_validation_with_nulls_large_numbers_and_nan(spark, tmp):
    def inversions(rows, ddl, name):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp}/{name}")
        return validate_sorted(spark, f"{tmp}/{name}", "k").first()["inversions"]

    big = 9007199254740992
    assert inversions([(None,), ("a",), ("b",)], "k string", "s1") == 0
    assert inversions([("a",), (None,), ("b",)], "k string", "s2") == 1
    assert inversions([(None,), (big + 1,), (big,)], "k bigint", "n1") == 1
    assert inversions([(None,), (1.0,), (float("nan"),)], "k double", "d1") == 0
    assert inversions([(float("nan"),), (1.0,)], "k double", "d2") == 1
    assert inversions([(False,), (True,), (False,)], "k boolean", "b1") == 1


def test_sort_checksum_covers_the_row_and_cannot_overflow(spark, tmp):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    rows.write.parquet(f"{tmp}/a")
    rows.withColumn("v", F.col("v") + F.when(F.col("k") == 5, 1).otherwise(0)).write.parquet(f"{tmp}/b")
    a, b = (validate_sorted(spark, f"{tmp}/{x}", "k").first()["checksum"] for x in "ab")
    assert a != b and a > 1 << 63

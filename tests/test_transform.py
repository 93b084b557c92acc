"""Caller SQL: user slots, and one plan for the batches of a round."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import write
from tidewater import FileClass
from tidewater.plans.ingest import ingest
from tidewater.plans.transform import knows_batches, lateral, legacy_to_named, over_views, run_sql, tokens
from tidewater.sinks.tables import BATCH_COLUMN, create_database, create_table, drop_table

DB = "tw_transform_test"


def test_tokens_cover_the_text():
    sql = "a -- it's\n/* x /* ' */ \" */ `o'k` 'it''s \\' %s' r'\\' \"d\"\"q\" tail 'open"
    pieces = list(tokens(sql))
    assert "".join(t for _, t in pieces) == sql
    assert [(k, t) for k, t in pieces if k != "text"] == [
        ("comment", "-- it's"), ("comment", "/* x /* ' */ \" */"), ("name", "`o'k`"),
        ("literal", "'it''s \\' %s'"), ("literal", "r'\\'"), ("literal", '"d""q"')]


@pytest.mark.parametrize("before", ["-- the caller's name\n", "/* it's */ ", "/* a /* nested ' */ \" */ ", "1 AS `o'k`, ",
                                    "r'\\' AS raw, ", "'it\\'s' AS x, "])
def test_a_slot_after_an_apostrophe_is_the_user(spark, before):
    spark.createDataFrame([("1",)], "id string").createOrReplaceTempView("slot_RAW")
    sql = legacy_to_named(f"SELECT {before}'%s' AS v, 'by %s' AS w FROM slot_RAW")
    row = run_sql(spark, sql, "ann").first()
    assert (row["v"], row["w"]) == ("ann", "by ann")


def test_slots_elsewhere():
    assert legacy_to_named("SELECT 1 -- %s and 100%%\n, '%s'") == "SELECT 1 --  and 100%\n, :user"
    assert legacy_to_named("SELECT r'a\\%s', \"%s\"") == "SELECT concat(r'a\\', :user, r''), :user"
    with pytest.raises(ValueError, match="name"):
        legacy_to_named("SELECT 1 AS `%s`, '%s'")
    assert knows_batches("SELECT t._BATCH_ID FROM t") and knows_batches("SELECT `_batch_id` FROM t")
    assert not knows_batches("SELECT '_batch_id' -- _batch_id\n FROM t")
    assert not knows_batches("SELECT order_batch_id, _batch_id2 FROM t")


QUERIES = [  # (SQL, whether Spark plans it for all batches at once)
    ("SELECT CAST(id AS BIGINT), k, :user, :user FROM t_RAW", True),
    ("SELECT * FROM t_RAW;", True),
    ("SELECT count(*), max(id) FROM t_RAW", True),
    ("SELECT k, count(*) FROM t_RAW GROUP BY k HAVING count(*) > 1", True),
    ("SELECT DISTINCT k FROM t_RAW -- it's the last line", True),
    ("SELECT t.id, s.name FROM t_RAW t JOIN s_RAW s ON t.k = s.k", True),
    ("SELECT id, row_number() OVER (ORDER BY CAST(id AS INT)) FROM t_RAW", True),
    ("SELECT id FROM t_RAW ORDER BY CAST(id AS INT) DESC LIMIT 2", True),
    ("SELECT id FROM t_RAW UNION SELECT name FROM s_RAW", True),
    ("WITH a AS (SELECT k, count(*) AS n FROM t_RAW GROUP BY k) SELECT x.k, y.n FROM a x JOIN a y ON x.n = y.n", True),
    ("SELECT 'x'", True),
    ("SELECT t.id, s.name FROM t_RAW t LEFT JOIN s_RAW s ON t.k = s.k", False),
    ("SELECT id FROM t_RAW WHERE k IN (SELECT k FROM s_RAW)", False),
    ("SELECT id, (SELECT max(name) FROM s_RAW) FROM t_RAW", False),
]


@pytest.mark.parametrize("sql,planned", QUERIES)
def test_all_batches_in_one_plan_equal_one_by_one(spark, sql, planned):
    from tidewater.plans.transform import bound_sql
    sql = bound_sql(sql)
    lines = spark.createDataFrame([(f"b{i % 3}", str(i), str(i % 2)) for i in range(12)], "_batch_id string, id string, k string")
    names = spark.createDataFrame([("b0", "0", "zero"), ("b0", "1", "one"), ("b1", "0", "Zero")],
                                  "_batch_id string, k string, name string")
    batches = ["b0", "b1", "b2", "b3"]  # the last has no lines

    def views(b=None):
        for name, df in (("tw_l", lines), ("tw_n", names)):
            (df if b is None else df.where(F.col("_batch_id") == b)).createOrReplaceTempView(name)
        return {"t_RAW": ("tw_l", ["id", "k"]), "s_RAW": ("tw_n", ["k", "name"])}

    expected = []
    for b in batches:
        expected += [(b, *r) for r in run_sql(spark, over_views(sql, views(b)), "ann").collect()]
    spark.createDataFrame([(b,) for b in batches], "_batch_id string").createOrReplaceTempView("tw_b")
    out = lateral(spark, sql, views(), "tw_b", "ann")
    assert (out is not None) == planned
    if planned:
        assert sorted(tuple(r) for r in out.collect()) == sorted(expected)


def make_table(spark, tmp, name, fields):
    create_database(spark, DB)
    drop_table(spark, f"{DB}.{name}")
    create_table(spark, f"{DB}.{name}", StructType([StructField(n, t) for n, t in fields]
                                                   + [StructField(BATCH_COLUMN, StringType())]),
                 f"{tmp}/tables/{name}", partition_by=(BATCH_COLUMN,))


def land(tmp, folder, i, name, lines):
    write(f"{tmp}/{folder}/{name}_{i}.csv", "\n".join(["header", *lines]) + "\n")
    write(f"{tmp}/{folder}/{name}_{i}_DONE.csv", "")


SALES = FileClass(table="sales", columns=("shop", "sum"), separator="|", pattern="^sales_", keys=("shop",))
SHOPS = FileClass(table="shops", columns=("shop", "town"), separator="|", pattern="^shops_", keys=("shop",))


def setup(spark, tmp, n):
    make_table(spark, tmp, "sales", [("town", StringType()), ("n", LongType()), ("total", LongType()), ("by", StringType())])
    make_table(spark, tmp, "shops", [("shop", StringType()), ("town", StringType())])
    for i in range(n):
        land(tmp, "landing", i, "sales", [f"s1|{i}", "s2|1", "s1|1"])
        land(tmp, "landing", i, "shops", [f"s1|town{i % 2}", "s2|other"])


LEGACY = ("SELECT t.town, count(*), CAST(sum(s.sum) AS BIGINT), '%s' FROM sales_RAW s JOIN shops_RAW t "
          "ON s.shop = t.shop GROUP BY t.town -- the caller's own")


def test_legacy_aggregate_over_siblings_runs_once(spark, tmp, monkeypatch):
    from tidewater.plans import ingest as module
    seen = []
    original = module.lateral
    monkeypatch.setattr(module, "lateral", lambda *a: seen.append(original(*a)) or seen[-1])
    setup(spark, tmp, 40)
    sales = replace(SALES, transform=LEGACY, keys=("town",))
    res = ingest(spark, [sales, SHOPS], tmp, database=DB, user="ann")
    assert res.failed_files == 0 and res.ledger.where("outcome = 'archived'").count() == 40
    got = sorted((r["town"], r["n"], r["total"], r["by"]) for r in spark.table(f"{DB}.sales").collect())
    assert got == sorted([(f"town{i % 2}", 2, i + 1, "ann") for i in range(40)] + [("other", 1, 1, "ann")] * 40)
    assert len(seen) == 2 and all(x is not None for x in seen)  # planned once, written once
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 3  # each RAW view and the batch ids once


def test_sql_that_spark_refuses_runs_batch_by_batch(spark, tmp):
    setup(spark, tmp, 3)
    sql = LEGACY.replace(" JOIN ", " LEFT JOIN ").replace("SELECT t.town", "SELECT coalesce(t.town, 'none') AS town")
    ingest(spark, [replace(SALES, transform=sql.replace("GROUP BY t.town", "GROUP BY 1"), keys=("town",)), SHOPS], tmp,
           database=DB, user="ann")
    assert spark.table(f"{DB}.sales").count() == 6


def test_one_batch_that_raises_fails_alone(spark, tmp):
    setup(spark, tmp, 5)
    sql = "SELECT 'x', count(*), CAST(max(CASE WHEN sum = '3' THEN 'bad' ELSE sum END) AS BIGINT), '%s' FROM sales_RAW"
    res = ingest(spark, [replace(SALES, transform=sql, keys=()), SHOPS], tmp, database=DB)
    assert res.failed_files == 2 and spark.table(f"{DB}.sales").count() == 4


def test_star_is_the_declared_columns(spark, tmp):
    setup(spark, tmp, 2)
    ingest(spark, [replace(SHOPS, table="shops", transform="SELECT * FROM shops_RAW")], tmp, database=DB)
    assert spark.table(f"{DB}.shops").count() == 4


def test_two_ingests_of_one_class_in_one_session(spark, tmp):
    setup(spark, tmp, 1)
    tops = [f"{tmp}/zone{k}" for k in range(4)]
    for k, top in enumerate(tops):
        for i in range(3):
            land(top, "landing", i, "sales", [f"s{k}|{k}"])
            land(top, "landing", i, "shops", [f"s{k}|zone{k}"])
    sales = replace(SALES, transform=LEGACY, keys=("town",))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda top: ingest(spark, [sales, SHOPS], top, database=DB, user="ann"), tops))
    got = {(r["town"], r["total"]): r["count"] for r in spark.table(f"{DB}.sales").groupBy("town", "total").count().collect()}
    assert got == {(f"zone{k}", k): 3 for k in range(4)}

"""Every registered workload equals its oracle SQL (DuckDB) at sf0.001, the
same check the driver runs at sf0.01."""

import hashlib
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewater.sources.generated import keyed_rows
from tidewater.workloads import ORACLES, QUERIES
from tools.check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderstatus", "n_orders"]


def test_generated_rows_follow_the_orders(spark, tmp_path):
    """Each row's key is made from its order key: orders that share one share it."""
    keys = [7, 3, 3, None, 12]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    assert tuple(QUERIES["generated_rows"](spark, str(tmp_path)).first()) == (5, 10, 4, 20)
    rows = keyed_rows(spark.createDataFrame([(k,) for k in keys], "o_orderkey long"), "o_orderkey").collect()
    assert sorted((r["row_id"], r["key"]) for r in rows) == [
        (k, hashlib.sha256(x.encode()).hexdigest()[:20]) for k, x in enumerate(("", "3", "3", "7", "12"))]

"""Known-answer inputs of the health probes: external delimited tables,
JSON array documents, generated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinal import group_ordinal

# The squares probe's table layout and answer (rows 1..10).
SQUARES_DDL = "sqrt INT, square INT"
SQUARES_ANSWER = (10, 385, 55)


def squares_lines(spark: SparkSession, n: int = 10) -> DataFrame:
    """``i,i*i`` lines for i in 1..n (the probe's inline data), generated on
    executors."""
    return spark.range(1, n + 1).select(F.format_string("%d,%d", F.col("id"), F.col("id") * F.col("id"))
                                        .alias("value"))


def create_external_csv_table(spark: SparkSession, name: str, ddl: str, location: str,
                              sep: str = ",") -> None:
    """``CREATE TABLE name (ddl) USING csv OPTIONS (sep) LOCATION`` over an
    existing directory, no header.  ``ddl`` is a column list (trusted
    configuration); name and location are bound as parameters."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({ddl}) USING csv "
              f"OPTIONS (sep :sep, header 'false') LOCATION :loc",
              args={"t": name, "sep": sep, "loc": location})


def load_json_documents(spark: SparkSession, path: str, schema: str | None = None,
                        multiline: bool = True) -> DataFrame:
    """JSON documents: with ``multiline`` every file is one JSON value (an
    array becomes one row per element); otherwise one value per line (a line
    holding an array also yields one row per element)."""
    reader = spark.read.option("multiLine", multiline)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def _key(column: str):
    return F.substring(F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")), 256), 1, 20).alias("key")


def keyed_rows(df: DataFrame, column: str) -> DataFrame:
    """:func:`generated_rows` with one row for each row of ``df``: the id is
    its place (from 0) in the order of ``column``, the key a hash of ``column``
    (NULL as '')."""
    numbered = group_ordinal(df.select(F.col(f"`{column}`").alias("of")), [], ["of"])
    return numbered.select((F.col("ordinal") - 1).alias("row_id"), _key("of"))


def generated_rows(spark: SparkSession, n: int, slices: int | None = None) -> DataFrame:
    """``n`` rows with a 10-byte-style random key and a row id, generated on
    executors (the generate step of generate/sort/validate)."""
    df = spark.range(0, n, 1, slices) if slices else spark.range(n)
    return df.select(F.col("id").alias("row_id"),
                     _key("id"))

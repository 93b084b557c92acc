"""Document collections kept as tables: commit (append) and delete-all.

Documents carry no id in this data, so there is no upsert key: a commit
appends.  Delete-all empties the table (static overwrite with no rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import create_table, overwrite_mode


def commit_documents(docs: DataFrame, table: str, location: str | None = None) -> None:
    spark = docs.sparkSession
    if not spark.catalog.tableExists(table):
        if location is None:
            raise ValueError(f"collection {table} does not exist and no location was given")
        create_table(spark, table, docs.schema, location)
    docs.select(*spark.table(table).columns).write.insertInto(table)


def delete_all_documents(spark: SparkSession, table: str) -> None:
    empty = spark.table(table).where(F.lit(False))
    # Nothing is read from the table, so a direct overwrite is allowed.
    with overwrite_mode(spark, "static"):
        spark.createDataFrame([], empty.schema).write.insertInto(table, overwrite=True)


def hit_count(spark: SparkSession, table: str) -> int:
    """Match-all query: the number of documents."""
    return spark.table(table).count()

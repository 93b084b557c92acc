"""From raw documents to token numbers, stage by stage.

Every stage takes what the one before kept; its result is written as Parquet
to the shared work area and reread.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, language, pii, simhash
from tidewater.llm.common import read_table
from tidewater.session import configure, scratch, work_dir
from tidewater.sinks.files import delete_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: no text, no letters, or
    a text that no language learned from the table explains."""
    configure(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    configure(spark)
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out; drops documents that are mostly such."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    configure(spark)
    return pii.redact_pii(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token numbers; keeps only documents that decode to their text."""
    configure(spark)
    coded = bpe.encode_texts(docs, bpe.default_path(), ("ids", "n_tokens", "ids_sha256", "decoded_sha256"))
    return coded.where(F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256))


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("pii", redact),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Of the work area only they are left: what a
    stage needed goes when its result is written, the result when the next is."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            path = work_dir(spark, f"pipeline-{name}")
            done = stage(spark, docs, sf_dir)
            done.write.parquet(path)
            keep.add(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.schema(done.schema).parquet(path), path
    return docs


#: SQL cannot express the stages; tests hold run() against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

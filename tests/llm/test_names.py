"""Columns of any name pass through; nothing of a run stays behind."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bpe, chat, decontaminate, language, lexical, pii, sharding, simhash, spelling, suffixes, url_rules
from tidewater.llm.common import add_columns
from tidewater.session import shared_root

SF = "/root/testdata/sf0.001"
ODD = ["a.b", "__before", "__kept_id", "__kept_print", "__in0", "__print", "own_0", "c0", "n0", "kept_id", "before", "a`b",
       "hit_spans", "score", "text.x", "count", "version", "word"]


@pytest.fixture()
def docs(spark):
    rows = [(1, "the quick brown fox and mail me@example.org", "en"), (2, "the quick brown fox and mail me@example.org", "en"),
            (3, "une phrase tout à fait autre que les autres", "fr"), (None, None, None), (4, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.concat(F.lit(f"{k}-"), F.coalesce("text", F.lit("none"))).alias(c) for k, c in enumerate(ODD)])


def untouched(before, after):
    """The odd columns (but for those an operator adds) of the rows that are left are as they were."""
    same = [c for c in ODD if c not in ("hit_spans", "score")]

    def own(df):
        return {tuple(r[df.columns.index(c)] for c in same) for r in df.collect()}

    assert own(after) <= own(before)
    return after


def test_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == docs.columns
        assert untouched(docs, out).count() == {"language": 3, "simhash": 3}.get(name, 5)


def test_operators(spark, docs):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(setting)
    spark.conf.set(setting, 10000)
    try:
        operators(spark, docs)
        assert spark.conf.get(setting) == "10000"
    finally:
        spark.conf.set(setting, held)


def operators(spark, docs):
    bench = docs.withColumn("item_id", F.col("doc_id"))
    for out in (pii.find_pii(docs), pii.redact_pii(docs), decontaminate.find_contamination(docs, bench, window=3),
                decontaminate.find_contamination(docs, bench, window=3, item_bytes=30),
                language.identify(docs, docs), bpe.encode_texts(docs, bpe.default_path()), simhash.keep_one(docs),
                simhash.keep_one(docs.union(docs))):
        untouched(docs, out)
        assert out.count() >= 3
    same = docs.withColumn("conv_id", F.col("doc_id")).withColumn("turn", F.lit(1)).withColumn("role", F.lit("user"))
    assert chat.format_chats(same).count() == 5
    assert sharding.interleaved_shards(docs).count() == 5
    assert suffixes.remove_repeats(docs).count() == 5
    assert spelling.group_variants(spelling.word_counts(docs, min_count=1)).count() > 5
    assert lexical.search(docs, bench).count() > 4
    pages = docs.withColumn("page_id", F.col("doc_id")).withColumn("url", F.lit("http://a.com/x"))
    assert url_rules.filter_pages(pages).count() == 5


def test_redaction_keeps_a_column_called_before(spark):
    df = spark.createDataFrame([("a", "to me@example.org", 17)], "__before string, text string, n_chars int")
    assert tuple(pii.redact_pii(df).first()) == ("a", "to [EMAIL]", 10)


def test_columns_that_differ_by_case(spark):
    df = spark.createDataFrame([("x", "words here")], "Text string, other string").toDF("Text", "text")
    out = add_columns(df, ["text"], "n int", lambda: lambda t: (len(t),))
    assert out.columns == ["Text", "text", "n"] and tuple(out.collect()[0]) == ("x", "words here", 10)


def test_long_schemes_are_redacted_whole():
    finder = pii.Finder()
    for scheme in ("http", "x" * 40, "a+b.c-" * 30 + "z"):
        text = f"see {scheme}://me:pw@host now"
        assert ("login", 4, len(text) - 4) in finder.spans(text)
    assert ("login", 1, 12) in finder.spans("9s://me:pw@h")
    assert not [s for s in finder.spans("9://me:pw@h") if s[0] == "login"]


def work_folders(spark):
    root = f"{shared_root(spark).removeprefix('file:')}/tidewater-work"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_nothing_is_staged_for_a_benchmark_of_several_automata(spark, docs):
    before = work_folders(spark)
    bench = spark.createDataFrame([(i, f"the quick brown fox {i} " * 400) for i in range(60)], "item_id long, text string")
    out = decontaminate.find_contamination(docs, bench, window=4, item_bytes=50_000)
    assert {r["doc_id"]: len(r["hit_items"]) for r in out.collect()} == {1: 60, 2: 60, 3: 0, None: 0, 4: 0}
    assert work_folders(spark) == before


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_the_pipeline_leaves_its_last_stage_only(spark):
    before = work_folders(spark)
    out = corpus_pipeline.run(spark, SF)
    left = work_folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-bpe")
    assert out.count() > 0

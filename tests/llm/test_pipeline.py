"""The pipeline against plain versions of its stages."""

import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidewater.llm.bpe import default_path
from tidewater.llm.pii import Finder, redacted

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    docs = {i: x for i, x in zip(t["doc_id"], t["text"], strict=True) if any(c.isalpha() for c in x or "")}
    order = sorted(docs)
    prints = [brute.simhash(docs[i]) for i in order]
    pairs = [(i, j) for i in range(len(order)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    kept = sorted({order[r] for r in brute.components(len(order), pairs)})
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    found = brute.contamination([(i, docs[i]) for i in kept], list(zip(bench["item_id"], bench["text"], strict=True)))
    clean = {i for i, (_, hit, _) in zip(kept, found, strict=True) if not hit}
    mostly = {i for i, (n, hit, _) in zip(kept, found, strict=True) if 2 * len(hit) > n}
    tokenizer, finder = Tokenizer.from_file(default_path()), Finder()

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(kept) - mostly
    assert len(clean) < len(kept)
    for i, r in got.items():
        if i in clean:
            assert r["text"] == redacted(docs[i], finder.spans(docs[i]))
        else:
            assert r["n_chars"] == len(r["text"]) < len(docs[i]) + 20
        assert not brute.pii(r["text"])
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(np.array(ids, "<u4").tobytes()) and r["decoded_sha256"] == brute.sha(r["text"])


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, hit_spans long, ids string"
    rows = [(1, None, None, None, None, "x", 1, "y"), (None, "words of a text without an id", "en", None, 3, None, None, None),
            (2, "", "en", "s", 0, "x", 1, "y"), (2, "again the same row twice", "en", "s", 0, "x", 1, "y"),
            (2, "again the same row twice", "en", "s", 0, "x", 1, "y")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "bpe":
                assert out.columns == docs.columns
            docs = out
        assert docs.count() == (2 if data else 0)


def test_registered():
    names = queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in oracle_sql()
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language", "simhash", "decontamination", "pii", "bpe"]

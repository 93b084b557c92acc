"""The registered queries on the driver's smallest tables, against their
oracle or brute force."""

import os
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidewater.llm.bpe import default_path
from tidewater.llm.registry import ORACLES, QUERIES
from tools.check_oracles import TABLES, digest

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def table(name, *columns):
    t = pq.read_table(f"{SF}/{name}.parquet").to_pydict()
    return list(zip(*(t[c] for c in columns), strict=True))


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, expected = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(expected.columns, expected.fetchall())


def test_embeddings(spark):
    data = table("embeddings", "vec_id", "embedding")
    x = np.array([v for _, v in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    root = brute.components(len(data), zip(*np.nonzero(near), strict=True))
    low = {}
    for r, (i, _) in zip(root, data, strict=True):
        low[r] = min(low.get(r, i), i)
    expected = {(i, int(near[k].sum()), low[root[k]], i == low[root[k]]) for k, (i, _) in enumerate(data)}
    assert {tuple(r) for r in rows(spark, "op2_embeddings")} == expected


def test_simhash(spark):
    data = table("documents", "doc_id", "text")
    prints = [brute.simhash(t) for _, t in data]
    pairs = [(i, j) for i in range(len(data)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root, low = brute.components(len(data), pairs), {}
    for r, (i, _) in zip(root, data, strict=True):
        low[r] = min(low.get(r, i), i)
    expected = {(i, f"{p:016x}", low[r]) for (i, _), p, r in zip(data, prints, root, strict=True)}
    assert {tuple(r) for r in rows(spark, "op3_simhash")} == expected


def test_pii(spark):
    got = {r["doc_id"]: r for r in rows(spark, "op4_pii")}
    data = table("documents", "doc_id", "text")
    assert len(got) == len(data)
    for i, text in data:
        spans = brute.pii(text)
        assert [got[i][f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in spans) for k in brute.KINDS]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[i]["base_sha256"] == brute.sha(listed)
        assert ",".join(x for x in got[i]["spans"].split(",") if x.split(":")[0] in brute.KINDS) == listed


def test_repeats(spark):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op6_repeats")}
    assert got == brute.repeats(table("documents", "doc_id", "text"))
    assert sum(v[1] for v in got.values()) > 0


def test_contamination(spark):
    docs = table("documents", "doc_id", "text")
    found = brute.contamination(docs, table("benchmark", "item_id", "text"))
    expected = {(i, n, len(hit), len(items), brute.sha(",".join(sorted(items))), bool(hit))
                for (i, _), (n, hit, items) in zip(docs, found, strict=True)}
    assert {tuple(r) for r in rows(spark, "op7_decontaminate")} == expected
    assert any(r[5] for r in expected)


def test_sharding(spark):
    got = rows(spark, "op8_interleaved_shards")
    docs = dict(table("documents", "doc_id", "text"))
    sources = dict(table("documents", "doc_id", "source"))
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
    by_shard = {k: [r for r in got if r["shard"] == k] for k in range(40)}
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    for rs in by_shard.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    for source in set(sources.values()):
        share = sum(s == source for s in sources.values()) / 40
        assert all(abs(sum(sources[r["doc_id"]] == source for r in rs) - share) <= 3 for rs in by_shard.values())


def test_language(spark):
    langs = dict(table("documents", "doc_id", "lang"))
    got = rows(spark, "op9_language")
    assert len(got) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and langs[r["doc_id"]]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_bpe(spark):
    tokenizer = Tokenizer.from_file(default_path())
    docs = dict(table("documents", "doc_id", "text"))
    for r in rows(spark, "op10_bpe"):
        ids = tokenizer.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == brute.sha(tokenizer.decode(ids, skip_special_tokens=False))

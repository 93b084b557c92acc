"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import lexical


def terms(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, queries, top):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in queries:
        wanted, scored = set(terms(text)), []
        for d, c, n in counts:
            m = 10 + 90 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


DOCS, QUERIES = "doc_id long, text string, score string, `a.b` int", "item_id long, text string, rank int"


def tables(spark, docs, queries):
    return (spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS),
            spark.createDataFrame([(i, t, 7) for i, t in queries], QUERIES))


@pytest.mark.parametrize("shard_postings", [40, 1 << 20])
@pytest.mark.parametrize("top", [1, 10])
def test_against_scoring_all(spark, shard_postings, top):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["É", "ß9"]
    weights = [1 / (k + 1) for k in range(len(words))]

    def text(n):
        return " ".join(rng.choices(words, weights, k=n))

    docs = [(d, text(rng.choice((0, 1, 3, 20, 200)))) for d in range(200)]
    docs += [(d + 1000, docs[d % 7][1]) for d in range(80)]
    queries = [(q, text(rng.choice((1, 2, 8, 60)))) for q in range(12)]
    a, b = tables(spark, docs, queries)
    assert got(lexical.search(a, b, top, shard_postings=shard_postings)) == plain(docs, queries, top)


def test_odd_rows(spark):
    docs = [(None, "Alpha beta"), (1, None), (2, ""), (3, "-- ,"), (4, "alpha ALPHA alpha"), (4, "alpha ALPHA alpha"),
            (5, "beta " * 200_000), (6, "Éa éa"), (7, "alpha beta"), (8, "alpha beta"), (9, "gamma")]
    queries = [(1, "ALPHA, beta"), (1, "ALPHA, beta"), (2, None), (3, ""), (4, "unknown"), (None, "éa"), (6, "gamma " * 1000)]
    a, b = tables(spark, docs, queries)
    assert got(lexical.search(a, b)) == plain(docs, queries, 10)
    assert got(lexical.search(a, b, query_bytes=2000)) == plain(docs, queries, 10)
    assert got(lexical.search(a.where("false"), b)) == [] and got(lexical.search(a, b.where("false"))) == []


def test_many_intervals(monkeypatch):
    """Newest-first splitting, where many interval ends would be held, is exact too."""
    rng = np.random.default_rng(1)
    rows = [(d, int(rng.integers(1, 400)), np.unique(rng.integers(0, 30, rng.integers(1, 20))).astype(np.int32))
            for d in range(3000)]
    rows = [(d, n, t, rng.integers(1, 9, len(t)).astype(np.int32)) for d, n, t in rows]
    df = Counter(t for _, _, ts, _ in rows for t in ts.tolist())
    statistics = lexical.Statistics(len(rows), sum(n for _, n, _, _ in rows), df)

    def run():
        shard = lexical.Shard(10)
        for row in rows:
            shard.add(*row)
        shard.build(statistics)
        out = []
        for q in range(0, 30, 3):
            best = []
            shard.search(np.arange(q, 30), best)
            out.append(best)
        return out

    expected = []
    for q in range(0, 30, 3):
        scores = [(-sum(int(statistics.weight[t]) * (10 ** 9 * int(f) // (1000 * int(f) + statistics.damping(n)))
                        for t, f in zip(ts.tolist(), fs, strict=True) if t >= q), False, d) for d, n, ts, fs in rows]
        expected.append(sorted(s for s in scores if s[0] < 0)[:10])
    assert run() == expected
    monkeypatch.setattr(lexical, "_CELLS", 100)
    assert run() == expected

"""Sharding and language identification against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import language, sharding


# -- sharding ---------------------------------------------------------------------

def plain_shards(rows, shards, groups):
    """rows: (doc_id, source, size, crc, hash, shift of the source).  The
    seeded order is by the hash's group of equal width, then by the hash."""
    def seeded(h):
        return math.floor(((h % (1 << 64)) >> 11) / (1 << 53) * groups), h

    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    ranked = []
    for own in by_source.values():
        own.sort(key=lambda r: (seeded(r[4]), r[0] is not None, r[0] or 0, r[3], r[2]))
        ranked += [((k + r[5]) / len(own), r[1] is not None, r[1] or "", r[4], r) for k, r in enumerate(own)]
    ranked.sort(key=lambda x: x[:4])
    place = {shard: 0 for shard in range(shards)}
    out = {}
    for k, (*_, r) in enumerate(ranked):
        shard = k * shards // len(ranked)
        out[r[0]] = (r[1], r[2], r[3], shard, place[shard])
        place[shard] += 1
    return out


@pytest.mark.parametrize("group_rows", [7, 100, 5000])
def test_shards_as_a_plain_ranking_gives_them(spark, group_rows):
    rng = random.Random(2)
    rows = [(k, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice(["", "x" * rng.randrange(90), None])) for k in range(700)]
    rows += [(1000 + k, f"tiny{k}", "t") for k in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    text = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(text) + 16).cast("long"), F.crc32(text.cast("binary"))
    known = docs.select("doc_id", "source", size.alias("size"), crc.alias("crc")).select(
        "*", F.xxhash64(F.lit(sharding.SEED), "doc_id", "crc", "size"),
        sharding._unit(F.xxhash64(F.lit(sharding.SEED), "source"))).collect()
    expected = plain_shards([tuple(r) for r in known], 40, -(-len(rows) // group_rows))
    got = {r["doc_id"]: tuple(r)[1:] for r in sharding.interleaved_shards(docs, group_rows=group_rows).collect()}
    assert got == expected


def test_equal_rows_are_spread_over_groups(spark):
    """A third of the rows are one row repeated; no window holds them all."""
    docs = (spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.col("id").cast("string").alias("text"))
            .unionByName(spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"),
                                                  F.lit("same").alias("text"))))
    got = sharding.interleaved_shards(docs, shards=10, group_rows=100).collect()
    assert Counter(r["shard"] for r in got) == {k: 600 for k in range(10)}
    assert all(150 < sum(r["doc_id"] is None for r in got if r["shard"] == k) < 250 for k in range(10))
    rows = docs.select("*", F.lit(0).alias("size"), F.lit(0).alias("text_crc32"),
                       F.xxhash64("doc_id", "text").alias("h"), F.monotonically_increasing_id().alias("row"))
    hashed, counts = sharding._counted(rows, 60)
    assert counts.agg(F.max("n")).first()[0] >= 2000
    spread = sharding._spread(rows, hashed, counts.where("n > 400"), 100)
    assert spread.count() == 6000 and sharding._counted(spread, 60)[1].agg(F.max("n")).first()[0] < 250
    assert spread.where("doc_id is not null").exceptAll(rows.where("doc_id is not null")).count() == 0


# -- language -------------------------------------------------------------------------

def trigrams(text):
    words = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()
    data = (" " + " ".join(words) + " ").encode()
    return Counter(data[k:k + 3] for k in range(len(data) - 2))


def plain_mixture(counts, model, bins):
    """EM by the book over the chosen set of languages, which grows one by one."""
    def probability(lang, gram):
        total = sum(model[lang].values()) + language.SMOOTHING * bins
        return (model[lang].get(gram, 0) + language.SMOOTHING) / total

    table = {g: {k: probability(k, g) for k in model} for g in counts}

    def fit(langs):
        share = {k: 1 / len(langs) for k in langs}
        for _ in range(language.MAX_ROUNDS if len(langs) > 1 else 0):
            new = dict.fromkeys(langs, 0.0)
            for g, n in counts.items():
                whole = sum(share[k] * table[g][k] for k in langs)
                for k in langs:
                    new[k] += n * share[k] * table[g][k] / whole
            new = {k: v / sum(counts.values()) for k, v in new.items()}
            done = max(abs(new[k] - share[k]) for k in langs) < language.TOLERANCE
            share = new
            if done:
                break
        return share, sum(n * math.log(sum(share[k] * table[g][k] for k in langs)) for g, n in counts.items())

    worth = language.PENALTY + language.PENALTY_PER_TRIGRAM * sum(counts.values())
    best = max(sorted(model), key=lambda k: fit([k])[1])
    share, likelihood = fit([best])
    everything, most = fit(sorted(model))
    if most - likelihood > worth:
        for k in sorted(everything, key=lambda k: -everything[k]):
            if k not in share and most - likelihood > worth:
                tried, value = fit([*share, k])
                if value - likelihood > worth:
                    share, likelihood = tried, value
    if -sum(counts.values()) * math.log(bins) - likelihood > worth:
        return {}
    return share


def test_mixtures_as_plain_em_gives_them(spark):
    rng = random.Random(5)
    words = {"aa": "the and of with that have this from".split(), "bb": "der und die mit dass haben dies von".split(),
             "cc": "le et de avec que ont ce depuis".split()}

    def text(*langs):
        return " ".join(rng.choice(words[x]) for x in langs for _ in range(40))

    labelled = [(k, text(x), x) for k, x in enumerate(("aa", "bb", "cc") * 12)]
    docs = [(100, text("aa")), (101, text("bb", "cc")), (102, text("aa", "bb", "cc")), (103, "zzqq xxvv"), (104, "der")]
    train = spark.createDataFrame(labelled, "doc_id long, text string, lang string")
    frame = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(frame, train).collect()}
    model = {}
    for _, t, lang in labelled:
        model.setdefault(lang, Counter()).update(trigrams(t))
    for i, t in docs:
        expected = plain_mixture(trigrams(t), model, language.BINS)
        shares = {x["lang"]: x["share"] for x in got[i]["languages"]}
        assert set(shares) == set(expected), (i, shares, expected)
        assert all(abs(shares[k] - expected[k]) < 0.01 for k in expected)
        if expected:
            assert got[i]["lang_pred"] == max(expected, key=expected.get)
            assert abs(got[i]["score"] - max(expected.values())) < 0.01
        else:
            assert got[i]["lang_pred"] == "und"
    assert {len(plain_mixture(trigrams(t), model, language.BINS)) for _, t in docs} >= {1, 2, 3}


def test_a_table_of_many_labels_has_a_bounded_model(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 5)
    rows = [(k, f"word{chr(97 + k % 20) * 4} text", f"l{k % 20:02}") for k in range(200)] + [(900 + k, "usual words", "zz") for k in range(30)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["l00", "l01", "l02", "l03", "zz"] and model.p.shape == (language.BINS, 5)
    assert isinstance(model.p, np.ndarray)

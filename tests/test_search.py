"""Search expressions against a plain evaluation."""

import random
import re

import pytest

from tidewater.functions.search import search_condition

ROWS = [(i, f"k{i % 4}" if i % 5 else None, ("red apple", "red", "a*b", "a(b", 'say "x"', "É")[i % 6], i * 1.5 if i % 3 else None)
        for i in range(60)]
SCHEMA = "id int, kind string, note string, `price.x` double"
COLUMNS = ["id", "kind", "note", "price.x"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def ids(docs, text, default="AND"):
    return {r["id"] for r in docs.where(search_condition(docs, text, default)).collect()}


def plain(test):
    return {r[0] for r in ROWS if test(*r)}


@pytest.mark.parametrize("text,test", [
    ("", lambda i, k, n, p: True),
    ("*:*", lambda i, k, n, p: True),
    ("kind:k1 OR id:2 AND note:red", lambda i, k, n, p: k == "k1" or (i == 2 and n == "red")),
    ("(kind:k1 OR id:2) AND NOT note:red", lambda i, k, n, p: (k == "k1" or i == 2) and n != "red"),
    ("kind:(k1 OR k2) -note:red", lambda i, k, n, p: k in ("k1", "k2") and n != "red"),
    ("kind:(NOT k1)", lambda i, k, n, p: k != "k1"),
    ("NOT kind:*", lambda i, k, n, p: k is None),
    ("!kind:k1 && id:[* TO 30}", lambda i, k, n, p: k != "k1" and i < 30),
    ("id:{10 TO 12] || id:[50 TO *]", lambda i, k, n, p: 10 < i <= 12 or i >= 50),
    ("price.x:[-3 TO 7.5]", lambda i, k, n, p: p is not None and -3 <= p <= 7.5),
    ("kind:[k1 TO k2]", lambda i, k, n, p: k is not None and "k1" <= k <= "k2"),
    ("note:red*", lambda i, k, n, p: n.startswith("red")),
    ("note:r?d", lambda i, k, n, p: re.fullmatch("r.d", n)),
    (r"note:a\*b", lambda i, k, n, p: n == "a*b"),
    (r"note:a\(?", lambda i, k, n, p: re.fullmatch(r"a\(.", n)),
    ('note:"red apple" OR note:"say \\"x\\""', lambda i, k, n, p: n in ("red apple", 'say "x"')),
    ("note:É", lambda i, k, n, p: n == "É"),
    ("+kind:k1 +(id:1 OR id:13)", lambda i, k, n, p: k == "k1" and i in (1, 13)),
    ("--kind:k1", lambda i, k, n, p: k == "k1"),
    ("id:(3 OR [5 TO 6])", lambda i, k, n, p: i in (3, 5, 6)),
])
def test_expressions(docs, text, test):
    assert ids(docs, text) == plain(lambda *r: bool(test(*r)))


def test_terms_side_by_side(docs):
    assert ids(docs, "kind:k1 id:2", "OR") == plain(lambda i, k, n, p: k == "k1" or i == 2)
    assert ids(docs, "kind:k1 id:2") == set()
    assert ids(docs, "kind:k1 note:red AND id:1", "OR") == plain(lambda i, k, n, p: k == "k1" or (n == "red" and i == 1))


def test_random_trees(docs):
    rng = random.Random(4)

    def tree(depth):
        if not depth or rng.random() < 0.2:
            kind = rng.randrange(4)
            if kind == 0:
                v = f"k{rng.randrange(5)}"
                return f"kind:{v}", lambda r: r[1] == v
            if kind == 1:
                a, b = sorted(rng.sample(range(60), 2))
                return f"id:[{a} TO {b}}}", lambda r: a <= r[0] < b
            if kind == 2:
                return "note:*e*", lambda r: "e" in r[2]
            return "price.x:*", lambda r: r[3] is not None
        (s, f), (t, g) = tree(depth - 1), tree(depth - 1)
        kind = rng.randrange(3)
        if kind == 0:
            return f"({s} {rng.choice(('AND', '&&', ''))} {t})", lambda r: f(r) and g(r)
        if kind == 1:
            return f"({s} {rng.choice(('OR', '||'))} {t})", lambda r: f(r) or g(r)
        return f"{rng.choice(('NOT ', '-', '!'))}({s})", lambda r: not f(r)

    for _ in range(25):
        text, test = tree(4)
        assert ids(docs, text) == {r[0] for r in ROWS if test(r)}, text


def test_wrong_words(docs):
    with pytest.raises(ValueError):
        search_condition(docs, "id:1", "XOR")
    for text in ("id:1 ~", "a:b:c", "id:1 OR OR id:2", "TO", "id:TO", "()"):
        with pytest.raises(ValueError):
            search_condition(docs, text)

"""Language identification as inference of a mixture of languages.

A text's byte trigrams are taken as drawn from a mixture of the languages'
trigram distributions.  Expectation-maximisation estimates the proportions; a
further language is only let in if it raises the log-likelihood by more than
a penalty, and the language with the largest proportion is the prediction.
A text that this mixture makes less likely, by more than the same penalty, than
if all trigram bins were equally likely is explained by no learned language: it
is undetermined.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, kept_in_worker, read_table, set_aside

#: Trigrams are hashed to so many bins; the model has languages x bins numbers.
BINS = 1 << 16
#: Labelled rows that the model is fitted on, for each language, about: rows
#: are taken by a hash of id and text, so that their number stays bounded.
TRAIN_ROWS = 2_000
#: Languages that a model knows at most, those with the most labelled rows: it
#: bounds the broadcast to 128 MB, whatever labels a table holds.
MOST_LANGUAGES = 256
SMOOTHING = 0.05
MAX_ROUNDS, TOLERANCE = 40, 1e-4
#: Log-likelihood that a further language must add: this much, and this much
#: for each trigram of the text.
PENALTY, PENALTY_PER_TRIGRAM = 3.0, 0.02
UNDETERMINED = "und"

_CHUNK = 1 << 20
# ASCII bytes other than letters become blanks; bytes of other characters stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")
_OTHER_CHARACTER = re.compile("[^\x00-\x7f]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text))
                           or any(m.group().isalpha() for m in _OTHER_CHARACTER.finditer(text)))


def trigram_counts(text: str, bins: int = BINS) -> np.ndarray:
    """Counts by bin of the byte trigrams of the lower-cased words, with a
    blank before and after each word."""
    counts = np.zeros(bins, np.int64)
    for start in range(0, len(text), _CHUNK):
        data = text[max(0, start - 1):start + _CHUNK].lower().encode()
        words = b" ".join(data.translate(_LETTERS).split())
        codes = np.frombuffer(b" " + words + b" ", np.uint8).astype(np.uint32)
        codes = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
        counts += np.bincount(((codes * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(bins), minlength=bins)
    return counts


class Mixture:
    """Proportions of languages in texts; ``p`` holds the probability of each
    trigram bin (row) in each language (column)."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray) -> Mixture:
        smooth = counts + SMOOTHING
        return cls(languages, np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T))

    @staticmethod
    def _fit(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log-likelihood for trigrams with probabilities ``p``
        (trigram x language) that occur ``n`` times."""
        share, total = np.full(p.shape[1], 1 / p.shape[1]), n.sum()
        for _ in range(MAX_ROUNDS if p.shape[1] > 1 else 0):
            before = share
            share = before * ((n / (p @ before)) @ p) / total
            if np.abs(share - before).max() < TOLERANCE:
                break
        return share, float(n @ np.log(p @ share))

    def infer(self, text: str) -> dict[str, float]:
        """Proportions of the chosen set of languages, summing to one; none if
        equally likely trigram bins explain the text better by the penalty."""
        counts = trigram_counts(text, len(self.p))
        bins = np.flatnonzero(counts)
        n, p = counts[bins].astype(np.float64), self.p[bins]
        worth = PENALTY + PENALTY_PER_TRIGRAM * n.sum()
        single = n @ np.log(p)
        chosen = [int(single.argmax())]
        share, best = np.ones(1), float(single.max())
        if len(self.languages) > 1:
            everything, most = self._fit(p, n)
            # No set can gain more over the best single language than all together.
            for candidate in np.argsort(-everything, kind="stable").tolist() if most - best > worth else ():
                if candidate in chosen or most - best <= worth:
                    continue
                tried, likelihood = self._fit(p[:, [*chosen, candidate]], n)
                if likelihood - best > worth:
                    chosen, share, best = [*chosen, candidate], tried, likelihood
        if -n.sum() * np.log(len(self.p)) - best > worth:
            return {}
        return {self.languages[k]: float(s) for k, s in zip(chosen, share, strict=True)}


def _make_counts():
    def compute(lang, text):
        counts = trigram_counts(text)
        bins = np.flatnonzero(counts)
        return bins.tolist(), counts[bins].tolist()

    return compute


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Mixture | None:
    """A mixture model of the non-null ``lang`` values of ``labelled`` (doc_id,
    text, lang), fitted on about ``rows`` rows for each at most, of the
    :data:`MOST_LANGUAGES` most frequent ones (of equals, the first by name).
    None if no row has both a language and a letter.  What reaches the driver is
    one count for each language and trigram bin."""
    usable = labelled.select("doc_id", "lang", "text").where("lang is not null and text rlike '\\\\p{L}'")
    sizes = {r["lang"]: r["count"] for r in labelled.where("lang is not null").groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()}
    if not sizes:
        return None
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(9), "doc_id", "text"), 11).cast("double") / float(1 << 53)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in sorted(sizes.items()) for x in (k, min(1.0, rows / v))]),
                        F.col("lang"))
    counted = add_columns(usable.where(F.col("lang").isin(list(sizes)) & (chance < rate)), ["lang", "text"],
                          "bins array<int>, counts array<long>", _make_counts)
    model = (counted.select("lang", F.explode(F.arrays_zip("bins", "counts")).alias("x"))
             .groupBy("lang", "x.bins").agg(F.sum("x.counts").alias("n")).toPandas())
    languages = sorted(set(model["lang"]))
    if not languages:
        return None
    counts = np.zeros((len(languages), BINS))
    counts[[languages.index(x) for x in model["lang"]], model["bins"]] = model["n"]
    return Mixture.of_counts(languages, counts)


def _make_infer(shared):
    languages, data = shared.value
    key = hashlib.sha256(repr(languages).encode() + data).digest()
    model = kept_in_worker(("mixture", key), lambda: Mixture(languages, np.frombuffer(data).reshape(-1, len(languages))))

    def compute(text):
        if not has_letter(text):
            return UNDETERMINED, 0.0, []
        shares = model.infer(text)
        if not shares:
            return UNDETERMINED, 0.0, []
        lang = max(shares, key=lambda k: (shares[k], k))
        return lang, min(1.0, shares[lang]), [{"lang": k, "share": v} for k, v in sorted(shares.items())]

    return compute


def identify(docs: DataFrame, labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with ``lang_pred`` string, ``score`` double (the predicted
    language's proportion, 0 to 1) and ``languages`` array<struct<lang, share>>
    (the chosen set), from ``text`` alone by a model fitted on ``labelled``.

    Null texts, texts without a letter and texts that no learned language
    explains (their trigrams are less likely under the chosen set, by more
    than the penalty, than if all bins were equally likely), and all texts if there is nothing to learn from,
    are ``und`` with score 0 and no languages.  Rows pass as they
    are; columns named like a new one are replaced.  The model (512 KB a
    language, of which there are :data:`MOST_LANGUAGES` at most) is broadcast;
    documents are not shuffled.
    """
    return _identify(docs, train(labelled, train_rows))


def _identify(docs: DataFrame, model: Mixture | None) -> DataFrame:
    fields = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    if model is None:
        return docs.drop("lang_pred", "score", "languages").withColumns({
            "lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0),
            "languages": F.array().cast("array<struct<lang: string, share: double>>")})
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.p.tobytes()))
    return add_columns(docs, ["text"], fields, _make_infer, shared)


def held_out():
    """True for the documents that the model must not learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~F.coalesce(held_out(), F.lit(True)))


def identify_documents(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """:func:`identify` on ``docs``, learning from those of its own rows that
    have a language and are not held out.  Rows with a null id are held out."""
    return identify(docs, _learnable(docs), train_rows)


def keep_identified(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` (same columns) without the documents whose language cannot be
    told: null texts, texts without a letter and texts that no learned
    language explains (see :func:`identify`).  If there is nothing to learn
    from, all texts with a letter stay."""
    model = train(_learnable(docs), train_rows)
    if model is None:
        return docs.where("text rlike '\\\\p{L}'")
    free, own = set_aside(docs, "text")
    return own(_identify(free, model).where(F.col("lang_pred") != UNDETERMINED))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_documents(docs).select(
        "doc_id", F.coalesce(held_out(), F.lit(True)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language": op9_language}
ORACLES: dict[str, str] = {}

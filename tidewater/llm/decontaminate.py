"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items is small; training texts are
streamed through it word by word.  At each word it knows the longest suffix of
the text so far that occurs inside some item, so every stretch that shares a
window of words with an item is found in one pass, whatever its length.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, kept_in_worker, read_table, set_aside

#: Words of a window: shared stretches of at least this many words are hit.
WINDOW = 10
#: In :func:`decontaminate`, documents with a larger share of hit words go.
MAX_COVERAGE = 0.5
#: Bytes of item texts that one automaton is built from (some 100 bytes of
#: memory for each); larger benchmarks take several.
ITEM_BYTES = 4 << 20
#: Bytes of documents that a task holds while they pass through several automata.
HELD_BYTES = 128 << 20

_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
#: UTF-8 bytes to word bytes: A-Z lower-cased, separators to blanks.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_CHUNK = 1 << 20


class Automaton:
    """Suffix automaton of several word sequences; matches never span two."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]))
        for _, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        #: Names of the items a state's strings occur in, for strings of a window's length.
        self.holders: list[set[str]] = [set() for _ in self.next]
        #: For states that hold a whole short item: its (words, name).
        self.whole: dict[int, set[tuple[int, str]]] = {}
        for name, word_ids in coded:
            state = 0
            for w in word_ids:
                state = self.next[state][w]
                at = state
                while at > 0 and self.length[at] >= window and name not in self.holders[at]:
                    self.holders[at].add(name)
                    at = self.link[at]
            if len(word_ids) < window:
                self.whole.setdefault(state, set()).add((len(word_ids), name))
        self.shortest = min([window, *(len(ids) for _, ids in coded)])

    def _new(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """The state of ``parent``'s strings plus ``word``, apart from longer ones."""
        clone = self._new(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: int) -> int:
        child = self.next[last].get(word)
        if child is not None:  # an earlier item has this string
            return child if self.length[child] == self.length[last] + 1 else self._split(last, word, child)
        state, at = self._new(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            child = self.next[at][word]
            self.link[state] = child if self.length[child] == self.length[at] + 1 else self._split(at, word, child)
        return state


class Scanner:
    """Streams texts through an automaton."""

    def __init__(self, automaton: Automaton):
        self.a = automaton

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """The number of words, the hit word ranges (sorted, disjoint, end
        exclusive) and the names of items with an occurring window."""
        a, count, state, length = self.a, 0, 0, 0
        spans: list[list[int]] = []
        found: set[str] = set()
        if not text:
            return 0, [], found
        for words in _word_chunks(text):
            ids = np.fromiter(map(a.vocabulary.get, words, _ZEROS), np.int64, len(words))
            # Only runs of known words can match; a run inside the chunk must be long enough.
            known = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0]))))
            for start, end in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
                if start:
                    state = length = 0
                if end - start >= a.shortest or start == 0 or end == len(words):
                    state, length = self._run(ids[start:end].tolist(), count + start, state, length, spans, found)
            if len(ids) and not ids[-1]:
                state = length = 0
            count += len(words)
        return count, [(s, e) for s, e in spans], found

    def _run(self, ids, first, state, length, spans, found):
        a = self.a
        following, link, lengths, window, whole = a.next, a.link, a.length, a.window, a.whole
        for i, w in enumerate(ids, first):
            while state and w not in following[state]:
                state = link[state]
                length = lengths[state]
            if w not in following[state]:
                continue
            state = following[state][w]
            length += 1
            hit = 0
            if length >= window:
                hit, at = length, state
                while lengths[link[at]] >= window:
                    at = link[at]
                found |= a.holders[at]
            if whole:
                at = state
                while at > 0:
                    for words, name in whole.get(at, ()):
                        if words <= length:
                            found.add(name)
                            hit = max(hit, words)
                    at = link[at]
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return state, length


class _Zeros:
    def __iter__(self):
        return self

    def __next__(self):
        return 0


_ZEROS = _Zeros()


def _word_chunks(text: str):
    """Lists of normalised words, some megabyte of text at a time."""
    data = text.encode()
    at = 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        piece = data[at:end].translate(_NORMAL)
        if end < len(data) and not piece.endswith(b" "):
            # end at a separator: after the last one here, else before the next one
            cut = piece.rfind(b" ") + 1
            while not cut and end < len(data):
                more = data[end:end + _CHUNK].translate(_NORMAL)
                stop = more.find(b" ")
                piece += more if stop < 0 else more[:stop]
                end += len(more) if stop < 0 else stop
                if stop >= 0:
                    break
            if cut:
                piece, end = piece[:cut], at + cut
        yield piece.split()
        at = end


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def _scanner(items: list[tuple[str, str]], window: int) -> Scanner:
    """One automaton is kept in each worker process."""
    key = hashlib.sha256(repr((items, window)).encode()).digest()
    return kept_in_worker(("items", key), lambda: Scanner(Automaton(
        [(name, normal_words(text)) for name, text in items], window)))


def _make(items, window, cut):
    scanner = _scanner(items.value, window)

    def compute(text):
        return _row(text, [scanner.scan(text)], cut)

    return compute


def _make_in_turn(blocks, window, cut):
    """For item texts that take several automata: texts are held, and pass
    through one automaton after the other."""

    def compute(rows):
        scans = [[] for _ in rows]
        for items in blocks:
            scanner = _scanner(items.value, window)
            for (text,), found in zip(rows, scans, strict=True):
                found.append(scanner.scan(text))
        return [_row(text, found, cut) for (text,), found in zip(rows, scans, strict=True)]

    return compute


def _row(text, scans, cut):
    """Words, merged spans, item names (and the text without the spans)."""
    spans = scans[0][1] if len(scans) == 1 else merge_spans(s for _, spans, _ in scans for s in spans)
    row = (scans[0][0], [{"start": s, "end": e} for s, e in spans], sorted(set().union(*(names for _, _, names in scans))))
    return (*row, _cut(text, spans) if spans else text) if cut else row


def merge_spans(spans):
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_SPANS = "array<struct<start: int, end: int>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       item_bytes: int = ITEM_BYTES, cut: bool = False, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` long, ``hit_spans`` (word ranges inside
    occurrences of a window, disjoint, end exclusive) and ``hit_items``
    (item_ids, as strings, that have a window there).

    Words are runs of characters other than ASCII non-alphanumerics, A-Z
    lower-cased.  A window is ``window`` consecutive words of an item; an item
    of fewer words, but not none, is one window.  Null and empty texts have
    no words; null and empty items have no window; a null item_id is written
    as an empty string.  Rows pass as they are, repeated ones too; columns of
    ``docs`` named like a new one are replaced.

    With ``cut`` the hit words are also cut out of ``text``.

    The items, whose total bytes are counted first, are broadcast in blocks of
    some ``item_bytes``, an automaton for each.  Texts are read once, whatever
    the number of blocks: where there are several, a task holds ``held_bytes``
    of texts while they pass through the automata in turn, so that building
    those is little beside the scans.  Documents are never shuffled or staged.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
                             F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // item_bytes))
    blocks = []
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k).collect()
        blocks.append(spark.sparkContext.broadcast(sorted((r["name"], r["text"]) for r in part)))
    fields = f"n_words long, hit_spans {_SPANS}, hit_items array<string>" + ", text string" * cut
    if count == 1:
        return add_columns(docs, ["text"], fields, _make, blocks[0], window, cut)
    return add_columns(docs, ["text"], fields, _make_in_turn, blocks, window, cut, held_bytes=held_bytes)


def _hit_words():
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _cut(text, spans):
    """``text`` without the words of the given ranges; one blank stands in for each."""
    out, at, ranges = [], 0, iter(spans)
    start, end = next(ranges)
    for i, word in enumerate(_WORD.finditer(text)):
        if i == start:
            out.append(text[at:word.start()])
        if i == end - 1:
            at = word.end()
            start, end = next(ranges, (-1, -1))
            if end < 0:
                break
    return " ".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` (same columns) without benchmark passages: hit spans are cut
    from the texts, and documents of which more than ``max_coverage`` of the
    words are hit are dropped.  ``n_chars``, where there is one, follows the text.
    Documents without a hit come back as they were."""
    free, own = set_aside(docs, "text", "n_chars")
    found = find_contamination(free, benchmark, window, cut=True)
    cut = found.where(_hit_words() <= F.col("n_words") * F.lit(max_coverage))
    if "n_chars" in docs.columns:
        changed = F.size("hit_spans") > 0
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return own(cut)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", _hit_words().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"))


QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLES: dict[str, str] = {}

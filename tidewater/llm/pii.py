"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, ``://``, plus signs
before digits, digits before dots, digit pairs and words that announce an
identifier.  A small parser for each kind then expands from the anchor to the
boundaries of the address, number or account and validates it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, read_table, set_aside

#: All kinds, in the order in which spans with one start are listed; the
#: first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE = KINDS[:4]
#: Words that announce an identifier, matched in lower, upper and title case.
CUES = ("account", "acct", "api_key", "api key", "apikey", "iban", "passport", "passwd", "password", "secret", "ssn",
        "token")
#: Identifiers that announce themselves: prefix, then this many capitals or digits.
PREFIXED = {"AKIA": 16}

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_REST = re.compile(r"[ ().0-9-]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_USERINFO = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[^\s/?#@]+")
_ANNOUNCED = r"(?:[ \t]*+[:=#][ \t]*+|[ \t]++(?:number|no\.?|id|is)[ \t]*+[:=#]?[ \t]*+|[ \t]++)[\"']?"
_IDENTIFIER = re.compile(_ANNOUNCED + r"([A-Za-z0-9][A-Za-z0-9_-]{5,})")
_IBAN = re.compile(_ANNOUNCED + r"([A-Z]{2}[0-9]{2}(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,3})?(?![A-Za-z0-9]))")
_WORD = re.compile(r"\w")


def _anchors() -> ahocorasick.Automaton:
    found: dict[str, str] = {"@": "email", "://": "login"}
    for d in _DIGITS:
        found[f"{d}."] = "ip"
        found[f"+{d}"] = "phone"
        for e in _DIGITS:
            found |= {f"{d}{e}": "card", f"{d} {e}": "card", f"{d}-{e}": "card"}
    for cue in CUES:
        found |= {form: "cue" for form in (cue, cue.upper(), cue.title(), cue.capitalize())}
    found |= {prefix: "prefixed" for prefix in PREFIXED}
    automaton = ahocorasick.Automaton()
    for text, kind in found.items():
        automaton.add_word(text, (kind, len(text)))
    automaton.make_automaton()
    return automaton


def _luhn(number: str) -> bool:
    digits = [int(c) for c in reversed(number)]
    return sum(digits[::2] + [d * 2 - 9 * (d > 4) for d in digits[1::2]]) % 10 == 0


def _iban_end(groups: str) -> int | None:
    """Where the longest run of whole groups ends that is an IBAN by its
    check number (ISO 7064, mod 97)."""
    ends = [len(groups), *(m.start() for m in re.finditer("[ -]", groups))]
    for end in sorted(ends, reverse=True):
        number = re.sub("[ -]", "", groups[:end])
        if len(number) >= 12 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return end
    return None


class Finder:
    """Spans (kind, start, end) of a text, in code points, end exclusive."""

    def __init__(self):
        self.anchors = _anchors()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        places: dict[str, list[int]] = {}
        for end, (kind, length) in self.anchors.iter(text):
            places.setdefault(kind, []).append(end - length + 1 if kind not in ("cue", "prefixed") else end + 1)
        out = []
        for kind, parser in (("email", self._emails), ("ip", self._ips), ("card", self._cards),
                             ("phone", self._phones), ("login", self._logins), ("cue", self._accounts),
                             ("prefixed", self._prefixed)):
            if kind in places:
                out += [(kind if kind in KINDS else "account", s, e) for s, e in parser(text, places[kind])]
        order = {k: i for i, k in enumerate(KINDS)}
        return sorted(set(out), key=lambda x: (x[1], order[x[0]], x[2]))

    # Base kinds: matches are taken leftmost and do not overlap; a match that
    # fails its check is dropped but has used up its characters.
    @staticmethod
    def _emails(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        used = 0
        for at in places:
            start = at
            while start > used and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (match := _DOMAIN.match(text, at + 1)):
                used = match.end()
                yield start, used

    @staticmethod
    def _ips(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        used = 0
        for at in places:
            if at < used:
                continue
            start = at
            while start > used and text[start - 1] in _DIGITS:
                start -= 1
            if match := _QUAD.match(text, start):
                used = match.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.group().split(".")):
                    yield start, used

    @staticmethod
    def _cards(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        used = 0
        for at in places:
            if at < used:
                continue
            match = _GROUPED.match(text, at)
            used = match.end()
            number = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(number) <= 19 and _luhn(number):
                yield at, used

    @staticmethod
    def _phones(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        for at in places:
            rest = _PHONE_REST.match(text, at + 2)
            if not rest:
                continue
            end = rest.end()
            while end > at + 3 and text[end - 1] not in _DIGITS:
                end -= 1
            if end > at + 3 and 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                yield at, end

    # Kinds that the anchors add.
    @staticmethod
    def _logins(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        """Urls that carry a user's name and password."""
        for at in places:
            match = _USERINFO.match(text, at + 3)
            if not match:
                continue
            start = at
            while start and text[start - 1] in _SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():  # a scheme begins with a letter
                start += 1
            if start < at:
                yield start, match.end()

    @staticmethod
    def _accounts(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        """Identifiers after a cue, which a blank may part from it: six
        characters at least, one a digit; and IBANs in groups of four."""
        for at in places:
            match = _IBAN.match(text, at)
            if match and (end := _iban_end(match.group(1))):
                yield match.start(1), match.start(1) + end
                continue
            match = _IDENTIFIER.match(text, at)
            if match and any(c in _DIGITS for c in match.group(1)):
                yield match.span(1)

    @staticmethod
    def _prefixed(text: str, places: list[int]) -> Iterator[tuple[int, int]]:
        for at in places:
            for prefix, length in PREFIXED.items():
                start, end = at - len(prefix), at + length
                if (text.startswith(prefix, max(start, 0)) and re.fullmatch("[A-Z0-9]+", tail := text[at:end])
                        and len(tail) == length and not _WORD.match(text[start - 1:start])
                        and not _WORD.match(text[end:end + 1])):
                    yield start, end


def _make_find():
    finder = Finder()
    return lambda text: ([{"kind": k, "start": s, "end": e} for k, s, e in finder.spans(text)] if text else [],)


def _make_digests():
    finder = Finder()

    def compute(text):
        spans = finder.spans(text) if text else []
        listed = [f"{k}:{s}:{e}" for k, s, e in spans]
        base = ",".join(x for x, (k, _, _) in zip(listed, spans, strict=True) if k in BASE)
        counts = [sum(k == kind for k, _, _ in spans) for kind in BASE]
        return *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(listed)

    return compute


def redacted(text: str, spans) -> str:
    """``text`` with ``[KIND]`` for each span; overlapping spans become one,
    named after the first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _make_redact():
    finder = Finder()
    return lambda text: (redacted(text, finder.spans(text)) if text else text,)


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii`` array<struct<kind, start, end>>: all personal data
    in ``text``, by start, then kind as in :data:`KINDS`; code points, end
    exclusive.  Null and empty texts have none.  Rows pass as they are; a
    column of that name is replaced.  No shuffle."""
    return add_columns(docs, ["text"], "pii array<struct<kind: string, start: int, end: int>>", _make_find)


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns) with ``[EMAIL]`` and the like in place of
    personal data in ``text``; ``n_chars``, where there is one, follows the
    texts that change.  Null texts stay null, texts without any stay as they are."""
    free, own = set_aside(docs, "text", "n_chars")
    out = add_columns(free.withColumn("before", F.length("text")), ["text"], "text string", _make_redact)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.length("text") != F.col("before"), F.length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return own(out)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return add_columns(docs, ["text"], ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string",
                       _make_digests).drop("text")


QUERIES = {"op4_pii": op4_pii}
ORACLES: dict[str, str] = {}

"""Search expressions of collection lines as Spark conditions.

``field:value`` terms, joined by ``AND``, ``OR`` (``&&``, ``||``), negated by
``NOT``, ``-`` or ``!``, grouped by parentheses, also for one field:
``field:(a OR b)``.  Values are words with ``*`` and ``?`` as wildcards (a
backslash takes the next character as it is), phrases in double quotes (the
whole value), or ranges ``[low TO high]``, braces for ends that do not count,
``*`` for an open end.  ``*:*`` is everything, ``field:*`` any value.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

_TOKEN = re.compile(r"""\s*(?:
    (?P<mark>&&|\|\||[()!:+\[\]{}]|-(?=\S))
  | "(?P<phrase>(?:[^"\\]|\\.)*)"
  | (?P<word>(?:[^\s"()\[\]{}:^~\\&|!]|\\.|&(?!&)|\|(?!\|))+)
)""", re.X | re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_JOINERS = {"AND", "OR", "NOT", "&&", "||", "TO"}


def search_condition(df: DataFrame, text: str, default: str = "AND") -> Column:
    """The condition that ``text`` sets on the rows of ``df``.  Terms side by
    side are joined by ``default``.  Raises a ValueError for anything that is
    not understood as a whole, and for a field that ``df`` does not have."""
    if default not in ("AND", "OR"):
        raise ValueError(f"terms cannot be joined by {default!r}")
    return _Reader(df, text, default).whole()


def _tokens(text: str):
    """(kind, text) of each token; words keep their backslashes."""
    at = 0
    while text[at:].strip():
        match = _TOKEN.match(text, at)
        if not match:
            raise ValueError(f"query not understood at {text[at:].strip()!r}: {text!r}")
        yield match.lastgroup, match.group(match.lastgroup)
        at = match.end()


class _Reader:
    """Reads one expression, each method one kind of part."""

    def __init__(self, df: DataFrame, text: str, default: str):
        self.df, self.text, self.default = df, text, default
        self.left = list(_tokens(text))[::-1]

    def _next(self, *wanted: str) -> str | None:
        """Take the next mark or joining word if it is one of ``wanted``."""
        if self.left and self.left[-1][0] != "phrase" and self.left[-1][1] in wanted:
            return self.left.pop()[1]
        return None

    def _wrong(self):
        rest = " ".join(t for _, t in reversed(self.left))
        return ValueError(f"query not understood at {rest!r}: {self.text!r}")

    def whole(self) -> Column:
        condition = self._either(self._term) if self.left else F.lit(True)
        if self.left:
            raise self._wrong()
        return condition

    def _either(self, item: Callable[[], Column]) -> Column:
        out = self._both(item)
        while self._next("OR", "||") or (self.default == "OR" and self._more()):
            out = out | self._both(item)
        return out

    def _both(self, item: Callable[[], Column]) -> Column:
        out = self._not(item)
        while self._next("AND", "&&") or (self.default == "AND" and self._more()):
            out = out & self._not(item)
        return out

    def _more(self) -> bool:
        return bool(self.left) and self.left[-1][1] not in (")", "]", "}", ":", "OR", "||", "AND", "&&")

    def _not(self, item: Callable[[], Column]) -> Column:
        if self._next("NOT", "-", "!"):
            return ~self._not(item)
        self._next("+")
        if self._next("("):
            out = self._either(item)
            if not self._next(")"):
                raise self._wrong()
            return out
        return item()

    def _word(self) -> str:
        if not self.left or self.left[-1][0] != "word" or self.left[-1][1] in _JOINERS:
            raise self._wrong()
        return self.left.pop()[1]

    def _term(self) -> Column:
        name = self._word()
        if not self._next(":"):
            self.left.append(("word", name))
            raise self._wrong()
        if name == "*":
            if self._word() != "*":
                raise self._wrong()
            return F.lit(True)
        name = _ESCAPED.sub(r"\1", name)
        if name not in self.df.columns:
            raise ValueError(f"no field {name!r}: {self.text!r}")
        column, kind = F.col(f"`{name}`"), self.df.schema[name].dataType

        def value() -> Column:
            # no value, no hit, and so a hit for the negation
            return F.coalesce(self._value(column, kind), F.lit(False))

        return self._not(value)

    def _value(self, column: Column, kind: DataType) -> Column:
        if start := self._next("[", "{"):
            low, _, high = self._end(), self._to(), self._end()
            end = self._next("]", "}")
            if not end:
                raise self._wrong()
            out = column.isNotNull()
            if low is not None:
                out = out & (column >= self._typed(low, kind) if start == "[" else column > self._typed(low, kind))
            if high is not None:
                out = out & (column <= self._typed(high, kind) if end == "]" else column < self._typed(high, kind))
            return out
        if self.left and self.left[-1][0] == "phrase":
            return column.cast("string") == F.lit(_ESCAPED.sub(r"\1", self.left.pop()[1]))
        word = self._word()
        if word == "*":
            return column.isNotNull()
        if re.search(r"\A/|(?<!\\)[<>]", word):  # patterns and comparisons are other languages' values
            raise ValueError(f"value not understood: {word!r} in {self.text!r}")
        if re.search(r"(?<!\\)(?:\\\\)*[*?]", word):
            parts = re.findall(r"\\.|.", word, re.S)
            pattern = "".join({"*": ".*", "?": "."}.get(p) or _quoted(p[-1]) for p in parts)
            return column.cast("string").rlike(rf"(?s)\A{pattern}\z")
        return column.cast("string") == F.lit(_ESCAPED.sub(r"\1", word))

    def _end(self) -> str | None:
        """An end of a range; None if it is open."""
        if self.left and self.left[-1][0] == "phrase":
            return _ESCAPED.sub(r"\1", self.left.pop()[1])
        sign = "-" if self._next("-") else ""
        word = self._word()
        return None if word == "*" and not sign else sign + _ESCAPED.sub(r"\1", word)

    def _to(self) -> None:
        if not self._next("TO"):
            raise self._wrong()

    def _typed(self, value: str, kind: DataType) -> Column:
        """A range's end in the column's type."""
        literal = F.lit(value) if isinstance(kind, StringType) else F.lit(value).try_cast(kind)
        if self.df.sparkSession.range(1).select(literal.isNull().alias("n")).first()["n"]:
            raise ValueError(f"{value!r} is no {kind.simpleString()}: {self.text!r}")
        return literal


def _quoted(character: str) -> str:
    return character if character.isalnum() else f"\\x{{{ord(character):X}}}"

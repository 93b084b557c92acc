"""Caller SQL over RAW views: the user's slots, and one plan for all batches.

A transform sees the lines of one batch.  SQL that handles ``_batch_id`` itself
runs as it is over the lines of many batches.  SQL that does not know of
batches runs inside a lateral subquery, once for each row of a table of batch
ids as far as its meaning goes; Spark decorrelates it into joins and
aggregates by batch, so it is one plan with one scan, however many batches
there are.  Spark does not take every query that way (outer joins between RAW
views, nested subqueries); :func:`lateral` then returns None.
"""

from __future__ import annotations

import logging
import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

BATCH = "_batch_id"
log = logging.getLogger("tidewater.transform")

# Where a comment, a string literal (r'...' has no escapes) or a quoted name begins.
_OPENING = re.compile(r"""--|/\*|`|(?:(?<![A-Za-z0-9_])[rR])?['"]""")
_CLOSING = {"'": re.compile(r"(?:[^'\\]|\\.|'')*'", re.S), '"': re.compile(r'(?:[^"\\]|\\.|"")*"', re.S),
            "r'": re.compile(r"[^']*'"), 'r"': re.compile(r'[^"]*"'), "`": re.compile(r"(?:[^`]|``)*`"),
            "--": re.compile(r"[^\r\n]*")}
_BATCH_NAME = re.compile(rf"(?<![A-Za-z0-9_]){BATCH}(?![A-Za-z0-9_])", re.I)
_COMMENT_EDGE = re.compile(r"/\*|\*/")


def tokens(sql: str):
    """(kind, text) pieces of SQL: ``text``, ``literal``, ``name`` (in
    backticks) and ``comment``.  What is never closed is text."""
    at = 0
    while at < len(sql):
        opening = _OPENING.search(sql, at)
        if not opening:
            break
        mark = opening.group()
        if mark == "/*":
            end = _comment_end(sql, opening.end())
        else:
            closing = _CLOSING[mark.lower()].match(sql, opening.end())
            end = closing.end() if closing else None
        if end is None:
            break
        if opening.start() > at:
            yield "text", sql[at:opening.start()]
        yield {"--": "comment", "/*": "comment", "`": "name"}.get(mark, "literal"), sql[opening.start():end]
        at = end
    if at < len(sql):
        yield "text", sql[at:]


def _comment_end(sql: str, at: int) -> int | None:
    """End of a bracketed comment that began before ``at``; they nest."""
    depth = 1
    for edge in _COMMENT_EDGE.finditer(sql, at):
        depth += 1 if edge.group() == "/*" else -1
        if not depth:
            return edge.end()
    return None


def legacy_to_named(sql: str) -> str:
    """``%s`` user slots become the ``:user`` parameter: a literal that is
    one slot as a whole, a slot within a longer literal by concatenation, so
    that the user's name is never SQL text.  ``%%`` is a literal ``%``.  Slots
    in comments stand for nothing; a slot in a quoted name raises."""
    out = []
    for kind, token in tokens(sql):
        pieces = [p.replace("\0", "%") for p in token.replace("%%", "\0").split("%s")]
        if kind == "comment":
            out.append("".join(pieces))
        elif kind == "text" or len(pieces) == 1:
            out.append(":user".join(pieces))
        elif kind == "name":
            raise ValueError(f"the user cannot be part of a name: {token}")
        else:
            start = 2 if token[0] in "rR" else 1
            prefix, quote = token[:start], token[-1]
            pieces[0], pieces[-1] = pieces[0][start:], pieces[-1][:-1]
            if pieces == ["", ""]:
                out.append(":user")
            else:
                out.append("concat(" + ", :user, ".join(f"{prefix}{p}{quote}" for p in pieces) + ")")
    return "".join(out)


def bound_sql(transform: str) -> str:
    """The transform with its user slots as ``:user``, without a closing semicolon."""
    sql = legacy_to_named(transform) if "%s" in transform else transform
    return re.sub(r";\s*\Z", "", sql)


def run_sql(spark: SparkSession, sql: str, user: str) -> DataFrame:
    return spark.sql(sql, args={"user": user}) if ":user" in sql else spark.sql(sql)


def knows_batches(sql: str) -> bool:
    """Whether the SQL names the batch column."""
    return any(_BATCH_NAME.search(text) for kind, text in tokens(sql) if kind in ("text", "name"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def over_views(sql: str, views: dict[str, tuple[str, list[str]]], where: str = "") -> str:
    """``sql`` with RAW names bound to other views (and columns) for this
    statement only, so that runs in one session do not see each other's."""
    bound = ", ".join(f"{_quoted(name)} AS (SELECT {', '.join(map(_quoted, columns))} FROM {_quoted(view)} AS _raw{where})"
                      for name, (view, columns) in views.items())
    return f"WITH {bound} SELECT * FROM (\n{sql}\n)"


def lateral(spark: SparkSession, sql: str, views: dict[str, tuple[str, list[str]]], batches: str,
            user: str) -> DataFrame | None:
    """``_batch_id`` and the columns of ``sql``, as if it ran for each batch of
    the view ``batches`` over that batch's rows alone; None where Spark cannot
    plan it so."""
    inner = over_views(sql, views, f" WHERE _raw.{BATCH} = _batch.{BATCH}")
    whole = f"SELECT _batch.{BATCH}, _rows.* FROM {_quoted(batches)} AS _batch, LATERAL (\n{inner}\n) AS _rows"
    try:
        out = run_sql(spark, whole, user)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    except PySparkException as refused:
        log.info("no lateral plan: %s", str(refused).split("\n", 1)[0])
        return None
    except Exception as refused:  # the optimizer's own errors reach Python as Java errors
        if type(refused).__name__ != "Py4JJavaError":
            raise
        log.info("no lateral plan: %s", str(refused).split("\n", 1)[0])
        return None
    # what is left of a correlation that could not be resolved fails when it runs
    return None if "outer(" in plan else out


def apply_transform(spark: SparkSession, file_class, raw: DataFrame, user: str) -> DataFrame:
    """The transform's rows over the view ``<table>_RAW`` of this session (a
    callable gets ``raw`` instead)."""
    t = file_class.transform
    if t is None:
        return raw
    if callable(t):
        return t(raw, user)
    return run_sql(spark, bound_sql(t), user)

"""URL filtering by hashed host-suffix and path-prefix expressions.

Every url is expanded into the expressions a rule could be written as (its
host's suffixes of whole labels, joined with prefixes of its path).  They meet
the rules in an equi-join on a short hash prefix; the full digest confirms a
hit, and the longest confirmed rule decides.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, staged

#: (action, host, path) of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT_VERDICT = "allow"
#: Hex digits of the digest that the join is keyed by.
PREFIX_DIGITS = 8
#: Rules up to this many are broadcast (some 200 bytes each); more are shuffled.
BROADCAST_RULES = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url):
    """Host and path columns of a url column.  The host runs from the first
    ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path from
    there to ``?``, ``#`` or the end.  Null or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _digest(expression):
    return F.sha2(expression, 256)


def judge_urls(urls: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES,
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """``url``, ``host``, ``path``, ``rule``, ``verdict`` for every distinct url of ``urls``.

    A rule (action, host, path) fits its host and all subdomains where the
    url's path starts with the rule's.  The longest fitting rule wins (of
    equally long ones: the longer host, then ``block``).  ``rule`` is its host
    and path, null where none fits; the verdict is then ``default``.  Null and
    empty urls, and urls without ``://``, have an empty host, which no rule
    fits.  A rule listed twice counts once; no rules at all are allowed.
    """
    rules = sorted(set(rules))
    for action, host, path in rules:
        if action not in ("allow", "block") or not path.startswith("/") or not host or host != host.lower():
            raise ValueError(f"not a rule: {(action, host, path)}")
    spark = urls.sparkSession
    distinct = urls.select("url").distinct()
    host, path = url_parts(F.col("url"))
    parts = distinct.select("url", host.alias("host"), path.alias("path"))

    # Only shapes (labels of the host, characters of the path) that some rule has.
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    labels = F.size(F.split("host", r"\."))
    expressions = [F.when((labels >= n) & (F.length("path") >= k),
                          F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, k)))
                   for n, k in shapes] or [F.lit(None).cast("string")]
    # urls without any such shape keep a row
    expanded = (parts.select("url", "host", "path", F.explode_outer(F.array_compact(F.array(*expressions))).alias("expression"))
                .withColumn("digest", _digest(F.col("expression")))
                .select("url", "host", "path", "digest", F.substring("digest", 1, PREFIX_DIGITS).alias("short")))
    listed = spark.createDataFrame(rules, "action string, rule_host string, rule_path string")
    listed = listed.select("action", F.concat("rule_host", "rule_path").alias("rule"),
                           F.length("rule_host").alias("host_length")).withColumn(
        "rule_digest", _digest(F.col("rule"))).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    if len(rules) <= BROADCAST_RULES:
        listed = F.broadcast(listed)
    # the join with few rules leaves a url's rows where distinct has put them: no second shuffle
    hit = F.col("digest") == F.col("rule_digest")
    best = F.max(F.when(hit, F.struct(F.length("rule").alias("length"), "host_length", "action", "rule")))
    return (expanded.join(listed, "short", "left").groupBy("url")
            .agg(F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
            .select("url", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict")))


def filter_pages(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES,
                 default: str = DEFAULT_VERDICT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``: one row per row
    of ``pages``.  Each distinct url is judged once, however many pages have it."""
    # staged, so that both sides of the join are plain shuffles: those adaptive
    # execution can split where one url has most pages
    judged = staged(judge_urls(pages, rules, default), "judged").withColumnRenamed("url", "judged_url")
    return (pages.select("page_id", "url")
            .join(judged, F.col("url").eqNullSafe(F.col("judged_url")))
            .select("page_id", "host", "path", "rule", "verdict"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_pages(read_table(spark, sf_dir, "pages"))


QUERIES = {"op5_url_rules": op5_url_rules}
ORACLES = {"op5_url_rules": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS raw_host FROM rest),
parts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*', 0) AS path FROM split)
SELECT page_id, host, path,
  CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
       WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
  CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'allow'
       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'block'
       WHEN (host = 'net' OR host LIKE '%.net') AND (path LIKE '/es/%' OR path LIKE '/fr/%') THEN 'block'
       ELSE 'allow' END AS verdict
FROM parts"""}

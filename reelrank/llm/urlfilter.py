"""URL rules by hashed expressions: host suffixes x path prefixes, matched on short hash prefixes.

DataFrame functions only. A rule is one expression (host, path). A URL has an expression for each
host suffix (at a dot) and path prefix (at a slash, plus the lengths by which rules go beyond their
last slash) that is no longer than some rule's, so a rule fits exactly if the URL has its expression.
Expressions meet the rules on the first eight hex digits of their SHA-256; then the whole digests
are compared and the longest rule wins.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: host, path, verdict of the contract's rules
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: The rule table is broadcast up to this size, and met in salted shuffles beyond it.
BROADCAST_BYTES = 32 << 20
SALTS = 64


def lower_ascii(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: the host lies between the first ``://`` and the next ``/``, ``?`` or ``#``, with
    A-Z in lower case; the path goes on to ``?`` or ``#``. Both are empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)


def _digest(host: Column, path: Column) -> Column:
    # neither part can hold a "#"
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row (key, digest, text, size, verdict) an expression; block wins where both are given. A path
    that is neither empty nor begins with a slash fits no URL."""
    host = lower_ascii(F.coalesce(F.col("host").cast("string"), F.lit("")))
    r = rules.select(host.alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "verdict")
    r = r.where("verdict IN ('allow', 'block') AND (path = '' OR startswith(path, '/'))")
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    d = _digest(F.col("host"), F.col("path"))
    return r.select("host", "path", "verdict", d.alias("digest"), _short(d).alias("key"))


def _suffixes(host: Column, longest: int) -> Column:
    labels = F.split(F.expr(f"right(host, {longest + 1})"), r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda j: F.array_join(F.slice(labels, j, F.size(labels)), "."))
    # a label that was cut is part of the one suffix that is too long
    return F.filter(tails, lambda s: F.length(s) <= longest)


def _prefixes(path: Column, longest: int, beyond: list[int]) -> Column:
    parts = F.split(F.substring(path, 1, longest), "/")

    def at(k: Column) -> Column:  # the first k parts, each with its slash, then 0 or more letters of the next
        whole = F.when(k > 0, F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))).otherwise("")
        more = F.filter(F.array(*[F.lit(t) for t in beyond]), lambda t: t <= F.length(F.get(parts, k)))
        return F.transform(more, lambda t: F.concat(whole, F.substring(F.get(parts, k), F.lit(1), t)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), at))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url).

    ``rules`` (host, path, verdict allow or block): a rule fits its host and all subdomains where the
    URL's path starts with the rule's path; the longest host + path wins, then the longer host, then
    the greater text. Rules with another verdict are ignored. ``rule`` is host + path of the winner;
    without one it is null and the verdict is ``default``. Null URLs and those without ``://`` have empty
    parts; a null page_id stays null; repeated rows and ties come back as often as they are there;
    other columns are ignored; no pages give no rows, no rules the default. Of a very long URL only
    as much is expanded as the longest rule can reach.

    A row's winner is combined in its own input task before it is shuffled, and rows are joined
    by a row number: a host, URL or rule that holds a third of all rows fills no task.
    """
    host, path = url_parts(F.col("url"))
    rows = materialise(
        pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"),
                     F.monotonically_increasing_id().alias("row")), "url-rows")
    known = materialise(_rule_table(rules), "url-rules")
    tail = F.length(F.substring_index("path", "/", -1))
    # one row; the set is no larger than the longest path
    size = known.agg(F.max(F.length("host")).alias("host"), F.max(F.length("path")).alias("path"), F.collect_set(tail).alias("beyond"),
                     F.sum(F.octet_length("host") + F.octet_length("path") + 200).alias("bytes")).first()
    if size["bytes"] is None:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tests = rows.select("row", "path", F.explode(_suffixes(F.col("host"), size["host"])).alias("h")).select(
        "row", "h", F.explode(_prefixes(F.col("path"), size["path"], sorted(size["beyond"]))).alias("p"))
    tests = tests.select("row", _digest(F.col("h"), F.col("p")).alias("full")).withColumn("key", _short(F.col("full")))
    if size["bytes"] <= BROADCAST_BYTES:
        hits = tests.join(F.broadcast(known), "key")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = tests.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    text = F.concat("host", "path")
    best = hits.where("full = digest").groupBy("row").agg(
        F.max(F.struct(F.length(text).alias("n"), F.length("host").alias("m"), text.alias("rule"), "verdict")).alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rules`` as a frame of literals."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def op11_url_filters(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, rule_frame(pages.sparkSession, RULES))


OP11_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT row_number() OVER () AS r, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(rhost, rpath, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT r, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.r = p.r AND f.k = 1"""

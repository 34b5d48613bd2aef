"""Judge URLs by host and path rules through short hash prefixes.

Each rule (``example.net/en/``) fits its host and all hosts below it, if the URL's path starts with
the rule's path. A URL is expanded into the host suffixes and path prefixes that a rule could have,
these expressions are joined with the rules on the first bytes of their digest, and what meets there
is confirmed by the full digest. Of the rules that fit, the longest wins.

Everything is a built-in expression. Only distinct (host, path) pairs are expanded, so a page that
makes up a third of the crawl costs one row; the join back is an equi-join that adaptive execution
splits on a hot pair.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs as a table with the columns ``rule`` and ``verdict``."""
    rules = list(rules)
    if not rules:
        return spark.range(0).select(F.lit("").alias("rule"), F.lit("").alias("verdict"))
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules])
    return spark.range(1).select(F.inline(rows))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The host suffix with its path prefix for each (number of labels, length of path) that rules have.

    A suffix or a prefix that the URL is too short for is left out.
    """
    labels = _labels(host)
    made = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= m),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, m)),
        )
        for n, m in shapes
    ]
    return F.array_compact(F.array(*made))


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               prefix_bytes: int = 4) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    Columns of these names in the input are replaced; all others are kept. Each input row, repeated
    ones too, gives one row. Null URLs and those without ``://`` have an empty host and path, which
    no rule fits. Ties: of rules of equal length the one with the longer host wins, and of equal rules
    with different verdicts ``block``. Rules that are null or have no host fit nothing. The shapes of
    the rules (labels, path length) are read by the driver; there are as many as differ among the rules.
    """
    names = ("host", "path", "rule", "verdict")
    keyed = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    keyed = keyed.drop("rule", "verdict")

    rule_host = F.regexp_extract("rule", r"^([^/]*)", 1)
    listed = rules.where(F.length(rule_host) > 0).select(
        "rule", "verdict",
        F.size(_labels(rule_host)).alias("labels"), F.length(rule_host).alias("host_length"),
        (F.length("rule") - F.length(rule_host)).alias("path_length"), F.sha2("rule", 256).alias("digest"),
    )
    shapes = sorted((r[0], r[1]) for r in listed.select("labels", "path_length").distinct().collect())
    if not shapes:
        return keyed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}).select(
            *[c for c in urls.columns if c.lower() not in names], *names)

    short = F.substring("digest", 1, 2 * prefix_bytes)
    listed = listed.withColumn("short", short)
    asked = (
        keyed.select("host", "path").where(F.length("host") > 0).distinct()
        .select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), shapes)).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest")).withColumn("short", short)
    )
    met = asked.join(listed.withColumnRenamed("digest", "full"), "short").where(F.col("digest") == F.col("full"))
    precedence = F.struct(F.length("rule"), "host_length", F.col("verdict") == "block")
    judged = met.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), precedence).alias("won")
    ).select("host", "path", "won.rule", "won.verdict")
    return keyed.join(judged, ["host", "path"], "left").select(
        *[c for c in urls.columns if c.lower() not in names], "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )

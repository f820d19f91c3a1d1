"""URL rules on host suffixes and path prefixes, matched by short hash prefixes.

A URL is expanded into (host suffix, path prefix) expressions. Expressions meet the rules
in an equi-join on the first 32 bits of a SHA-256; the whole digest is compared after it,
and of the rules that fit the longest wins. Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
OUTPUT = ("host", "path", "rule", "verdict")


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _lengths(rules: DataFrame, name: str) -> list[int]:
    """Distinct lengths of the rules' hosts or paths, at most as many as the longest has characters."""
    return sorted(row[0] for row in rules.select(F.length(name)).distinct().collect())


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """Columns of ``pages`` with host, path, rule (host and path joined) and verdict.

    ``rules`` has host (A-Z count as a-z), path and verdict. A rule fits its host and all subdomains if the
    URL's path starts with the rule's. The longest (host and path together) wins; of equal
    length that with the longer host, of one place the blocking rule. Without a rule the
    verdict is ``otherwise`` and the rule null.

    Suffixes and prefixes are cut only at lengths that some rule has, so a URL of any length
    yields at most (host lengths x path lengths) expressions. Each distinct URL is expanded
    once, however many pages share it. Null and malformed URLs get empty host and path and
    no rule; repeated rows are kept; columns of the input named like the output are
    replaced; rules with a null part are left out; no rules leave every page to
    ``otherwise``.
    """
    lower = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    rules = rules.select(lower.alias("host"), "path", "verdict").na.drop()
    at_host, at_path = _lengths(rules, "host"), _lengths(rules, "path")
    digest = _digest(F.col("host"), F.col("path"))
    coded = rules.select(
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
        digest.alias("rule_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("found"),
    )
    host, path = host_and_path("url")
    urls = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    suffix = lambda n: F.when(
        (F.length("host") == n)
        | ((F.length("host") > n) & (F.substring("host", -(n + 1), 1) == ".") & (F.lit(n) > 0)),
        F.substring("host", -n, n) if n else F.lit(""),
    )
    prefix = lambda n: F.when(F.length("path") >= n, F.substring("path", 1, n))
    hosts = F.array_compact(F.array(*map(suffix, at_host)).cast("array<string>"))
    paths = F.array_compact(F.array(*map(prefix, at_path)).cast("array<string>"))
    expressions = (
        urls.select("url", host.alias("host"), path.alias("path"))
        .where("host <> '' OR path <> ''")
        .select("url", F.explode(hosts).alias("host"), paths.alias("paths"))
        .select("url", "host", F.explode("paths").alias("path"))
        .select("url", _digest(F.col("host"), F.col("path")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    judged = (
        expressions.join(coded, "prefix")
        .where("digest = rule_digest")
        .groupBy(F.col("url").alias("judged_url"))
        .agg(F.max("found").alias("found"))
    )
    host, path = host_and_path(pages[f"`{url}`"])
    kept = [pages[f"`{name}`"] for name in pages.columns if name not in OUTPUT]
    return pages.join(judged, pages[f"`{url}`"] == judged["judged_url"], "left").select(
        *kept,
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(otherwise)).alias("verdict"),
    )

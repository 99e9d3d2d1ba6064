"""URL filtering by host and path rules.

As in lookup-by-hash block lists, a URL is expanded into host-suffix and
path-prefix expressions, which meet the rules in an equi-join on a short hash
prefix. The full digest then confirms a hit, and the longest rule decides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*([^?#]*)", 1)


def _hashed(expression: Column) -> list[Column]:
    digest = F.sha2(expression, 256)
    return [digest.alias("_digest"), F.substring(digest, 1, PREFIX_HEX).alias("_prefix")]


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules with host, path, verdict as hashed expressions, one row per expression.

    Of rules with the same host and path but different verdicts, block wins.
    """
    merged = rules.groupBy("host", "path").agg(
        F.when(F.max((F.col("verdict") == "block").cast("int")) == 1, "block").otherwise("allow").alias("_verdict")
    )
    expression = F.concat("host", "path")
    return merged.select(
        expression.alias("_rule"),
        "_verdict",
        F.struct(F.char_length(expression).alias("length"), F.char_length("host").alias("host")).alias("_rank"),
        *_hashed(expression),
    )


def expressions(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every suffix of the host at a label boundary, with every prefix of the path
    that is as long as the path of some rule."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    known = F.array(*map(F.lit, path_lengths)).cast("array<int>")
    lengths = F.filter(known, lambda n: n <= F.char_length(path))
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(lengths, lambda n: F.concat(s, F.substr(path, F.lit(1), n))))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of each page.

    ``rules`` has host, path, verdict (block or allow). A rule fits its host and
    all subdomains where the path starts with the rule's path; the longest rule
    wins, among equally long ones that with the longer host. Without a rule the
    verdict is ``default`` and rule is null. A null url, or one without ``://``,
    has an empty host and path, which fits no rule with a path. Repeated rows are
    each judged; an empty table gives none; other columns are ignored.

    The table of rules is broadcast only where Spark finds it below its limit. The
    distinct path lengths of the rules, at most the longest URL, come to the driver.
    """
    lengths = sorted(r[0] for r in rules.select(F.char_length("path")).distinct().collect())
    url = F.col("url")
    urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("_copies"))
    parts = urls.select("page_id", "url", "_copies", host_of(url).alias("host"), path_of(url).alias("path"))
    spelled = parts.withColumn("_expression", F.explode_outer(expressions(F.col("host"), F.col("path"), lengths)))
    hashed = spelled.select("page_id", "url", "_copies", "host", "path", *_hashed(F.col("_expression")))
    known = rule_table(rules).withColumnRenamed("_digest", "_known")
    met = hashed.join(known, "_prefix", "left")
    hit = F.when(F.col("_digest") == F.col("_known"), F.struct("_rank", "_rule", "_verdict"))
    judged = met.groupBy("page_id", "url").agg(
        F.first("_copies").alias("_copies"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(hit).alias("_hit")
    )
    each = judged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return each.select(
        "page_id",
        "host",
        "path",
        F.col("_hit._rule").alias("rule"),
        F.coalesce("_hit._verdict", F.lit(default)).alias("verdict"),
    )

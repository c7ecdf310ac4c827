"""URL filters: host-suffix and path-prefix expressions joined to rules by digest prefix.

A rule is ``(host, path, verdict)``. It fits a URL whose host is the rule's host or a subdomain of
it and whose path starts with the rule's path; of several that fit, the longest ``host + path`` wins
(ties: the greater text). Rule paths begin and end with ``/``, so prefixes only have to be taken at
slashes.

Every distinct (host, path) is expanded into its host suffixes times its path prefixes, no further
than the rules reach: suffixes with more labels and prefixes with more slashes than any rule has
can't match, so the number of expressions of a URL is bounded by the rules and not by the URL. Each
expression is hashed with SHA-256; the first eight hex digits are the join key, and the whole digest
confirms the match. Verdicts are computed per distinct (host, path) and joined back, so a URL that
is repeated in a third of all rows is expanded once.

Null or malformed URLs (no ``://``) have an empty host and path and fit no rule. Repeated rows give
repeated rows, an empty table gives an empty table, and other columns are neither read nor kept
unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Rule = tuple[str, str, str]
PREFIX_DIGITS = 8
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules with their digests; hosts are lower-cased (A-Z)."""
    for host, path, verdict in rules:
        if not host or not (path.startswith("/") and path.endswith("/")):
            raise ValueError(f"a rule needs a host and a path between slashes: {host!r} {path!r}")
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
    rows = [(ascii_lower_text(h), p, v) for h, p, v in rules]
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    return spark.createDataFrame(rows, RULE_SCHEMA).select(
        F.concat("rule_host", "rule_path").alias("rule"),
        "rule_verdict",
        digest.alias("rule_digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("short"),
    )


def ascii_lower_text(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def host_and_path(url):
    """Columns (host, path) of a URL column; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def expressions(addresses: DataFrame, labels: int, slashes: int) -> DataFrame:
    """One row per (host, path, expression), as far as ``labels`` and ``slashes`` reach."""
    parts = F.split("path", "/", slashes + 1)
    n_prefix = F.least(F.size(parts) - 1, F.lit(slashes))
    return (
        addresses.withColumn("suffix_labels", F.explode(F.sequence(F.lit(1), F.lit(labels))))
        .filter("suffix_labels <= size(split(host, '[.]'))")
        .withColumn("suffix", F.expr("substring_index(host, '.', -suffix_labels)"))
        .filter(F.col("suffix") != "")
        .filter(n_prefix >= 1)
        .withColumn("depth", F.explode(F.sequence(F.lit(1), n_prefix)))
        .select(
            "host",
            "path",
            F.sha2(
                F.concat("suffix", F.expr("substring_index(path, '/', depth)"), F.lit("/")), 256
            ).alias("digest"),
        )
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """``keep`` columns, host, path, the winning rule (or null) and the verdict, per row."""
    host, path = host_and_path(F.col(url))
    seen = pages.select(*keep, host.alias("host"), path.alias("path"))
    if not rules:
        return seen.withColumns(
            {"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)}
        )
    table = rules_table(pages.sparkSession, rules)
    found = (
        expressions(
            seen.select("host", "path").filter("host != ''").distinct(),
            max(r[0].count(".") + 1 for r in rules),
            max(r[1].count("/") for r in rules),
        )
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        .join(table, "short")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )
    return seen.join(found, ["host", "path"], "left").select(
        *keep,
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.lit(otherwise)).alias("verdict"),
    )

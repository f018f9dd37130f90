"""URL filters: host suffixes and path prefixes matched against hashed rules.

A rule is a host, a path and a verdict. It fits its host and every subdomain when the path of
the URL starts with the rule's path. Each distinct (host, head of path) is expanded into its
host suffixes times its path prefixes. The SHA-256 of such an expression starts with a short
prefix on which it is joined with the rules; the full digest then confirms the rule, and the
rule with the longest expression decides (then the longer host, then block before allow).

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm.common import ascii_lower, unused

ALLOW, BLOCK = "allow", "block"
#: Rules up to this many are broadcast; more are joined by shuffling both sides.
BROADCAST_RULES = 1_000_000
#: Hex digits of the digest that are joined on (32 bits).
SHORT = 8
#: The registered rules.
RULES = [
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
]

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str | Column) -> Column:
    """What stands between the first :// and the next of / ? #, A to Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ? or #; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table host, path, verdict."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(host: Column, path: Column) -> Column:
    # No host holds a slash, so the two parts cannot run into each other.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` to every page.

    ``rules`` has host, path and verdict; rules with a null part or an empty host are void, and
    of rules with the same host and path block wins. A null URL, or one without ``://``, has an
    empty host and path, fits no rule and gets ``default``. Rows are kept as often as they
    occur; columns of ``pages`` that bear one of the four names are replaced, all others kept.
    """
    ruled = (
        rules.select(ascii_lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
        .filter("rule_host <> '' AND rule_path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    # The shapes of rules that exist: bounded by the longest host and path, not by their number.
    shapes = ruled.agg(
        F.count(F.lit(1)).alias("rules"),
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    longest = max(shapes["lengths"], default=0)

    out = pages.drop("host", "path", "rule", "verdict")
    out = out.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not shapes["rules"]:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    head, judged_by = unused(out, "_head", "_best")
    out = out.withColumn(head, F.substring("path", 1, longest))

    labels, lengths = (F.array(*[F.lit(x) for x in shapes[k]]) for k in ("labels", "lengths"))
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(labels, lambda k: k <= F.size(parts)),
        lambda k: F.concat_ws(".", F.slice(parts, F.size(parts) - k + 1, k)),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda k: k <= F.length(head)), lambda k: F.substring(F.col(head), F.lit(1), k)
    )
    expressions = (
        out.filter("host <> ''")
        .select("host", head)
        .distinct()
        .withColumn("_suffix", F.explode(suffixes))
        .withColumn("_prefix", F.explode(prefixes))
        .withColumn("_digest", _digest(F.col("_suffix"), F.col("_prefix")))
        .withColumn("short", F.substring("_digest", 1, SHORT))
    )
    if shapes["rules"] <= BROADCAST_RULES:
        ruled = F.broadcast(ruled)
    precedence = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("verdict"),
    )
    best = (
        expressions.join(ruled, "short")
        .filter(F.col("_digest") == F.col("digest"))
        .groupBy("host", head)
        .agg(F.max(precedence).alias(judged_by))
    )
    return (
        out.join(best, ["host", head], "left")
        .withColumns(
            {
                "rule": F.col(judged_by)["rule"],
                "verdict": F.coalesce(F.col(judged_by)["verdict"], F.lit(default)),
            }
        )
        .drop(head, judged_by)
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op1: every page judged by the registered rules."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

ORACLE = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_VALUES}),
parts AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path
  FROM pages
)
SELECT page_id, host, path,
       (SELECT arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) FROM rules r
        WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.rule_host || r.rule_path)) FROM rules r
        WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)), '{ALLOW}') AS verdict
FROM parts
"""

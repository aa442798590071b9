"""URL filters: host-suffix and path-prefix expressions, hash-prefix join, full-digest check, precedence.

All DataFrame functions. Every distinct (host, path) is expanded once, into
host suffixes x path prefixes of the lengths that the rules have, so a rule
without a slash at its end is found like any other, and a host of thousands of
labels has no more suffixes than the rules have labels. The join key is the first
32 bits of SHA-256 of the expression alone; the whole digest is compared after it
with the rules of that prefix.

Defined results: a null url, or one without ``://``, has an empty host and an
empty path and fits only rules with an empty host. Repeated urls are judged
once and every row keeps its own verdict. Ties: the longest expression wins,
then the longer host, then ``block`` before ``allow``; a rule given twice
counts once. Very long urls are judged whole. Without rules every row has the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import ascii_lower, col, fresh, prepared_session, staged, table

#: The rules of the query (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as a frame (host, path, verdict); hosts are lower-cased."""
    if not rules:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join("(" + ", ".join(quote(x) for x in r) + ")" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, verdict)")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def _digested(df: DataFrame) -> DataFrame:
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    return df.withColumn("digest", digest).withColumn("key", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))


def judge(hosts: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(host, path) distinct -> host, path, rule, verdict."""
    rules = rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    # block sorts after allow, so max() keeps it among rules with one expression
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    # at most as many numbers as the longest rule path has characters
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    labels = F.split("host", "\\.")
    # no rule has more labels than ``deepest``: longer suffixes of a host can't be one
    deepest = rules.agg(F.max(F.size(F.split("rule_host", "\\.")))).first()[0] or 1
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - (deepest - 1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    cuts = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    prefixes = F.transform(F.filter(cuts, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = hosts.withColumn("rule_host", F.explode(suffixes)).withColumn("rule_path", F.explode(prefixes))
    # the join sees prefixes alone; a prefix's few rules come as a list, of which the whole digest picks
    found = _digested(rules).withColumn("rule", F.struct("digest", F.col("rule_host").alias("r_host"), F.col("rule_path").alias("r_path"), "verdict"))
    right = found.groupBy("key").agg(F.collect_list("rule").alias("candidates"))
    near = _digested(expressions).join(right, "key")
    hits = near.select("host", "path", F.inline(F.filter("candidates", lambda c: c["digest"] == F.col("digest"))))
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"), "verdict",
        F.concat("r_host", "r_path").alias("rule"),
    )
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return (
        hosts.join(best, ["host", "path"], "left")
        .select("host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Append ``host``, ``path``, ``rule``, ``verdict``; input columns of these names are replaced."""
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    h, p = fresh(pages, "url_host"), fresh(pages, "url_path")
    left = pages.select(*[col(c) for c in keep], host_of(col(url)).alias(h), path_of(col(url)).alias(p))
    verdicts = judge(left.select(F.col(h).alias("host"), F.col(p).alias("path")).distinct(), rules, default)
    # written first: a join that reads both sides anew can split the partition of a url with many rows
    prepared_session(pages.sparkSession)
    verdicts = staged(verdicts, "url-verdicts")
    joined = left.join(verdicts, (F.col(h) == F.col("host")) & (F.col(p) == F.col("path")))
    return joined.select(*[col(c) for c in keep], "host", "path", "rule", "verdict")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
sites AS (SELECT DISTINCT host, path FROM parts),
best AS (
  SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS verdict
  FROM sites JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)
"""

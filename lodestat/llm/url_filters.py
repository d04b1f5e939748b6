"""URL filters by short hash prefixes, with DataFrame operations alone.

Each URL is expanded into expressions: a suffix of its host (at a dot) with a prefix of its path. Those whose lengths no rule
has can't match and aren't made. An expression meets the rules on the first 4 bytes of its SHA-256; full
digests confirm the match, and of the rules that fit a URL the longest wins (ties: the one that blocks, then the text).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end.
Missing URLs, and those without ``://``, have an empty host and path and match nothing. A URL that no rule fits is
allowed. Rules with an empty host fit no URL. Repeated URLs are looked up once; every row gets its verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast
from lodestat.llm.rows import lower_ascii, table
from lodestat.session import store

DEFAULT = "allow"
# verdict, host, path: the rules that the registered query judges by
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url):
    """The two parts of a URL column."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://((?s:.*))", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def hash_prefix(expression):
    """The first 4 bytes of the digest, as hexadecimal digits."""
    return F.substring(F.sha2(expression, 256), 1, 8)


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """Rules as a table ``verdict, host, path``."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def hashed_rules(rules: DataFrame) -> DataFrame:
    """One row per host and path: ``rule, short, full, host_dots, path_length, rule_length, verdict``."""
    rule = F.concat("host", "path")
    # the host and path are told apart by a byte that neither holds
    key = F.concat("host", F.lit("\x00"), "path")
    return (
        rules.filter("host <> '' and path is not null")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(
            rule.alias("rule"), hash_prefix(key).alias("short"), F.sha2(key, 256).alias("full"),
            F.size(F.split("host", "[.]")).alias("host_labels"),
            F.char_length("path").alias("path_length"), F.char_length(rule).alias("rule_length"), "verdict",
        )
    )


def expressions(urls: DataFrame, hashed: DataFrame) -> DataFrame:
    """``host, path, expression``: what a rule could name of each host and path.

    The shapes (labels of the host, length of the path) that rules have are few and bound what is made of a URL.
    """
    shapes = hashed.groupBy("host_labels").agg(F.collect_set("path_length").alias("path_lengths"))
    shapes = store(shapes, "url-shapes")
    longest = shapes.agg(F.max("host_labels").alias("n")).first()["n"] or 0
    if not longest:
        return urls.select("host", "path", F.lit("").alias("expression")).limit(0)
    labels = F.least(F.size(F.split("host", "[.]")), F.lit(longest))
    suffixes = urls.select("host", "path", F.explode(F.sequence(F.lit(1), labels)).alias("host_labels"))
    suffixes = suffixes.join(bounded_broadcast(shapes, longest, 4096), "host_labels")
    fits = F.filter("path_lengths", lambda n: n <= F.char_length("path"))
    suffix = F.expr("substring_index(host, '.', -host_labels)")
    made = F.transform(fits, lambda n: F.concat(suffix, F.lit("\x00"), F.substring("path", F.lit(1), n)))
    return suffixes.select("host", "path", F.explode(made).alias("expression"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each row."""
    host, path = host_and_path(F.col(url_col))
    rows = store(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), "url-parts")
    urls = rows.select("host", "path").filter("host <> ''").distinct()
    hashed = store(hashed_rules(rules), "url-rules")
    made = expressions(urls, hashed).withColumn("short", hash_prefix("expression"))
    # 300 bytes a rule: the hint is given where the rules are counted and found small
    matched = made.join(bounded_broadcast(hashed, hashed.count(), 300), "short")
    matched = matched.filter(F.sha2("expression", 256) == F.col("full"))
    best = F.max(F.struct("rule_length", "verdict", "rule"))
    won = store(matched.groupBy("host", "path").agg(best.alias("won")), "url-verdicts")
    return rows.join(won, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(DEFAULT)).alias("verdict"),
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the rule that decides on it."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP7_SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*', 0) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
parts AS (SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM cut),
rules (verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT host, path, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND place = 1
"""

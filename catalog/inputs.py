"""Inputs of the registered queries, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as typed rides; money and minutes as exact decimals."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("medallion"),
        F.col("l_partkey").alias("driver"),
        F.col("l_quantity").cast("decimal(18,2)").alias("minutes"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("money"),
    )


def _digits(value: Column, places: int) -> Column:
    return value.cast(f"decimal(18,{places})").cast("string")


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as comma-separated trip lines.

    Every 97th order lacks a field, every 89th has text where seconds belong, every 83rd a total
    of zero.
    """
    key = F.col("l_orderkey")
    stamp = F.col("l_shipdate").cast("string")
    fields = [
        F.col("l_suppkey").cast("string"),
        F.col("l_partkey").cast("string"),
        stamp,
        stamp,
        F.when(key % 89 == 0, "x").otherwise(_digits(F.col("l_quantity") * 60, 2)),
        _digits(F.col("l_quantity"), 2),
        *[F.lit("0")] * 4,
        F.col("l_returnflag"),
        _digits(F.col("l_extendedprice") / 1000, 5),
        _digits(F.col("l_discount"), 2),
        F.when(key % 97 != 0, "0"),  # concat_ws leaves NULL out
        _digits(F.col("l_tax"), 2),
        F.col("l_linenumber").cast("string"),
        F.when(key % 83 == 0, "0.00").otherwise(_digits(F.col("l_extendedprice"), 2)),
    ]
    items = table(spark, sf_dir, "lineitem").drop("l_linestatus")
    return spread(items).select(F.concat_ws(",", *fields).alias("value"))


TRIP_LINES_SQL = """
lines AS (
  SELECT concat_ws(',',
    CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'),
    CASE WHEN l_orderkey % 89 = 0 THEN 'x' ELSE CAST(CAST(l_quantity * 60 AS DECIMAL(18,2)) AS VARCHAR) END,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR), '0', '0', '0', '0', l_returnflag,
    CAST(CAST(l_extendedprice / 1000 AS DECIMAL(18,5)) AS VARCHAR),
    CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR),
    CASE WHEN l_orderkey % 97 <> 0 THEN '0' END,
    CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), CAST(l_linenumber AS VARCHAR),
    CASE WHEN l_orderkey % 83 = 0 THEN '0.00' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END
  ) AS value FROM lineitem),
fields AS (SELECT string_split(value, ',') AS f FROM lines),
trips AS (
  SELECT len(f) AS n_fields, f[1] AS medallion, f[2] AS driver, f[3] AS pickup,
    {numbers}
  FROM fields)
""".replace(
    "{numbers}",
    ",\n    ".join(
        f"CASE WHEN regexp_full_match(f[{i}], '\\s*[+-]?([0-9]+\\.?[0-9]*([eE][+-]?[0-9]+)?"
        f"|\\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\\s*') THEN TRY_CAST(f[{i}] AS DOUBLE) END AS {name}"
        for i, name in ((5, "secs"), (6, "miles"), (12, "fare"), (13, "surcharge"), (16, "tolls"), (17, "total"))
    ),
)


def regression_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"),
        F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"),
        F.col("l_linenumber").cast("double").alias("x4"),
        "l_orderkey",
        "l_linenumber",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, spread over the cores where the file has fewer splits."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the ids of the positive class carry the mark ``AU``."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    mark = F.when(F.col("lang") == "de", "AU").otherwise("")
    return docs.select(F.concat(mark, F.col("doc_id").cast("string")).alias("doc_id"), "text")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories per document: source and language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return docs.select("doc_id", F.explode(F.array("source", "lang")).alias("category"))


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tagged lines; those in Spanish lack the url."""
    head = F.concat(F.lit('<doc id="'), F.col("doc_id").cast("string"))
    url = F.when(F.col("lang") == "es", '" title="t">').otherwise('" url="u" title="t">')
    return table(spark, sf_dir, "documents").select(F.concat(head, url, "text", F.lit("</doc>")).alias("value"))


TAGGED_LINES_SQL = """
lines AS (
  SELECT '<doc id="' || doc_id || CASE WHEN lang = 'es' THEN '" title="t">' ELSE '" url="u" title="t">' END
    || text || '</doc>' AS value FROM documents)
"""


def post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as posts; those in Spanish lack the closing tag."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    end = F.when(F.col("lang") == "es", "").otherwise("</doc>")
    line = F.concat(
        F.lit('<doc id="posts/'), "source", F.lit("/"), F.col("doc_id").cast("string"),
        F.lit('" url="u" title="t">'), "text", end,
    )
    return spread(docs).select(line.alias("value"))


POSTS_SQL = """
lines AS (
  SELECT '<doc id="posts/' || source || '/' || doc_id || '" url="u" title="t">' || text
    || CASE WHEN lang = 'es' THEN '' ELSE '</doc>' END AS value FROM documents),
posts AS (
  SELECT regexp_extract(value, '(<[^>]+>)', 1) AS header,
    substr(value, instr(value, 'id="') + 4, instr(value, '" url=') - instr(value, 'id="') - 4) AS doc_id,
    substr(value, instr(value, '>'),
      CASE WHEN instr(value, '</doc>') > 0 THEN instr(value, '</doc>') ELSE length(value) END - instr(value, '>')
    ) AS body
  FROM lines),
parsed AS (SELECT header, doc_id, regexp_extract(header, '/(.*?)/', 1) AS category, body FROM posts)
"""

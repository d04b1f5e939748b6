"""Comparison of clusters with the categories documents really have."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast


def cluster_doc_counts(assigned: DataFrame) -> DataFrame:
    """``cluster, n`` in cluster order."""
    return assigned.groupBy("cluster").agg(F.count("*").alias("n")).orderBy("cluster")


def cluster_category_share(assigned: DataFrame) -> DataFrame:
    """``cluster, category, n, pct``: share of a category among the documents of a cluster.

    The totals are added up from the category counts, so the documents are read once and a big
    cluster never meets in one task.
    """
    counts = assigned.groupBy("cluster", "category").agg(F.count("*").alias("n"))
    totals = counts.groupBy("cluster").agg(F.sum("n").alias("_total"))
    shares = counts.join(totals, "cluster")
    return shares.select("cluster", "category", "n", (F.col("n") / F.col("_total") * 100).alias("pct"))


def cluster_top_categories(shares: DataFrame, k: int = 3) -> DataFrame:
    """The k largest categories of each cluster."""
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), F.asc("category"))
    return shares.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def cluster_term_counts(counts: DataFrame, assigned: DataFrame, vocab: DataFrame, k: int, size: int) -> DataFrame:
    """``cluster, term_id, cnt`` for every cluster and vocabulary position, empty ones as 0.

    Counts, of which a document has many, run past a table of their partition's documents and aren't sorted for the join.
    """
    scaffold = vocab.select("term_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster"))
    found = (
        counts.join(assigned.select("doc_id", "cluster").hint("shuffle_hash"), "doc_id")
        .groupBy("cluster", "term_id")
        .agg(F.sum("cnt").alias("cnt"))
    )
    joined = scaffold.join(bounded_broadcast(found, k * size, 16), ["cluster", "term_id"], "left")
    return joined.select("cluster", "term_id", F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"))

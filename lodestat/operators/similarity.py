"""Category prediction from the documents most similar to a free-text query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestat.functions.text import tokens_letters
from lodestat.operators.doc_rows import folded
from lodestat.operators.nearest import Queries, all_scores, nearest_links, term_bounds
from lodestat.operators.vectors import (
    doc_term_counts,
    term_frequency,
    term_frequency_binary,
    tfidf,
)
from lodestat.operators.vocab import VOCABULARY_SIZE


def query_vectors(
    spark: SparkSession,
    texts: Sequence[str],
    vocab: DataFrame,
    idf_table: DataFrame,
    binary: bool = False,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """TF-IDF vectors ``query_id, term_id, value`` of query texts.

    A text without a known word has no rows, and therefore no prediction.
    """
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counts = doc_term_counts(tokens_letters(table), vocab, size)
    tf = term_frequency_binary(counts) if binary else term_frequency(counts)
    return tfidf(tf, idf_table, size).withColumnRenamed("doc_id", "query_id")


def similarity_scores(
    vectors: DataFrame,
    queries: DataFrame,
    n_queries: int,
    cosine: bool = False,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``query_id, doc_id, score`` of every document with a vector, for every answerable query of the first ``n_queries``.

    For long tables, which are folded by document first. Vector rows are scored where they lie, by
    :func:`lodestat.operators.nearest.all_scores`.
    """
    asked = Queries.of(queries.filter(F.col("query_id") < n_queries), cosine)
    return all_scores(folded(vectors), asked, cosine)


def category_features(links: DataFrame, vectors: DataFrame) -> DataFrame:
    """``category, doc_id, term_id, value``: one copy of a vector per category of its document.

    Give stored vectors: both sides of the join are then plain shuffles, of which AQE splits the
    partition of a document with very many categories.
    """
    return links.join(vectors, "doc_id").select("category", "doc_id", "term_id", "value")


def nearest_rows(links: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """The k best (category, score) rows per query; equal scores by document, then category.

    Scores, not vectors, meet the categories. Rows of one document are equally near, so no more
    than its first k categories can count: the rest of a document with very many is left behind
    before the join. Both rank limits work within tasks before they shuffle.
    """
    per_doc = F.row_number().over(Window.partitionBy("doc_id").orderBy("category"))
    first = links.withColumn("_nth", per_doc).filter(F.col("_nth") <= k).drop("_nth")
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.asc("doc_id"), F.asc("category"))
    )
    return first.join(scores, "doc_id").withColumn("rank", rank).filter(F.col("rank") <= k)


def votes(nearest: DataFrame) -> DataFrame:
    """``query_id, category, votes``: votes among the nearest rows, the most first."""
    counted = nearest.groupBy("query_id", "category").agg(F.count("*").alias("votes"))
    return counted.orderBy("query_id", F.desc("votes"), "category")


def knn_predict(links: DataFrame, scores: DataFrame, k: int = 10) -> DataFrame:
    """:func:`votes` of the k nearest rows, from given scores of all documents."""
    return votes(nearest_rows(links, scores, k))


def predict(
    links: DataFrame, rows: DataFrame, queries: DataFrame, bounds: DataFrame | None = None, k: int = 10, cosine: bool = False
) -> DataFrame:
    """:func:`votes` of the k nearest rows, from vector rows of all documents: those that can't come near are left out
    where they lie. ``bounds``: their :func:`lodestat.operators.nearest.term_bounds`, where those are kept."""
    known = term_bounds(rows, cosine) if bounds is None else bounds
    return votes(nearest_links(links, rows, Queries.of(queries, cosine), known, k, cosine))

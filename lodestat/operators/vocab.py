"""Word counts and the vocabulary: the most frequent words with dense positions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast
from lodestat.session import store

VOCABULARY_SIZE = 20_000


def corpus_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n"))


def word_count(tokens: DataFrame) -> DataFrame:
    """``word, cnt``. Frequent words are combined on the map side before the shuffle."""
    return tokens.groupBy("word").agg(F.count("*").alias("cnt"))


def _least_count(counts: DataFrame, size: int) -> int:
    """The count of the ``size``-th most frequent word, 0 if there are fewer words.

    From the number of words at each count, of which there are at most as many as the square root of twice the corpus.
    """
    levels = counts.groupBy("cnt").agg(F.count("*").alias("n"))
    reached = levels.withColumn("_n", F.sum("n").over(Window.orderBy(F.desc("cnt")))).filter(F.col("_n") >= size)
    return reached.agg(F.max("cnt")).first()[0] or 0


def vocabulary(counts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``word, cnt, term_id``: position 0 is the most frequent word, equal counts in word order.

    Fewer words than ``size`` give a shorter vocabulary. Words below the count of the last one are left behind where they are.
    The others are sorted by range; a word's position is its place in its range plus the sizes of the ranges before, so
    that no task sees the whole vocabulary.
    """
    if size < 1:
        return counts.limit(0).select("word", "cnt", F.lit(0).alias("term_id"))
    counts = store(counts.select("word", "cnt"), "word-counts")
    order = [F.desc("cnt"), F.asc("word")]
    head = counts.filter(F.col("cnt") >= _least_count(counts, size)).orderBy(*order)
    # the number of a row has its partition in the upper bits, its place there in the lower 33
    sorted_ = store(head.withColumn("_at", F.monotonically_increasing_id()), "word-order")
    ranges = sorted_.groupBy(F.shiftright("_at", 33).cast("int").alias("_range")).agg(F.count("*").alias("_n")).collect()
    starts = [0] * (max((r["_range"] for r in ranges), default=0) + 2)  # one number per range
    for r in ranges:
        starts[r["_range"] + 1] = r["_n"]
    start = F.get(F.lit([int(n) for n in np.cumsum(starts)]), F.shiftright("_at", 33).cast("int"))
    place = start + F.col("_at").bitwiseAND((1 << 33) - 1)
    return sorted_.select("word", "cnt", place.cast("int").alias("term_id")).filter(F.col("term_id") < size)


def vocab_head(counts: DataFrame, n: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("cnt"), F.asc("word")).limit(n)


def vocab_tail(vocab: DataFrame, n: int = 20) -> DataFrame:
    """The n highest positions."""
    return vocab.select("word", "term_id").orderBy(F.desc("term_id")).limit(n)


def with_term_ids(tokens: DataFrame, vocab: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Replace words by positions; words outside the vocabulary vanish."""
    terms = bounded_broadcast(vocab.select("word", "term_id"), size)
    return tokens.join(terms, "word").drop("word")

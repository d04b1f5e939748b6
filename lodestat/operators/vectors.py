"""Document vectors as long tables ``doc_id, term_id, value``.

Row counts follow the distinct words of the documents. Groups per document are bounded by the
vocabulary, groups per term shrink on the map side, so neither depends on one hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast
from lodestat.operators.vocab import VOCABULARY_SIZE, with_term_ids


def doc_term_counts(tokens: DataFrame, vocab: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``doc_id, term_id, cnt`` of the words in the vocabulary.

    The shuffle behind this table is the dearest of all. Whatever is derived from it in one plan
    reads the same columns and rows (``cnt`` too, and no row without an id), so that Spark sees
    equal shuffles and runs them once.
    """
    named = tokens.filter(F.col("doc_id").isNotNull())
    return with_term_ids(named, vocab, size).groupBy("doc_id", "term_id").agg(F.count("*").alias("cnt"))


def term_frequency(counts: DataFrame) -> DataFrame:
    """Share of a term among the in-vocabulary words of its document."""
    total = F.sum("cnt").over(Window.partitionBy("doc_id"))
    return counts.select("doc_id", "term_id", (F.col("cnt") / total).alias("tf"))


def term_frequency_binary(counts: DataFrame) -> DataFrame:
    """1 / number of distinct in-vocabulary words of the document."""
    distinct = F.count_if(F.col("cnt") > 0).over(Window.partitionBy("doc_id"))
    return counts.select("doc_id", "term_id", (F.lit(1.0) / distinct).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """``term_id, df``: documents where the term is present; each is one row of ``counts``."""
    return counts.groupBy("term_id").agg(F.count_if(F.col("cnt") > 0).alias("df"))


def idf(df: DataFrame, n_docs: Column) -> DataFrame:
    """ln(N / df). N counts every line of the corpus, valid or not."""
    return df.select("term_id", F.ln(n_docs.cast("double") / F.col("df")).alias("idf"))


def idf_guarded(vocab: DataFrame, df: DataFrame, n_docs: Column) -> DataFrame:
    """IDF of a second corpus for every vocabulary position; 0 where that corpus lacks the word."""
    joined = vocab.select("term_id").join(df, "term_id", "left")
    value = F.when(F.col("df") > 0, F.ln(n_docs.cast("double") / F.col("df"))).otherwise(F.lit(0.0))
    return joined.select("term_id", value.alias("idf"))


def tfidf(tf: DataFrame, idf_table: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``doc_id, term_id, value``."""
    weights = bounded_broadcast(idf_table, size)
    return tf.join(weights, "term_id").select("doc_id", "term_id", (F.col("tf") * F.col("idf")).alias("value"))


def vector_sum(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Elementwise sum of dense vectors per key, as ``key, pos, total``.

    The summariser keeps one buffer per key and task, so vectors are added before the shuffle.
    """
    as_double = F.col(vector).cast("array<double>")
    summed = df.groupBy(key).agg(Summarizer.sum(array_to_vector(as_double)).alias("_sum"))
    return summed.select(key, F.posexplode(vector_to_array("_sum")).alias("pos", "total"))


def term_sum(values: DataFrame, value: str = "value") -> DataFrame:
    """Elementwise sum of sparse vectors: one total per term."""
    return values.groupBy("term_id").agg(F.sum(value).alias("total"))


def mean_tf_by_class(
    tf: DataFrame,
    vocab: DataFrame,
    words: Sequence[str],
    label: Column,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``class, word, mean_tf`` of the given words over all documents with a vector.

    Documents without a word count as 0; words outside the vocabulary give no rows. ``label`` is
    an expression over ``doc_id``. One pass serves all words and classes: a document folds into
    one row with a column per word.
    """
    probes = vocab.filter(F.col("word").isin(list(words))).select("term_id", "word")
    marked = tf.join(bounded_broadcast(probes, min(len(words), size)), "term_id", "left")
    per_doc = marked.groupBy("doc_id").agg(
        *[F.sum(F.when(F.col("word") == word, F.col("tf"))).alias(f"_w{i}") for i, word in enumerate(words)]
    )
    per_class = per_doc.groupBy(label.alias("class")).agg(
        *[F.avg(F.coalesce(f"_w{i}", F.lit(0.0))).alias(f"_w{i}") for i in range(len(words))]
    )
    means = F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"_w{i}").alias("mean_tf")) for i, w in enumerate(words)])
    long = per_class.select("class", F.inline(means))
    return long.join(F.broadcast(probes.select("word")), "word", "left_semi").select("class", "word", "mean_tf")


def doc_term_map(counts: DataFrame) -> DataFrame:
    """``doc_id, counts, total``: position-to-count map of a document and its in-vocabulary words.

    The list behind a map holds one entry per distinct term, at most the vocabulary.
    """
    entries = F.sort_array(F.collect_list(F.struct("term_id", "cnt")))
    return counts.groupBy("doc_id").agg(
        F.map_from_entries(entries).alias("counts"), F.sum("cnt").alias("total")
    )


def doc_top_terms(counts: DataFrame, vocab: DataFrame, doc: Column, n: int = 100) -> DataFrame:
    """Counts of the n most common vocabulary words in the chosen document, zeros included."""
    head = vocab.filter(F.col("term_id") < n).select("term_id", "word")
    one = counts.filter(doc).groupBy("term_id").agg(F.sum("cnt").alias("cnt"))
    return head.join(one, "term_id", "left").select(
        "term_id", "word", F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt")
    )

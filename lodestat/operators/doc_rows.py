"""Documents as one row each: words and counts, or terms and values, in sorted arrays.

A text is split once, by expressions. Its words are counted inside its row, so no shuffle brings a document together; only
rows with the same id are merged, and those alone move. Vocabulary and counts both come from these rows. A row is bounded by the
distinct words of its document. Counting, looking words up in the vocabulary and weighing work on batches of rows in Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.text import (
    MIN_LETTERS,
    STOP_WORDS,
    edge_trim_words,
    letters_words,
    strip_words,
)
from lodestat.layout import BROADCAST_BYTES, bounded_broadcast
from lodestat.operators.blocks import cut
from lodestat.operators.vocab import VOCABULARY_SIZE, with_term_ids
from lodestat.session import store

WORD_BYTES = 100  # of a word in a task's table, at most in the mean


def letters(text: Column) -> Column:
    """Words of the letters tokeniser."""
    return F.array_remove(letters_words(text), "")


def stripped(text: Column) -> Column:
    """Words of the strip tokeniser: three letters or more, no stop words."""
    return F.filter(strip_words(text), lambda w: (F.length(w) >= MIN_LETTERS) & ~w.isin(STOP_WORDS))


def edge_trimmed(text: Column) -> Column:
    """Words of the edge-trim tokeniser: three characters or more."""
    return F.filter(edge_trim_words(text), lambda w: F.length(w) >= MIN_LETTERS)


def _lists(n: int, row: np.ndarray, *values):
    """Arrow lists of ``values`` by ``row``, for rows 0 to ``n``."""
    import pyarrow as pa

    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype("int32"))
    return [pa.ListArray.from_arrays(ends, v if isinstance(v, pa.Array) else pa.array(v)) for v in values]


def _counted(rows: DataFrame) -> DataFrame:
    """``doc_id, words, cnts`` of ``doc_id, _words``: a row's distinct words in order, and how often each occurs."""
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("words", T.ArrayType(T.StringType(), False)),
        T.StructField("cnts", T.ArrayType(T.LongType(), False)),
    ])

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in cut(batches, "_words"):
            found = batch.column("_words")
            coded = found.flatten().dictionary_encode()
            order = pc.array_sort_indices(coded.dictionary).to_numpy().astype("int64")
            place = np.empty(len(order), "int64")
            place[order] = np.arange(len(order))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(found).to_numpy())
            # one number per (row, word), so that a single sort counts all rows
            key, cnt = np.unique(row * max(1, len(order)) + place[coded.indices.to_numpy()], return_counts=True)
            row, word = np.divmod(key, max(1, len(order)))
            lists = _lists(batch.num_rows, row, coded.dictionary.take(pa.array(order[word])), cnt)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=schema.names)

    return rows.mapInArrow(count, schema)


def _merged(rows: DataFrame) -> DataFrame:
    """``doc_id, words, cnts`` with one row per id. Ids are counted without the words; rows of repeated ids alone are merged."""
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id")
    n = repeated.count()
    if not n:
        return rows
    known = bounded_broadcast(store(repeated, "repeated-ids"), n)
    parts = rows.join(known, "doc_id", "left_semi").select("doc_id", F.inline(F.arrays_zip("words", "cnts")))
    summed = parts.groupBy("doc_id", "words").agg(F.sum("cnts").alias("cnts"))
    inside = F.sort_array(F.collect_list(F.struct("words", "cnts")))
    whole = summed.groupBy("doc_id").agg(inside.alias("_e")).select(
        "doc_id", F.col("_e.words").alias("words"), F.col("_e.cnts").alias("cnts")
    )
    return rows.join(known, "doc_id", "left_anti").unionByName(store(whole, "merged-ids"))


def word_rows(docs: DataFrame, words: Callable[[Column], Column] = letters, text: str = "text") -> DataFrame:
    """``doc_id, words, cnts`` of every document with an id, kept; a document without words has empty arrays."""
    named = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", words(F.col(text)).alias("_words"))
    none = F.coalesce("_words", F.array().cast("array<string>"))
    return _merged(store(_counted(named.select("doc_id", none.alias("_words"))), "word-rows"))


def word_count(rows: DataFrame) -> DataFrame:
    """``word, cnt`` over all documents; what a task adds up leaves it as one row per word."""
    return rows.select(F.inline(F.arrays_zip("words", "cnts"))).groupBy(F.col("words").alias("word")).agg(
        F.sum("cnts").alias("cnt")
    )


def term_rows(rows: DataFrame, vocab: DataFrame, size: int = VOCABULARY_SIZE, keep_empty: bool = False) -> DataFrame:
    """``doc_id, terms, cnts``: words of the vocabulary as positions, in order; documents without any vanish, or with
    ``keep_empty`` have empty arrays.

    A vocabulary of at most ``size`` words goes to the tasks as a table. Where that isn't bounded to fit, words meet
    it in a join, and are brought together again by document.
    """
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("terms", T.ArrayType(T.IntegerType(), False)),
        T.StructField("cnts", T.ArrayType(T.LongType(), False)),
    ])
    if size * WORD_BYTES > BROADCAST_BYTES:
        long = rows.select("doc_id", F.inline(F.arrays_zip("words", "cnts"))).withColumnRenamed("words", "word")
        inside = F.sort_array(F.collect_list(F.struct("term_id", "cnts")))
        found = with_term_ids(long, vocab, size).groupBy("doc_id").agg(inside.alias("_e"))
        if keep_empty:
            found = rows.select("doc_id").join(found, "doc_id", "left")
        return found.select(
            "doc_id", F.coalesce(F.col("_e.term_id"), F.array().cast("array<int>")).alias("terms"),
            F.coalesce(F.col("_e.cnts"), F.array().cast("array<bigint>")).alias("cnts"),
        )
    known = sorted((r["word"], r["term_id"]) for r in vocab.select("word", "term_id").collect())
    words, terms = [w for w, _ in known], np.array([t for _, t in known], "int32")

    def look_up(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = pa.array(words, pa.string())
        for batch in cut(batches, "words"):
            found = batch.column("words")
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(found).to_numpy())
            at = pc.index_in(found.flatten().cast(pa.string()), value_set=table)
            inside = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            term = terms[at.take(pa.array(inside)).to_numpy()] if len(inside) else np.zeros(0, "int32")
            row, cnt = row[inside], batch.column("cnts").flatten().to_numpy()[inside]
            order = np.lexsort((term, row))
            row, term, cnt = row[order], term[order], cnt[order]
            kept = np.arange(batch.num_rows)
            if not keep_empty:
                kept, row = np.unique(row, return_inverse=True)
            lists = _lists(len(kept), row, term, cnt)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(kept)), *lists], names=schema.names)

    return rows.select("doc_id", "words", "cnts").mapInArrow(look_up, schema)


def _long(rows: DataFrame, values: Column, name: str) -> DataFrame:
    pairs = F.arrays_zip(F.col("terms"), values.alias("x"))
    return rows.select("doc_id", F.inline(pairs).alias("term_id", name))


def counts(rows: DataFrame) -> DataFrame:
    """``doc_id, term_id, cnt``."""
    return rows.select("doc_id", F.inline(F.arrays_zip("terms", "cnts")).alias("term_id", "cnt"))


def frequencies(binary: bool = False) -> Column:
    """Array of term frequencies of a row: the share of each term, or 1 / number of distinct terms."""
    if binary:
        return F.transform("terms", lambda t: F.lit(1.0) / F.size("terms"))
    total = F.aggregate("cnts", F.lit(0).cast("bigint"), lambda s, c: s + c)
    return F.transform(F.arrays_zip("cnts", F.array_repeat(total, F.size("cnts")).alias("n")), lambda e: e["cnts"] / e["n"])


def term_frequency(rows: DataFrame, binary: bool = False) -> DataFrame:
    """``doc_id, term_id, tf``."""
    return _long(rows.withColumn("_tf", frequencies(binary)), F.col("_tf"), "tf")


def frequency_rows(rows: DataFrame, binary: bool = False) -> DataFrame:
    """``doc_id, terms, vals`` with term frequencies as values."""
    return rows.select("doc_id", "terms", frequencies(binary).alias("vals"))


def document_frequency(rows: DataFrame) -> DataFrame:
    """``term_id, df``: a term stands once in a row, so rows are counted."""
    return rows.select(F.explode("terms").alias("term_id")).groupBy("term_id").agg(F.count("*").alias("df"))


def vector_rows(rows: DataFrame, idf_table: DataFrame, binary: bool = False) -> DataFrame:
    """``doc_id, terms, vals, norm``: TF-IDF of a document, and its length; terms without IDF are left out."""
    weights = idf_table.select("term_id", "idf").toPandas()
    size = int(weights["term_id"].max()) + 1 if len(weights) else 0
    dense = np.full(size, np.nan)
    dense[weights["term_id"].to_numpy("int64")] = weights["idf"].to_numpy("float64")
    schema = T.StructType([
        rows.schema["doc_id"], rows.schema["terms"], T.StructField("vals", T.ArrayType(T.DoubleType(), False)),
        T.StructField("norm", T.DoubleType()),
    ])

    def weigh(batches):
        import pyarrow as pa

        for batch in cut(batches, "terms"):
            terms, tf = batch.column("terms"), batch.column("_tf")
            n, lengths = batch.num_rows, np.diff(terms.offsets.to_numpy())
            row, term = np.repeat(np.arange(n), lengths), terms.flatten().to_numpy()
            known = np.flatnonzero((term < size) & ~np.isnan(dense[np.minimum(term, size - 1)])) if size else np.zeros(0, "int64")
            row, term = row[known], term[known]
            value = tf.flatten().to_numpy()[known] * dense[term]
            # bincount adds in the order of terms, so copies of a document get equal numbers
            norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
            kept, row = np.unique(row, return_inverse=True)
            lists = _lists(len(kept), row, term, value)
            columns = [batch.column("doc_id").take(pa.array(kept)), *lists, pa.array(norm[kept])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("doc_id", "terms", frequencies(binary).alias("_tf")).mapInArrow(weigh, schema)


def vectors(rows: DataFrame) -> DataFrame:
    """``doc_id, term_id, value`` of vector rows."""
    return _long(rows, F.col("vals"), "value")


def folded(values: DataFrame) -> DataFrame:
    """Vector rows of a long table ``doc_id, term_id, value``, by one shuffle."""
    entries = F.sort_array(F.collect_list(F.struct("term_id", F.col("value").cast("double").alias("x"))))
    rows = values.groupBy("doc_id").agg(entries.alias("_e"))
    squares = F.aggregate(F.col("_e.x"), F.lit(0.0), lambda s, x: s + x * x)
    return rows.select("doc_id", F.col("_e.term_id").alias("terms"), F.col("_e.x").alias("vals"), F.sqrt(squares).alias("norm"))


def term_map(rows: DataFrame) -> DataFrame:
    """``doc_id, counts, total``: position-to-count map of a document and its in-vocabulary words."""
    total = F.aggregate("cnts", F.lit(0).cast("bigint"), lambda s, c: s + c)
    return rows.select("doc_id", F.map_from_arrays("terms", "cnts").alias("counts"), total.alias("total"))


def mean_tf_by_class(rows: DataFrame, vocab: DataFrame, words: Sequence[str], label: Column) -> DataFrame:
    """``class, word, mean_tf`` of the given words over all documents with a known word.

    Documents without a word count as 0; words outside the vocabulary give no rows. ``label`` is an expression over
    ``doc_id``. A document looks its words up in its own row, so one row per class and task is all that moves.
    """
    known = {r["word"]: r["term_id"] for r in vocab.filter(F.col("word").isin(list(words))).select("word", "term_id").collect()}
    names = [f"_w{i}" for i in range(len(known))]
    share = [
        F.coalesce(F.get(F.col("_tf"), F.array_position("terms", F.lit(t)).cast("int") - 1), F.lit(0.0)).alias(name)
        for name, t in zip(names, known.values())
    ]
    marked = rows.withColumn("_tf", frequencies()).select(label.alias("class"), *share)
    per_class = marked.groupBy("class").agg(*[F.avg(name).alias(name) for name in names], F.count("*").alias("_n"))
    if not known:
        return per_class.select("class", F.lit("").alias("word"), F.lit(0.0).alias("mean_tf")).limit(0)
    means = F.array(*[F.struct(F.lit(w).alias("word"), F.col(name).alias("mean_tf")) for w, name in zip(known, names)])
    return per_class.select("class", F.inline(means))

"""Training and evaluation of text classifiers on two files of tagged documents.

Documents whose id carries the mark are the positive class.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import spread
from lodestat.operators import classify, doc_rows, evaluate, vectors, vocab
from lodestat.operators.vocab import VOCABULARY_SIZE
from lodestat.session import Kept, materialize, store
from lodestat.sources.documents import class_label, parse_lines
from lodestat.sources.files import read_lines


def label(negative: int = 0) -> Column:
    return class_label(F.col("doc_id"), negative=negative)


@dataclass
class Corpus:
    """Words of a file of documents, counted in each document's row, and the file's lines, valid or not.

    The file is read and unpacked once, into Parquet, and split into words once; all else works on the rows.
    """

    rows: DataFrame
    lines: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Corpus:
        stored = store(parse_lines(read_lines(spark, path)), "documents")
        return cls(doc_rows.word_rows(spread(stored)), stored)

    @property
    def n_lines(self) -> Column:
        return vocab.corpus_count(self.lines).scalar()

    def vocabulary(self, size: int = VOCABULARY_SIZE) -> DataFrame:
        return materialize(vocab.vocabulary(doc_rows.word_count(self.rows), size))

    def terms(self, words: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
        """``doc_id, terms, cnts``, kept."""
        return store(doc_rows.term_rows(self.rows, words, size), "case-terms")

    def idf(self, words: DataFrame, terms: DataFrame) -> DataFrame:
        """IDF of every vocabulary position in this corpus, 0 where it lacks the word."""
        return vectors.idf_guarded(words, doc_rows.document_frequency(terms), self.n_lines)


@dataclass
class Evaluation:
    model: object
    vocab: DataFrame
    scored: DataFrame
    kept: Kept

    def close(self) -> None:
        """Delete the stored vocabulary and scores."""
        self.kept.close()

    def confusion(self) -> DataFrame:
        return evaluate.confusion_f1(self.scored)

    def false_positives(self, n: int = 3) -> DataFrame:
        return evaluate.false_positives(self.scored, n)

    def top_words(self, n: int = 5) -> DataFrame:
        """Words with the largest weights of a model trained by descent."""
        weights = self.model.weights_table(self.vocab.sparkSession)
        return classify.top_coefficients(weights, self.vocab, n, len(self.model.weights))


def mean_tf(spark: SparkSession, path: str, words: Sequence[str], size: int = VOCABULARY_SIZE) -> DataFrame:
    """Mean term frequency of words in both classes."""
    corpus = Corpus.read(spark, path)
    known = corpus.vocabulary(size)
    return doc_rows.mean_tf_by_class(corpus.terms(known, size), known, words, label())


def logistic(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    size: int = VOCABULARY_SIZE,
    max_iter: int | None = None,
    idf_from: str = "test",
) -> Evaluation:
    """Logistic regression by gradient descent on TF-IDF.

    Test vectors use the IDF of the test corpus, or of the training corpus with
    ``idf_from="train"``.
    """
    with Kept() as kept:
        with Kept():  # of all but the vocabulary and the scores
            train, test = Corpus.read(spark, train_path), Corpus.read(spark, test_path)
            words = _owned(kept, train.vocabulary, size)
            terms, tested = train.terms(words, size), test.terms(words, size)
            idf = train.idf(words, terms)
            rows = classify.lay_out(classify.row_points(doc_rows.vector_rows(terms, idf), label()))
            model = classify.train(rows, words.count(), classify.logistic_objective(), max_iter)
            known = {"test": lambda: test.idf(words, tested), "train": lambda: idf}[idf_from]()
            scores = classify.row_scores(doc_rows.vector_rows(tested, known), model.weights)
            scored = _owned(kept, store, classify.logistic_predict(scores).withColumn("label", label()), "scored")
        kept.hold()
    return Evaluation(model, words, scored, kept)


def _owned(kept: Kept, work, *settings) -> DataFrame:
    """What ``work`` stores, owned by ``kept``."""
    kept.hold()
    with kept:
        return work(*settings)


def lbfgs(
    spark: SparkSession, train_path: str, test_path: str, size: int = VOCABULARY_SIZE, max_iter: int = 100
) -> Evaluation:
    """Logistic regression by L-BFGS on term frequencies."""
    with Kept() as kept:
        with Kept():
            train, test = Corpus.read(spark, train_path), Corpus.read(spark, test_path)
            words = _owned(kept, train.vocabulary, size)
            width = words.count()

            def points(corpus: Corpus) -> DataFrame:
                rows = doc_rows.frequency_rows(doc_rows.term_rows(corpus.rows, words, size))
                return classify.vector_rows(classify.row_points(rows, label()), width)

            model = classify.train_lbfgs(points(train), max_iter)
            scored = _owned(kept, store, classify.lbfgs_predict(model, points(test)), "scored")
        kept.hold()
    return Evaluation(model, words, scored, kept)


def svm(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    size: int = VOCABULARY_SIZE,
    max_iter: int | None = None,
    weighted: bool = False,
) -> Evaluation:
    """Linear SVM on term frequencies; with ``weighted`` each class counts by the size of the other."""
    with Kept() as kept:
        with Kept():
            train, test = Corpus.read(spark, train_path), Corpus.read(spark, test_path)
            words = _owned(kept, train.vocabulary, size)
            found = doc_rows.frequency_rows(doc_rows.term_rows(train.rows, words, size))
            rows = classify.lay_out(classify.row_points(found, label(-1)))
            if weighted:
                sizes = {r["label"]: r["n"] for r in evaluate.class_counts(rows).collect()}
                objective = classify.weighted_hinge_objective(sizes.get(-1.0, 0), sizes.get(1.0, 0))
            else:
                objective = classify.hinge_objective(train.lines.count())
            model = classify.train(rows, words.count(), objective, max_iter)
            tested = doc_rows.frequency_rows(doc_rows.term_rows(test.rows, words, size))
            scores = classify.row_scores(tested, model.weights)
            scored = _owned(kept, store, classify.margin_predict(scores).withColumn("label", label(-1)), "scored")
        kept.hold()
    return Evaluation(model, words, scored, kept)

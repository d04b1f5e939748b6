"""Clustering of a file of posts, and comparison with their real categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.text import tokens_strip
from lodestat.layout import spread
from lodestat.operators import clusters, doc_rows, mixture, vectors, vocab
from lodestat.operators.vocab import VOCABULARY_SIZE
from lodestat.session import Kept, materialize, store
from lodestat.sources.documents import parse_posts
from lodestat.sources.files import read_lines


@dataclass
class PostCorpus:
    """Posts with the dictionary of their words and the counts of dictionary words per post.

    Dictionary and counts use different tokenisers on purpose: ``don't`` enters the dictionary as
    ``dont`` and is never counted. The file is read and unpacked once, into Parquet. Each line is a post; ``doc_id`` is
    its id and the number of its line, since ids may be missing or repeated.
    """

    posts: DataFrame
    vocab: DataFrame
    rows: DataFrame
    size: int
    kept: Kept

    @classmethod
    def read(cls, spark: SparkSession, path: str, size: int = VOCABULARY_SIZE) -> PostCorpus:
        # a line is a post, whatever its id: the line's number, written once, makes its key
        line = F.monotonically_increasing_id().cast("string")
        parsed = parse_posts(read_lines(spark, path)).select(
            F.concat_ws("#", "doc_id", line).alias("doc_id"), "category", "body"
        )
        kept = Kept()
        kept.hold()
        with kept:
            posts = spread(store(parsed, "posts"))
            words = materialize(vocab.vocabulary(vocab.word_count(tokens_strip(posts)), size))
        with Kept():
            counted = doc_rows.word_rows(posts, doc_rows.edge_trimmed, "body")
            with kept:
                rows = store(doc_rows.term_rows(counted, words, size, keep_empty=True), "post-terms")
        return cls(posts, words, rows, size, kept)

    def close(self) -> None:
        """Delete the stored posts, dictionary and counts."""
        self.kept.close()

    @property
    def counts(self) -> DataFrame:
        """``doc_id, term_id, cnt``."""
        return doc_rows.counts(self.rows)

    def top_terms(self, part_of_id: str, n: int = 100) -> DataFrame:
        """Counts of the n most common dictionary words in the post whose id contains the text."""
        return vectors.doc_top_terms(self.counts, self.vocab, F.col("doc_id").contains(part_of_id), n)

    def term_maps(self) -> DataFrame:
        return doc_rows.term_map(self.rows.filter(F.size("terms") > 0))


@dataclass
class Clustering:
    corpus: PostCorpus
    mixture: mixture.Mixture

    def close(self) -> None:
        """Delete the stored corpus and clusters."""
        self.corpus.close()

    def assigned(self) -> DataFrame:
        """``doc_id, category, cluster``."""
        return self.corpus.posts.select("doc_id", "category").join(self.mixture.assigned, "doc_id")

    def doc_counts(self) -> DataFrame:
        return clusters.cluster_doc_counts(self.mixture.assigned)

    def top_categories(self, n: int = 3) -> DataFrame:
        return clusters.cluster_top_categories(clusters.cluster_category_share(self.assigned()), n)

    def top_words(self, n: int = 50) -> DataFrame:
        table = self.mixture.log_mu_table(self.corpus.vocab.sparkSession)
        return mixture.mixture_top_words(table, self.corpus.vocab, n, self.corpus.size)


def cluster_posts(
    spark: SparkSession,
    path: str,
    k: int = mixture.CLUSTERS,
    sweeps: int = mixture.SWEEPS,
    seed: int = 0,
    size: int = VOCABULARY_SIZE,
    alpha: float = mixture.ALPHA,
    beta: float = mixture.BETA,
) -> Clustering:
    corpus = PostCorpus.read(spark, path, size)
    rows = mixture.count_rows(corpus.rows)
    with corpus.kept:
        found = mixture.mixture_gibbs(rows, corpus.vocab.count(), k, alpha, beta, sweeps, seed)
    return Clustering(corpus, found)

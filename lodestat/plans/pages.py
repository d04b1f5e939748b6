"""Category prediction for free texts from a file of tagged pages and a file of category links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import spread
from lodestat.operators import doc_rows, nearest, similarity, vectors, vocab
from lodestat.operators.vocab import VOCABULARY_SIZE
from lodestat.session import Kept, materialize, store
from lodestat.sources.documents import parse_lines, parse_links
from lodestat.sources.files import read_lines


# Texts answered in one pass over the pages: the tasks hold a weight per text for every word that any of them asks for.
TEXTS_PER_PASS = 50


@dataclass
class PageIndex:
    """Vocabulary, IDF and document vectors, each computed once and kept.

    The text files are read and unpacked once, into Parquet, and split into words once; the vocabulary comes from the counted
    words of each page, and so do the vectors. ``rows`` holds one row per page, in which predictions score it; ``bounds`` the
    greatest value at each term, by which they leave pages out.
    """

    vocab: DataFrame
    idf: DataFrame
    rows: DataFrame
    bounds: DataFrame
    links: DataFrame
    cosine: bool
    size: int
    kept: Kept

    @classmethod
    def build(
        cls,
        spark: SparkSession,
        pages_path: str,
        links_path: str,
        cosine: bool = False,
        size: int = VOCABULARY_SIZE,
    ) -> PageIndex:
        kept = Kept()
        kept.hold()
        with Kept():  # of what building alone needs
            stored = store(parse_lines(read_lines(spark, pages_path)), "pages")
            n_lines = vocab.corpus_count(stored).scalar()
            counted = doc_rows.word_rows(spread(stored))
            with kept:
                words = materialize(vocab.vocabulary(doc_rows.word_count(counted), size))
            terms = store(doc_rows.term_rows(counted, words, size), "page-terms")
            with kept:
                idf = materialize(vectors.idf(doc_rows.document_frequency(terms), n_lines))
                rows = store(doc_rows.vector_rows(terms, idf, cosine), "page-vectors")
                bounds = materialize(nearest.term_bounds(rows, cosine))
                links = store(parse_links(read_lines(spark, links_path)), "links")
        return cls(words, idf, rows, bounds, links, cosine, size, kept)

    def close(self) -> None:
        """Delete the stored tables; the index and what it gave can't be read any more."""
        self.kept.close()

    @property
    def vectors(self) -> DataFrame:
        """``doc_id, term_id, value``."""
        return doc_rows.vectors(self.rows)

    def features(self) -> DataFrame:
        """``category, doc_id, term_id, value``: the vectors by category."""
        return similarity.category_features(self.links, self.vectors)

    def _passes(self, texts: Sequence[str]) -> list[nearest.Queries]:
        if not texts:
            raise ValueError("no texts to score")
        spark, passes = self.vocab.sparkSession, []
        for first in range(0, len(texts), TEXTS_PER_PASS):
            some = texts[first : first + TEXTS_PER_PASS]
            asked = similarity.query_vectors(spark, some, self.vocab, self.idf, self.cosine, self.size)
            passes.append(nearest.Queries.of(asked.withColumn("query_id", F.col("query_id") + first), self.cosine))
        return passes

    def scores(self, texts: Sequence[str]) -> DataFrame:
        """``query_id, doc_id, score`` of every page."""
        parts = [nearest.all_scores(self.rows, asked, self.cosine) for asked in self._passes(texts)]
        return reduce(DataFrame.unionByName, parts)

    def predict(self, texts: Sequence[str], k: int = 10) -> DataFrame:
        """``query_id, category, votes`` for a batch of texts."""
        with self.kept:  # what an answer stores goes with the index
            found = [
                nearest.nearest_links(self.links, self.rows, asked, self.bounds, k, self.cosine)
                for asked in self._passes(texts)
            ]
        return similarity.votes(reduce(DataFrame.unionByName, found))

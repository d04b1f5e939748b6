"""Scores of document rows for a few query vectors, and the k best documents of each query.

Query vectors are small and go to the tasks; documents are scored where they lie, a batch at a time, and don't move.
For the best k a task keeps k documents per query. Once it has them, only documents with an essential term can still enter: the
terms of a query are ordered by the most that they can add (the query's weight times the greatest value that any
document has there), and those that together stay below the k-th best score are not essential. Documents without
a common term score 0, and are looked at only while the k-th best isn't above that.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.layout import bounded_broadcast
from lodestat.operators.blocks import cut
from lodestat.session import materialize

# Room for rounding when sums of bounds are compared with scores.
SLACK = 1e-9


@dataclass(frozen=True)
class Queries:
    """Answerable queries over the terms that they ask for: ``weights`` is terms x queries; ``void`` are those without length."""

    ids: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    void: np.ndarray

    @classmethod
    def of(cls, vectors: DataFrame, cosine: bool = False) -> Queries:
        """From ``query_id, term_id, value``, bounded by the words of the texts. With ``cosine`` vectors get length 1."""
        table = vectors.select("query_id", "term_id", F.col("value").cast("double")).toPandas()
        table = table.sort_values(["query_id", "term_id"])
        ids, at = np.unique(table["query_id"].to_numpy("int64"), return_inverse=True)
        value = table["value"].to_numpy("float64")
        if cosine and len(ids):
            length = np.sqrt(np.bincount(at, weights=value * value, minlength=len(ids)))
            value = np.divide(value, length[at], out=np.full(len(value), np.nan), where=length[at] > 0)
        terms, place = np.unique(table["term_id"].to_numpy("int64"), return_inverse=True)
        weights = np.zeros((len(terms), len(ids)))
        weights[place, at] = value
        void = np.isnan(weights).any(axis=0)
        return cls(ids, terms, np.where(np.isnan(weights), 0.0, weights), void)


def _hits(batch, terms: np.ndarray):
    """Row, place in ``terms`` and value of every entry of a batch that a query asks for, in order."""
    lists = batch.column("terms")
    term = lists.flatten().to_numpy()
    if not len(terms):
        return np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
    place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
    asked = np.flatnonzero(terms[place] == term)
    row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[asked]
    return row, place[asked], batch.column("vals").flatten().to_numpy()[asked]


def _scored(row, place, value, weights: np.ndarray, norm, n: int) -> np.ndarray:
    """Scores of ``n`` rows. Products are added in the order of terms, so copies of a document tie to the last digit."""
    dots = np.bincount(row, weights=value * weights[place], minlength=n).astype("float64")  # integers where nothing is added
    return dots if norm is None else np.divide(dots, norm, out=np.full(n, np.nan), where=norm > 0)


def all_scores(rows: DataFrame, queries: Queries, cosine: bool = False) -> DataFrame:
    """``query_id, doc_id, score`` of every document for every query; NULL where a length is 0."""
    schema = T.StructType([
        T.StructField("query_id", T.IntegerType()), rows.schema["doc_id"], T.StructField("score", T.DoubleType()),
    ])

    def run(batches):
        import pyarrow as pa

        for batch in cut(batches, "terms"):
            n = batch.num_rows
            row, place, value = _hits(batch, queries.terms)
            norm = batch.column("norm").to_numpy() if cosine else None
            for k, query in enumerate(queries.ids):
                score = _scored(row, place, value, queries.weights[:, k], norm, n)
                score = np.full(n, np.nan) if queries.void[k] else score
                columns = [pa.array(np.full(n, query, "int32")), batch.column("doc_id"), pa.array(score, mask=np.isnan(score))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select("doc_id", "terms", "vals", "norm").mapInArrow(run, schema)


def term_bounds(rows: DataFrame, cosine: bool = False) -> DataFrame:
    """``term_id, top``: the greatest size of a value at each term, as scores use it."""
    pairs = rows.select(F.inline(F.arrays_zip("terms", "vals")), "norm")
    size = F.abs(F.try_divide("vals", F.col("norm")) if cosine else F.col("vals"))
    return pairs.groupBy(F.col("terms").alias("term_id")).agg(F.coalesce(F.max(size), F.lit(0.0)).alias("top"))


class Best:
    """The best ``k`` documents of a query so far, by score (missing ones last), then id."""

    def __init__(self, k: int, weights: np.ndarray, tops: np.ndarray):
        self.k, self.kept = k, []
        most = np.abs(weights) * tops
        self.order = np.argsort(most, kind="stable")
        self.reach = np.cumsum(most[self.order]) * (1 + SLACK)

    @staticmethod
    def _key(entry):
        score, doc = entry
        return (score is None, 0.0 if score is None else -score, doc)

    @property
    def floor(self) -> float | None:
        """The score that has to be reached; None while there is room, or some are there without score."""
        return self.kept[-1][0] if len(self.kept) == self.k else None

    def essential(self, n: int) -> np.ndarray:
        """Which of the ``n`` terms a document needs at least one of."""
        needed, floor = np.ones(n, bool), self.floor
        if floor is not None:
            needed[self.order[: np.searchsorted(self.reach, floor, "left")]] = False
        return needed

    def offer(self, scores: np.ndarray, at: np.ndarray, docs) -> None:
        """Documents ``docs[at]``; not-a-numbers are missing scores."""
        floor = self.floor
        if floor is not None:
            worth = scores >= floor
            scores, at = scores[worth], at[worth]
        if len(at) > self.k:  # all that the k-th best of these leaves
            ranked = np.where(np.isnan(scores), -np.inf, scores)
            worth = ranked >= np.partition(ranked, -self.k)[-self.k]
            scores, at = scores[worth], at[worth]
        if len(at):
            found = docs.take(at).to_pylist()
            entries = self.kept + [(None if np.isnan(s) else float(s), d) for s, d in zip(scores, found)]
            self.kept = sorted(entries, key=self._key)[: self.k]


def nearest_docs(rows: DataFrame, queries: Queries, bounds: DataFrame, k: int, cosine: bool = False) -> DataFrame:
    """``query_id, doc_id, score, rank`` of the k best documents of each query; equal scores by id.

    At most k rows per query leave a task. ``bounds``: :func:`term_bounds` of these rows.
    """
    schema = T.StructType([
        T.StructField("query_id", T.IntegerType()), rows.schema["doc_id"], T.StructField("score", T.DoubleType()),
    ])
    asked = [int(t) for t in queries.terms]
    known = {r["term_id"]: r["top"] for r in bounds.filter(F.col("term_id").isin(asked)).collect()} if asked else {}
    tops = np.array([known.get(t, 0.0) for t in asked])

    def run(batches):
        import pyarrow as pa

        best = [Best(k, queries.weights[:, q], tops) for q in range(len(queries.ids))]
        kind = None
        for batch in cut(batches, "terms"):
            docs, n = batch.column("doc_id"), batch.num_rows
            kind = docs.type
            row, place, value = _hits(batch, queries.terms)
            norm = batch.column("norm").to_numpy() if cosine else None
            for q, kept in enumerate(best):
                if queries.void[q]:
                    kept.offer(np.full(n, np.nan), np.arange(n), docs)
                    continue
                weights, floor = queries.weights[:, q], kept.floor
                if floor is None or floor <= 0:  # documents that share nothing may count
                    kept.offer(_scored(row, place, value, weights, norm, n), np.arange(n), docs)
                    continue
                needed = kept.essential(len(queries.terms)) & (weights != 0)
                rows_left = np.unique(row[needed[place]])
                if len(rows_left):
                    seat = np.full(n, -1)
                    seat[rows_left] = np.arange(len(rows_left))
                    inside = seat[row] >= 0
                    length = None if norm is None else norm[rows_left]
                    score = _scored(seat[row[inside]], place[inside], value[inside], weights, length, len(rows_left))
                    kept.offer(score, rows_left, docs)
        found = [(int(queries.ids[q]), doc, score) for q, kept in enumerate(best) for score, doc in kept.kept]
        if found:
            ids, docs, scores = zip(*found)
            columns = [pa.array(ids, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = rows.select("doc_id", "terms", "vals", "norm").mapInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_links(
    links: DataFrame, rows: DataFrame, queries: Queries, bounds: DataFrame, k: int = 10, cosine: bool = False
) -> DataFrame:
    """The k best (category, score) rows per query; equal scores by document, then category.

    k documents have k rows unless some are without a category. Then four times as many are asked for, until each query has its
    k rows or no documents are left. Links meet the few best documents and don't move; of a document with very
    many categories no more than k leave a task.
    """
    best_last = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.asc("doc_id"), F.asc("category"))
    wanted = k
    while True:
        best = materialize(nearest_docs(rows, queries, bounds, wanted, cosine).drop("rank"))
        joined = links.join(bounded_broadcast(best, wanted * len(queries.ids)), "doc_id")
        found = joined.withColumn("rank", F.row_number().over(best_last)).filter(F.col("rank") <= k)
        found = materialize(found)
        full = {r["query_id"] for r in found.groupBy("query_id").count().filter(F.col("count") >= k).collect()}
        more = {r["query_id"] for r in best.groupBy("query_id").count().filter(F.col("count") >= wanted).collect()}
        if more <= full:
            return found
        wanted *= 4

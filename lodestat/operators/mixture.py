"""Multinomial mixture over word counts: posterior, parameter counts and Gibbs sampling.

Parameters are ``log_pi`` (one number per cluster) and ``log_mu`` (clusters by terms). They are
bounded by clusters times vocabulary; documents stay on the executors.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.core.broadcast import Broadcast
from pyspark.core.rdd import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lodestat.layout import bounded_broadcast
from lodestat.operators import blocks, slices
from lodestat.operators.vocab import VOCABULARY_SIZE
from lodestat.session import Kept, store

CLUSTERS = 20
ALPHA = 0.1
BETA = 0.1
SWEEPS = 200

# Term id under which a pass reports documents per cluster.
DOCS_ROW = -1
# Numbers of a run of documents while their clusters are drawn, so that a core's cache holds them.
CACHED = 1 << 16


def smoothed_pi(doc_counts: DataFrame, k: int = CLUSTERS, alpha: float = ALPHA) -> DataFrame:
    """``cluster, log_pi``: mean of the Dirichlet that follows from documents per cluster."""
    total = doc_counts.agg(F.sum("n").cast("double") + k * alpha).scalar()
    clusters = doc_counts.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    seen = clusters.join(doc_counts, "cluster", "left")
    return seen.select("cluster", F.ln((F.coalesce("n", F.lit(0)) + alpha) / total).alias("log_pi"))


def smoothed_mu(term_counts: DataFrame, beta: float = BETA) -> DataFrame:
    """``cluster, term_id, log_mu``: mean of the Dirichlet that follows from words per cluster."""
    totals = term_counts.groupBy("cluster").agg((F.sum("cnt") + F.count("*") * beta).alias("_total"))
    return term_counts.join(F.broadcast(totals), "cluster").select(
        "cluster", "term_id", F.ln((F.col("cnt") + beta) / F.col("_total")).alias("log_mu")
    )


def mixture_posterior(
    docs: DataFrame,
    counts: DataFrame,
    log_pi: DataFrame,
    log_mu: DataFrame,
    k: int = CLUSTERS,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``doc_id, cluster, prob`` for every document and cluster.

    Each term carries its log-probabilities as one array over the clusters, so a document adds k
    sums in one pass instead of multiplying its rows by k. The largest sum is subtracted before
    leaving log space. A document without known words follows ``log_pi``.
    """

    def by_cluster(value: str) -> Column:
        return F.sort_array(F.collect_list(F.struct("cluster", value))).getField(value)

    per_term = log_mu.groupBy("term_id").agg(by_cluster("log_mu").alias("_lm"))
    prior = log_pi.agg(by_cluster("log_pi")).scalar()
    joined = counts.join(bounded_broadcast(per_term, size, 16 + 8 * k), "term_id")
    names = [f"_l{j}" for j in range(k)]
    sums = joined.groupBy("doc_id").agg(
        *[F.sum(F.col("cnt") * F.get("_lm", F.lit(j))).alias(name) for j, name in enumerate(names)]
    )
    rows = docs.select("doc_id").distinct().join(sums, "doc_id", "left").withColumn("_prior", prior)
    logs = [(F.coalesce(name, F.lit(0.0)) + F.get("_prior", F.lit(j))).alias(name) for j, name in enumerate(names)]
    rows = rows.select("doc_id", *logs).withColumn("_top", F.greatest(*names) if k > 1 else F.col(names[0]))
    rows = rows.select("doc_id", *[F.exp(F.col(name) - F.col("_top")).alias(name) for name in names])
    rows = rows.withColumn("_total", sum((F.col(name) for name in names), F.lit(0.0)))
    shares = F.array(*[F.col(name) / F.col("_total") for name in names])
    return rows.select("doc_id", F.posexplode(shares).alias("cluster", "prob"))


def mixture_top_words(log_mu: DataFrame, vocab: DataFrame, n: int = 50, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``cluster, rank, word, log_mu``: the n most likely words of each cluster."""
    named = log_mu.join(bounded_broadcast(vocab.select("term_id", "word"), size), "term_id")
    order = Window.partitionBy("cluster").orderBy(F.desc("log_mu"), F.asc("term_id"))
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    return ranked.select("cluster", "rank", "word", "log_mu")


def document_rows(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``doc_id, idx, cnt`` for every document, with empty arrays where no word is known."""
    entries = F.sort_array(F.collect_list(F.struct("term_id", "cnt")))
    folded = counts.groupBy("doc_id").agg(entries.alias("_e"))
    rows = docs.select("doc_id").distinct().join(folded, "doc_id", "left")
    return rows.select(
        "doc_id",
        F.coalesce(F.col("_e.term_id"), F.array().cast("array<int>")).alias("idx"),
        F.coalesce(F.col("_e.cnt"), F.array().cast("array<bigint>")).alias("cnt"),
    )


def count_rows(rows: DataFrame) -> DataFrame:
    """``doc_id, idx, cnt`` of document rows ``doc_id, terms, cnts``, which stay where they are."""
    return rows.select("doc_id", F.col("terms").alias("idx"), F.col("cnts").alias("cnt"))


def uniform(seed: int, sweep: int, key: Column) -> Column:
    """A number in [0, 1) fixed by seed, sweep and key: repeating a lost task repeats its draws.

    The first 52 bits of an MD5, so that other engines can draw the same.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(str(sweep)), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


@dataclass
class MixtureParameters:
    log_pi: np.ndarray
    log_mu: np.ndarray


def _log_dirichlet(rng: np.random.Generator, shape: np.ndarray) -> np.ndarray:
    """Logarithm of a Dirichlet draw; small shapes do not underflow.

    A Gamma(a) draw is a Gamma(a + 1) draw times the a-th root of a uniform one.
    """
    log_gamma = np.log(rng.standard_gamma(shape + 1.0)) + np.log1p(-rng.random(shape.shape)) / shape
    top = log_gamma.max()
    return log_gamma - (top + np.log(np.exp(log_gamma - top).sum()))


def draw_parameters(
    doc_counts: np.ndarray, term_counts: np.ndarray, seed: int, sweep: int, alpha: float = ALPHA, beta: float = BETA
) -> MixtureParameters:
    """Draw prevalences and word probabilities given the counts of the present assignment."""
    k = len(doc_counts)
    log_pi = _log_dirichlet(np.random.default_rng([seed, sweep + 1, 0]), alpha + doc_counts)
    log_mu = np.stack(
        [_log_dirichlet(np.random.default_rng([seed, sweep + 1, 1 + j]), beta + term_counts[j]) for j in range(k)]
    )
    return MixtureParameters(log_pi, log_mu)


def parameters_of(log_pi: DataFrame, log_mu: DataFrame, k: int, size: int) -> MixtureParameters:
    """Parameters from the tables of :func:`smoothed_pi` and :func:`smoothed_mu`, as the sampler takes them."""
    pi, mu = log_pi.toPandas(), log_mu.toPandas()
    found = MixtureParameters(np.full(k, -np.inf), np.full((k, size), -np.inf))
    found.log_pi[pi["cluster"].to_numpy()] = pi["log_pi"].to_numpy()
    found.log_mu[mu["cluster"].to_numpy(), mu["term_id"].to_numpy()] = mu["log_mu"].to_numpy()
    return found


def share_parameters(spark: SparkSession, params: MixtureParameters) -> Broadcast:
    return spark.sparkContext.broadcast((params.log_pi, params.log_mu))


def _by_term(log_mu: np.ndarray) -> np.ndarray:
    """A row for each term, as :func:`_draw` reads them."""
    return np.ascontiguousarray(log_mu.T)


def _draw(log_pi, by_term, u, sizes, idx, cnt, room):
    """Clusters of documents with ``sizes`` entries each, one after the other, under the parameters.

    A document is one product of its counts and the rows of its terms. Rows are fetched for a run of documents at a time, which
    a core's cache holds; what a document gets doesn't depend on its run.
    """
    k = by_term.shape[1]
    loglik = np.zeros((len(u), k))
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(u):
        begin = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, begin + CACHED // k, "right")))
        some = idx[begin : ends[last - 1]]
        rows = by_term.take(some, axis=0, out=room.of("rows", len(some), np.float64, k), mode="clip")
        start = begin
        for row, end in zip(loglik[first:last], ends[first:last].tolist()):
            if end > start:
                np.dot(cnt[start:end], rows[start - begin : end - begin], out=row)
            start = end
        first = last
    loglik += log_pi
    weight = np.exp(loglik - loglik.max(axis=1, keepdims=True))
    steps = np.cumsum(weight, axis=1)
    cluster = (steps <= (u * steps[:, -1])[:, None]).sum(axis=1)
    return np.minimum(cluster, k - 1)


def _adder(shared: Broadcast):
    """Task-side counts over blocks ``u, sizes, idx, cnt``: documents per cluster, then words by cluster and term."""

    def add_up(found):
        (log_pi, log_mu), room = shared.value, blocks.Room()
        (k, size), by_term = log_mu.shape, _by_term(log_mu)
        docs, words = np.zeros(k), blocks.Sums(k * size)
        for u, sizes, idx, cnt in found:
            idx, cnt = room.places("idx", idx, size), room.filled("cnt", cnt)
            cluster = _draw(log_pi, by_term, u, sizes, idx, cnt, room)
            docs += np.bincount(cluster, minlength=k)
            places, added = words.add(len(idx))
            np.add(np.repeat(cluster * size, sizes), idx, out=places)
            added[:] = cnt
        return np.concatenate([docs, words.finish()])

    return add_up


def _with_uniform(rows: DataFrame, seed: int, sweep: int, *columns: str) -> DataFrame:
    return rows.select(*columns, "idx", "cnt", uniform(seed, sweep, F.col("doc_id")).alias("u"))


def _sweep_slices(rows: DataFrame, shared: Broadcast, seed: int, sweep: int) -> DataFrame:
    """Packed slices of the counts per task."""
    add_up = _adder(shared)

    def run(batches):
        yield from slices.packed(add_up(blocks.arrays(b, "u", "idx", "cnt") for b in blocks.cut(batches, "idx")))

    return _with_uniform(rows, seed, sweep).mapInArrow(run, slices.SCHEMA)


def _uniforms(seed: int, sweep: int, ids: list[str | None]) -> np.ndarray:
    """The numbers of :func:`uniform` for ids as text."""
    head = f"{seed}:{sweep}"
    keys = (head if i is None else f"{head}:{i}" for i in ids)
    found = b"".join([hashlib.md5(key.encode(), usedforsecurity=False).digest() for key in keys])
    return (np.frombuffer(found, ">u8")[::2] >> 12) / 2.0**52


def _sweep_total(parts: RDD, shared: Broadcast, seed: int, sweep: int, size: int) -> np.ndarray:
    """The counts of one sweep over blocks ``doc_id, sizes, idx, cnt``."""
    add_up = _adder(shared)

    def run(found):
        yield add_up((_uniforms(seed, sweep, ids), *rest) for ids, *rest in found)

    return blocks.total(parts.mapPartitions(run), size)


def sweep_counts(rows: DataFrame, shared: Broadcast, seed: int, sweep: int) -> DataFrame:
    """Draw a cluster for every document and return ``cluster, term_id, cnt`` where there are any.

    Documents per cluster come under ``DOCS_ROW``. Tasks add up their own documents, so only
    packed slices of counts are shuffled.
    """
    k, size = shared.value[1].shape
    found = slices.entries(_sweep_slices(rows, shared, seed, sweep))
    docs, place = F.col("place") < k, F.col("place") - k
    return found.select(
        F.when(docs, F.col("place")).otherwise((place - place % size) / size).cast("int").alias("cluster"),
        F.when(docs, DOCS_ROW).otherwise(place % size).cast("int").alias("term_id"),
        F.col("total").cast("bigint").alias("cnt"),
    )


def assign(rows: DataFrame, shared: Broadcast, seed: int, sweep: int) -> DataFrame:
    """``doc_id, cluster``: the same draws that :func:`sweep_counts` counts."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def label(batches):
        import pyarrow as pa

        (log_pi, log_mu), room = shared.value, blocks.Room()
        by_term = _by_term(log_mu)
        for batch in blocks.cut(batches, "idx"):
            u, sizes, idx, cnt = blocks.arrays(batch, "u", "idx", "cnt")
            idx, cnt = room.places("idx", idx, len(by_term)), room.filled("cnt", cnt)
            cluster = _draw(log_pi, by_term, u, sizes, idx, cnt, room)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cluster.astype("int32"))], names=["doc_id", "cluster"]
            )

    return _with_uniform(rows, seed, sweep, "doc_id").mapInArrow(label, f"doc_id {id_type}, cluster int")


@dataclass
class Mixture:
    """Outcome of the sampler: the last assignment, and the parameters drawn after it."""

    assigned: DataFrame
    params: MixtureParameters

    def log_mu_table(self, spark: SparkSession) -> DataFrame:
        """``cluster, term_id, log_mu``."""
        k, size = self.params.log_mu.shape
        wide = spark.createDataFrame(
            [(j, [float(v) for v in self.params.log_mu[j]]) for j in range(k)], "cluster int, _v array<double>"
        )
        return wide.select("cluster", F.posexplode("_v").alias("term_id", "log_mu"))


def mixture_gibbs(
    rows: DataFrame,
    size: int,
    k: int = CLUSTERS,
    alpha: float = ALPHA,
    beta: float = BETA,
    sweeps: int = SWEEPS,
    seed: int = 0,
) -> Mixture:
    """Gibbs sampling over ``document_rows``: clusters of documents, then parameters, per sweep.

    A draw depends on (seed, sweep, document) alone. Assignments are therefore not stored between
    sweeps: each is one job over the same blocks of rows, packed once and kept.
    """
    if sweeps < 1:
        raise ValueError("at least one sweep is needed")
    scratch = Kept()
    scratch.hold()
    with scratch:
        rows = store(rows, "documents")
    named = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    kept = blocks.packed(named, "doc_id", "idx", "cnt").persist(StorageLevel.MEMORY_AND_DISK)
    parts = blocks.per_core(kept)
    params = draw_parameters(np.zeros(k), np.zeros((k, size)), seed, -1, alpha, beta)
    shared = None
    try:
        for sweep in range(sweeps):
            if shared is not None:
                shared.destroy()
            shared = share_parameters(rows.sparkSession, params)
            total = _sweep_total(parts, shared, seed, sweep, k + k * size)
            params = draw_parameters(total[:k], total[k:].reshape(k, size), seed, sweep, alpha, beta)
    finally:
        kept.unpersist()
    # stored, so that every report sees one assignment
    assigned = store(assign(rows, shared, seed, sweeps - 1), "assigned")
    shared.destroy()
    scratch.close()
    return Mixture(assigned, params)

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import blocks, clusters, mixture
from lodestat.plans.posts import PostCorpus, cluster_posts

K, V = 3, 6


@pytest.fixture(scope="module")
def data(spark):
    """Documents of two planted kinds, one of them without words."""
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 4, (30, V))
    counts[::2, :3] *= 5
    counts[1::2, 3:] *= 5
    counts[7] = 0
    rows = [(f"d{i}", t, int(n)) for i, r in enumerate(counts) for t, n in enumerate(r) if n]
    table = spark.createDataFrame(rows, "doc_id string, term_id int, cnt bigint")
    docs = spark.createDataFrame([(f"d{i}",) for i in range(30)], "doc_id string")
    return counts, docs, table


def params(seed=0):
    return mixture.draw_parameters(np.array([10.0, 10, 10]), np.ones((K, V)) * 5, seed, 0)


def posterior(counts, p):
    s = p.log_pi + counts @ p.log_mu.T
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_parameter_draws_are_distributions():
    rng = np.random.default_rng(0)
    tiny = mixture._log_dirichlet(rng, np.full(20_000, 0.01))
    assert np.isfinite(tiny).all() and np.exp(tiny).sum() == pytest.approx(1)
    draws = np.exp([mixture._log_dirichlet(rng, np.array([1.0, 2.0, 7.0])) for _ in range(4000)])
    assert draws.mean(axis=0) == pytest.approx([0.1, 0.2, 0.7], abs=0.02)
    p = params()
    assert np.exp(p.log_pi).sum() == pytest.approx(1) and np.exp(p.log_mu).sum(axis=1) == pytest.approx(np.ones(K))


def test_posterior_against_dense_arithmetic(data, spark):
    counts, docs, table = data
    p = params()
    log_pi = spark.createDataFrame([(j, float(v)) for j, v in enumerate(p.log_pi)], "cluster int, log_pi double")
    rows = [(j, t, float(p.log_mu[j, t])) for j in range(K) for t in range(V)]
    log_mu = spark.createDataFrame(rows, "cluster int, term_id int, log_mu double")
    got = {(r[0], r[1]): r[2] for r in mixture.mixture_posterior(docs, table, log_pi, log_mu, K, V).collect()}
    want = posterior(counts, p)
    assert got == pytest.approx({(f"d{i}", j): want[i, j] for i in range(30) for j in range(K)})


def uniforms(docs, seed, sweep):
    rows = docs.select("doc_id", mixture.uniform(seed, sweep, F.col("doc_id")).alias("u")).collect()
    return {r["doc_id"]: r["u"] for r in rows}


def test_uniform_draws(spark):
    ids = spark.range(20000).select(mixture.uniform(1, 2, F.col("id")).alias("u"))
    row = ids.agg(F.min("u"), F.max("u"), F.avg("u"), F.count_distinct("u")).first()
    assert 0 <= row[0] and row[1] < 1 and row[2] == pytest.approx(0.5, abs=0.01) and row[3] == 20000


def test_sampler_follows_the_plain_loop(data, spark):
    counts, docs, table = data
    seed, sweeps = 4, 3
    p = mixture.draw_parameters(np.zeros(K), np.zeros((K, V)), seed, -1)
    for sweep in range(sweeps):
        u = uniforms(docs, seed, sweep)
        steps = np.cumsum(posterior(counts, p), axis=1)
        drawn = np.array([int(np.searchsorted(steps[i] / steps[i, -1], u[f"d{i}"], "right")) for i in range(30)])
        per_cluster = np.stack([counts[drawn == j].sum(axis=0) for j in range(K)])
        p = mixture.draw_parameters(np.bincount(drawn, minlength=K), per_cluster, seed, sweep)
    rows = mixture.document_rows(docs, table)
    result = mixture.mixture_gibbs(rows, V, K, sweeps=sweeps, seed=seed)
    assert {r["doc_id"]: r["cluster"] for r in result.assigned.collect()} == {f"d{i}": c for i, c in enumerate(drawn)}
    assert result.params.log_mu == pytest.approx(p.log_mu) and result.params.log_pi == pytest.approx(p.log_pi)
    other = mixture.mixture_gibbs(rows.repartition(5), V, K, sweeps=sweeps, seed=seed)
    assert sorted(other.assigned.collect()) == sorted(result.assigned.collect())
    table = result.log_mu_table(spark)
    assert table.count() == K * V
    assert table.groupBy("cluster").agg(F.sum(F.exp("log_mu")).alias("s")).filter("abs(s - 1) > 1e-9").count() == 0


def test_cluster_reports(spark, data):
    rows = [("a", "x", 0)] * 3 + [("b", "y", 0)] + [("c", "y", 2)] * 2 + [("d", "z", 2)] * 2
    assigned = spark.createDataFrame(rows, "doc_id string, category string, cluster int")
    assert [tuple(r) for r in clusters.cluster_doc_counts(assigned).collect()] == [(0, 4), (2, 4)]
    shares = clusters.cluster_category_share(assigned)
    assert {tuple(r) for r in shares.collect()} == {(0, "x", 3, 75.0), (0, "y", 1, 25.0), (2, "y", 2, 50.0), (2, "z", 2, 50.0)}
    top = clusters.cluster_top_categories(shares, 1)
    assert {(r["cluster"], r["category"], r["rank"]) for r in top.collect()} == {(0, "x", 1), (2, "y", 1)}


def test_empty_cluster_has_zero_counts(spark):
    vocab = spark.createDataFrame([("w", 0), ("v", 1)], "word string, term_id int")
    counts = spark.createDataFrame([("a", 0, 2)], "doc_id string, term_id int, cnt bigint")
    assigned = spark.createDataFrame([("a", 1)], "doc_id string, cluster int")
    rows = clusters.cluster_term_counts(counts, assigned, vocab, 2, 2).collect()
    assert {tuple(r) for r in rows} == {(0, 0, 0), (0, 1, 0), (1, 0, 2), (1, 1, 0)}
    log_pi = mixture.smoothed_pi(clusters.cluster_doc_counts(assigned), 3)
    assert log_pi.agg(F.sum(F.exp("log_pi"))).first()[0] == pytest.approx(1) and log_pi.count() == 3


def test_planted_clusters_are_found(spark, text_file):
    rng = np.random.default_rng(0)
    topics = {"space": "orbit rocket moon launch".split(), "food": "bread cheese butter onion".split()}
    lines = []
    for i in range(60):
        topic = "space" if i % 2 else "food"
        words = " ".join(map(str, rng.choice(topics[topic], 15)))
        lines.append(f'<doc id="news/{topic}/{i}" url="u"> {words}, the don\'t </doc>')
    lines.append('<doc id="news/empty/1" url="u"> </doc>')
    path = text_file("posts.txt", *lines)
    found = cluster_posts(spark, path, k=4, sweeps=15, seed=1)
    assert found.doc_counts().agg(F.sum("n")).first()[0] == 61
    top = {r["cluster"]: r for r in found.top_categories(1).collect()}
    assert {r["category"] for r in top.values()} >= {"space", "food"}
    mixed = found.assigned().filter("category <> 'empty'").groupBy("cluster").agg(F.count_distinct("category").alias("n"))
    assert mixed.filter("n > 1").count() == 0
    assert found.top_words(3).groupBy("cluster").count().filter("count <> 3").count() == 0


def test_post_corpus(spark, text_file):
    path = text_file(
        "posts.txt",
        '<doc id="n/a/101" url="u"> Image image, files! don\'t dont the </doc>',
        '<doc id="n/b/2" url="u"> files </doc>',
    )
    corpus = PostCorpus.read(spark, path)
    words = {r["word"]: r["term_id"] for r in corpus.vocab.collect()}
    assert set(words) == {"image", "files", "dont"}
    top = {r["word"]: r["cnt"] for r in corpus.top_terms("a/101").collect()}
    assert top == {"image": 2, "files": 1, "dont": 1}
    maps = {r["doc_id"].split("#")[0]: (r["counts"], r["total"]) for r in corpus.term_maps().collect()}
    assert maps["n/b/2"] == ({words["files"]: 1}, 1)


def test_every_line_is_a_post(spark, text_file):
    path = text_file(
        "posts.txt",
        '<doc id="n/a/1" url="u"> one two </doc>', '<doc id="n/a/1" url="u"> two three </doc>',
        "no tag one", "no tag two", '<doc id="n/b/2" url="u"> three </doc>',
    )
    found = cluster_posts(spark, path, k=2, sweeps=3, seed=1)
    assert found.doc_counts().agg(F.sum("n")).first()[0] == 5
    assert found.assigned().groupBy("cluster").count().agg(F.sum("count")).first()[0] == 5


def test_a_document_draws_the_same_in_any_run(monkeypatch):
    draw = np.random.default_rng(6)
    sizes = draw.integers(0, 30, 200)
    idx, cnt = draw.integers(0, 40, sizes.sum()), draw.integers(1, 4, sizes.sum()).astype("float64")
    log_mu, log_pi, u = np.log(draw.dirichlet(np.ones(40), 5)), np.log(draw.dirichlet(np.ones(5))), draw.random(200)
    plain = np.array([log_pi + cnt[e - n : e] @ log_mu[:, idx[e - n : e]].T for n, e in zip(sizes, np.cumsum(sizes))])
    steps = np.cumsum(np.exp(plain - plain.max(1, keepdims=True)), axis=1)
    want = [int(np.searchsorted(s, v * s[-1], "right")) for s, v in zip(steps, u)]
    for cached in (1, 200, 1 << 16):
        monkeypatch.setattr(mixture, "CACHED", cached)
        assert mixture._draw(log_pi, mixture._by_term(log_mu), u, sizes, idx, cnt, blocks.Room()).tolist() == want

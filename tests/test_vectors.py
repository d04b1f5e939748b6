import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.functions.text import tokens_letters
from lodestat.operators import similarity, vectors, vocab
from lodestat.plans.pages import PageIndex
from lodestat.sources.documents import class_label

WORDS = "alpha beta gamma delta omega rare sole".split()


def corpus(seed=3, n=30):
    rng = random.Random(seed)
    texts = {f"{'AU' if i % 3 == 0 else ''}{i}": " ".join(rng.choices(WORDS[:5], k=rng.randint(1, 12))) for i in range(n)}
    texts["r"] = "rare rare alpha"
    texts["none"] = "12 34"
    texts["copy"] = texts["1"]
    return texts


@pytest.fixture(scope="module")
def setup(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    tokens = tokens_letters(docs)
    words = vocab.vocabulary(vocab.word_count(tokens), 6).persist()
    position = {r["word"]: r["term_id"] for r in words.collect()}
    counts = vectors.doc_term_counts(tokens, words, 6).persist()
    expected = {d: Counter(position[w] for w in t.split() if w in position) for d, t in texts.items()}
    expected = {d: c for d, c in expected.items() if c}
    return texts, docs, words, position, counts, expected


def as_dict(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def test_counts_and_frequencies(setup):
    _, _, _, _, counts, expected = setup
    assert as_dict(counts) == {(d, t): n for d, c in expected.items() for t, n in c.items()}
    tf = {(d, t): n / sum(c.values()) for d, c in expected.items() for t, n in c.items()}
    assert as_dict(vectors.term_frequency(counts)) == tf
    binary = {(d, t): 1 / len(c) for d, c in expected.items() for t in c}
    assert as_dict(vectors.term_frequency_binary(counts)) == binary


def test_idf_counts_every_line(setup, spark):
    texts, docs, words, position, counts, expected = setup
    df = Counter(t for c in expected.values() for t in c)
    n = vocab.corpus_count(docs).scalar()
    got = {r["term_id"]: r["idf"] for r in vectors.idf(vectors.document_frequency(counts), n).collect()}
    assert got == pytest.approx({t: math.log(len(texts) / k) for t, k in df.items()})
    other = tokens_letters(spark.createDataFrame([("x", "alpha alpha"), ("y", "beta alpha")], "doc_id string, text string"))
    second = vectors.document_frequency(vectors.doc_term_counts(other, words, 6))
    guarded = {r["term_id"]: r["idf"] for r in vectors.idf_guarded(words, second, F.lit(2)).collect()}
    assert guarded == pytest.approx({t: math.log(2) if w == "beta" else 0.0 for w, t in position.items()})


def test_mean_tf_by_class(setup):
    _, _, words, position, counts, expected = setup
    probes = ["alpha", "rare", "unknown"]
    got = as_dict(
        vectors.mean_tf_by_class(vectors.term_frequency(counts), words, probes, class_label(F.col("doc_id")), 6)
    )
    want = {}
    for label in (0, 1):
        members = [c for d, c in expected.items() if ("AU" in d) == bool(label)]
        for w in ("alpha", "rare"):
            want[label, w] = sum(c[position[w]] / sum(c.values()) for c in members) / len(members)
    assert got == pytest.approx(want)


def test_maps_and_top_terms(setup):
    _, _, words, position, counts, expected = setup
    got = {r["doc_id"]: (r["counts"], r["total"]) for r in vectors.doc_term_map(counts).collect()}
    assert got == {d: (dict(c), sum(c.values())) for d, c in expected.items()}
    top = vectors.doc_top_terms(counts, words, F.col("doc_id") == "r", 4).collect()
    assert {r["term_id"]: r["cnt"] for r in top} == {t: expected["r"][t] for t in range(4)}


def test_sums(spark, setup):
    rows = [(1, [1.0, 2.0]), (1, [0.5, -2.0]), (2, [3.0, 3.0])]
    dense = vectors.vector_sum(spark.createDataFrame(rows, "k int, v array<float>"), "k", "v")
    assert as_dict(dense) == {(1, 0): 1.5, (1, 1): 0.0, (2, 0): 3.0, (2, 1): 3.0}
    counts, expected = setup[4], setup[5]
    total = {r["term_id"]: r["total"] for r in vectors.term_sum(counts, "cnt").collect()}
    assert total == dict(sum(expected.values(), Counter()))


def dense_scores(texts, cosine, queries):
    """All scores by dense arithmetic."""
    seen = " ".join(texts.values()).split()
    position = {w: i for i, w in enumerate(WORDS) if w in seen}

    def vector(text):
        v = np.zeros(len(WORDS))
        for w in "".join(ch if ch.isalpha() else " " for ch in text).lower().split():
            if w in position:
                v[position[w]] += 1
        if cosine:
            v = (v > 0).astype(float)
        return v / v.sum() if v.sum() else None

    docs = {d: vector(t) for d, t in texts.items()}
    docs = {d: v for d, v in docs.items() if v is not None}
    df = sum((v > 0).astype(float) for v in docs.values())
    idf = np.where(df > 0, np.log(len(texts) / np.maximum(df, 1)), 0.0)
    scores = {}
    for q, text in enumerate(queries):
        asked = vector(text)
        if asked is None:
            continue
        asked = asked * idf
        for d, v in docs.items():
            score = float(v * idf @ asked)
            if cosine:
                score /= np.linalg.norm(v * idf) * np.linalg.norm(asked)
            scores[q, d] = score
    return scores


@pytest.mark.parametrize("cosine", [False, True])
def test_page_index_against_dense_arithmetic(spark, text_file, cosine, monkeypatch):
    monkeypatch.setattr("lodestat.plans.pages.TEXTS_PER_PASS", 3)
    texts = corpus()
    pages = text_file("pages.txt", *[f'<doc id="{d}" url="u" title="t">{t}</doc>' for d, t in texts.items()])
    categories = {d: ["all", f"c{len(t) % 4}"] for d, t in texts.items()}
    links = text_file("links.csv", *[f'"{d}","{c}"' for d, cs in categories.items() for c in cs], '"missing","all"')
    queries = ["Alpha beta, alpha!", "nothing known", "rare", "sole"]
    index = PageIndex.build(spark, pages, links, cosine=cosine)
    scores = dense_scores(texts, cosine, queries)
    assert {(r["query_id"], r["doc_id"]): r["score"] for r in index.scores(queries).collect()} == pytest.approx(
        scores, abs=2e-9
    )
    k = 7
    want = {}
    for q in {q for q, _ in scores}:
        rows = [(-s, d, c) for (qq, d), s in scores.items() if qq == q for c in categories[d]]
        for category, votes in Counter(c for _, _, c in sorted(rows)[:k]).items():
            want[q, category] = votes
    assert as_dict(index.predict(queries, k)) == want
    assert index.features().count() == 2 * index.vectors.count()


def test_nearest_rows_with_one_hot_document(spark):
    many = [("a", f"c{i:03d}") for i in range(200)] + [("a", "c000")] * 3 + [("b", "x"), ("c", "y")]
    links = spark.createDataFrame(many, "doc_id string, category string")
    scores = spark.createDataFrame([(0, "a", 0.5), (0, "b", 0.9), (0, "c", 0.1), (1, "c", 1.0)], "query_id int, doc_id string, score double")
    got = similarity.nearest_rows(links, scores, 7).orderBy("query_id", "rank")
    assert [(r["query_id"], r["category"]) for r in got.collect()] == [
        (0, c) for c in ["x", "c000", "c000", "c000", "c000", "c001", "c002"]
    ] + [(1, "y")]


def test_vector_without_length_has_no_cosine(spark):
    data = spark.createDataFrame([("a", 0, 0.0), ("b", 0, 1.0)], "doc_id string, term_id int, value double")
    asked = spark.createDataFrame([(0, 0, 2.0), (1, 0, 0.0)], "query_id int, term_id int, value double")
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in similarity.similarity_scores(data, asked, 2, True).collect()}
    assert got == {(0, "a"): None, (0, "b"): 1.0, (1, "a"): None, (1, "b"): None}
    links = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, category string")
    best = similarity.nearest_rows(links, similarity.similarity_scores(data, asked, 1, True), 1)
    assert [r["category"] for r in best.collect()] == ["y"]


def test_small_scores_keep_their_order(spark):
    data = spark.createDataFrame([("a", 0, 1e-10), ("b", 0, 3e-10), ("c", 0, 2e-10)], "doc_id string, term_id int, value double")
    asked = spark.createDataFrame([(0, 0, 1.0)], "query_id int, term_id int, value double")
    links = spark.createDataFrame([(d, d) for d in "abc"], "doc_id string, category string")
    best = similarity.nearest_rows(links, similarity.similarity_scores(data, asked, 1), 3).orderBy("rank")
    assert [r["category"] for r in best.collect()] == ["b", "c", "a"]


def test_category_features(setup, spark):
    counts = setup[4]
    weighted = vectors.term_frequency(counts).withColumnRenamed("tf", "value")
    links = spark.createDataFrame([("r", "a"), ("r", "b"), ("gone", "a")], "doc_id string, category string")
    assert similarity.category_features(links, weighted).count() == 2 * len(setup[5]["r"])

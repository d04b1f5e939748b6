import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.functions.text import tokens_edge_trim, tokens_letters, tokens_strip
from lodestat.operators import classify, doc_rows, nearest, similarity, vectors, vocab

WORDS = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(6) for b in range(6)]


def corpus(n=150, seed=5):
    draw = random.Random(seed)
    texts = [(k, " ".join(draw.choices(WORDS, [1 / (i + 1) for i in range(len(WORDS))], k=draw.randint(0, 25)))) for k in range(n)]
    return texts + [(900, texts[3][1]), (901, texts[3][1]), (902, None), (903, "12 34"), (904, "don't the THE, the -- x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string").repartition(5).persist()


def plain(texts):
    return {d: Counter("".join(c if c.isascii() and c.isalpha() else " " for c in t or "").lower().split()) for d, t in texts}


def as_counts(rows):
    return {r["doc_id"]: dict(zip(r["words"], r["cnts"])) for r in rows.collect()}


@pytest.mark.parametrize("words, tokens", (
    (doc_rows.letters, tokens_letters), (doc_rows.stripped, tokens_strip), (doc_rows.edge_trimmed, tokens_edge_trim),
))
def test_rows_hold_what_tokens_count(docs, words, tokens):
    rows = doc_rows.word_rows(docs, words)
    long = tokens(docs, text="text").groupBy("doc_id", "word").count()
    want = {}
    for r in long.collect():
        want.setdefault(r["doc_id"], {})[r["word"]] = r["count"]
    got = as_counts(rows)
    assert {d: c for d, c in got.items() if c} == want and len(got) == docs.count()
    assert all(list(r["words"]) == sorted(r["words"]) for r in rows.collect())
    assert "Exchange" not in rows.select(F.inline(F.arrays_zip("words", "cnts")))._jdf.queryExecution().executedPlan().toString()


def test_repeated_ids_are_one_document(spark):
    texts = [(1, "a b b"), (1, "b c"), (None, "lost"), (2, "a"), (1, None), (3, ""), (3, "z")]
    rows = doc_rows.word_rows(spark.createDataFrame(texts, "doc_id long, text string"))
    assert as_counts(rows) == {1: {"a": 1, "b": 3, "c": 1}, 2: {"a": 1}, 3: {"z": 1}} and rows.count() == 3
    none = doc_rows.word_rows(spark.createDataFrame([], "doc_id long, text string"))
    assert none.count() == 0 and doc_rows.word_count(none).count() == 0


@pytest.mark.parametrize("joined", (False, True))
def test_terms_frequencies_and_vectors(docs, monkeypatch, joined):
    if joined:  # as for a vocabulary that is too large for a task's table
        monkeypatch.setattr(doc_rows, "BROADCAST_BYTES", 0)
    counted = doc_rows.word_rows(docs)
    words = vocab.vocabulary(doc_rows.word_count(counted), 20).persist()
    position = {r["word"]: r["term_id"] for r in words.collect()}
    known = {d: {position[w]: n for w, n in c.items() if w in position} for d, c in plain(corpus()).items()}
    everyone = doc_rows.term_rows(counted, words, 20, keep_empty=True).collect()
    assert {r["doc_id"]: dict(zip(r["terms"], r["cnts"])) for r in everyone} == known
    known = {d: c for d, c in known.items() if c}
    rows = doc_rows.term_rows(counted, words, 20).persist()
    assert {(r[0], r[1]): r[2] for r in doc_rows.counts(rows).collect()} == {(d, t): n for d, c in known.items() for t, n in c.items()}
    assert all(list(r["terms"]) == sorted(r["terms"]) for r in rows.collect())
    for binary in (False, True):
        tf = {(d, t): (1 / len(c) if binary else n / sum(c.values())) for d, c in known.items() for t, n in c.items()}
        assert {(r[0], r[1]): r[2] for r in doc_rows.term_frequency(rows, binary).collect()} == tf
        df = Counter(t for c in known.values() for t in c)
        assert {r["term_id"]: r["df"] for r in doc_rows.document_frequency(rows).collect()} == df
        weights = vectors.idf(doc_rows.document_frequency(rows), F.lit(len(known))).filter("term_id <> 2")
        found = doc_rows.vector_rows(rows, weights, binary).collect()
        want = {d: {t: tf[d, t] * math.log(len(known) / df[t]) for t in c if t != 2} for d, c in known.items()}
        assert {r["doc_id"]: dict(zip(r["terms"], r["vals"])) for r in found} == {d: pytest.approx(v) for d, v in want.items() if v}
        assert all(r["norm"] == pytest.approx(math.sqrt(sum(v * v for v in r["vals"]))) for r in found)
    total = {r["doc_id"]: (r["counts"], r["total"]) for r in doc_rows.term_map(rows).collect()}
    assert total == {d: (c, sum(c.values())) for d, c in known.items()}


def test_mean_frequency_of_words_by_class(docs):
    counted = doc_rows.word_rows(docs)
    words = vocab.vocabulary(doc_rows.word_count(counted), 20)
    rows = doc_rows.term_rows(counted, words, 20)
    label = F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)
    probes = [WORDS[0], WORDS[3], "unknown"]
    want = vectors.mean_tf_by_class(doc_rows.term_frequency(rows), words, probes, label, 20)
    got = doc_rows.mean_tf_by_class(rows, words, probes, label)
    key = {(r["class"], r["word"]): r["mean_tf"] for r in want.collect()}
    assert len(key) == 4 and {(r["class"], r["word"]): r["mean_tf"] for r in got.collect()} == pytest.approx(key)
    assert doc_rows.mean_tf_by_class(rows, words, ["unknown"], label).count() == 0


def made_rows(spark, draw, n, deep=6, terms=12, negative=False):
    """Random vector rows in several partitions, with copies and documents without length."""
    rows = []
    for k in range(n):
        chosen = sorted(draw.sample(range(terms), draw.randint(1, deep)))
        vals = [0.0 if draw.random() < 0.1 else draw.choice((0.5, 1.0, 2.5)) * (-1 if negative and draw.random() < 0.3 else 1) for _ in chosen]
        rows.append((f"d{draw.randrange(10**6):06d}-{k}", chosen, vals, math.sqrt(sum(v * v for v in vals))))
    rows += [(f"{d}copy", t, v, m) for d, t, v, m in rows[:10]]
    schema = "doc_id string, terms array<int>, vals array<double>, norm double"
    return rows, spark.createDataFrame(rows, schema).repartition(4).persist()


def plain_scores(rows, asked, cosine):
    scores = {}
    for q, weights in asked.items():
        length = math.sqrt(sum(w * w for w in weights.values()))
        for doc, terms, vals, norm in rows:
            dot = sum(v * (weights.get(t, 0.0) / (length if cosine and length else 1)) for t, v in zip(terms, vals))
            scores[q, doc] = None if cosine and (not norm or not length) else dot / norm if cosine else dot
    return scores


@pytest.mark.parametrize("cosine", (False, True))
@pytest.mark.parametrize("negative", (False, True))
def test_best_documents_are_those_of_all_scores(spark, cosine, negative):
    draw = random.Random(3 + cosine + 2 * negative)
    rows, df = made_rows(spark, draw, 300, negative=negative)
    asked = {0: {1: 2.0, 4: 0.5, 7: 1.0}, 1: {11: 1.0}, 2: {50: 3.0}, 4: {0: 0.0}, 5: {t: 1.0 / (t + 1) for t in range(12)}}
    if negative:
        asked[6] = {2: -1.0, 3: 1.0}
    long = spark.createDataFrame([(q, t, w) for q, ws in asked.items() for t, w in ws.items()], "query_id int, term_id int, value double")
    queries = nearest.Queries.of(long, cosine)
    want = plain_scores(rows, asked, cosine)
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in nearest.all_scores(df, queries, cosine).collect()}
    assert got.keys() == want.keys() and {k for k, s in got.items() if s is None} == {k for k, s in want.items() if s is None}
    assert all(got[k] == pytest.approx(s) for k, s in want.items() if s is not None)
    bounds = nearest.term_bounds(df, cosine)
    for k in (1, 7, 40, 1000):
        found = nearest.nearest_docs(df, queries, bounds, k, cosine).collect()
        for q in asked:
            ranked = sorted((s is None, 0.0 if s is None else -s, d) for (p, d), s in got.items() if p == q)[:k]
            assert [(r["doc_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [
                (d, got[q, d]) for _, _, d in ranked
            ]


def test_unknown_words_score_zero_everywhere(spark):
    rows, df = made_rows(spark, random.Random(2), 20)
    asked = spark.createDataFrame([(0, 99, 1.0)], "query_id int, term_id int, value double")
    for cosine in (False, True):
        found = nearest.all_scores(df, nearest.Queries.of(asked, cosine), cosine)
        assert {r["doc_id"]: r["score"] for r in found.collect()} == {d: None if cosine and not m else 0.0 for d, _, _, m in rows}
    assert {r["score"] for r in classify.row_scores(df.select("doc_id", F.array().cast("array<int>").alias("terms"), F.array().cast("array<double>").alias("vals")), np.ones(3)).collect()} == {0.0}


def test_no_more_than_k_documents_leave_a_task(spark):
    _, df = made_rows(spark, random.Random(9), 400)
    asked = spark.createDataFrame([(0, 1, 1.0), (0, 5, 0.2)], "query_id int, term_id int, value double")
    queries = nearest.Queries.of(asked)
    plan = nearest.nearest_docs(df, queries, nearest.term_bounds(df), 3)
    assert "CartesianProduct" not in plan._jdf.queryExecution().toString()
    best = nearest.Best(2, np.array([1.0, 0.1]), np.array([2.0, 1.0]))
    assert best.essential(2).all()
    import pyarrow as pa

    best.offer(np.array([2.0, 1.5, 0.1]), np.arange(3), pa.array(["a", "b", "c"]))
    assert best.floor == 1.5 and best.essential(2).tolist() == [True, False]
    best.offer(np.array([1.5, 1.5]), np.arange(2), pa.array(["aa", "zz"]))
    assert [d for _, d in best.kept] == ["a", "aa"]


def test_links_are_met_by_the_best_documents(spark):
    draw = random.Random(4)
    rows, df = made_rows(spark, draw, 200)
    linked = [d for d, *_ in rows if draw.random() < 0.08]
    links = [(d, f"c{draw.randrange(4)}") for d in linked for _ in range(draw.choice((1, 1, 5)))] + [(linked[0], f"many{k:03d}") for k in range(300)]
    asked = {0: {1: 2.0, 4: 0.5}, 1: {9: 1.0}, 2: {77: 1.0}}
    long = spark.createDataFrame([(q, t, w) for q, ws in asked.items() for t, w in ws.items()], "query_id int, term_id int, value double")
    table = spark.createDataFrame(links, "doc_id string, category string")
    for cosine in (False, True):
        scores = nearest.all_scores(df, nearest.Queries.of(long, cosine), cosine)
        want = similarity.knn_predict(table, scores, 9)
        got = similarity.predict(table, df, long, k=9, cosine=cosine)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count()
    assert similarity.predict(table.limit(0), df, long, k=9).count() == 0
    assert similarity.predict(table, df.limit(0), long, k=9).count() == 0


def test_row_scores_are_those_of_long_tables(spark):
    rows, df = made_rows(spark, random.Random(8), 60)
    weights = np.arange(10) - 4.5
    got = {r["doc_id"]: r["score"] for r in classify.row_scores(df, weights).collect()}
    assert got == pytest.approx({d: sum(v * weights[t] for t, v in zip(ts, vs) if t < 10) for d, ts, vs, _ in rows})
    points = classify.row_points(df, F.lit(1)).collect()
    assert {r["doc_id"]: (r["idx"], r["val"], r["label"]) for r in points} == {d: (ts, vs, 1.0) for d, ts, vs, _ in rows}


@pytest.mark.parametrize("size", (0, 1, 40, 41, 300, 999, 5000))
def test_vocabulary_cuts_ties_by_word(spark, size):
    draw = random.Random(1)
    counts = [(f"w{draw.randrange(10**9)}", draw.choice((1, 1, 1, 2, 2, 3, 50, draw.randint(1, 10**6)))) for _ in range(1000)]
    df = spark.createDataFrame(counts, "word string, cnt long").repartition(6)
    ranked = sorted(counts, key=lambda r: (-r[1], r[0]))[:size]
    found = vocab.vocabulary(df, size)
    assert found.dtypes == [("word", "string"), ("cnt", "bigint"), ("term_id", "int")]
    assert [tuple(r) for r in found.orderBy("term_id").collect()] == [(w, n, k) for k, (w, n) in enumerate(ranked)]

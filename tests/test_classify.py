import dataclasses
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import blocks, classify, evaluate, slices
from lodestat.plans import cases
from lodestat.sources.documents import class_label

TERMS = 6


@pytest.fixture(scope="module")
def points(spark):
    """Sparse random documents, a third of them positive."""
    rng = np.random.default_rng(5)
    x = rng.random((40, TERMS)) * (rng.random((40, TERMS)) < 0.5)
    x[:, 5] = 0.0
    ids = [f"{'AU' if i % 3 == 0 else ''}{i}" for i in range(40)]
    x[::3, 0] += 1.0
    rows = [(d, t, float(v)) for d, r in zip(ids, x) for t, v in enumerate(r) if v > 0]
    used = x.sum(axis=1) > 0
    positive = np.array(["AU" in d for d in ids])
    return x[used], positive[used], spark.createDataFrame(rows, "doc_id string, term_id int, value double")


def naive(x, y, cost, gradient, start, rate, max_iter, precision=0.1):
    w, old, steps = np.full(x.shape[1], start), 0.0, []
    for i in range(max_iter):
        c, g = cost(w, x, y), gradient(w, x, y)
        if i >= 1:
            rate = rate * 1.05 if c < old else rate * 0.5
        steps.append((i, c, rate))
        if abs(c - old) <= precision:
            return w, i, steps
        old = c
        w = w - rate * g
    return w, None, steps


def sums(values):
    return sum(values)


CASES = {
    "logistic": (
        0,
        lambda n, nr, pr: classify.logistic_objective(0.3),
        lambda w, x, y, n, nr, pr: sums(-yi * (w @ xi) + np.log(1 + np.exp(w @ xi)) for xi, yi in zip(x, y))
        + 0.3 * np.sqrt((w**2).sum()),
        lambda w, x, y, nr, pr: sums(-xi * yi + xi * np.exp(w @ xi) / (1 + np.exp(w @ xi)) for xi, yi in zip(x, y))
        + 2 * 0.3 * w,
        0.0,
        0.001,
    ),
    "hinge": (
        -1,
        lambda n, nr, pr: classify.hinge_objective(n, 7.0),
        lambda w, x, y, n, nr, pr: (w**2).sum() / (n * 7.0) / 2
        + sums(max(0, 1 - yi * (w @ xi)) for xi, yi in zip(x, y)),
        lambda w, x, y, nr, pr: sums(0 * xi if 1 - yi * (w @ xi) <= 0 else -7.0 * yi * xi for xi, yi in zip(x, y)),
        0.1,
        0.01,
    ),
    "weighted": (
        -1,
        lambda n, nr, pr: classify.weighted_hinge_objective(nr, pr),
        lambda w, x, y, n, nr, pr: sums(
            max(0, nr * (1 + yi) * (1 - yi * (w @ xi)) / 2 + pr * (1 - yi) * (1 - yi * (w @ xi)) / 2)
            for xi, yi in zip(x, y)
        ),
        lambda w, x, y, nr, pr: sums(
            0 * xi if yi * (w @ xi) > 1 else xi * (pr * (1 - yi) - nr * (1 + yi)) / 2 for xi, yi in zip(x, y)
        ),
        0.1,
        0.001,
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_training_follows_the_plain_loop(points, spark, name):
    x, positive, table = points
    negative, objective, cost, gradient, start, rate = CASES[name]
    y = np.where(positive, 1, negative)
    nr, pr = int((~positive).sum()), int(positive.sum())
    rows = classify.training_rows(table, class_label(F.col("doc_id"), negative=negative))
    want, stopped, steps = naive(
        x, y, lambda w, x, y: cost(w, x, y, 50, nr, pr), lambda w, x, y: gradient(w, x, y, nr, pr), start, rate, 25
    )
    model = classify.train(rows, TERMS, objective(50, nr, pr), max_iter=25)
    assert model.stopped_at == stopped and model.weights == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert [s[0] for s in model.steps] == [s[0] for s in steps]
    assert np.array(model.steps) == pytest.approx(np.array(steps), rel=1e-9)
    assert model.trace(spark).count() == len(steps) and model.weights_table(spark).count() == TERMS


def test_logistic_loss_is_stable():
    cost, slope = classify.logistic_objective().loss(np.array([1.0, 0.0]), np.array([-1e4, 1e4]))
    assert cost == pytest.approx([1e4, 1e4]) and slope == pytest.approx([-1.0, 1.0])


def test_boundary_scores(spark):
    scores = spark.createDataFrame([("a", 0.0), ("b", 0.1), ("c", -0.1)], "doc_id string, score double")
    assert [r["predicted"] for r in classify.logistic_predict(scores).collect()] == [0, 1, 0]
    assert [r["predicted"] for r in classify.margin_predict(scores).collect()] == [1, 1, -1]


@pytest.mark.parametrize("negative", [0, -1])
def test_confusion(spark, negative):
    rows = [("1", 1, 1)] * 3 + [("2", negative, 1)] * 2 + [("3", 1, negative)] + [("4", negative, negative)] * 4
    scored = spark.createDataFrame(rows, "doc_id string, label int, predicted int")
    assert tuple(evaluate.confusion_f1(scored).first()) == (3, 2, 1, 66.67)
    assert [r["doc_id"] for r in evaluate.false_positives(scored, 1).collect()] == ["2"]
    none = evaluate.confusion_f1(scored.filter("doc_id = '4'")).first()
    assert tuple(none) == (0, 0, 0, None)


def write_corpus(text_file, name, seed, n=40):
    rng = np.random.default_rng(seed)
    law, other, shared = "applicant court appeal mr".split(), "protein river music goal".split(), "the of and in".split()
    out = []
    for i in range(n):
        own = law if i % 3 == 0 else other
        words = [*rng.choice(own, 6), *rng.choice(shared, 10), *rng.choice(law + other, 1)]
        out.append(f'<doc id="{"AU" if i % 3 == 0 else ""}{i}" url="u" title="t">{" ".join(map(str, words))}</doc>')
    out.append('<doc id="999" url="u" title="t">1 2 3</doc>')  # a line without words: counted in N only
    return text_file(name, *out)


@pytest.fixture
def corpora(text_file):
    return write_corpus(text_file, "train.txt", 1), write_corpus(text_file, "test.txt", 2)


def test_logistic_job(spark, corpora):
    for source in ("test", "train"):
        done = cases.logistic(spark, *corpora, max_iter=8, idf_from=source)
        assert done.scored.count() == 40
    assert {r["word"] for r in done.top_words(4).collect()} == {"applicant", "court", "appeal", "mr"}
    found = done.confusion().first()
    assert found["tp"] == 14 and found["fn"] == 0
    assert done.false_positives().count() == min(3, found["fp"])


def test_lbfgs_job(spark, corpora):
    assert cases.lbfgs(spark, *corpora).confusion().first()["f1"] == 100.0


@pytest.mark.parametrize("weighted", [False, True])
def test_svm_jobs(spark, corpora, weighted):
    done = cases.svm(spark, *corpora, weighted=weighted)
    assert done.model.stopped_at is not None
    found = done.confusion().first()
    assert found["tp"] + found["fn"] == 14 and found["f1"] > 60


def test_mean_tf_job(spark, corpora):
    rows = {(r["class"], r["word"]): r["mean_tf"] for r in cases.mean_tf(spark, corpora[0], ["court", "river"]).collect()}
    assert rows[1, "court"] > rows[0, "court"] and rows[0, "river"] > rows[1, "river"]


def noisy_rows(spark, n=80, seed=12):
    """Rows that no weights separate: equal documents with different labels."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        counts = [draw.randint(0, 4) for _ in range(4)]
        used = [j for j, c in enumerate(counts) if c] or [0]
        vals = [counts[j] / max(1, sum(counts)) for j in used]
        rows += [(2 * k, draw.random() < 0.3 + 0.4 * (used[0] == 0), used, vals), (2 * k + 1, k % 2 == 0, used, vals)]
    rows = [(d, float(y), i, v) for d, y, i, v in rows]
    return rows, spark.createDataFrame(rows, "doc_id long, label double, idx array<int>, val array<double>")


def test_lbfgs_reaches_the_optimum(spark):
    rows, df = noisy_rows(spark)
    x, y = np.zeros((len(rows), 4)), np.array([r[1] for r in rows])
    for k, (_, _, idx, val) in enumerate(rows):
        x[k, idx] = val
    w = np.zeros(4)
    for _ in range(50):  # Newton
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.lstsq((x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y), rcond=None)[0]
    theta = x @ w
    best = float((np.logaddexp(0, theta) - y * theta).sum())
    model = classify.train_lbfgs(classify.vector_rows(df, 4))
    found = classify.certificate(df, model.coefficients.toArray()).first()
    assert found["optimal"] and found["n"] == len(rows) and found["cost"] == pytest.approx(best, rel=1e-5)
    assert not classify.certificate(df, np.zeros(4)).first()["optimal"]
    assert not classify.certificate(df, w + 0.5).first()["optimal"]
    predicted = classify.lbfgs_predict(model, classify.vector_rows(df, 4)).collect()
    assert {r["doc_id"]: r["predicted"] for r in predicted} == {d: int(t > 0) for (d, *_), t in zip(rows, theta)}
    assert any(r["label"] != r["predicted"] for r in predicted)  # one that returned the label would fail


def test_slices_add_up_like_vectors(spark):
    size, parts = 3 * slices.SLICE + 5, 7
    draws = [np.where(np.random.default_rng(k).random(size) < 0.01, k + 1.0, 0.0) for k in range(parts)]
    draws[0][-1] = 2.5

    def emit(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield from slices.packed(draws[k])

    packed = spark.range(0, parts, 1, parts).mapInArrow(emit, slices.SCHEMA)
    assert slices.vector(packed, size).tolist() == sum(draws).tolist()
    assert {r["place"]: r["total"] for r in slices.entries(packed).collect()} == {
        k: v for k, v in enumerate(sum(draws).tolist()) if v
    }
    assert packed.count() < parts * 4 + 1 and not slices.vector(packed.limit(0), size).any()


@pytest.mark.parametrize("weighted", [False, True])
def test_documents_without_cost_are_left_out(spark, weighted):
    """The course is that of all documents, though most passes read few of them."""
    draw = np.random.default_rng(8)
    rows = []
    for i, y in enumerate(draw.integers(0, 2, 300) * 2.0 - 1):
        # a word tells the sides apart, but for a few documents
        key = 40 + int(y < 0) if i % 100 else 40 + int(y > 0)
        terms = np.append(np.sort(draw.choice(40, 6, False)), key)
        val = draw.random(7) * 0.1 + (terms >= 40)
        rows.append((f"d{i}", float(y), terms.tolist(), (val / val.sum()).tolist()))
    frame = spark.createDataFrame(rows, "doc_id string, label double, idx array<int>, val array<double>").repartition(3)
    objective = classify.weighted_hinge_objective(150, 150) if weighted else classify.hinge_objective(300)
    made = classify.train(frame, 42, objective, max_iter=60, precision=1e-9)
    plain = classify.train(frame, 42, dataclasses.replace(objective, flat=None), max_iter=60, precision=1e-9)
    assert plain.whole_passes == len(plain.steps) == len(made.steps) and made.whole_passes < 0.7 * len(made.steps)
    assert made.weights == pytest.approx(plain.weights)
    assert [s[1:] for s in made.steps] == [pytest.approx(s[1:]) for s in plain.steps]


def test_documents_far_from_reach_have_no_cost():
    draw = np.random.default_rng(9)
    sizes = draw.integers(0, 9, 400)
    idx, val = draw.integers(0, 30, sizes.sum()), draw.normal(size=sizes.sum())
    y, w = draw.integers(0, 2, 400) * 2.0 - 1, draw.normal(size=30)

    def theta(weights):
        return blocks.row_sums(val * weights[idx], sizes)

    reach = classify.Reach.ahead(1.0, w, 0.02 * draw.normal(size=30))
    near = reach.near(y, theta(w), sizes, val)
    assert 0 < near.sum() < 400 and near[y * theta(w) <= 1].all()
    for _ in range(200):
        way = draw.normal(size=30) * (draw.random(30) < draw.random())
        way *= min(reach.most / max(np.abs(way).max(), 1e-9), reach.length / max(np.linalg.norm(way), 1e-9)) * (1 - 1e-9)
        assert reach.holds(w + way) and (y * theta(w + way) > 1)[~near].all()
    assert not reach.holds(w + 2 * reach.most)

"""Binary classification of documents; the positive class is marked in the ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from catalog.inputs import labelled_documents, table
from catalog.text import LETTERS_SQL, VOCAB_SQL, letters_vocabulary
from catalog.vectors import LABELLED_TOKENS_SQL, letters_rows, n_docs, rounded
from lodestat.operators import classify, doc_rows, evaluate, vectors, vocab
from lodestat.session import materialize, store
from lodestat.sources.documents import class_label


def _label():
    return class_label(F.col("doc_id"))


def _side():
    return class_label(F.col("doc_id"), negative=-1)


def _terms(spark, sf_dir):
    """Labelled documents as term rows, and their vocabulary."""
    return letters_rows(spark, sf_dir, labelled_documents(spark, sf_dir))


def _tfidf(spark, sf_dir):
    """TF-IDF rows, the vocabulary, and its size."""
    rows, words = _terms(spark, sf_dir)
    rows = store(rows, "term-rows")
    weights = vectors.idf(doc_rows.document_frequency(rows), n_docs(spark, sf_dir))
    return doc_rows.vector_rows(rows, weights), words, words.count()


def _tf(spark, sf_dir):
    """Term frequency rows, the vocabulary, and its size."""
    rows, words = _terms(spark, sf_dir)
    return doc_rows.frequency_rows(rows), words, words.count()


def _dense(words, totals, places=7):
    """Totals of all positions, 0 where no document adds anything, and the cost."""
    terms = words.select("term_id").unionByName(
        words.sparkSession.range(1).select(F.lit(classify.COST_ROW).alias("term_id"))
    )
    full = terms.join(totals, "term_id", "left").select("term_id", F.coalesce("total", F.lit(0.0)).alias("total"))
    return rounded(full, places, "total")


def _sample_weights(size):
    """Uneven weights of both signs that bring scores of either side of zero."""
    return 40.0 * ((np.arange(size) * 7919) % 10007 / 10007.0 - 0.5)


SAMPLE_WEIGHT_SQL = "40.0::DOUBLE * ((term_id * 7919) % 10007 / 10007.0::DOUBLE - 0.5)"


def class_counts(spark, sf_dir):
    docs = labelled_documents(spark, sf_dir)
    return evaluate.class_counts(docs.select(_side().alias("label")))


def logreg_step(spark, sf_dir):
    """Cost (term -1) and gradient of the logistic loss, without penalty, at the sample weights."""
    found, words, size = _tfidf(spark, sf_dir)
    shared = classify.share_weights(spark, _sample_weights(size))
    return _dense(words, classify.loss_pass(classify.row_points(found, _label()), shared, classify.logistic_objective().loss))


def hinge_step(spark, sf_dir):
    """Cost and gradient of the hinge loss at the sample weights."""
    found, words, size = _tf(spark, sf_dir)
    shared = classify.share_weights(spark, _sample_weights(size))
    return _dense(words, classify.loss_pass(classify.row_points(found, _side()), shared, classify.hinge_objective(1).loss))


def _class_sizes(rows):
    sizes = {r["label"]: r["n"] for r in evaluate.class_counts(rows).collect()}
    return sizes.get(-1.0, 0), sizes.get(1.0, 0)


def weighted_hinge_step(spark, sf_dir):
    """Cost and gradient of the class-weighted hinge loss at its start weights."""
    found, words, size = _tf(spark, sf_dir)
    rows = classify.lay_out(classify.row_points(found, _side()))
    objective = classify.weighted_hinge_objective(*_class_sizes(rows))
    shared = classify.share_weights(spark, np.full(size, objective.start))
    return _dense(words, classify.loss_pass(rows, shared, objective.loss), 3)


def logreg_train(spark, sf_dir):
    found, _, size = _tfidf(spark, sf_dir)
    rows = classify.lay_out(classify.row_points(found, _label()))
    return rounded(classify.train(rows, size, classify.logistic_objective()).weights_table(spark), 6, "weight")


def svm_train(spark, sf_dir):
    found, _, size = _tf(spark, sf_dir)
    rows = classify.lay_out(classify.row_points(found, _side()))
    lines = vocab.corpus_count(labelled_documents(spark, sf_dir)).first()["n"]
    return rounded(classify.train(rows, size, classify.hinge_objective(lines)).weights_table(spark), 6, "weight")


def weighted_svm_train(spark, sf_dir):
    found, _, size = _tf(spark, sf_dir)
    rows = classify.lay_out(classify.row_points(found, _side()))
    objective = classify.weighted_hinge_objective(*_class_sizes(rows))
    return rounded(classify.train(rows, size, objective).weights_table(spark), 6, "weight")


def logreg_lbfgs(spark, sf_dir):
    """Classes that the L-BFGS model, trained on all documents, gives them."""
    found, _, size = _tf(spark, sf_dir)
    points = classify.vector_rows(classify.row_points(found, _label()), size)
    return classify.lbfgs_predict(classify.train_lbfgs(points), points)


FEW_TERMS = 8


def lbfgs_certificate(spark, sf_dir):
    """Cost of the L-BFGS model on rows that no weights separate, and whether its gradient vanishes there.

    The most frequent words alone count, and ids of both parities are to be told apart.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = doc_rows.word_rows(docs)
    words = materialize(vocab.vocabulary(doc_rows.word_count(counted), FEW_TERMS))
    found = doc_rows.frequency_rows(doc_rows.term_rows(counted, words, FEW_TERMS))
    rows = classify.lay_out(classify.row_points(found, F.col("doc_id") % 2))
    model = classify.train_lbfgs(classify.vector_rows(rows, words.count()))
    return rounded(classify.certificate(rows, model.coefficients.toArray()), 4, "cost")


def _sample_table(words):
    weight = F.lit(40.0) * (F.col("term_id") * 7919 % 10007 / 10007.0 - 0.5)
    return words.select("term_id", weight.alias("weight"))


def _logreg_scored(spark, sf_dir):
    found, _, size = _tfidf(spark, sf_dir)
    return classify.logistic_predict(classify.row_scores(found, _sample_weights(size))).withColumn("label", _label())


def logreg_score(spark, sf_dir):
    return rounded(_logreg_scored(spark, sf_dir), 8, "score")


def svm_score(spark, sf_dir):
    found, _, size = _tf(spark, sf_dir)
    scores = classify.row_scores(found, _sample_weights(size))
    return rounded(classify.margin_predict(scores).withColumn("label", _side()), 8, "score")


def top_coefficients(spark, sf_dir):
    words = materialize(letters_vocabulary(spark, sf_dir))
    return rounded(classify.top_coefficients(_sample_table(words), words, 5), 8, "weight")


def confusion_f1(spark, sf_dir):
    return evaluate.confusion_f1(_logreg_scored(spark, sf_dir))


def false_positives(spark, sf_dir):
    return evaluate.false_positives(_logreg_scored(spark, sf_dir), 3)


QUERIES = {
    "class_counts": class_counts,
    "logreg_step": logreg_step,
    "hinge_step": hinge_step,
    "weighted_hinge_step": weighted_hinge_step,
    "logreg_train": logreg_train,
    "logreg_score": logreg_score,
    "logreg_lbfgs": logreg_lbfgs,
    "lbfgs_certificate": lbfgs_certificate,
    "svm_train": svm_train,
    "svm_score": svm_score,
    "weighted_svm_train": weighted_svm_train,
    "top_coefficients": top_coefficients,
    "confusion_f1": confusion_f1,
    "false_positives": false_positives,
}

MODEL_SQL = f"""{LABELLED_TOKENS_SQL}, {VOCAB_SQL},
counts AS (SELECT doc_id, term_id, count(*) AS cnt FROM tok JOIN vocab USING (word) GROUP BY doc_id, term_id),
tf AS (SELECT doc_id, term_id, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS x FROM counts),
df AS (SELECT term_id, count(DISTINCT doc_id) AS df FROM counts GROUP BY term_id),
tfidf AS (SELECT doc_id, term_id, x * ln((SELECT count(*) FROM documents) / df) AS x FROM tf JOIN df USING (term_id)),
w AS (SELECT term_id, {SAMPLE_WEIGHT_SQL} AS weight FROM vocab),
sides AS (SELECT doc_id, CASE WHEN contains(doc_id, 'AU') THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y
  FROM (SELECT DISTINCT doc_id FROM tf)),
sizes AS (SELECT count(*) FILTER (y < 0) AS nr, count(*) FILTER (y > 0) AS pr FROM sides)
"""


def _step_sql(values: str, weights: str, loss: str, places: int = 7) -> str:
    return f"""WITH {MODEL_SQL},
margins AS (SELECT doc_id, sum(x * weight) AS theta FROM {values} JOIN {weights} USING (term_id) GROUP BY doc_id),
losses AS (SELECT doc_id, {loss} FROM margins JOIN sides USING (doc_id), sizes),
gradient AS (SELECT term_id, sum(x * slope) AS total FROM {values} JOIN losses USING (doc_id) GROUP BY term_id)
SELECT term_id, round(coalesce(total, 0), {places}) + 0.0 AS total FROM vocab LEFT JOIN gradient USING (term_id)
UNION ALL SELECT -1, round(sum(cost), {places}) FROM losses"""


def _train_sql(values: str, start: float, rate: float, loss: str, penalty: str = "0 * count(*)", shrink: str = "0") -> str:
    """The whole descent: a step per recursion, with one row per term, until the cost settles.

    ``penalty`` is an aggregate of the weights ``w`` in the cost, ``shrink`` its part of the gradient.
    """
    step = "CASE WHEN i = 0 THEN rate WHEN total.cost < last THEN rate * 1.05 ELSE rate * 0.5 END"
    return f"""WITH RECURSIVE {MODEL_SQL},
entries AS MATERIALIZED (SELECT doc_id, term_id, x FROM {values}),
places AS MATERIALIZED (SELECT term_id FROM vocab),
known AS MATERIALIZED (SELECT doc_id, y, nr, pr, (SELECT count(*) FROM documents) AS n FROM sides, sizes),
walk(i, term_id, w, rate, last, done) AS (
  SELECT 0, term_id, {start}::DOUBLE, {rate}::DOUBLE, 0::DOUBLE, false FROM places
  UNION ALL (
  WITH margins AS (SELECT doc_id, sum(x * w) AS theta FROM entries JOIN walk USING (term_id) WHERE NOT done GROUP BY doc_id),
  losses AS (SELECT doc_id, {loss} FROM margins JOIN known USING (doc_id)),
  gradient AS (SELECT term_id, sum(x * slope) AS g FROM entries JOIN losses USING (doc_id) GROUP BY term_id),
  total AS (SELECT (SELECT sum(cost) FROM losses)
    + (SELECT {penalty} FROM walk, (SELECT any_value(n) AS n FROM known) WHERE NOT done) AS cost)
  SELECT i + 1, walk.term_id,
    CASE WHEN abs(total.cost - last) <= 0.1 THEN w ELSE w - ({step}) * (coalesce(g, 0) + {shrink}) END,
    {step}, total.cost, abs(total.cost - last) <= 0.1
  FROM walk LEFT JOIN gradient USING (term_id), total WHERE NOT walk.done))
SELECT term_id, round(w, 6) + 0.0 AS weight FROM walk WHERE done"""


LOGISTIC_LOSS_SQL = """greatest(theta, 0) + ln(1 + exp(-abs(theta))) - CASE WHEN y > 0 THEN theta ELSE 0 END AS cost,
  1 / (1 + exp(-theta)) - CASE WHEN y > 0 THEN 1 ELSE 0 END AS slope"""
HINGE_LOSS_SQL = """greatest(0, 1 - y * theta) AS cost, CASE WHEN 1 - y * theta > 0 THEN -100 * y ELSE 0 END AS slope"""
WEIGHTED_LOSS_SQL = """greatest(0, nr * (1 + y) * (1 - y * theta) / 2 + pr * (1 - y) * (1 - y * theta) / 2) AS cost,
  CASE WHEN y * theta > 1 THEN 0 ELSE (pr * (1 - y) - nr * (1 + y)) / 2 END AS slope"""

SCORED_SQL = f"""{MODEL_SQL},
scores AS (SELECT doc_id, sum(x * weight) AS score FROM tfidf JOIN w USING (term_id) GROUP BY doc_id),
scored AS (SELECT doc_id, score, CASE WHEN score > 0 THEN 1 ELSE 0 END AS predicted,
  CASE WHEN contains(doc_id, 'AU') THEN 1 ELSE 0 END AS label FROM scores),
confusion AS (SELECT count(*) FILTER (label = 1 AND predicted = 1) AS tp,
  count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn FROM scored)
"""

# The optimum by steps that a bound of the curvature at each term allows, until they stand still.
OPTIMUM_SQL = f"""WITH RECURSIVE {LETTERS_SQL}, {VOCAB_SQL},
counts AS (SELECT doc_id, term_id, count(*) AS cnt FROM tok JOIN vocab USING (word) WHERE term_id < {FEW_TERMS} GROUP BY ALL),
entries AS MATERIALIZED (SELECT doc_id, term_id, doc_id % 2 AS y, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS x FROM counts),
bends AS MATERIALIZED (SELECT term_id, sum(x) / 4 AS bend FROM entries GROUP BY term_id),
walk(i, term_id, w, step) AS (
  SELECT 0, term_id, 0::DOUBLE, 1::DOUBLE FROM bends
  UNION ALL (
  WITH slopes AS (SELECT doc_id, 1 / (1 + exp(-sum(x * w))) - any_value(y) AS slope
    FROM entries JOIN walk USING (term_id) GROUP BY doc_id),
  moves AS (SELECT term_id, sum(x * slope) / any_value(bend) AS move
    FROM entries JOIN slopes USING (doc_id) JOIN bends USING (term_id) GROUP BY term_id)
  SELECT i + 1, term_id, w - move, max(abs(move)) OVER () FROM walk JOIN moves USING (term_id)
  WHERE step > 1e-9 AND i < 5000)),
thetas AS (SELECT doc_id, any_value(y) AS y, sum(x * w) AS theta FROM entries
  JOIN (SELECT * FROM walk QUALIFY i = max(i) OVER ()) USING (term_id) GROUP BY doc_id)
SELECT count(*) AS n, round(sum(greatest(theta, 0) + ln(1 + exp(-abs(theta))) - y * theta), 4) + 0.0 AS cost, true AS optimal
FROM thetas"""

ORACLES = {
    "lbfgs_certificate": OPTIMUM_SQL,
    "class_counts": """SELECT CASE WHEN lang = 'de' THEN 1 ELSE -1 END AS label, count(*) AS n
        FROM documents GROUP BY 1""",
    "logreg_step": _step_sql("tfidf", "w", LOGISTIC_LOSS_SQL),
    "hinge_step": _step_sql("tf", "w", HINGE_LOSS_SQL),
    "weighted_hinge_step": _step_sql("tf", "(SELECT term_id, 0.1::DOUBLE AS weight FROM vocab)", WEIGHTED_LOSS_SQL, 3),
    "logreg_train": _train_sql(
        "tfidf", 0, 0.001, LOGISTIC_LOSS_SQL, "0.005::DOUBLE * sqrt(sum(w * w))", "2 * 0.005::DOUBLE * w"
    ),
    "svm_train": _train_sql("tf", 0.1, 0.01, HINGE_LOSS_SQL, "sum(w * w) / (2.0::DOUBLE * any_value(n) * 100)"),
    "weighted_svm_train": _train_sql("tf", 0.1, 0.001, WEIGHTED_LOSS_SQL),
    "logreg_score": f"WITH {SCORED_SQL} SELECT doc_id, round(score, 8) + 0.0 AS score, predicted, label FROM scored",
    "svm_score": f"""WITH {MODEL_SQL},
        scores AS (SELECT doc_id, sum(x * weight) AS score FROM tf JOIN w USING (term_id) GROUP BY doc_id)
        SELECT doc_id, round(score, 8) + 0.0 AS score, CASE WHEN score >= 0 THEN 1 ELSE -1 END AS predicted,
          CASE WHEN contains(doc_id, 'AU') THEN 1 ELSE -1 END AS label FROM scores""",
    "top_coefficients": f"""WITH {MODEL_SQL} SELECT word, term_id, round(weight, 8) + 0.0 AS weight
        FROM vocab JOIN w USING (term_id) ORDER BY w.weight DESC, term_id LIMIT 5""",
    "confusion_f1": f"""WITH {SCORED_SQL} SELECT tp, fp, fn,
        floor(CASE WHEN tp + fp + fn > 0 THEN tp / (tp + 0.5 * (fp + fn)) END * 100 * 100 + 0.5) / 100 AS f1
        FROM confusion""",
    # the optimum separates the training documents, so each gets its own class
    "logreg_lbfgs": f"""WITH {MODEL_SQL} SELECT doc_id, CASE WHEN y > 0 THEN 1 ELSE 0 END AS label,
        CASE WHEN y > 0 THEN 1 ELSE 0 END AS predicted FROM sides""",
    "false_positives": f"""WITH {SCORED_SQL}
        SELECT doc_id FROM scored WHERE label = 0 AND predicted = 1 ORDER BY doc_id LIMIT 3""",
}

"""Mixture of word counts over posts, and clusters against real categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.text import post_dictionary, posts
from catalog.vectors import POST_TERMS_SQL, post_terms, rounded
from lodestat.operators import clusters, doc_rows, mixture
from lodestat.operators.vocab import VOCABULARY_SIZE
from lodestat.session import materialize, store

K = mixture.CLUSTERS
SWEEPS = mixture.SWEEPS
SEED = 7


def _number(doc_id):
    return F.regexp_extract(doc_id, "([0-9]+)$", 1).cast("bigint")


def assigned(spark, sf_dir):
    """All posts with a cluster fixed by their number."""
    return posts(spark, sf_dir).select(
        "doc_id", "category", (_number(F.col("doc_id")) % K).cast("int").alias("cluster")
    )


def cluster_doc_counts(spark, sf_dir):
    return clusters.cluster_doc_counts(assigned(spark, sf_dir))


def cluster_category_share(spark, sf_dir):
    return rounded(clusters.cluster_category_share(assigned(spark, sf_dir)), 6, "pct")


def cluster_top_categories(spark, sf_dir):
    """Categories of clusters that cut across them: sources by day of a week of posts."""
    mixed = assigned(spark, sf_dir).withColumn("cluster", (_number(F.col("doc_id")) % 7).cast("int"))
    return rounded(clusters.cluster_top_categories(clusters.cluster_category_share(mixed), 3), 6, "pct")


def _term_counts(spark, sf_dir, words, counts=None):
    known = counts or post_terms(spark, sf_dir, words)
    return clusters.cluster_term_counts(known, assigned(spark, sf_dir), words, K, VOCABULARY_SIZE)


def cluster_term_counts(spark, sf_dir):
    return _term_counts(spark, sf_dir, materialize(post_dictionary(spark, sf_dir)))


def mixture_posterior(spark, sf_dir):
    """Posterior of every post under the parameters that the fixed clusters imply."""
    words = materialize(post_dictionary(spark, sf_dir))
    counts = store(post_terms(spark, sf_dir, words), "counts")
    log_mu = mixture.smoothed_mu(_term_counts(spark, sf_dir, words, counts))
    log_pi = mixture.smoothed_pi(cluster_doc_counts(spark, sf_dir))
    probs = mixture.mixture_posterior(posts(spark, sf_dir), counts, log_pi, materialize(log_mu))
    return rounded(probs, 5, "prob")


def mixture_top_words(spark, sf_dir):
    words = materialize(post_dictionary(spark, sf_dir))
    log_mu = mixture.smoothed_mu(_term_counts(spark, sf_dir, words))
    return rounded(mixture.mixture_top_words(log_mu, words, 50), 8, "log_mu")


def _rows(spark, sf_dir, words):
    """All posts as rows of counts."""
    counted = doc_rows.word_rows(posts(spark, sf_dir), doc_rows.edge_trimmed, "body")
    return mixture.count_rows(doc_rows.term_rows(counted, words, keep_empty=True))


def mixture_gibbs(spark, sf_dir):
    """Clusters of all posts after all sweeps."""
    words = materialize(post_dictionary(spark, sf_dir))
    return mixture.mixture_gibbs(_rows(spark, sf_dir, words), words.count(), K, sweeps=SWEEPS, seed=SEED).assigned


def _sweep(spark, sf_dir):
    """Posts and shared parameters of one sweep: those that the fixed clusters imply."""
    words = materialize(post_dictionary(spark, sf_dir))
    rows = store(_rows(spark, sf_dir, words), "post-rows")
    long = rows.select("doc_id", F.inline(F.arrays_zip("idx", "cnt")).alias("term_id", "cnt"))
    log_mu = mixture.smoothed_mu(_term_counts(spark, sf_dir, words, long))
    log_pi = mixture.smoothed_pi(cluster_doc_counts(spark, sf_dir))
    return rows, mixture.share_parameters(spark, mixture.parameters_of(log_pi, log_mu, K, words.count()))


def mixture_sweep_assigned(spark, sf_dir):
    """Clusters that one sweep draws for all posts."""
    return mixture.assign(*_sweep(spark, sf_dir), SEED, 0)


def mixture_sweep_counts(spark, sf_dir):
    """Words per cluster and term after that sweep, and posts per cluster (term -1)."""
    return mixture.sweep_counts(*_sweep(spark, sf_dir), SEED, 0)


def mixture_sweep_report(spark, sf_dir):
    """The three most frequent categories of each cluster that the sweep draws."""
    drawn = mixture_sweep_assigned(spark, sf_dir).join(posts(spark, sf_dir).select("doc_id", "category"), "doc_id")
    return rounded(clusters.cluster_top_categories(clusters.cluster_category_share(drawn), 3), 6, "pct")


QUERIES = {
    "mixture_posterior": mixture_posterior,
    "cluster_term_counts": cluster_term_counts,
    "cluster_doc_counts": cluster_doc_counts,
    "cluster_category_share": cluster_category_share,
    "cluster_top_categories": cluster_top_categories,
    "mixture_top_words": mixture_top_words,
    "mixture_gibbs": mixture_gibbs,
    "mixture_sweep_assigned": mixture_sweep_assigned,
    "mixture_sweep_counts": mixture_sweep_counts,
    "mixture_sweep_report": mixture_sweep_report,
}

ASSIGNED_SQL = """
assigned AS (SELECT 'posts/' || source || '/' || doc_id AS doc_id, source AS category,
  CAST(doc_id % 20 AS INTEGER) AS cluster, CAST(doc_id % 7 AS INTEGER) AS day FROM documents)
"""
SHARE_SQL = """
shares AS (SELECT {c} AS cluster, category, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY {c}) * 100 AS pct FROM assigned GROUP BY {c}, category)
"""
PARAMETERS_SQL = f"""{POST_TERMS_SQL}, {ASSIGNED_SQL},
found AS (SELECT cluster, term_id, sum(cnt) AS cnt FROM counts JOIN assigned USING (doc_id) GROUP BY cluster, term_id),
scaffold AS (SELECT cluster, term_id FROM vocab, (SELECT unnest(range(20))::INTEGER AS cluster)),
term_counts AS (SELECT cluster, term_id, CAST(coalesce(cnt, 0) AS BIGINT) AS cnt
  FROM scaffold LEFT JOIN found USING (cluster, term_id)),
mu AS (SELECT cluster, term_id, ln((cnt + 0.1::DOUBLE)
  / (sum(cnt) OVER (PARTITION BY cluster) + count(*) OVER (PARTITION BY cluster) * 0.1::DOUBLE)) AS log_mu
  FROM term_counts),
pi AS (SELECT cluster, ln((count(*) + 0.1::DOUBLE) / ((SELECT count(*) FROM assigned) + 20 * 0.1::DOUBLE)) AS log_pi
  FROM assigned GROUP BY cluster)
"""
# One draw per post: the first 52 bits of an MD5 of seed, sweep and id, against the running sum of weights.
SWEEP_SQL = f"""{PARAMETERS_SQL},
sums AS (SELECT doc_id, cluster, sum(cnt * log_mu) AS ll FROM counts JOIN mu USING (term_id) GROUP BY doc_id, cluster),
logp AS (SELECT a.doc_id, pi.cluster, log_pi + coalesce(ll, 0) AS s FROM assigned a CROSS JOIN pi
  LEFT JOIN sums ON sums.doc_id = a.doc_id AND sums.cluster = pi.cluster),
weights AS (SELECT doc_id, cluster, exp(s - max(s) OVER (PARTITION BY doc_id)) AS weight FROM logp),
steps AS (SELECT doc_id, sum(weight) OVER (PARTITION BY doc_id ORDER BY cluster) AS step,
  sum(weight) OVER (PARTITION BY doc_id)
  * (('0x' || substr(md5('{SEED}:0:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) AS mark FROM weights),
drawn AS (SELECT doc_id, CAST(least(count(*) FILTER (step <= mark), {K - 1}) AS INTEGER) AS cluster FROM steps GROUP BY doc_id)
"""

ORACLES = {
    "mixture_sweep_report": f"""WITH {SWEEP_SQL},
        shares AS (SELECT cluster, category, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY cluster) * 100 AS pct
          FROM drawn JOIN (SELECT doc_id, category FROM assigned) USING (doc_id) GROUP BY cluster, category),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, category) AS INTEGER) AS rank
          FROM shares)
        SELECT cluster, category, n, round(pct, 6) AS pct, rank FROM ranked WHERE rank <= 3""",
    "mixture_sweep_assigned": f"WITH {SWEEP_SQL} SELECT doc_id, cluster FROM drawn",
    "mixture_sweep_counts": f"""WITH {SWEEP_SQL}
        SELECT cluster, term_id, CAST(sum(cnt) AS BIGINT) AS cnt FROM counts JOIN drawn USING (doc_id) GROUP BY cluster, term_id
        UNION ALL SELECT cluster, -1, count(*) FROM drawn GROUP BY cluster""",
    "mixture_posterior": f"""WITH {PARAMETERS_SQL},
        sums AS (SELECT doc_id, cluster, sum(cnt * log_mu) AS ll FROM counts JOIN mu USING (term_id)
          GROUP BY doc_id, cluster),
        logp AS (SELECT a.doc_id, pi.cluster, log_pi + coalesce(ll, 0) AS s FROM assigned a CROSS JOIN pi
          LEFT JOIN sums ON sums.doc_id = a.doc_id AND sums.cluster = pi.cluster),
        e AS (SELECT doc_id, cluster, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM logp)
        SELECT doc_id, cluster, round(e / sum(e) OVER (PARTITION BY doc_id), 5) AS prob FROM e""",
    "cluster_term_counts": f"WITH {PARAMETERS_SQL} SELECT cluster, term_id, cnt FROM term_counts",
    "cluster_doc_counts": f"WITH {ASSIGNED_SQL} SELECT cluster, count(*) AS n FROM assigned GROUP BY cluster",
    "cluster_category_share": f"""WITH {ASSIGNED_SQL}, {SHARE_SQL.format(c="cluster")}
        SELECT cluster, category, n, round(pct, 6) AS pct FROM shares""",
    "cluster_top_categories": f"""WITH {ASSIGNED_SQL}, {SHARE_SQL.format(c="day")},
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, category) AS INTEGER) AS rank
          FROM shares)
        SELECT cluster, category, n, round(pct, 6) AS pct, rank FROM ranked WHERE rank <= 3""",
    "mixture_top_words": f"""WITH {PARAMETERS_SQL},
        ranked AS (SELECT cluster, word, log_mu, CAST(row_number() OVER (PARTITION BY cluster
          ORDER BY log_mu DESC, term_id) AS INTEGER) AS rank FROM mu JOIN vocab USING (term_id))
        SELECT cluster, rank, word, round(log_mu, 8) AS log_mu FROM ranked WHERE rank <= 50""",
}

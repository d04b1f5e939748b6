"""Document vectors, similarity and category prediction."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import documents, labelled_documents, links, table
from catalog.text import LETTERS_SQL, STRIP_SQL, TRIM_SQL, VOCAB_SQL, letters_vocabulary, post_dictionary, posts
from lodestat.functions.text import tokens_edge_trim, tokens_letters
from lodestat.operators import doc_rows, nearest, similarity, vectors, vocab
from lodestat.session import materialize, store
from lodestat.sources.documents import class_label

QUERY_TEXTS = ("The tion of and", "der die und zzzzzz", "que la en ou: que?")
PROBE_WORDS = ("the", "der", "que", "tion", "of", "zzzzzz")
NEAREST = 10


def n_docs(spark, sf_dir):
    return vocab.corpus_count(table(spark, sf_dir, "documents")).scalar()


def letters_rows(spark, sf_dir, docs=None):
    """Documents as rows of vocabulary terms, and the vocabulary; texts are split once."""
    counted = doc_rows.word_rows(documents(spark, sf_dir) if docs is None else docs)
    words = materialize(vocab.vocabulary(doc_rows.word_count(counted)))
    return doc_rows.term_rows(counted, words), words


def post_rows(spark, sf_dir, dictionary=None):
    known = dictionary or post_dictionary(spark, sf_dir)
    return doc_rows.term_rows(doc_rows.word_rows(posts(spark, sf_dir), doc_rows.edge_trimmed, "body"), known)


def post_terms(spark, sf_dir, dictionary=None):
    return doc_rows.counts(post_rows(spark, sf_dir, dictionary))


def letters_idf(spark, sf_dir, rows):
    return vectors.idf(doc_rows.document_frequency(rows), n_docs(spark, sf_dir))


def letters_vectors(spark, sf_dir, binary=False):
    """Vector rows, kept, with their vocabulary and IDF."""
    rows, words = letters_rows(spark, sf_dir)
    rows = store(rows, "term-rows")
    weights = materialize(letters_idf(spark, sf_dir, rows))
    return store(doc_rows.vector_rows(rows, weights, binary), "vector-rows"), words, weights


def letters_tfidf(spark, sf_dir):
    return doc_rows.vectors(letters_vectors(spark, sf_dir)[0])


def rounded(df, places=9, *columns):
    """Cut the last digits, which depend on the order of additions; no negative zeros."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


def term_frequency(spark, sf_dir):
    return doc_rows.term_frequency(letters_rows(spark, sf_dir)[0])


def term_frequency_binary(spark, sf_dir):
    return doc_rows.term_frequency(letters_rows(spark, sf_dir)[0], binary=True)


def document_frequency(spark, sf_dir):
    return doc_rows.document_frequency(letters_rows(spark, sf_dir)[0])


def idf(spark, sf_dir):
    return rounded(letters_idf(spark, sf_dir, letters_rows(spark, sf_dir)[0]), 9, "idf")


def idf_guarded(spark, sf_dir):
    """Vocabulary of the documents, IDF of the conversations: each message is a document."""
    talk = table(spark, sf_dir, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("doc_id"), "text")
    words = materialize(letters_vocabulary(spark, sf_dir))
    counts = vectors.doc_term_counts(tokens_letters(talk), words)
    messages = vocab.corpus_count(table(spark, sf_dir, "conversations")).scalar()
    return rounded(vectors.idf_guarded(words, vectors.document_frequency(counts), messages), 9, "idf")


def tfidf(spark, sf_dir):
    return rounded(letters_tfidf(spark, sf_dir), 9, "value")


def vector_sum(spark, sf_dir):
    return rounded(vectors.vector_sum(table(spark, sf_dir, "embeddings"), "label", "embedding"), 6, "total")


def term_sum(spark, sf_dir):
    """Elementwise sum of all TF-IDF vectors."""
    return rounded(vectors.term_sum(letters_tfidf(spark, sf_dir)), 8, "total")


def mean_tf_by_class(spark, sf_dir):
    rows, words = letters_rows(spark, sf_dir, labelled_documents(spark, sf_dir))
    means = doc_rows.mean_tf_by_class(rows, words, PROBE_WORDS, class_label(F.col("doc_id")))
    return rounded(means, 9, "mean_tf")


def doc_term_counts(spark, sf_dir):
    return post_terms(spark, sf_dir)


def doc_term_map(spark, sf_dir):
    """Maps written as ``position:count`` lists, in order of position."""
    maps = doc_rows.term_map(post_rows(spark, sf_dir))
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return maps.select("doc_id", F.array_join(entries, ",").alias("counts"), "total")


def doc_top_terms(spark, sf_dir):
    words = materialize(post_dictionary(spark, sf_dir))
    chosen = F.col("doc_id").contains("src0/0")
    return vectors.doc_top_terms(post_terms(spark, sf_dir, words), words, chosen, 100)


def category_features(spark, sf_dir):
    return rounded(similarity.category_features(links(spark, sf_dir), letters_tfidf(spark, sf_dir)), 9, "value")


def _asked(spark, sf_dir, cosine):
    rows, words, weights = letters_vectors(spark, sf_dir, binary=cosine)
    return rows, similarity.query_vectors(spark, QUERY_TEXTS, words, weights, binary=cosine)


def _scores(spark, sf_dir, cosine):
    rows, asked = _asked(spark, sf_dir, cosine)
    return nearest.all_scores(rows, nearest.Queries.of(asked, cosine), cosine)


def similarity_scores(spark, sf_dir):
    return rounded(_scores(spark, sf_dir, cosine=False), 9, "score")


def similarity_cosine(spark, sf_dir):
    return rounded(_scores(spark, sf_dir, cosine=True), 9, "score")


def knn_predict_dot(spark, sf_dir):
    rows, asked = _asked(spark, sf_dir, cosine=False)
    return similarity.predict(links(spark, sf_dir), rows, asked, k=NEAREST)


def knn_predict_cosine(spark, sf_dir):
    rows, asked = _asked(spark, sf_dir, cosine=True)
    return similarity.predict(links(spark, sf_dir), rows, asked, k=NEAREST, cosine=True)


QUERIES = {
    "term_frequency": term_frequency,
    "term_frequency_binary": term_frequency_binary,
    "document_frequency": document_frequency,
    "idf": idf,
    "idf_guarded": idf_guarded,
    "tfidf": tfidf,
    "vector_sum": vector_sum,
    "term_sum": term_sum,
    "mean_tf_by_class": mean_tf_by_class,
    "doc_term_counts": doc_term_counts,
    "doc_term_map": doc_term_map,
    "doc_top_terms": doc_top_terms,
    "category_features": category_features,
    "similarity_scores": similarity_scores,
    "similarity_cosine": similarity_cosine,
    "knn_predict_dot": knn_predict_dot,
    "knn_predict_cosine": knn_predict_cosine,
}

TERMS_SQL = f"""{LETTERS_SQL}, {VOCAB_SQL},
counts AS (SELECT doc_id, term_id, count(*) AS cnt FROM tok JOIN vocab USING (word) GROUP BY doc_id, term_id),
tf AS (SELECT doc_id, term_id, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM counts),
df AS (SELECT term_id, count(DISTINCT doc_id) AS df FROM counts GROUP BY term_id),
idf AS (SELECT term_id, ln((SELECT count(*) FROM documents) / df) AS idf FROM df),
tfidf AS (SELECT doc_id, term_id, tf * idf AS value FROM tf JOIN idf USING (term_id))
"""
POST_TERMS_SQL = f"""{STRIP_SQL}, {VOCAB_SQL}, {TRIM_SQL},
counts AS (SELECT doc_id, term_id, count(*) AS cnt FROM dict_tok GROUP BY doc_id, term_id)
"""
LABELLED_TOKENS_SQL = LETTERS_SQL.replace(
    "SELECT doc_id, unnest", "SELECT CASE WHEN lang = 'de' THEN 'AU' ELSE '' END || doc_id AS doc_id, unnest"
)
_ASKED = ", ".join(f"({i}, '{t}')" for i, t in enumerate(QUERY_TEXTS))
QUERY_SQL = f"""
asked(query_id, text) AS (VALUES {_ASKED}),
asked_tok AS (SELECT query_id, unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +'))
  AS word FROM asked),
asked_counts AS (SELECT query_id, term_id, count(*) AS cnt FROM asked_tok JOIN vocab USING (word) GROUP BY ALL),
links AS (SELECT doc_id, source AS category FROM documents UNION ALL SELECT doc_id, lang FROM documents)
"""
DOT_SQL = f"""{TERMS_SQL}, {QUERY_SQL},
q AS (SELECT query_id, term_id, cnt / sum(cnt) OVER (PARTITION BY query_id) * idf AS w
  FROM asked_counts JOIN idf USING (term_id)),
pairs AS (SELECT doc_id, query_id FROM (SELECT DISTINCT doc_id FROM tfidf), (SELECT DISTINCT query_id FROM q)),
hits AS (SELECT query_id, doc_id, list_sum(list(value * w ORDER BY term_id)) AS dot FROM tfidf JOIN q USING (term_id) GROUP BY ALL),
scores AS (SELECT query_id, doc_id, coalesce(dot, 0) AS score
  FROM pairs LEFT JOIN hits USING (query_id, doc_id))
"""
COSINE_SQL = f"""{TERMS_SQL}, {QUERY_SQL},
bin AS (SELECT doc_id, term_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY doc_id) * idf AS value
  FROM counts JOIN idf USING (term_id)),
q AS (SELECT query_id, term_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY query_id) * idf AS w
  FROM asked_counts JOIN idf USING (term_id)),
dnorm AS (SELECT doc_id, sqrt(list_sum(list(value * value ORDER BY term_id))) AS dn FROM bin GROUP BY doc_id),
qnorm AS (SELECT query_id, sqrt(sum(w * w)) AS qn FROM q GROUP BY query_id),
hits AS (SELECT query_id, doc_id, list_sum(list(value * w ORDER BY term_id)) AS dot FROM bin JOIN q USING (term_id) GROUP BY ALL),
scores AS (SELECT query_id, doc_id,
    CASE WHEN dn * qn > 0 THEN coalesce(dot, 0) / qn / dn END AS score
  FROM (SELECT * FROM dnorm, qnorm) LEFT JOIN hits USING (query_id, doc_id))
"""
VOTES_SQL = f"""
SELECT query_id, category, count(*) AS votes FROM (
  SELECT query_id, category, row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC NULLS LAST, doc_id, category) AS rank FROM links JOIN scores USING (doc_id))
WHERE rank <= {NEAREST} GROUP BY query_id, category
"""
_PROBES = "(" + ", ".join(f"'{w}'" for w in PROBE_WORDS) + ")"

ORACLES = {
    "term_frequency": f"WITH {TERMS_SQL} SELECT doc_id, term_id, tf FROM tf",
    "term_frequency_binary": f"""WITH {TERMS_SQL}
        SELECT doc_id, term_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY doc_id) AS tf FROM counts""",
    "document_frequency": f"WITH {TERMS_SQL} SELECT term_id, df FROM df",
    "idf": f"WITH {TERMS_SQL} SELECT term_id, round(idf, 9) AS idf FROM idf",
    "idf_guarded": f"""WITH {LETTERS_SQL}, {VOCAB_SQL},
        talk AS (SELECT conv_id || '/' || turn AS doc_id,
          unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +')) AS word
          FROM conversations),
        df AS (SELECT word, count(DISTINCT doc_id) AS df FROM talk GROUP BY word)
        SELECT term_id, CASE WHEN df > 0 THEN round(ln((SELECT count(*) FROM conversations) / df), 9)
          ELSE 0.0::DOUBLE END AS idf FROM vocab LEFT JOIN df USING (word)""",
    "tfidf": f"WITH {TERMS_SQL} SELECT doc_id, term_id, round(value, 9) AS value FROM tfidf",
    "vector_sum": """
        SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(sum(x), 6) + 0.0 AS total FROM (
          SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos""",
    "term_sum": f"WITH {TERMS_SQL} SELECT term_id, round(sum(value), 8) AS total FROM tfidf GROUP BY term_id",
    "mean_tf_by_class": f"""WITH {LABELLED_TOKENS_SQL}, {VOCAB_SQL},
        counts AS (SELECT doc_id, word, count(*) AS cnt FROM tok JOIN vocab USING (word) GROUP BY ALL),
        tf AS (SELECT doc_id, CASE WHEN contains(doc_id, 'AU') THEN 1 ELSE 0 END AS class, word,
          cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM counts),
        sizes AS (SELECT class, count(DISTINCT doc_id) AS n FROM tf GROUP BY class)
        SELECT s.class, v.word, round(coalesce(sum(tf.tf), 0) / any_value(s.n), 9) AS mean_tf
        FROM sizes s CROSS JOIN (SELECT word FROM vocab WHERE word IN {_PROBES}) v
        LEFT JOIN tf ON tf.class = s.class AND tf.word = v.word GROUP BY s.class, v.word""",
    "doc_term_counts": f"WITH {POST_TERMS_SQL} SELECT doc_id, term_id, cnt FROM counts",
    "doc_term_map": f"""WITH {POST_TERMS_SQL}
        SELECT doc_id, string_agg(term_id || ':' || cnt, ',' ORDER BY term_id) AS counts,
          CAST(sum(cnt) AS BIGINT) AS total FROM counts GROUP BY doc_id""",
    "doc_top_terms": f"""WITH {POST_TERMS_SQL}
        SELECT term_id, word, coalesce(c.cnt, 0) AS cnt FROM vocab
        LEFT JOIN (SELECT * FROM counts WHERE contains(doc_id, 'src0/0')) c USING (term_id) WHERE term_id < 100""",
    "category_features": f"""WITH {TERMS_SQL}, {QUERY_SQL}
        SELECT category, doc_id, term_id, round(value, 9) AS value FROM links JOIN tfidf USING (doc_id)""",
    "similarity_scores": f"WITH {DOT_SQL} SELECT query_id, doc_id, round(score, 9) + 0.0 AS score FROM scores",
    "similarity_cosine": f"WITH {COSINE_SQL} SELECT query_id, doc_id, round(score, 9) + 0.0 AS score FROM scores",
    "knn_predict_dot": f"WITH {DOT_SQL} {VOTES_SQL}",
    "knn_predict_cosine": f"WITH {COSINE_SQL} {VOTES_SQL}",
}

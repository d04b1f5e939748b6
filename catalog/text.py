"""Tokenisers, word counts and the vocabulary."""

from __future__ import annotations

from catalog.inputs import POSTS_SQL, documents, post_lines, table
from lodestat.functions import text
from lodestat.operators import vocab
from lodestat.sources.documents import parse_posts

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP_WORDS) + ")"

LETTERS_SQL = """
tok AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +')) AS word
    FROM documents) WHERE word <> '')
"""
VOCAB_SQL = """
wc AS (SELECT word, count(*) AS cnt FROM tok GROUP BY word),
vocab AS (
  SELECT word, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS INTEGER) AS term_id
  FROM wc QUALIFY term_id < 20000)
"""
# White space as Unicode defines it, with the separator control codes.
SPACE_SQL = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
STRIP_SQL = f"""
{POSTS_SQL},
tok AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, lower(regexp_replace(raw, '[^a-zA-Z]', '', 'g')) AS word FROM (
      SELECT doc_id, unnest(string_split_regex(body, '{SPACE_SQL}')) AS raw FROM parsed))
  WHERE length(word) > 2 AND word NOT IN {STOP_SQL})
"""
TRIM_SQL = """
trimmed AS (
  SELECT doc_id, trim(lower(raw), '!"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~') AS word FROM (
    SELECT doc_id, unnest(string_split(body, ' ')) AS raw FROM parsed)),
dict_tok AS (SELECT doc_id, term_id, t.word FROM trimmed t JOIN vocab v ON t.word = v.word WHERE length(t.word) > 2)
"""


def posts(spark, sf_dir):
    return parse_posts(post_lines(spark, sf_dir)).select("doc_id", "category", "body")


def letters_counts(spark, sf_dir):
    return vocab.word_count(text.tokens_letters(documents(spark, sf_dir)))


def letters_vocabulary(spark, sf_dir):
    return vocab.vocabulary(letters_counts(spark, sf_dir))


def post_dictionary(spark, sf_dir):
    return vocab.vocabulary(vocab.word_count(text.tokens_strip(posts(spark, sf_dir))))


def tokenize_letters(spark, sf_dir):
    return text.tokens_letters(documents(spark, sf_dir))


def tokenize_strip(spark, sf_dir):
    return text.tokens_strip(posts(spark, sf_dir))


def tokenize_edge_trim(spark, sf_dir):
    """Edge-trimmed tokens that the dictionary knows, with their positions."""
    tokens = text.tokens_edge_trim(posts(spark, sf_dir))
    return vocab.with_term_ids(tokens, post_dictionary(spark, sf_dir))


def stopword_filter(spark, sf_dir):
    return text.drop_stop_words(text.tokens_letters(documents(spark, sf_dir)))


def corpus_count(spark, sf_dir):
    return vocab.corpus_count(table(spark, sf_dir, "documents"))


def vocab_head(spark, sf_dir):
    return vocab.vocab_head(letters_counts(spark, sf_dir), 10)


def vocab_tail(spark, sf_dir):
    return vocab.vocab_tail(letters_vocabulary(spark, sf_dir), 20)


QUERIES = {
    "tokenize_letters": tokenize_letters,
    "tokenize_strip": tokenize_strip,
    "tokenize_edge_trim": tokenize_edge_trim,
    "stopword_filter": stopword_filter,
    "word_count": letters_counts,
    "corpus_count": corpus_count,
    "vocabulary": letters_vocabulary,
    "vocab_head": vocab_head,
    "vocab_tail": vocab_tail,
}

ORACLES = {
    "tokenize_letters": f"WITH {LETTERS_SQL} SELECT doc_id, word FROM tok",
    "tokenize_strip": f"WITH {STRIP_SQL} SELECT doc_id, word FROM tok",
    "tokenize_edge_trim": f"WITH {STRIP_SQL}, {VOCAB_SQL}, {TRIM_SQL} SELECT doc_id, term_id FROM dict_tok",
    "stopword_filter": f"WITH {LETTERS_SQL} SELECT doc_id, word FROM tok WHERE word NOT IN {STOP_SQL}",
    "word_count": f"WITH {LETTERS_SQL} SELECT word, count(*) AS cnt FROM tok GROUP BY word",
    "corpus_count": "SELECT count(*) AS n FROM documents",
    "vocabulary": f"WITH {LETTERS_SQL}, {VOCAB_SQL} SELECT word, cnt, term_id FROM vocab",
    "vocab_head": f"WITH {LETTERS_SQL}, {VOCAB_SQL} SELECT word, cnt FROM vocab WHERE term_id < 10",
    "vocab_tail": f"WITH {LETTERS_SQL}, {VOCAB_SQL} SELECT word, term_id FROM vocab ORDER BY term_id DESC LIMIT 20",
}

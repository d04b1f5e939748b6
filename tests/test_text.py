import random
import re
import string

import pytest

from lodestat.functions import text
from lodestat.operators import vocab

SAMPLES = [
    "The cat's 2 hats, THE end.",
    "don't stop believing\tnow\nor\x1clater ok",
    "  ",
    "",
    "---a--b--- (word) [x] `tick` \\slash\\ _under_ ~~",
    "Café naïve Kelvin İstanbul Über",
    "1,000 e-mail: me@example.com!!",
    "'quoted' \"double\" mid'dle end.' ...",
]


def words(df):
    return [r["word"] for r in df.collect()]


def docs(spark, sample):
    return spark.createDataFrame([(1, sample, sample)], "doc_id int, text string, body string")


@pytest.mark.parametrize("sample", SAMPLES)
def test_letters(spark, sample):
    expected = re.sub("[^a-zA-Z]", " ", sample).lower().split()
    assert words(text.tokens_letters(docs(spark, sample))) == expected


@pytest.mark.parametrize("sample", SAMPLES)
def test_strip(spark, sample):
    cleaned = [re.sub("[^a-zA-Z]", "", w).lower() for w in sample.split()]
    expected = [w for w in cleaned if len(w) > 2 and w not in text.STOP_WORDS]
    assert words(text.tokens_strip(docs(spark, sample))) == expected


@pytest.mark.parametrize("sample", SAMPLES)
def test_edge_trim(spark, sample):
    expected = [w for w in (t.lower().strip(string.punctuation) for t in sample.split(" ")) if len(w) > 2]
    assert words(text.tokens_edge_trim(docs(spark, sample))) == expected


def test_tokenisers_on_random_texts(spark):
    rng = random.Random(11)
    alphabet = list("abcXYZ ,.-'()\\_\t\n\r") + list("\x1c\x85\xa0\u2003\u3000éßİK") + ["the", " of "]
    samples = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    table = spark.createDataFrame([(i, s, s) for i, s in enumerate(samples)], "doc_id int, text string, body string")
    plain = {
        text.tokens_letters: lambda s: re.sub("[^a-zA-Z]", " ", s).lower().split(),
        text.tokens_strip: lambda s: [
            w for w in (re.sub("[^a-zA-Z]", "", t).lower() for t in s.split()) if len(w) > 2 and w not in text.STOP_WORDS
        ],
        text.tokens_edge_trim: lambda s: [
            w for w in (t.lower().strip(string.punctuation) for t in s.split(" ")) if len(w) > 2
        ],
    }
    for tokeniser, words_of in plain.items():
        found = {}
        for row in tokeniser(table).collect():
            found.setdefault(row["doc_id"], []).append(row["word"])
        assert found == {i: words_of(s) for i, s in enumerate(samples) if words_of(s)}


def test_long_punctuation_runs_take_one_pass(spark):
    sample = "a" + "-" * 200_000 + "b " + "." * 200_000 + " end" + "!" * 200_000
    assert words(text.tokens_edge_trim(docs(spark, sample)))[-1] == "end"


def test_dictionary_and_counts_see_different_words(spark):
    sample = docs(spark, "don't")
    assert words(text.tokens_strip(sample)) == ["dont"] and words(text.tokens_edge_trim(sample)) == ["don't"]


def test_null_text_gives_no_words(spark):
    assert words(text.tokens_letters(spark.createDataFrame([(1, None)], "doc_id int, text string"))) == []


def test_vocabulary_orders_ties_and_accepts_few_words(spark):
    tokens = spark.createDataFrame([(w,) for w in "b b a a c d d d".split()], "word string")
    counts = vocab.word_count(tokens)
    rows = [tuple(r) for r in vocab.vocabulary(counts, 3).orderBy("term_id").collect()]
    assert rows == [("d", 3, 0), ("a", 2, 1), ("b", 2, 2)]
    full = vocab.vocabulary(counts)
    assert full.count() == 4
    assert [r["word"] for r in vocab.vocab_head(counts, 2).collect()] == ["d", "a"]
    assert [tuple(r) for r in vocab.vocab_tail(full, 2).collect()] == [("c", 3), ("b", 2)]

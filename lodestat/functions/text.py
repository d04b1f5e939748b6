"""Tokenisers as column expressions. Each gives an array of words without empty ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The English stop words of the post dictionary.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his "
    "himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom "
    "this that that'll these those am is are was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where why how all "
    "any both each few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn "
    "hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# ASCII punctuation at the start or the end of a blank-separated token. A run is tried
# at its first character only, so long runs cost one pass.
EDGE_PUNCTUATION = r"(?<![^ ])\p{Punct}++|(?<!\p{Punct})\p{Punct}++(?![^ ])"

# White space as Unicode defines it, with the four separator control codes.
SPACE = r"\s\x1c-\x1f"

MIN_LETTERS = 3


def letters_words(text: Column) -> Column:
    """Runs of ASCII letters, lower case."""
    return F.split(F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " ")), " ", -1)


def strip_words(text: Column) -> Column:
    """White-space tokens with everything but letters deleted inside them (``don't`` gives ``dont``).

    Deleting over the whole text before splitting gives the same words in one scan.
    """
    letters = F.regexp_replace(text, f"(?U)[^a-zA-Z{SPACE}]+", "")
    return F.split(F.lower(F.regexp_replace(letters, f"(?U)[{SPACE}]+", " ")), " ", -1)


def edge_trim_words(text: Column) -> Column:
    """Blank-separated tokens, lower case, without punctuation at both ends."""
    return F.split(F.regexp_replace(F.lower(text), EDGE_PUNCTUATION, ""), " ", -1)


def _explode(docs: DataFrame, keys: Sequence[str], words: Column) -> DataFrame:
    # The outer form keeps the optimiser from repeating the tokeniser in a filter on array size;
    # a row without words turns up as NULL and falls to the filters of the callers.
    return docs.select(*keys, F.explode_outer(words).alias("word"))


def tokens_letters(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per word of the letters tokeniser."""
    return _explode(docs, keys, letters_words(F.col(text))).filter(F.col("word") != "")


def tokens_strip(
    docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "body", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """One row per word of the strip tokeniser: three letters or more, no stop words."""
    words = _explode(docs, keys, strip_words(F.col(text))).filter(F.length("word") >= MIN_LETTERS)
    return drop_stop_words(words, stop_words)


def tokens_edge_trim(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "body") -> DataFrame:
    """One row per blank-separated token of three characters or more, trimmed at its edges.

    Meant to be joined to a dictionary, which drops whatever is no word.
    """
    return _explode(docs, keys, edge_trim_words(F.col(text))).filter(F.length("word") >= MIN_LETTERS)


def drop_stop_words(words: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Catalyst turns the list into a hash set; no join is needed."""
    return words.filter(~F.col("word").isin(list(stop_words)))

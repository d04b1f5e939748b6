"""The training-text pipeline: from raw documents to token ids.

Toxic documents go, then all but one of equal ones, then all but one of each group of near copies, then those with benchmark
passages; what is left is encoded. Each stage reads what its predecessor kept, written as Parquet, and all columns but those
that the last stage adds are the documents' own. A document without text isn't toxic, equals other documents without
text, and is encoded as no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestat.llm import decontaminate, exact_dedup, jaccard_join, prefix_bpe, toxicity
from lodestat.llm.rows import table
from lodestat.session import store

NEAR_WORDS, NEAR_PERCENT = 5, 80  # of the near copies; the query op6 has a contract of its own


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a network trained on the labels."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_unequal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.drop_exact_copies(docs)


def keep_unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of shingle sets hold together, by the pipeline's own runs and share."""
    return jaccard_join.drop_near_copies(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and the bytes that these decode to."""
    return prefix_bpe.encode(docs)


STAGES = [
    ("toxicity", keep_civil),
    ("exact dedup", keep_unequal),
    ("n-gram Jaccard join", keep_unlike),
    ("benchmark decontamination", keep_unseen),
    ("byte-level BPE", encode),
]

# A trained network decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Rows with an identity of their own, for operators that bring decisions back to rows.

Document ids may be missing or repeated, so decisions are kept by a number given to each row. The number is given once
and written with the row; a lost executor can't change it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.session import store

ASCII_SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, label: str, name: str = "uid") -> DataFrame:
    """``df`` with a unique, lasting number per row, kept in the shared folder."""
    return store(df.withColumn(name, F.monotonically_increasing_id()), label)


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(name: str = "text"):
    """A text column as UTF-8, empty where it is missing."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def lower_ascii(word):
    """Lower-case A-Z alone. Words of ASCII take Spark's fast path."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, upper, upper.lower())
    )

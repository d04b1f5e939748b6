"""Files in and out. Spark reads bz2 and gzip text by file name; bz2 files are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Headerless CSV under a declared schema, so that no pass is spent on inferring types."""
    return spark.read.schema(schema).option("header", "false").option("sep", sep).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", compression: str = "none") -> None:
    """One file per partition; nothing is gathered."""
    df.write.mode("errorifexists").option("header", "false").option("escape", '"').csv(
        path, sep=sep, compression=compression, emptyValue=""
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def write_lines(df: DataFrame, path: str, column: str = "value", compression: str = "none") -> None:
    df.select(column).write.mode("errorifexists").text(path, compression=compression)


def pair_line(key: Column, value: Column) -> Column:
    """``('key', value)``: the line format of a saved list of pairs."""
    return F.concat(F.lit("('"), key.cast("string"), F.lit("', "), value.cast("string"), F.lit(")"))


def write_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """Save a ranked list as pair lines, in the order of the frame."""
    write_lines(df.select(pair_line(F.col(key), F.col(value)).alias("value")), path)

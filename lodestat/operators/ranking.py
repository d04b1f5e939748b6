"""Ranked aggregates with a defined order among ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.numbers import exact_sum, nonzero, round_half_up, within


def distinct_pairs(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(key, value).distinct()


def distinct_by_key(df: DataFrame, key: str, value: str, name: str = "n") -> DataFrame:
    """Distinct values per key.

    Spark shuffles this on (key, value) first, so one hot key is spread over its values.
    """
    return df.groupBy(key).agg(F.count_distinct(F.col(value)).alias(name))


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k rows with the largest ``by``; equal ones in ascending order of ``ties``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)


def top_distinct_by_key(df: DataFrame, key: str, value: str, k: int = 10, name: str = "n") -> DataFrame:
    return top_k(distinct_by_key(df, key, value, name), k, name, key)


def _total(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return exact_sum(F.col(name).cast("double"))
    return F.sum(name).cast("double")


def ratio_by_key(
    df: DataFrame, key: str, numerator: str, denominator: str, name: str = "ratio", keep: Column | None = None
) -> DataFrame:
    """Ratio of two sums per key, to two places.

    Both sums come from one pass with partial aggregation, and neither depends on the order of
    rows, so that ranks are the same in every run.
    """
    rows = df if keep is None else df.filter(keep)
    sums = rows.groupBy(key).agg(_total(df, numerator).alias("_num"), _total(df, denominator).alias("_den"))
    return sums.select(key, round_half_up(F.try_divide("_num", "_den"), 2).alias(name))


def top_ratio_by_key(
    df: DataFrame,
    key: str,
    numerator: str,
    denominator: str,
    k: int = 10,
    name: str = "ratio",
    keep: Column | None = None,
) -> DataFrame:
    """The k keys with the best rounded ratio."""
    return top_k(ratio_by_key(df, key, numerator, denominator, name, keep), k, name, key)


def best_paid(df: DataFrame, key: str, money: str, minutes: str, k: int = 10, name: str = "ratio") -> DataFrame:
    """Money per minute, without rides under a minute or without money."""
    keep = within(F.col(minutes).cast("double"), 1) & nonzero(F.col(money).cast("double"))
    return top_ratio_by_key(df, key, money, minutes, k, name, keep)


def best_hour(df: DataFrame, hour: str, surcharge: str, miles: str, k: int = 1, name: str = "ratio") -> DataFrame:
    """Hour with the best surcharge per mile, without rows where either is zero."""
    keep = nonzero(F.col(miles).cast("double")) & nonzero(F.col(surcharge).cast("double"))
    return top_ratio_by_key(df, hour, surcharge, miles, k, name, keep)

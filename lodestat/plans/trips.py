"""Jobs over a file of trip lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.clock import hour_of_text
from lodestat.layout import spread
from lodestat.operators import linear, ranking
from lodestat.sources.files import read_lines, write_pairs
from lodestat.sources.trips import clean_basic, parse_trips, regression_rows

FEATURES = ("minutes", "miles", "fare", "surcharge")


def cleaned_trips(spark: SparkSession, path: str) -> DataFrame:
    return clean_basic(parse_trips(spread(read_lines(spark, path))))


def busiest_taxis(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """Taxis with the most distinct drivers."""
    return ranking.top_distinct_by_key(cleaned_trips(spark, path), "medallion", "driver", k)


def best_paid_drivers(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """Drivers with the most money per minute on trips of a minute or more."""
    trips = cleaned_trips(spark, path)
    rides = trips.select("driver", (F.col("secs") / 60).alias("minutes"), F.col("total").alias("money"))
    return ranking.best_paid(rides, "driver", "money", "minutes", k)


def best_surcharge_hour(spark: SparkSession, path: str, k: int = 1) -> DataFrame:
    """Hour of day with the best surcharge per mile; trips without a time of day are left out."""
    trips = cleaned_trips(spark, path)
    rows = trips.select(hour_of_text(F.col("pickup")).alias("hour"), "surcharge", "miles")
    return ranking.best_hour(rows.filter(F.col("hour").isNotNull()), "hour", "surcharge", "miles", k)


def save_ranking(ranked: DataFrame, path: str) -> None:
    """Write a ranking of two columns as lines of pairs."""
    key, value = ranked.columns
    write_pairs(ranked, path, key, value)


def fare_line(spark: SparkSession, path: str) -> DataFrame:
    """Fare by distance: slope and intercept in closed form."""
    return linear.ols_simple(_regression_trips(spark, path), "miles", "fare")


def fare_descent(spark: SparkSession, path: str, **settings: float) -> linear.Descent:
    """Fare by distance, by gradient descent."""
    return linear.gradient_descent(_regression_trips(spark, path), ["miles"], "fare", **settings)


def total_descent(spark: SparkSession, path: str, **settings: float) -> linear.Descent:
    """Total amount by minutes, miles, fare and surcharge, by gradient descent."""
    return linear.gradient_descent(_regression_trips(spark, path), FEATURES, "total", **settings)


def _regression_trips(spark: SparkSession, path: str) -> DataFrame:
    return regression_rows(parse_trips(spread(read_lines(spark, path))))

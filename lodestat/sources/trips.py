"""Trip records: headerless comma-separated lines of 17 fields, without quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.numbers import nonzero, to_number, within

# The field order of a trip line.
TRIP_FIELDS = (
    "medallion",
    "driver",
    "pickup",
    "dropoff",
    "secs",
    "miles",
    "pickup_lon",
    "pickup_lat",
    "dropoff_lon",
    "dropoff_lat",
    "payment",
    "fare",
    "surcharge",
    "tax",
    "tip",
    "tolls",
    "total",
)
NUMERIC_FIELDS = ("secs", "miles", "fare", "surcharge", "tolls", "total")


def _once(value: Column) -> Column:
    """Compute a value in a step of its own, as a generator of one row.

    A plain alias would be substituted into every filter and column that uses it, and the line
    split again for each.
    """
    return F.explode(F.array(value))


def parse_trips(lines: DataFrame, value: str = "value") -> DataFrame:
    """``n_fields`` and the 17 fields; the numeric ones as DOUBLE, NULL where they are no number.

    Fields that a short line lacks are NULL.
    """
    fields = lines.select(_once(F.split(F.col(value), ",", -1)).alias("_f"))
    numbers = [to_number(F.get("_f", F.lit(TRIP_FIELDS.index(name)))).alias(name) for name in NUMERIC_FIELDS]
    rows = fields.select("_f", _once(F.struct(*numbers)).alias("_n"))
    return rows.select(
        F.size("_f").alias("n_fields"),
        *[
            F.col(f"_n.{name}") if name in NUMERIC_FIELDS else F.get("_f", F.lit(i)).alias(name)
            for i, name in enumerate(TRIP_FIELDS)
        ],
    )


def _complete(trips: DataFrame, *numeric: str) -> DataFrame:
    test = F.col("n_fields") == len(TRIP_FIELDS)
    for name in numeric:
        test = test & F.col(name).isNotNull()  # NaN is a number here, which dropna would not accept
    return trips.filter(test)


def clean_basic(trips: DataFrame) -> DataFrame:
    """17 fields, numbers where numbers belong, and a total that is not zero.

    Zero seconds, miles or fares stay: the ranked aggregates filter what they divide by.
    """
    return _complete(trips, "secs", "miles", "fare", "surcharge", "total").filter(nonzero(F.col("total")))


def clean_range(trips: DataFrame) -> DataFrame:
    """Rides of 2 to 60 minutes, fares of 3 to 200, 1 to 50 miles, and tolls of at least 3."""
    return _complete(trips, "secs", "miles", "fare", "tolls").filter(
        within(F.col("secs"), 120, 3600)
        & within(F.col("fare"), 3, 200)
        & within(F.col("miles"), 1, 50)
        & within(F.col("tolls"), 3)
    )


def regression_rows(trips: DataFrame) -> DataFrame:
    """Cleaned trips with the features of the linear models.

    ``surcharge`` and ``total`` are not covered by :func:`clean_range`; rows where one of them
    is no number are left out.
    """
    rows = clean_range(trips).withColumn("minutes", F.col("secs") / 60)
    return rows.select("minutes", "miles", "fare", "surcharge", "total").dropna()

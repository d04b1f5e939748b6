"""Number parsing, range tests, rounding and sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number in a text field. A cast alone would also take
# "1d", "1f" and hexadecimal floats.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"


def to_number(text: Column) -> Column:
    """DOUBLE value of a text field, NULL where it is not a plain number."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def within(value: Column, low: float, high: float | None = None) -> Column:
    """Range test that NaN fails (Spark orders NaN above every number)."""
    test = ~F.isnan(value) & (value >= low)
    return test if high is None else test & (value <= high)


def nonzero(value: Column) -> Column:
    return ~F.isnan(value) & (value != 0)


def round_half_up(value: Column, places: int = 2) -> Column:
    """Round by scaling, halves upward; the same digits in every IEEE engine.

    Numbers whose scaled value no long holds have no decimal places and stay as they are, like what is not finite.
    """
    scale = float(10**places)
    rounded = F.floor(value * scale + 0.5) / scale
    return F.when(F.abs(value) < 2.0**63 / scale, rounded).otherwise(value)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of rows.

    Values are added as decimals of 12 places; what no decimal holds (infinite or huge) is added
    as it is.
    """
    fixed = value.try_cast("decimal(24,12)")
    rest = F.sum(F.when(fixed.isNull(), value))
    return F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))

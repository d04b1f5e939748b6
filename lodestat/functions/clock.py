"""Time of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_text(stamp: Column) -> Column:
    """Zero-padded hour of a ``yyyy-MM-dd HH:mm:ss`` text, NULL where there is no time part."""
    clock = F.get(F.split(stamp, " ", -1), F.lit(1))
    return F.get(F.split(clock, ":", -1), F.lit(0))


def hour_of_timestamp(stamp: Column) -> Column:
    """Zero-padded hour of a timestamp, also of one without a time zone."""
    return F.lpad(F.hour(stamp).cast("string"), 2, "0")

"""Choices about where rows sit: spreading small inputs, broadcasting only what is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side that gets an explicit broadcast hint. Beyond it the join is left to Catalyst,
# which shuffles both sides (and splits skewed partitions under AQE).
BROADCAST_BYTES = 64 * 1024 * 1024


def bounded_broadcast(df: DataFrame, max_rows: int, row_bytes: int = 100) -> DataFrame:
    """Hint a broadcast if ``max_rows`` rows, the proven bound of ``df``, fit the limit."""
    return F.broadcast(df) if max_rows * row_bytes <= BROADCAST_BYTES else df


def gathered(df: DataFrame, per_core: int = 4) -> DataFrame:
    """``df`` in at most ``per_core`` partitions a core, without a shuffle.

    A task that adds up its rows then leaves one sum for many splits, so that sums follow cores and not splits.
    """
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than there are cores.

    Input in many files or in splittable ones has more and is returned as it is, so that no text is
    shuffled. A few files that cannot be split (gzip) would leave most cores idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

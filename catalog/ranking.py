"""Ranked aggregates over line items and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import rides, table
from lodestat.functions.clock import hour_of_timestamp
from lodestat.operators import ranking


def distinct_pairs(spark, sf_dir):
    return ranking.distinct_pairs(rides(spark, sf_dir), "medallion", "driver")


def top_distinct_by_key(spark, sf_dir):
    return ranking.top_distinct_by_key(rides(spark, sf_dir), "medallion", "driver", 10)


def top_ratio_by_key(spark, sf_dir):
    return ranking.best_paid(rides(spark, sf_dir), "driver", "money", "minutes", 10)


def best_hour_ratio(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        hour_of_timestamp(F.col("ts")).alias("hour"),
        F.col("value").cast("decimal(18,2)").alias("surcharge"),
        F.get_json_object("props", "$.k").cast("decimal(18,2)").alias("miles"),
    )
    return ranking.best_hour(events, "hour", "surcharge", "miles", 1)


QUERIES = {
    "distinct_pairs": distinct_pairs,
    "top_distinct_by_key": top_distinct_by_key,
    "top_ratio_by_key": top_ratio_by_key,
    "best_hour_ratio": best_hour_ratio,
}

ORACLES = {
    "distinct_pairs": "SELECT DISTINCT l_suppkey AS medallion, l_partkey AS driver FROM lineitem",
    "top_distinct_by_key": """
        SELECT l_suppkey AS medallion, count(DISTINCT l_partkey) AS n
        FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, medallion LIMIT 10""",
    "top_ratio_by_key": """
        SELECT l_partkey AS driver, floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
          / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) * 100 + 0.5) / 100 AS ratio
        FROM lineitem WHERE l_quantity >= 1 AND l_extendedprice <> 0
        GROUP BY l_partkey ORDER BY ratio DESC, driver LIMIT 10""",
    "best_hour_ratio": """
        WITH e AS (SELECT strftime(ts, '%H') AS hour, CAST(value AS DECIMAL(18,2)) AS surcharge,
          CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS miles FROM events)
        SELECT hour, floor(CAST(sum(surcharge) AS DOUBLE) / CAST(sum(miles) AS DOUBLE) * 100 + 0.5) / 100 AS ratio
        FROM e WHERE miles <> 0 AND surcharge <> 0 GROUP BY hour ORDER BY ratio DESC, hour LIMIT 1""",
}

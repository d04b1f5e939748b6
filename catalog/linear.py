"""Linear regression over line items: price in thousands by quantity and further columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import regression_input
from catalog.vectors import rounded
from lodestat.operators import linear

MULTI = ["x", "x2", "x3", "x4"]


def regression_sums(spark, sf_dir):
    sums = linear.regression_sums(regression_input(spark, sf_dir), "x", "y")
    return rounded(sums, 2, "sum_x", "sum_y", "sum_xy", "sum_x2")


def ols_simple(spark, sf_dir):
    return rounded(linear.ols_simple(regression_input(spark, sf_dir), "x", "y"), 6, "m", "b")


def linear_predict(spark, sf_dir):
    """Predictions and residuals at the fitted line."""
    rows = regression_input(spark, sf_dir)
    line = linear.ols_simple(rows, "x", "y").first()
    predicted = linear.linear_predict(["x"], [line["m"]], line["b"])
    scored = rows.select("l_orderkey", "l_linenumber", predicted.alias("predicted"), (F.col("y") - predicted).alias("residual"))
    return rounded(scored, 6, "predicted", "residual")


def gd_simple_trace(spark, sf_dir):
    course = linear.gradient_descent(regression_input(spark, sf_dir), ["x"], "y")
    return rounded(course.trace(spark, ["b", "m"]), 4, "cost", "b", "m").withColumn("lr", F.round("lr", 12))


def gd_multi_trace(spark, sf_dir):
    names = [f"theta{i}" for i in range(len(MULTI) + 1)]
    course = linear.gradient_descent(regression_input(spark, sf_dir), MULTI, "y")
    return rounded(course.trace(spark, names), 4, "cost", *names).withColumn("lr", F.round("lr", 12))


QUERIES = {
    "regression_sums": regression_sums,
    "ols_simple": ols_simple,
    "linear_predict": linear_predict,
    "gd_simple_trace": gd_simple_trace,
    "gd_multi_trace": gd_multi_trace,
}

DATA_SQL = """
data AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y, l_discount AS x2, l_tax AS x3,
  l_linenumber::DOUBLE AS x4, l_orderkey, l_linenumber FROM lineitem),
sums AS (SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy, sum(x * x) AS sx2 FROM data),
line AS (SELECT n, (n * sxy - sx * sy) / (n * sx2 - sx * sx) AS m, (sx2 * sy - sx * sxy) / (n * sx2 - sx * sx) AS b
  FROM sums)
"""


def descent_sql(features: list[str], names: list[str], data: str = DATA_SQL) -> str:
    """Recursive SQL over the sums of products of ``data``: one row per iteration."""
    columns = ["1.0::DOUBLE", *features]
    width = len(columns)
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = [f"sum({columns[i]} * {columns[j]}) AS g{i}{j}" for i, j in pairs]
    sums += [f"sum({c} * y) AS h{i}" for i, c in enumerate(columns)]

    def g(i, j):
        return f"g{min(i, j)}{max(i, j)}"

    quad = " + ".join(f"t{i} * t{j} * {g(i, j)}" for i in range(width) for j in range(width))
    lin = " + ".join(f"t{i} * h{i}" for i in range(width))
    cost = f"(({quad}) - 2 * ({lin}) + yy) / n"

    def gradient(i):
        fit = " + ".join(f"t{j} * {g(i, j)}" for j in range(width))
        return f"(-2.0 / n) * (h{i} - ({fit}))"

    theta = ", ".join(f"t{i}" for i in range(width))
    stepped = ", ".join(f"t{i} - lr * ({gradient(i)}) AS t{i}" for i in range(width))
    start = ", ".join(f"0.1::DOUBLE AS t{i}" for i in range(width))
    shown = ", ".join(f"round(t{i}, 4) + 0.0 AS {name}" for i, name in enumerate(names))
    return f"""WITH RECURSIVE {data},
gram AS MATERIALIZED (SELECT count(*) AS n, sum(y * y) AS yy, {", ".join(sums)} FROM data),
walk AS (
  SELECT -1 AS iteration, 0.0::DOUBLE AS cost, 0.0::DOUBLE AS before, 0.001::DOUBLE AS lr, {start}
  UNION ALL
  SELECT iteration, cost, before, lr, {stepped} FROM (
    SELECT iteration + 1 AS iteration, {cost} AS cost, cost AS before,
      CASE WHEN iteration < 0 THEN lr WHEN {cost} < cost THEN lr * 1.05::DOUBLE ELSE lr * 0.5::DOUBLE END AS lr,
      {theta}, gram.* FROM walk, gram
    WHERE iteration < 99 AND (iteration < 0 OR abs(cost - before) > 0.1)))
SELECT iteration, round(cost, 4) + 0.0 AS cost, round(lr, 12) AS lr, {shown} FROM walk
WHERE iteration >= 0 AND abs(cost - before) > 0.1"""


ORACLES = {
    "regression_sums": f"""WITH {DATA_SQL} SELECT n, round(sx, 2) AS sum_x, round(sy, 2) AS sum_y,
        round(sxy, 2) AS sum_xy, round(sx2, 2) AS sum_x2 FROM sums""",
    "ols_simple": f"WITH {DATA_SQL} SELECT n, round(m, 6) AS m, round(b, 6) AS b FROM line",
    "linear_predict": f"""WITH {DATA_SQL} SELECT l_orderkey, l_linenumber,
        round(b + m * x, 6) + 0.0 AS predicted, round(y - (b + m * x), 6) + 0.0 AS residual FROM data, line""",
    "gd_simple_trace": descent_sql(["x"], ["b", "m"]),
    "gd_multi_trace": descent_sql(MULTI, [f"theta{i}" for i in range(len(MULTI) + 1)]),
}

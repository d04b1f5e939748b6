"""Whole jobs over text files: trips that are ranked or fitted, pages that answer texts, cases that are learned and judged."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import classify
from catalog.inputs import TRIP_LINES_SQL, links, table, trip_lines
from catalog.linear import descent_sql
from catalog.vectors import COSINE_SQL, NEAREST, QUERY_TEXTS, VOTES_SQL, rounded
from lodestat.plans import cases, pages, trips
from lodestat.session import fresh_path


def _file(spark, sf_dir):
    path = fresh_path(spark, "trips")
    trip_lines(spark, sf_dir).write.text(path)
    return path


def trips_busiest_taxis(spark, sf_dir):
    return trips.busiest_taxis(spark, _file(spark, sf_dir))


def trips_best_paid_drivers(spark, sf_dir):
    """Money per minute, the minutes from seconds."""
    return trips.best_paid_drivers(spark, _file(spark, sf_dir))


def trips_best_surcharge_hour(spark, sf_dir):
    """The hour is taken from the text of the pickup."""
    return trips.best_surcharge_hour(spark, _file(spark, sf_dir))


def trips_fare_line(spark, sf_dir):
    """Fare by distance over rides within the ranges."""
    return rounded(trips.fare_line(spark, _file(spark, sf_dir)), 6, "m", "b")


def trips_fare_descent(spark, sf_dir):
    """The course of fare by distance, until the cost settles."""
    course = trips.fare_descent(spark, _file(spark, sf_dir))
    return rounded(course.trace(spark, ["b", "m"]), 4, "cost", "b", "m").withColumn("lr", F.round("lr", 12))


def trips_total_descent(spark, sf_dir):
    """The course of the total by minutes, miles, fare and surcharge; costs go over many powers of ten, so their logarithm is given."""
    names = [f"theta{i}" for i in range(5)]
    course = trips.total_descent(spark, _file(spark, sf_dir)).trace(spark, names)
    scaled = course.withColumn("log_cost", F.round(F.log("cost"), 8) + F.lit(0.0)).drop("cost")
    return rounded(scaled, 4, *names).withColumn("lr", F.round("lr", 12))


def _lines(spark, rows, doc_id, label="lines"):
    """A file of tagged documents, one a line."""
    path = fresh_path(spark, label)
    text = F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ")
    line = F.concat(F.lit('<doc id="'), doc_id, F.lit('" url="u" title="t">'), text, F.lit("</doc>"))
    rows.select(line.alias("value")).write.text(path)
    return path


def pages_predict(spark, sf_dir):
    """Categories for texts, from files of all documents and of their sources and languages."""
    page_file = _lines(spark, table(spark, sf_dir, "documents"), F.col("doc_id").cast("string"), "page-lines")
    link_file = fresh_path(spark, "link-lines")
    pairs = links(spark, sf_dir).select(F.format_string('"%s","%s"', F.col("doc_id").cast("string"), "category"))
    pairs.write.text(link_file)
    return pages.PageIndex.build(spark, page_file, link_file, cosine=True).predict(QUERY_TEXTS, NEAREST)


def _judged(spark, sf_dir):
    """A logistic model of German documents, learned from all documents and tried on all messages, of which
    those of users count as German."""
    docs, talk = table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations")

    def named(doc_id, positive):
        return F.concat(F.when(positive, "AU").otherwise(""), doc_id)

    train = _lines(spark, docs, named(F.col("doc_id").cast("string"), F.col("lang") == "de"), "train-lines")
    key = F.concat_ws("/", "conv_id", "turn")
    return cases.logistic(spark, train, _lines(spark, talk, named(key, F.col("role") == "user"), "test-lines"))


def cases_confusion(spark, sf_dir):
    """Hits and misses on the second corpus."""
    return _judged(spark, sf_dir).confusion()


def cases_top_words(spark, sf_dir):
    """Words with the largest weights."""
    return rounded(_judged(spark, sf_dir).top_words(5), 6, "weight")


QUERIES = {
    "trips_fare_descent": trips_fare_descent,
    "trips_total_descent": trips_total_descent,
    "pages_predict": pages_predict,
    "cases_confusion": cases_confusion,
    "cases_top_words": cases_top_words,
    "trips_busiest_taxis": trips_busiest_taxis,
    "trips_best_paid_drivers": trips_best_paid_drivers,
    "trips_best_surcharge_hour": trips_best_surcharge_hour,
    "trips_fare_line": trips_fare_line,
}

CLEAN_SQL = f"""{TRIP_LINES_SQL},
clean AS (SELECT * FROM trips WHERE n_fields = 17 AND secs IS NOT NULL AND miles IS NOT NULL AND fare IS NOT NULL
  AND surcharge IS NOT NULL AND total <> 0 AND NOT isnan(total)),
ranged AS (SELECT miles AS x, fare AS y FROM trips WHERE n_fields = 17 AND secs BETWEEN 120 AND 3600
  AND fare BETWEEN 3 AND 200 AND miles BETWEEN 1 AND 50 AND tolls >= 3 AND NOT isnan(tolls)
  AND surcharge IS NOT NULL AND total IS NOT NULL AND NOT isnan(surcharge) AND NOT isnan(total)),
sums AS (SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy, sum(x * x) AS sx2 FROM ranged)
"""
RANGED_SQL = CLEAN_SQL.replace(
    "ranged AS (SELECT miles AS x, fare AS y", "ranged AS (SELECT secs / 60 AS minutes, miles, fare, surcharge, total, miles AS x, fare AS y"
)


def _as_text(sql: str) -> str:
    """Ids as the strings that files hold."""
    return sql.replace("SELECT doc_id, unnest", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, unnest").replace(
        "SELECT doc_id, source AS category", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS category"
    ).replace("SELECT doc_id, lang FROM", "SELECT CAST(doc_id AS VARCHAR), lang FROM")


# The descent of the registered trainer, then all messages at its weights, with the IDF of the messages.
WEIGHTS_SQL = classify.ORACLES["logreg_train"].rpartition("SELECT term_id")[0].rstrip()
JUDGED_SQL = f"""{WEIGHTS_SQL},
weights AS (SELECT term_id, w FROM walk WHERE done),
said AS (SELECT CASE WHEN role = 'user' THEN 'AU' ELSE '' END || conv_id || '/' || turn AS doc_id, text FROM conversations),
said_tok AS (SELECT doc_id, unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +')) AS word FROM said),
said_counts AS (SELECT doc_id, term_id, count(*) AS cnt FROM said_tok JOIN vocab USING (word) GROUP BY ALL),
said_df AS (SELECT term_id, ln((SELECT count(*) FROM said) / count(*)) AS idf FROM said_counts GROUP BY term_id),
said_scores AS (SELECT doc_id, sum(tf * idf * w) AS score FROM (
    SELECT doc_id, term_id, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM said_counts)
  JOIN said_df USING (term_id) JOIN weights USING (term_id) GROUP BY doc_id),
judged AS (SELECT count(*) FILTER (contains(doc_id, 'AU') AND score > 0) AS tp,
  count(*) FILTER (NOT contains(doc_id, 'AU') AND score > 0) AS fp,
  count(*) FILTER (contains(doc_id, 'AU') AND NOT score > 0) AS fn FROM said_scores)
"""


def _ratio(numerator: str, denominator: str) -> str:
    return f"""floor(CAST(sum(CAST({numerator} AS DECIMAL(24,12))) AS DOUBLE)
      / CAST(sum(CAST({denominator} AS DECIMAL(24,12))) AS DOUBLE) * 100 + 0.5) / 100 AS ratio"""


ORACLES = {
    "trips_fare_descent": descent_sql(["x"], ["b", "m"], RANGED_SQL.rpartition(",\nsums AS")[0] + ", data AS (SELECT * FROM ranged)"),
    "trips_total_descent": descent_sql(
        ["minutes", "miles", "fare", "surcharge"], [f"theta{i}" for i in range(5)],
        RANGED_SQL.rpartition(",\nsums AS")[0] + ", data AS (SELECT minutes, miles, fare, surcharge, total AS y FROM ranged)",
    ).replace("round(cost, 4) + 0.0 AS cost", "round(ln(cost), 8) + 0.0 AS log_cost"),
    "pages_predict": f"WITH {_as_text(COSINE_SQL)} {VOTES_SQL}",
    "cases_confusion": f"""{JUDGED_SQL} SELECT tp, fp, fn,
        floor(CASE WHEN tp + fp + fn > 0 THEN tp / (tp + 0.5 * (fp + fn)) END * 100 * 100 + 0.5) / 100 AS f1 FROM judged""",
    "cases_top_words": f"""{JUDGED_SQL} SELECT word, term_id, round(w, 6) + 0.0 AS weight
        FROM weights JOIN vocab USING (term_id) ORDER BY w DESC, term_id LIMIT 5""",
    "trips_busiest_taxis": f"""WITH {CLEAN_SQL} SELECT medallion, count(DISTINCT driver) AS n FROM clean
        GROUP BY medallion ORDER BY n DESC, medallion LIMIT 10""",
    "trips_best_paid_drivers": f"""WITH {CLEAN_SQL} SELECT driver, {_ratio("total", "secs / 60")} FROM clean
        WHERE secs / 60 >= 1 GROUP BY driver ORDER BY ratio DESC, driver LIMIT 10""",
    "trips_best_surcharge_hour": f"""WITH {CLEAN_SQL},
        hours AS (SELECT string_split(string_split(pickup, ' ')[2], ':')[1] AS hour, surcharge, miles FROM clean)
        SELECT hour, {_ratio("surcharge", "miles")} FROM hours WHERE miles <> 0 AND surcharge <> 0 AND hour IS NOT NULL
        GROUP BY hour ORDER BY ratio DESC, hour LIMIT 1""",
    "trips_fare_line": f"""WITH {CLEAN_SQL} SELECT n, round((n * sxy - sx * sy) / (n * sx2 - sx * sx), 6) AS m,
        round((sx2 * sy - sx * sxy) / (n * sx2 - sx * sx), 6) AS b FROM sums""",
}

"""Reading, parsing, cleaning and writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (
    POSTS_SQL,
    TAGGED_LINES_SQL,
    TRIP_LINES_SQL,
    labelled_documents,
    post_lines,
    rides,
    table,
    tagged_lines,
    trip_lines,
)
from lodestat.operators.ranking import distinct_by_key
from lodestat.session import fresh_path
from lodestat.sources import documents, files, trips

TRIP_COLUMNS = "medallion, driver, pickup, secs, miles, fare, surcharge, tolls, total"


def _trip_view(rows):
    return rows.select(*TRIP_COLUMNS.split(", "))


def taxi_parse(spark, sf_dir):
    parsed = trips.parse_trips(trip_lines(spark, sf_dir))
    return parsed.select("n_fields", *TRIP_COLUMNS.split(", "))


def taxi_clean_basic(spark, sf_dir):
    return _trip_view(trips.clean_basic(trips.parse_trips(trip_lines(spark, sf_dir))))


def taxi_clean_range(spark, sf_dir):
    return _trip_view(trips.clean_range(trips.parse_trips(trip_lines(spark, sf_dir))))


def scan_text_docs(spark, sf_dir):
    """Write all documents as tagged lines of bz2 text, then scan and parse the files."""
    one_line = F.translate("value", "\r\n", "  ")
    path = fresh_path(spark, "tagged")
    files.write_lines(
        tagged_lines(spark, sf_dir).select(one_line.alias("value")), path, compression="bzip2"
    )
    return documents.parse_documents(documents.valid_lines(files.read_lines(spark, path)))


def scan_csv_links(spark, sf_dir):
    """Write two links per document as quoted CSV, then scan the files under a declared schema."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    category = F.explode(F.array("source", F.concat(F.lit('in "'), "lang", F.lit('", text'))))
    path = fresh_path(spark, "links")
    files.write_csv(docs.select(F.col("doc_id").cast("string"), category.alias("category")), path)
    return files.read_csv(spark, path, "doc_id string, category string")


def sink_roundtrip(spark, sf_dir):
    """Save drivers per taxi as lines of pairs, and read the lines back."""
    path = fresh_path(spark, "pairs")
    files.write_pairs(distinct_by_key(rides(spark, sf_dir), "medallion", "driver"), path, "medallion", "n")
    return files.read_lines(spark, path)


def docs_valid_lines(spark, sf_dir):
    return documents.valid_lines(tagged_lines(spark, sf_dir))


def docs_parse(spark, sf_dir):
    return documents.parse_documents(tagged_lines(spark, sf_dir))


def category_links(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    category = F.explode(F.array("source", F.concat("lang", F.lit(",texts"))))
    quoted = docs.select(F.col("doc_id").cast("string").alias("id"), category.alias("category"))
    lines = quoted.select(F.concat(F.lit('"'), "id", F.lit('","'), "category", F.lit('"')).alias("value"))
    return documents.parse_links(lines)


def posts_parse(spark, sf_dir):
    return documents.parse_posts(post_lines(spark, sf_dir))


def class_label(spark, sf_dir):
    docs = labelled_documents(spark, sf_dir)
    return docs.select(
        "doc_id",
        documents.class_label(F.col("doc_id")).alias("label"),
        documents.class_label(F.col("doc_id"), negative=-1).alias("side"),
    )


QUERIES = {
    "taxi_parse": taxi_parse,
    "taxi_clean_basic": taxi_clean_basic,
    "taxi_clean_range": taxi_clean_range,
    "scan_text_docs": scan_text_docs,
    "scan_csv_links": scan_csv_links,
    "sink_roundtrip": sink_roundtrip,
    "docs_valid_lines": docs_valid_lines,
    "docs_parse": docs_parse,
    "category_links": category_links,
    "posts_parse": posts_parse,
    "class_label": class_label,
}

ORACLES = {
    "taxi_parse": f"WITH {TRIP_LINES_SQL} SELECT CAST(n_fields AS INTEGER) AS n_fields, {TRIP_COLUMNS} FROM trips",
    "taxi_clean_basic": f"""WITH {TRIP_LINES_SQL} SELECT {TRIP_COLUMNS} FROM trips
        WHERE n_fields = 17 AND secs IS NOT NULL AND miles IS NOT NULL AND fare IS NOT NULL
          AND surcharge IS NOT NULL AND total <> 0 AND NOT isnan(total)""",
    "taxi_clean_range": f"""WITH {TRIP_LINES_SQL} SELECT {TRIP_COLUMNS} FROM trips
        WHERE n_fields = 17 AND secs BETWEEN 120 AND 3600 AND fare BETWEEN 3 AND 200
          AND miles BETWEEN 1 AND 50 AND tolls >= 3 AND NOT isnan(tolls)""",
    "scan_text_docs": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, translate(text, chr(13) || chr(10), '  ') AS text
        FROM documents WHERE lang <> 'es'""",
    "scan_csv_links": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS category FROM documents
        UNION ALL SELECT CAST(doc_id AS VARCHAR), 'in "' || lang || '", text' FROM documents""",
    "sink_roundtrip": """
        SELECT '(''' || l_suppkey || ''', ' || count(DISTINCT l_partkey) || ')' AS value
        FROM lineitem GROUP BY l_suppkey""",
    "docs_valid_lines": f"""WITH {TAGGED_LINES_SQL}
        SELECT value FROM lines WHERE contains(value, 'id') AND contains(value, 'url=')""",
    "docs_parse": f"""WITH {TAGGED_LINES_SQL}
        SELECT substr(value, instr(value, 'id="') + 4, instr(value, '" url=') - instr(value, 'id="') - 4) AS doc_id,
          substr(value, instr(value, '">') + 2, length(value) - 6 - instr(value, '">') - 1) AS text
        FROM lines WHERE instr(value, '" url=') > 0""",
    "category_links": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS category FROM documents
        UNION ALL SELECT CAST(doc_id AS VARCHAR), lang FROM documents""",
    "posts_parse": f"WITH {POSTS_SQL} SELECT header, doc_id, category, body FROM parsed",
    "class_label": """
        SELECT CASE WHEN lang = 'de' THEN 'AU' ELSE '' END || doc_id AS doc_id,
          CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS label, CASE WHEN lang = 'de' THEN 1 ELSE -1 END AS side
        FROM documents""",
}

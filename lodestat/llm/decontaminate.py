"""Benchmark passages in documents, by winnowed fingerprints, with DataFrame operations alone.

Of the hashes of all runs of ``GRAM`` words, the smallest of every ``WINDOW - GRAM + 1`` neighbours is kept. Two texts that
share ``WINDOW`` words share those hashes and so the smallest: no shared window is missed. Documents and items that
share a fingerprint are candidates; they alone are compared word by word, and a hit is extended over all words of the windows that occur.
Items of fewer words are one window; runs of just as many words are compared for those lengths that the benchmark has.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Missing texts have no words, and neither hit nor are
hit. Repeated rows are judged each; repeated items count once per distinct ``item_id``; items without an id are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast
from lodestat.llm.rows import lower_ascii, table
from lodestat.session import settle, store

WINDOW = 10
GRAM = 5
# What stands between words before A-Z are lower-cased, which is done word by word.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text):
    """The words of a text column, empty for a missing text."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), BREAK), lambda w: w != "")
    return F.transform(parts, lower_ascii)


def _over(df: DataFrame, source: str, out: str, width: int, join) -> DataFrame:
    """Column ``out``: ``join`` over every ``width`` neighbours of ``source``, doubling the reach; parts may overlap.

    A step uses the column before twice only, since the optimiser may put one step into the next: with four uses its trees
    took hundreds of megabytes of the driver. So steps run past the end, and what they make there is cut off last.
    """
    df, reach = df.withColumn(out, F.col(source)), 1
    while reach < width:
        step = min(reach, width - reach)
        df = df.withColumn(out, F.zip_with(out, F.slice(out, F.lit(step + 1), F.lit(1 << 30)), lambda a, b: join(a, b)))
        reach += step
    return df.withColumn(out, F.slice(out, F.lit(1), F.greatest(F.size(source) - (width - 1), F.lit(0))))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def fingerprints(df: DataFrame) -> DataFrame:
    """``df``, which has ``words``, with ``prints``: the distinct winnowed hashes."""
    df = _over(_hashed(df), "hashes", "grams", GRAM, F.xxhash64)
    df = _over(df, "grams", "prints", WINDOW - GRAM + 1, F.least)
    return df.withColumn("prints", F.array_distinct("prints")).drop("hashes", "grams")


def runs(df: DataFrame, width: int) -> DataFrame:
    """``df`` with ``prints``: the distinct hashes of all runs of ``width`` words."""
    df = _over(_hashed(df), "hashes", "prints", width, F.xxhash64)
    return df.withColumn("prints", F.array_distinct("prints")).drop("hashes")


def _windows(size):
    """Every run of ``size`` of the words, as text; words hold no blanks."""
    places = F.sequence(F.lit(1), F.size("words") - size + 1)
    made = F.transform(places, lambda i: F.concat_ws(" ", F.slice("words", i, size)))
    return F.when(F.size("words") >= size, made).otherwise(F.array().cast("array<string>"))


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, words, size`` of items that have words; ``size`` words make a window."""
    found = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("words"))
    return found.filter("size(words) > 0 and item_id is not null").withColumn(
        "size", F.least(F.size("words"), F.lit(WINDOW))
    )


def _meeting(rows: DataFrame, prints: DataFrame, count: int) -> DataFrame:
    """Keys of the rows that share a fingerprint."""
    parts = rows.select("doc_id", "text_hash", F.explode("prints").alias("print"))
    return parts.join(bounded_broadcast(prints, count, 40), "print", "left_semi").select("doc_id", "text_hash").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, n_words, n_hit, n_items, items, contaminated``.

    Rows are known by id and hash of the text: rows alike in both have the same result.
    """
    key = ["doc_id", "text_hash"]
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col, F.octet_length(text_col)).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    split = texts.select(*key, words(F.col("text")).alias("words"))
    rows = fingerprints(split).select(*key, F.size("words").cast("long").alias("n_words"), "prints")
    rows = store(rows, "winnow-documents")

    wanted = store(item_windows(items, item_id_col, item_text_col), "winnow-items")
    full = wanted.filter(F.col("size") == WINDOW)
    prints = store(fingerprints(full).select(F.explode("prints").alias("print")).distinct(), "winnow-prints")
    candidates = _meeting(rows, prints, prints.count())
    sizes = sorted(r["size"] for r in wanted.filter(F.col("size") < WINDOW).select("size").distinct().collect())
    for size in sizes:  # at most WINDOW - 1 of them
        short = runs(wanted.filter(F.col("size") == size), size).select(F.explode("prints").alias("print")).distinct()
        short = store(short, "winnow-short")
        candidates = candidates.unionByName(_meeting(runs(split, size), short, short.count()))
    candidates = store(candidates.distinct(), "winnow-candidates")

    windows = wanted.select("item_id", "size", F.explode(_windows(F.col("size"))).alias("window")).distinct()
    windows = store(windows, "winnow-windows")
    texts_of = store(windows.select("window").distinct(), "winnow-texts")
    n_windows = texts_of.count()
    meant = texts.join(candidates, _same(texts, candidates), "left_semi").dropDuplicates(key)
    meant = store(meant.select(*key, words(F.col("text")).alias("words")), "winnow-words")
    found = None
    for size in [*sizes, WINDOW]:
        places = meant.select(*key, F.posexplode(_windows(F.lit(size))).alias("place", "window"))
        hits = places.join(bounded_broadcast(texts_of, n_windows, 400), "window", "left_semi").withColumn("size", F.lit(size))
        found = hits if found is None else found.unionByName(hits)
    found = store(found, "winnow-hits")

    covered = found.select(*key, F.explode(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("word"))
    n_hit = covered.distinct().groupBy(key).agg(F.count("*").alias("n_hit"))
    listed = found.select(*key, "window").distinct().join(windows.select("window", "item_id"), "window")
    listed = listed.select(*key, "item_id").distinct().groupBy(key).agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items")
    )
    results = store(
        n_hit.alias("a").join(listed.alias("b"), _same(n_hit, listed, "a", "b")).select(
            "a.doc_id", "a.text_hash", "n_hit", "n_items", "items"
        ), "winnow-results",
    )
    return rows.alias("a").join(results.alias("b"), _same(rows, results, "a", "b"), "left").select(
        "a.doc_id", "a.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _same(left: DataFrame, right: DataFrame, a: str | None = None, b: str | None = None):
    """Join condition on the key, in which missing ids are alike."""
    this, that = (lambda c: F.col(f"{a}.{c}") if a else left[c]), (lambda c: F.col(f"{b}.{c}") if b else right[c])
    return (this("text_hash") == that("text_hash")) & this("doc_id").eqNullSafe(that("doc_id"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""

    def hit():
        found = contamination(docs, items, id_col, text_col).filter("contaminated")
        return found.select(F.col("doc_id").alias("drop_id_"), F.col("text_hash").alias("drop_hash_")).distinct()

    found = settle(docs.sparkSession, hit, "winnow-drop")
    text_hash = F.xxhash64(docs[text_col], F.octet_length(docs[text_col]))
    same = (text_hash == found["drop_hash_"]) & docs[id_col].eqNullSafe(found["drop_id_"])
    return docs.join(found, same, "left_anti")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside benchmark windows."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", joined.alias("items_sha256"), "contaminated")


_WORDS_SQL = """list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""
OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, t.item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM places) p
  JOIN windows t ON p.t = t.t AND p.n = t.n),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS items_sha256 FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

"""Exact duplicates by distributed MSD radix partitioning.

Texts are compared by their own bytes, never by a digest. A round reads the next digit (a run of bytes) of every text
that still shares its group, splits each group by it, and drops texts that are alone. A text that has ended together with
others of its group is equal to them. Digits widen by ``GROWTH`` per round, so the number of rounds grows with the
logarithm of the longest shared text.

Texts are equal when identical after white space (``[\\x20\\x09-\\x0D]``) is deleted. Missing texts count as empty, and
empty texts are equal. Rows repeated in full form a group like any other. Of equal texts stays the row with the most code
points, then the smallest id, missing ids last, then the first row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.rows import ASCII_SPACE, table, text_bytes, unused
from lodestat.session import settle, store

FIRST_DIGIT = 256
GROWTH = 8


def _normalise(batches):
    for batch in batches:
        norms = [t.translate(None, ASCII_SPACE) for t in batch.column("norm").to_pylist()]
        shas = [hashlib.sha256(n).hexdigest() for n in norms]
        columns = [c for c in batch.schema.names if c != "norm"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(shas, pa.string()), pa.array(norms, pa.binary())],
            names=[*columns, "text_sha256", "norm"],
        )


def normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``uid, doc_id, n_chars, text_sha256, norm`` of each row, kept."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).alias("n_chars"),
        text_bytes(text_col).alias("norm"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, n_chars int, text_sha256 string, norm binary"
    return store(rows.mapInArrow(_normalise, schema), "radix-texts")


def equal_groups(texts: DataFrame, text_col: str = "norm") -> DataFrame:
    """``uid, gid`` of every row whose bytes another row shares; ``gid`` is the group's smallest ``uid``.

    The first digit of all rows is shuffled without the texts. Rows alone after it, most of them, are done; the others
    get their text once and carry what is left of it.
    """
    key = ["gid", "digit", "ended"]
    rows = texts.select(
        "uid", F.lit(0).cast("long").alias("gid"),
        F.substring(text_col, 1, FIRST_DIGIT).alias("digit"), (F.octet_length(text_col) <= FIRST_DIGIT).alias("ended"),
    )
    width, found = FIRST_DIGIT, []
    while True:
        # Kept apart from the join, so that Spark can split a group that holds many rows.
        shared = store(
            rows.groupBy(key).agg(F.min("uid").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n"),
            "radix-groups",
        )
        split = rows.join(shared, key).drop("gid", "digit").withColumnRenamed("head", "gid")
        split = store(split, "radix-members")
        found.append(split.filter("ended").select("uid", "gid"))
        active = split.filter("not ended").drop("ended")
        if active.isEmpty():
            break
        if len(found) == 1:  # those to go on with grow with the corpus: not for a broadcast
            rest = F.col(text_col)
            active = active.hint("merge").join(texts.select("uid", rest.alias("rest")), "uid")
            active = active.withColumn("rest", F.substring("rest", FIRST_DIGIT + 1, 2**31 - 1))
        width *= GROWTH
        rows = active.select(
            "uid", "gid", F.substring("rest", 1, width).alias("digit"),
            (F.octet_length("rest") <= width).alias("ended"),
            F.substring("rest", width + 1, 2**31 - 1).alias("rest"),
        )
        rows = store(rows, "radix-digits")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``uid, doc_id, keep_id, group_size, kept, text_sha256``."""
    texts = normalised(docs, id_col, text_col)
    rows = texts.select("uid", "doc_id", "n_chars", "text_sha256")
    members = rows.join(equal_groups(texts), "uid", "left").withColumn("gid", F.coalesce("gid", "uid"))
    best = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "uid")
    heads = store(
        members.groupBy("gid").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
        .select("gid", F.col("best.doc_id").alias("keep_id"), F.col("best.uid").alias("keep_uid"), "group_size"),
        "radix-heads",
    )
    return members.join(heads, "gid").select(
        "uid", "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    uid = unused("row_uid", docs)
    rows = store(docs.withColumn(uid, F.monotonically_increasing_id()), "radix-rows")
    slim = rows.select(F.col(uid).alias("row_key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kept = settle(docs.sparkSession, lambda: kept_keys(slim), "radix-kept")
    return rows.join(kept, rows[uid] == kept["row_key"], "left_semi").select(*docs.columns)


def kept_keys(slim: DataFrame) -> DataFrame:
    """``row_key`` of the rows that stay, of rows ``row_key, doc_id, text``."""
    packed = slim.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key").alias("doc_id"), "text")
    return exact_groups(packed).filter("kept").select(F.col("doc_id.row_key").alias("row_key"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for it."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("uid")


OP8_SQL = """
WITH norm AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS place,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size FROM norm)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM ranked
"""

"""Passages that repeat across documents, by hashes of sliding runs of sentences.

A text falls into sentences, at line ends and after ``.``, ``!`` or ``?`` before white space. A sentence of more than ``LONG``
words is cut further, after words chosen by their hash, so that copies are cut alike wherever they stand, or after ``MOST`` words. From each sentence starts a
run: the fewest consecutive sentences that are at least ``RUN`` and have ``RUN_WORDS`` words. Hashes of all runs are joined over the whole
corpus; of equal runs the first stays (smallest id, missing ids last, then first row, then place), and all sentences that any
other covers are removed. Repeats within a text count too.

Runs are equal when their words are, after lower-casing and apart from white space. Missing texts count as empty: no
sentences. Texts with fewer words than a run have no runs and stay whole. Repeated rows repeat all their runs: the first
stays whole.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lodestat.llm.pieces import portions
from lodestat.llm.rows import table, unused
from lodestat.session import store

RUN, RUN_WORDS = 3, 16
LONG = 12  # words beyond which a sentence is cut
LEAST, MOST = 4, 32  # words of a cut part
END = re.compile(r"[.!?]+\s+|\n\s*")
WORD = re.compile(r"\S+\s*")


def sentences(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, end, words, hash)`` of each sentence; together they cover the text from its first word on."""
    cuts = [0, *(m.end() for m in END.finditer(text)), len(text)]
    out = []

    def add(start: int, end: int, words: list[str]) -> None:
        out.append((start, end, len(words), xxhash.xxh64_intdigest(" ".join(words).lower())))

    for start, end in zip(cuts, cuts[1:]):
        words = text[start:end].split()
        if not words:
            continue
        if len(words) <= LONG:
            add(start, end, words)
            continue
        begin, run = start, []
        for m in WORD.finditer(text, start, end):
            word = m[0].strip()
            run.append(word)
            if len(run) == MOST or len(run) >= LEAST and zlib.crc32(word.lower().encode()) & 3 == 0:
                add(begin, m.end(), run)
                begin, run = m.end(), []
        if run:
            add(begin, end, run)
    return out


def runs(found) -> list[tuple[int, int, int]]:
    """``(hash, first, last)`` of the run from each sentence that begins one."""
    out, last, words = [], -1, 0
    for first in range(len(found)):
        while last + 1 < len(found) and (last - first + 1 < RUN or words < RUN_WORDS):
            last += 1
            words += found[last][2]
        if last - first + 1 < RUN or words < RUN_WORDS:
            break
        packed = b"".join(s[3].to_bytes(8, "big") for s in found[first : last + 1])
        out.append((xxhash.xxh64_intdigest(packed) - (1 << 63), first, last))
        words -= found[first][2]
    return out


FIELDS = {"hash": "q", "first": "i", "last": "i", "start": "i", "end": "i"}
SPAN = StructType([StructField(n, LongType() if k == "q" else IntegerType()) for n, k in FIELDS.items()])
PORTION = 1 << 20  # characters of texts worked on at a time


def _find(batches):
    """Sentences and runs of a portion of texts at a time, in flat arrays: objects would take many times a text's room."""
    for batch in batches:
        *kept, texts = batch.columns
        done = 0
        for part in portions((text.as_py() for text in texts), PORTION):
            columns, counts, ends = [array(k) for k in FIELDS.values()], array("q"), array("i", [0])
            for text in part:
                found = sentences(text)
                counts.append(len(found))
                for h, first, last in runs(found):
                    for column, value in zip(columns, (h, first, last, found[first][0], found[last][1])):
                        column.append(value)
                ends.append(len(columns[0]))
            spans = pa.StructArray.from_arrays([pa.array(np.asarray(c)) for c in columns], list(FIELDS))
            lists = pa.ListArray.from_arrays(pa.array(np.asarray(ends)), spans)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(done, len(part)) for c in kept), pa.array(np.asarray(counts)), lists],
                names=[*batch.schema.names[:-1], "n_sentences", "spans"],
            )
            done += len(part)


def _removed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``uid, doc_id, n_sentences`` and, by row, ``uid, places, ranges``: sentences and spans to remove."""
    schema = StructType([
        StructField("uid", LongType()), docs.schema["doc_id"], StructField("n_sentences", LongType()), StructField("spans", ArrayType(SPAN)),
    ])
    rows = store(docs.select("uid", "doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_find, schema), "span-runs")
    spans = rows.select("uid", "doc_id", F.explode("spans").alias("span")).select(
        F.col("span.hash").alias("hash"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "span.first").alias("at"),
        "span.last", "span.start", "span.end",
    )
    heads = spans.groupBy("hash").agg(F.min("at").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    heads = store(heads, "span-heads")
    again = spans.join(heads, "hash").filter(~F.col("at").eqNullSafe(F.col("head")))
    again = again.select(
        F.col("at.uid").alias("uid"), F.sequence("at.first", "last").alias("places"), F.struct("start", "end").alias("range")
    )
    removed = again.groupBy("uid").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.sort_array(F.collect_list("range")).alias("ranges")
    )
    return rows.drop("spans"), removed


def _merged(ranges):
    """Sorted spans, those that touch joined."""
    start = F.transform(ranges, lambda r: r)
    empty = F.slice(start, 1, 0)
    return F.aggregate(
        ranges, empty,
        lambda done, r: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= r["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], r["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_sentences, n_removed, removed``, the spans to remove in code points."""
    slim = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    rows, removed = _removed(slim)
    return rows.join(removed, "uid", "left").select(
        "doc_id", "n_sentences", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(_merged(F.col("ranges")), F.array().cast("array<struct<start:int,end:int>>")).alias("removed"),
    )


def _cut(batches):
    for batch in batches:
        *kept, texts, ranges = batch.columns
        done = 0
        for part in portions((text.as_py() or "" for text in texts), PORTION):
            out = []
            missing, cut = (c.slice(done, len(part)).to_pylist() for c in (texts.is_null(), ranges))
            for text, none, spans in zip(part, missing, cut):
                for span in reversed(spans or []):
                    text = text[: span["start"]] + text[span["end"] :]
                out.append(None if none else text)
            columns = [*(c.slice(done, len(part)) for c in kept), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
            done += len(part)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated sentences cut out of the text; the text column comes last."""
    uid, spans = unused("row_uid", docs), unused("row_ranges", docs)
    kept = store(docs.withColumn(uid, F.monotonically_increasing_id()), "span-rows")
    slim = kept.select(F.col(uid).alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    _, removed = _removed(slim)
    removed = removed.select(F.col("uid").alias(uid), _merged(F.col("ranges")).alias(spans))
    others = [c for c in docs.columns if c != text_col]
    rows = kept.join(removed, uid, "left").select(*others, F.col(text_col).cast("string"), spans)
    return rows.mapInArrow(_cut, StructType([f for f in rows.schema if f.name != spans]))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the spans that repeat earlier ones."""
    found = repeated_spans(table(spark, sf_dir, "documents"))
    text = F.transform("removed", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string")))
    n_chars = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_sentences", "n_removed", F.concat_ws(",", text).alias("removed"), n_chars.alias("n_chars_removed"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )

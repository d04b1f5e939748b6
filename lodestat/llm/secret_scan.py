"""Secrets in texts, told apart by who owns them.

Candidates are strings that look like secrets: the base kinds (``assign``, ``access``, ``hex``), and single words of 20 or more
characters of ``[A-Za-z0-9+/_=-]`` with digits, small and capital letters. Their hashes are aggregated over the whole
corpus by distinct repositories and distinct owners. A value that ``COMMON`` or more owners hold is a widely copied example;
one that a single owner holds is specific to that owner and looks live. Base spans always stay, marked with their verdict. A word
outside base spans is added as a span of kind ``owned`` where one owner alone holds it.

Spans are ``kind:start:end`` in code points, the end exclusive, of the whole match. Missing texts count as empty and have no
spans; missing owners and repositories count as one of their own, the empty one. Repeated rows are scanned each.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.rows import table, text_bytes
from lodestat.session import store

ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
WORD = re.compile(rb"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[A-Z0-9+/_=-]*[a-z])(?=[a-z0-9+/_=-]*[A-Z])"
                  rb"[A-Za-z0-9+/_=-]{20,}")
COMMON = 3
# All bytes but those of the class become blanks, so that long runs are found by a plain search.
_HEX_RUN, _WORD_RUN = b"h" * 16, b"w" * 20
_AS_HEX = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_WORD_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_AS_WORD = bytes(0x77 if b in _WORD_BYTES else 0x20 for b in range(256))
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def base_matches(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """``(start, end, kind, value)`` of the base kinds, in bytes, by start, then kind."""
    found = []
    lowered = text.lower()
    if any(key in lowered for key in _KEYS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                found.append((m.start(), m.end(), 0, m[2]))
    if b"AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    runs, end = text.translate(_AS_HEX), 0
    while (start := runs.find(_HEX_RUN, end)) >= 0:
        end = runs.find(b" ", start)
        end = len(text) if end < 0 else end
        found.append((start, end, 2, text[start:end]))
    return sorted(found)


def word_matches(text: bytes, taken) -> list[tuple[int, int, bytes]]:
    """Mixed words of 20 or more characters that touch no span of ``taken``."""
    if _WORD_RUN not in text.translate(_AS_WORD):
        return []
    return [
        (m.start(), m.end(), m[0])
        for m in WORD.finditer(text)
        if all(m.end() <= start or m.start() >= end for start, end, *_ in taken)
    ]


def _places(text: bytes, offsets) -> dict[int, int]:
    """Byte offsets as code points."""
    places, before, points = {}, 0, 0
    for offset in sorted(set(offsets)):
        points += len(text[before:offset].decode())
        places[offset], before = points, offset
    return places


_FOUND = "array<struct<start:int,end:int,kind:int,hash:binary>>"


def _scan(batches):
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("hash", pa.binary())])
    )
    for batch in batches:
        *kept, texts = batch.columns
        rows = []
        for text in texts.to_pylist():
            base = base_matches(text)
            spans = base + [(start, end, 3, value) for start, end, value in word_matches(text, base)]
            at = _places(text, (edge for span in spans for edge in span[:2]))
            rows.append([
                {"start": at[s], "end": at[e], "kind": k, "hash": hashlib.sha256(v).digest()[:16]} for s, e, k, v in spans
            ])
        yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, kind)], names=[*batch.schema.names[:-1], "found"])


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """``uid, doc_id, owner, repo, found``: the candidates of each row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        text_bytes(text_col).alias("text"),
    )
    schema = f"uid long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, owner string, repo string, found {_FOUND}"
    return store(rows.mapInArrow(_scan, schema), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repos`` of every candidate value: distinct owners and repositories that hold it.

    Copies within a repository are merged before the shuffle, so that a value copied everywhere leaves a row per
    repository and task.
    """
    held = found.select("owner", "repo", F.explode("found.hash").alias("hash")).distinct()
    return held.groupBy("hash").agg(
        F.countDistinct("owner").alias("owners"), F.countDistinct("owner", "repo").alias("repos")
    )


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, found``, spans by start and kind, each ``start, end, kind, owners, repos, verdict``.

    A repository is named by its owner and ``repo_col``.
    """
    rows = scan(docs, id_col, text_col, owner_col, repo_col)
    owners = store(ownership(rows), "secret-owners")
    spans = rows.select("uid", F.explode("found").alias("span")).select("uid", "span.*").join(owners, "hash")
    verdict = F.when(F.col("owners") >= COMMON, "example").when(F.col("owners") == 1, "live").otherwise("shared")
    spans = spans.withColumn("verdict", verdict).filter("kind < 3 or verdict = 'live'")
    names = F.array(*map(F.lit, (*KINDS, "owned")))
    whole = F.struct("start", F.col("kind").alias("order"), "end", names[F.col("kind")].alias("kind"), "owners", "repos", "verdict")
    listed = spans.groupBy("uid").agg(F.sort_array(F.collect_list(whole)).alias("spans"))
    return rows.select("uid", "doc_id").join(listed, "uid", "left").select("doc_id", F.col("spans").alias("found"))


def _joined(spans):
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", text)


def _count(field: str, value: str):
    """How many of the spans have this value."""
    n = F.size(F.filter("found", lambda span: span[field] == value))
    return F.coalesce(n, F.lit(0)).cast("long").alias(f"n_{value}")


def op2_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans and what their owners say of them."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    counts = [_count("kind", kind) for kind in KINDS] + [_count("verdict", v) for v in ("live", "shared", "example")]
    base = F.filter("found", lambda s: s["kind"] != "owned")
    return found.select(
        "doc_id", *counts[:3], F.sha2(F.coalesce(_joined(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("found")), F.lit("")).alias("spans"), *counts[3:],
    )

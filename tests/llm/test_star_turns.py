"""What a list of near copies costs, and portions of batches."""

import numpy as np
import pyarrow as pa
from lodestat.llm import jaccard_join
from pyspark.sql import functions as F
from test_near_stage import edited


def copies(many):
    """A text, and copies with two words changed, which link with it and not with each other."""
    words = [f"a{k}" for k in range(150)]
    rows = [(0, " ".join(words))]
    for k in range(1, many + 1):
        copy = list(words)
        copy[5 + k % 60], copy[140 - k % 60] = f"b{k}", f"c{k}"
        rows.append((k, " ".join(copy)))
    return rows + [(many + 1, " ".join(edited(words, 6)))]


def test_copies_of_one_text_are_compared_with_it_and_not_with_each_other(spark, monkeypatch):
    compared, plain = [], jaccard_join.store

    def counted(df, label="table"):
        out = plain(df, label)
        compared.append(out.count() if label == "jaccard-pairs" else 0)
        return out

    monkeypatch.setattr(jaccard_join, "store", counted)
    docs = spark.createDataFrame(copies(120), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_groups(docs).collect()}
    assert got == {k: 0 for k in range(121)} | {121: 121}
    assert sum(compared) <= 4 * len(got)


def test_sets_of_one_component_do_not_meet(spark):
    rows = [(1, k, 100, 0, 7) for k in range(20)] + [(1, 50, 100, 2, 50), (1, 60, 90, 0, 60), (1, 70, 100, 40, 70), (1, 80, 50, 0, 80)]
    rest = spark.createDataFrame(rows, "key long, set_id long, n long, place long, root long")
    other = rest.select("key", *(F.col(c).alias(f"other_{c}") for c in ("set_id", "n", "place", "root")))
    plain = rest.join(other, "key").filter("set_id < other_set_id and root <> other_root")
    plain = plain.filter(jaccard_join._similar_size(F.col("n"), F.col("other_n"), 85))
    plain = plain.filter(jaccard_join._enough_left("n", "place", "other_n", "other_place", 85))
    got = {tuple(r) for r in jaccard_join._pairs_left(rest, 85).collect()}
    assert got == {(r.set_id, r.other_set_id) for r in plain.collect()} and len(got) == 41


def test_parts_hold_every_row_once_and_few_bytes():
    texts = pa.array([b"x" * k for k in (0, 9, 1, 30, 2, 2, 0)] + [None], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), texts], names=["doc_id", "text"])
    parts = list(jaccard_join._parts([batch, batch.slice(0, 0)], "text", 10))
    assert [r for part in parts for r in part.to_pylist()] == batch.to_pylist()
    assert [part.num_rows for part in parts] == [3, 1, 4]


def test_repeated_values_are_counted():
    values, counts = jaccard_join._repeated([np.array(v, np.uint64) for v in ([1, 5, 9], [5, 9], [9, 1 << 63], [])])
    assert values.tolist() == [5, 9] and counts.tolist() == [2, 3]
    assert [len(v) for v in jaccard_join._repeated([])] == [0, 0]

import pickle

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestat.operators import blocks, classify, clusters, doc_rows, mixture, slices


class Caught:
    """Rows that hand over what they would map with."""

    def __init__(self, schema):
        self.schema = schema

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def batch(n=6, width=5):
    ids = pa.array(range(n), pa.int64())
    ends = pa.array(range(0, n * width + 1, width), pa.int32())
    words = pa.ListArray.from_arrays(ends, pa.array([f"w{i % 7}" for i in range(n * width)]))
    cnts = pa.ListArray.from_arrays(ends, pa.array(range(1, n * width + 1), pa.int64()))
    return pa.RecordBatch.from_arrays([ids, words, cnts], names=["doc_id", "words", "cnts"])


def test_long_batches_are_cut():
    whole = batch()
    assert [b.num_rows for b in blocks.cut([whole], "words", 10)] == [2, 2, 2]
    assert [b.num_rows for b in blocks.cut([whole], "words", 1)] == [1] * 6
    assert [b.num_rows for b in blocks.cut([whole.slice(1, 4)], "words", 12)] == [2, 2]
    assert list(blocks.cut([whole.slice(0, 0)], "words")) == []
    assert pa.Table.from_batches(blocks.cut([whole], "words", 7)).combine_chunks().to_pydict() == whole.to_pydict()


def test_a_task_holds_arrays_of_few_rows_at_a_time(spark, monkeypatch):
    rows = Caught(spark.createDataFrame([], "doc_id long, words array<string>, cnts array<bigint>").schema)
    vocab = spark.createDataFrame([(f"w{i}", i) for i in range(5)], "word string, term_id int")
    run = doc_rows.term_rows(rows, vocab, 10).run
    whole = pa.Table.from_batches(run([batch()])).combine_chunks().to_pydict()
    monkeypatch.setattr(blocks, "ENTRIES", 10)
    parts = list(run([batch()]))
    assert len(parts) == 3 and pa.Table.from_batches(parts).combine_chunks().to_pydict() == whole


def test_blocks_add_up_to_what_rows_do(spark):
    draw = np.random.default_rng(3)
    size = slices.SLICE + 9
    data = [(f"d{i}", float(i % 2), sorted(draw.choice(size, i % 5, False).tolist()), draw.random(i % 5).tolist()) for i in range(40)]
    rows = spark.createDataFrame(data, "doc_id string, label double, idx array<int>, val array<double>").repartition(3)
    packed = blocks.per_core(blocks.packed(rows, "label", "idx", "val"))
    assert sum(len(block[0]) for block in packed.collect()) == 40
    weights, objective = draw.random(size), classify.logistic_objective()
    cost, gradient = classify.evaluate_objective(rows, weights, objective)
    again, same = classify.evaluate_objective(packed, weights, objective)
    assert again == pytest.approx(cost) and same == pytest.approx(gradient)
    none = blocks.packed(rows.limit(0), "label", "idx", "val")
    assert classify.evaluate_objective(none, np.zeros(size), objective)[0] == 0


def test_tasks_draw_the_numbers_that_columns_do(spark):
    ids = ["a", "posts/x/12", "ü", None, ""]
    found = spark.createDataFrame([(i, d) for i, d in enumerate(ids)], "i int, d string").orderBy("i")
    want = [r["u"] for r in found.select(mixture.uniform(7, 3, F.col("d")).alias("u")).collect()]
    assert mixture._uniforms(7, 3, ids).tolist() == want


def test_counts_are_not_sorted_to_meet_their_clusters(spark):
    vocab = spark.createDataFrame([("w", 0)], "word string, term_id int")
    counts = spark.createDataFrame([("a", 0, 2), ("a", 0, 3), ("b", 0, 1)], "doc_id string, term_id int, cnt bigint")
    assigned = spark.createDataFrame([("a", 1), ("a", 1), ("c", 0)], "doc_id string, cluster int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = clusters.cluster_term_counts(counts, assigned, vocab, 2, 1)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin [doc_id" in plan and "SortMergeJoin [doc_id" not in plan
        assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 0), (1, 0, 10)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packed_entries_are_small_and_the_same():
    draw = np.random.default_rng(4)
    room = blocks.Room()
    for entries in (draw.integers(0, 20_000, 5000), draw.integers(1, 9, 5000), draw.integers(1, 9, 5000) / draw.integers(20, 40, 5000)):
        packed = blocks.small(entries)
        assert len(pickle.dumps(packed)) <= 0.4 * len(pickle.dumps(entries))
        assert room.filled("x", packed, entries.dtype).tolist() == entries.tolist()
    odd = np.array([0.0, -0.0, np.nan, np.inf, -1.5] * 99)
    assert room.filled("x", blocks.small(odd)).tobytes() == odd.tobytes()
    alone = draw.random(100)
    assert blocks.small(alone) is alone and blocks.small(np.array([-1, 70_000])).tolist() == [-1, 70_000]
    with pytest.raises(IndexError):
        room.places("y", np.array([3, 5]), 5)


def test_sums_of_waiting_entries_are_those_of_all():
    draw = np.random.default_rng(5)
    sums, want = blocks.Sums(50), np.zeros(50)
    for n in (3, 0, 40, 20, 200, 1):
        at, value = draw.integers(0, 50, n), draw.integers(0, 9, n)
        places, added = sums.add(n)
        places[:], added[:] = at, value
        want += np.bincount(at, weights=value, minlength=50)
    assert sums.finish().tolist() == want.tolist()


def test_chosen_rows_are_packed_anew(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 4)
    found = [(np.array([1.0, 2, 3]), np.array([2, 0, 3]), np.arange(5), np.arange(5) / 4), (np.array([4.0]), np.array([2]), np.array([7, 8]), np.array([1.0, 2]))]
    room, got = blocks.Room(), []
    for keys, sizes, idx, val in blocks.chosen(found, lambda y, *_: y != 1):
        ends = np.cumsum(sizes)
        idx, val = room.filled("i", idx, np.int64).tolist(), room.filled("v", val).tolist()
        got += [(y, idx[e - n : e], val[e - n : e]) for y, n, e in zip(keys, sizes, ends)]
    assert got == [(2, [], []), (3, [2, 3, 4], [0.5, 0.75, 1.0]), (4, [7, 8], [1.0, 2.0])]

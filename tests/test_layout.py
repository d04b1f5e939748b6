import os

import pytest
from pyspark.sql import functions as F

from lodestat import layout
from lodestat.operators import classify, vectors, vocab
from lodestat.plans import cases, pages, posts
from lodestat.session import Kept, fresh_path, materialize, shared_folder, store


@pytest.fixture
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(spark, no_automatic_broadcast, monkeypatch):
    tokens = spark.createDataFrame([(d, w) for d in "ab" for w in "x y z".split()], "doc_id string, word string")
    words = vocab.vocabulary(vocab.word_count(tokens), 2)
    small = vectors.doc_term_counts(tokens, words, 2)
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(layout, "BROADCAST_BYTES", 10)
    large = vectors.doc_term_counts(tokens, words, 2)
    assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
    assert sorted(small.collect()) == sorted(large.collect())


def test_scores_beyond_the_bound(spark, no_automatic_broadcast, monkeypatch):
    values = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 1, 3.0)], "doc_id string, term_id int, value double")
    weights = spark.createDataFrame([(0, 0.5), (1, -1.0)], "term_id int, weight double")
    monkeypatch.setattr(layout, "BROADCAST_BYTES", 10)
    scores = classify.linear_scores(values, weights)
    assert "BroadcastHashJoin" not in plan(scores)
    assert {r["doc_id"]: r["score"] for r in scores.collect()} == {"a": -1.5, "b": -3.0}


def test_spread_leaves_many_splits_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=cores)
    assert layout.spread(many) is many
    assert layout.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == cores


def test_passes_leave_sums_per_core_not_per_split(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 4000, 1, 50 * cores).select(
        F.lit(1.0).alias("label"), F.array(F.lit(0), F.lit(1)).alias("idx"), F.array(F.lit(1.0), F.lit(2.0)).alias("val")
    )
    few = layout.gathered(rows)
    assert few.rdd.getNumPartitions() == 4 * cores
    shared = classify.share_weights(spark, [0.0, 0.0])
    totals = [classify.loss_pass(r, shared, classify.logistic_objective().loss).collect() for r in (rows, few)]
    assert sorted((r["term_id"], round(r["total"], 6)) for r in totals[0]) == sorted((r["term_id"], round(r["total"], 6)) for r in totals[1])
    assert layout.gathered(spark.range(10, numPartitions=2)).rdd.getNumPartitions() == 2


def test_kept_tables(spark):
    df = spark.range(5).select("id", F.array(F.lit(1.5)).alias("v"))
    for kept in (materialize(df), store(df)):
        assert kept.columns == df.columns and sorted(kept.collect()) == sorted(df.collect())
    assert fresh_path(spark, "x").startswith(shared_folder(spark)) and fresh_path(spark, "x") != fresh_path(spark, "x")


class Settings:
    """As much of a session as the folder lookup sees."""

    def __init__(self, named, master="yarn", folder=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_folder_of_the_cluster_is_used():
    assert shared_folder(Settings("hdfs://shared/kept/")) == "hdfs://shared/kept"
    assert shared_folder(Settings(None, folder="hdfs://other")) == "hdfs://other"
    with pytest.raises(ValueError):
        shared_folder(Settings(None))
    assert "lodestat-" in shared_folder(Settings(None, master="local[2]"))


def test_owners_delete_what_they_own(spark):
    with Kept() as outer:
        first = store(spark.range(3), "first")
        with Kept() as inner:
            store(spark.range(4), "second")
            with outer:  # an inner owner's block may store for an outer one
                outer.hold()
                third = materialize(spark.range(5))
            store(spark.range(6), "fourth")
            assert len(inner.paths) == 2 and len(outer.paths) == 2
        assert not inner.paths and first.count() == 3 and third.count() == 5
    assert len(outer.paths) == 2
    outer.close()
    outer.close()
    assert not outer.paths and not Kept._open


@pytest.mark.parametrize("job", ("pages", "logistic", "lbfgs", "svm", "posts"))
def test_jobs_leave_nothing_behind(spark, text_file, job):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    lines = [f'<doc id="{"AU" * (k % 2)}{k}" url="u" title="t">{"alpha beta" if k % 2 else "gamma delta beta"} {"x" * (k % 3)}</doc>' for k in range(12)]
    path = text_file("cases.txt", *lines)
    if job == "pages":
        done = pages.PageIndex.build(spark, path, text_file("links.csv", *[f'"{k}","c{k % 3}"' for k in range(12)]))
        assert done.predict(["gamma"], 3).count()
    elif job == "posts":
        done = posts.cluster_posts(spark, path, k=2, sweeps=2, size=5)
        assert done.top_categories(1).count() >= 0 and done.doc_counts().count()
    else:
        settings = {"max_iter": 3} if job != "lbfgs" else {}
        done = getattr(cases, job)(spark, path, path, size=4, **settings)
        assert done.confusion().count() == 1
    assert set(os.listdir(folder)) > before
    done.close()
    assert set(os.listdir(folder)) == before

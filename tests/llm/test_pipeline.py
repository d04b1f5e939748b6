import __spark_entry__ as registry
import corpus_pipeline
from lodestat.llm import toxicity
from lodestat.session import store
from tests_llm_brute import brute_components, brute_hits, by_norm

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in registry.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in registry.queries()


def test_stages_agree_with_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_LABEL", 60)
    monkeypatch.setattr(toxicity, "STRIDE", 24)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = store(stage(spark, docs, SF_DIR), "stage")
        kept = {r.doc_id for r in docs.collect()}
        if name == "exact dedup":
            best = {min(g, key=lambda r: (-len(r.text), r.doc_id)).doc_id for g in by_norm(before).values()}
            assert kept == best
        elif name == "n-gram Jaccard join":
            roots = brute_components([(r.doc_id, r.text) for r in before])
            assert kept == {k for k, (n, root) in roots.items() if root == k}
        elif name == "benchmark decontamination":
            assert kept == {r.doc_id for r in before if not brute_hits(r.text, items)[1]}
        elif name == "byte-level BPE":
            assert docs.columns == [*columns, "token_ids", "decoded"]
            assert all(bytes(r.decoded).decode() == r.text for r in docs.collect()) and len(kept) == len(before)
        if name != "byte-level BPE":
            assert docs.columns == columns and 0 < len(kept) <= len(before)

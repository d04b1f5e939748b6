import numpy as np
import pyarrow as pa

from lodestat.llm import jaccard_join, prefix_bpe, toxicity


class Shared:
    def __init__(self, value):
        self.value = value


def test_texts_of_sets_that_nobody_asks_for_are_not_split(monkeypatch):
    texts = [f"a{i} b c d e{i}".encode() for i in range(6)]
    names = [jaccard_join.set_hash(jaccard_join.Shingler(4)(t)) for t in texts]
    split = []

    class Counted(jaccard_join.Shingler):
        def __call__(self, text):
            split.append(text)
            return super().__call__(text)

    monkeypatch.setattr(jaccard_join, "Shingler", Counted)
    bits = np.zeros(1 << jaccard_join.BLOOM_BITS - 3, np.uint8)
    slot = names[2] & (1 << jaccard_join.BLOOM_BITS) - 1
    bits[slot >> 3] |= 128 >> (slot & 7)
    batch = pa.RecordBatch.from_arrays([pa.array(names + names, pa.int64()), pa.array(texts + texts, pa.binary())], names=["set_id", "text"])
    (found,) = jaccard_join._wanted_sets(4, Shared(bits))([batch])
    assert found.column("set_id").to_pylist() == [names[2]] and split == [texts[2]]
    assert found.column("found").to_pylist() == [jaccard_join.Shingler(4)(texts[2]).tobytes()]


def test_a_batch_is_scored_in_portions():
    texts = ["word " * 60_000] * 5 + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    shared = Shared(toxicity.Network().p)
    parts = list(toxicity._score(shared, "text", "score")([batch]))
    assert len(parts) == 2 and [d for p in parts for d in p.column("doc_id").to_pylist()] == list(range(7))
    scores = [s for p in parts for s in p.column("score").to_pylist()]
    assert [n for p in parts for n in p.schema.names] == ["doc_id", "text", "score"] * 2
    want = toxicity.Scorer(shared.value)([b"word " * 60_000] * 4)
    assert scores[:4] == list(want) and scores[5] == scores[6]
    old = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b"word"])], names=["doc_id", "made"])
    (part,) = toxicity._score(Shared(None), None, "made")([old])
    assert part.to_pydict() == {"doc_id": [1], "made": [0.0]}


def test_a_batch_is_encoded_in_portions():
    texts = ["word " * 60_000] * 4 + ["", "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(texts)], names=["doc_id", "text_"])
    for results in (prefix_bpe._id_columns, prefix_bpe._digest_columns):
        parts = list(prefix_bpe._each_text(None, results)([batch]))
        assert [p.num_rows for p in parts] == [2, 2, 2]
        whole = results(prefix_bpe.encoder(prefix_bpe.public_tokenizers.path(prefix_bpe.FILE)), texts)
        got = pa.Table.from_batches(parts).to_pydict()
        assert got == {"doc_id": list(range(6)), **{name: column.to_pylist() for name, column in whole.items()}}
    (part,) = prefix_bpe._each_text(None, prefix_bpe._id_columns)([batch.slice(4, 1)])
    assert part.to_pydict() == {"doc_id": [4], "token_ids": [[]], "decoded": [b""]}


def test_training_scores_its_windows_in_portions(monkeypatch):
    texts = [b" ".join(b"w%d" % (40 * k + i) for i in range(40)) for k in range(60)]
    labels = (np.arange(60) % 2).astype(np.float32)
    seen, inputs = [], toxicity.Network.inputs
    monkeypatch.setattr(toxicity, "BATCH", 16)
    want = toxicity.train(texts, labels).p
    monkeypatch.setattr(toxicity, "AT_ONCE", 16)
    monkeypatch.setattr(toxicity.Network, "inputs", lambda self, buckets: seen.append(len(buckets[0])) or inputs(self, buckets))
    got = toxicity.train(texts, labels).p
    assert max(seen) <= 16 * toxicity.WINDOW < 60 * 40 and want.keys() == got.keys()
    assert all(np.allclose(want[name], got[name], atol=1e-3) for name in got)

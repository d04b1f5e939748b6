"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained here.

A text is read in overlapping windows of ``WINDOW`` words, ``STRIDE`` words apart, the last one at its end. A word enters as two
vectors: one of the whole word, and the mean of those of its character trigrams; both come from hashed tables,
so words never seen in training still have characters. A network of gated units reads each window forwards and backwards;
attention weighs its states; the weighted sum gives the window's probability. A text scores as its highest window.

Training takes at most ``PER_LABEL`` labelled rows of each label, those of the smallest hash of the id, whose texts have at
most ``LONGEST`` bytes: a bounded sample. A label holds for a text and not
for each window: training first takes windows at random, then those that the network scores highest. Scoring reads all
windows of all texts.

Missing texts count as empty; an empty text is one window without words and scores what the network gives it. Labels missing or other
than 0 and 1 aren't learned from; ids labelled several times count once per label row. Repeated rows are scored each. Without
rows of both labels nothing can be learned, and every text scores 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.rows import table, text_bytes, unused

WINDOW, STRIDE = 24, 12
BUCKETS, DEPTH, UNITS = 1 << 13, 8, 8
PER_LABEL, LONGEST = 1500, 1 << 16  # rows to learn from, and bytes of such a row's text
EPOCHS, BATCH, RATE = 8, 128, 0.01
THRESHOLD = 0.7
AT_ONCE = 4096  # windows scored together


class Words:
    """Numbers of words; for each, the buckets of the word and of its trigrams."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        out = []
        numbers = self.numbers
        for text in texts:
            found = text.lower().split()
            for word in found:
                if word not in numbers:
                    numbers[word] = len(numbers)
            out.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        return out

    def buckets(self, first: int = 0):
        """Of words from number ``first`` on: word buckets, trigram buckets one after the other, and trigrams per word."""
        words = list(self.numbers)[first:]
        whole = np.fromiter((zlib.crc32(w) % BUCKETS for w in words), np.int64, len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"^".join([b"", *words, b""]), np.uint8).astype(np.uint32)
        # each word's bytes, with a mark on either side, hold as many trigrams as bytes
        value = (data[:-2] * np.uint32(0x85EBCA6B) ^ data[1:-1] * np.uint32(0xC2B2AE35) ^ data[2:] * np.uint32(0x27D4EB2F))
        value = (value ^ (value >> np.uint32(15))) % np.uint32(BUCKETS)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        inside = np.ones(len(value) + 2, bool)
        inside[starts] = False
        return whole, value[inside[1:-1]].astype(np.int64), sizes


def windows(numbers: np.ndarray) -> np.ndarray:
    """Rows of ``WINDOW`` word numbers, -1 where a text is shorter; they cover all words."""
    n = len(numbers)
    if n <= WINDOW:
        return np.pad(numbers, (0, WINDOW - n), constant_values=-1)[None]
    starts = np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)
    return numbers[starts[:, None] + np.arange(WINDOW)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, and passes over windows of words."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)

        def small(*shape, scale=0.3):
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": small(BUCKETS, DEPTH), "chars": small(BUCKETS, DEPTH),
            "into": small(2, 2 * DEPTH, 3 * UNITS), "shift": np.zeros((2, 3 * UNITS), np.float32),
            "back": small(2, UNITS, 3 * UNITS), "look": small(2 * UNITS), "out": small(2 * UNITS),
            "base": np.full(1, -1.0, np.float32),
        }

    def inputs(self, buckets) -> np.ndarray:
        """A vector for each word."""
        whole, trigrams, sizes = buckets
        if not len(whole):
            return np.zeros((0, 2 * DEPTH), np.float32)
        starts = np.cumsum(sizes) - sizes
        chars = np.add.reduceat(self.p["chars"][trigrams], starts, axis=0) / sizes[:, None]
        return np.concatenate([self.p["word"][whole], chars], axis=1).astype(np.float32)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions; the last row, of no word, is zero."""
        rows = np.einsum("nd,gdk->gnk", vectors, self.p["into"]) + self.p["shift"][:, None]
        return np.concatenate([rows, np.zeros((2, 1, 3 * UNITS), np.float32)], axis=1)

    def states(self, added: np.ndarray, rows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of both directions at every place of every window."""
        n, inside = len(rows), (rows >= 0).astype(np.float32)
        out = np.empty((n, WINDOW, 2 * UNITS), np.float32)
        for way in (0, 1):
            state, back = np.zeros((n, UNITS), np.float32), self.p["back"][way]
            for place in range(WINDOW) if way == 0 else reversed(range(WINDOW)):
                given = added[way][rows[:, place]]
                gates = _sigmoid(given[:, : 2 * UNITS] + state @ back[:, : 2 * UNITS])
                update = gates[:, :UNITS] * inside[:, place : place + 1]
                reset = gates[:, UNITS:]
                fresh = np.tanh(given[:, 2 * UNITS :] + (reset * state) @ back[:, 2 * UNITS :])
                if keep is not None:
                    keep.append((way, place, state, gates, fresh))
                state = state + update * (fresh - state)
                out[:, place, way * UNITS : (way + 1) * UNITS] = state
        return out

    def pooled(self, states: np.ndarray, rows: np.ndarray):
        looks = np.where(rows >= 0, states @ self.p["look"], -30.0)
        weights = np.exp(looks - looks.max(1, keepdims=True)) * (rows >= 0)
        weights /= np.maximum(weights.sum(1, keepdims=True), 1e-9)
        return weights, np.einsum("nt,ntk->nk", weights, states)

    def logits(self, added: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(rows), AT_ONCE):
            some = rows[at : at + AT_ONCE]
            out.append(self.pooled(self.states(added, some), some)[1] @ self.p["out"] + self.p["base"])
        return np.concatenate(out)

    def gradients(self, buckets, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of windows with labels."""
        p, n = self.p, len(rows)
        vectors, keep = self.inputs(buckets), []
        added = self.projected(vectors)
        states = self.states(added, rows, keep)
        weights, pooled = self.pooled(states, rows)
        miss = ((_sigmoid(pooled @ p["out"] + p["base"]) - labels) / n).astype(np.float32)
        g = {"out": pooled.T @ miss, "base": miss.sum(keepdims=True)}
        to_pooled = miss[:, None] * p["out"]
        to_weights = np.einsum("nk,ntk->nt", to_pooled, states)
        to_looks = weights * (to_weights - (weights * to_weights).sum(1, keepdims=True))
        g["look"] = np.einsum("nt,ntk->k", to_looks, states)
        to_states = weights[:, :, None] * to_pooled[:, None] + to_looks[:, :, None] * p["look"]
        inside = (rows >= 0).astype(np.float32)
        to_added, g["back"] = np.zeros_like(added), np.zeros_like(p["back"])
        ahead = [np.zeros((n, UNITS), np.float32), np.zeros((n, UNITS), np.float32)]
        for way, place, state, gates, fresh in reversed(keep):
            back, here = p["back"][way], inside[:, place : place + 1]
            total = ahead[way] + to_states[:, place, way * UNITS : (way + 1) * UNITS]
            update, reset = gates[:, :UNITS] * here, gates[:, UNITS:]
            to_fresh = total * update * (1 - fresh**2)
            to_held = to_fresh @ back[:, 2 * UNITS :].T
            to_gates = np.concatenate([total * (fresh - state) * here, to_held * state], axis=1) * gates * (1 - gates)
            g["back"][way][:, : 2 * UNITS] += state.T @ to_gates
            g["back"][way][:, 2 * UNITS :] += (reset * state).T @ to_fresh
            ahead[way] = total * (1 - update) + to_held * reset + to_gates @ back[:, : 2 * UNITS].T
            np.add.at(to_added[way], rows[:, place], np.concatenate([to_gates, to_fresh], axis=1))
        to_added = to_added[:, :-1]
        g["shift"] = to_added.sum(1)
        g["into"] = np.einsum("nd,gnk->gdk", vectors, to_added)
        to_vectors = np.einsum("gnk,gdk->nd", to_added, p["into"])
        whole, trigrams, sizes = buckets
        g["word"], g["chars"] = np.zeros_like(p["word"]), np.zeros_like(p["chars"])
        np.add.at(g["word"], whole, to_vectors[:, :DEPTH])
        np.add.at(g["chars"], trigrams, np.repeat(to_vectors[:, DEPTH:] / np.maximum(sizes, 1)[:, None], sizes, axis=0))
        return g


def _numbered_anew(rows: np.ndarray):
    """The distinct word numbers in ``rows``, and ``rows`` by place among them; -1 stays."""
    distinct, places = np.unique(rows, return_inverse=True)
    places = places.reshape(rows.shape)
    if len(distinct) and distinct[0] < 0:
        return distinct[1:], places - 1
    return distinct, places


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """A network fitted to labelled texts, all windows of which are read."""
    network, draw = Network(seed), np.random.default_rng(seed)
    words = Words()
    rows = [windows(numbers) for numbers in words(texts)]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    every = np.concatenate(rows)
    whole, trigrams, sizes = words.buckets()
    starts = np.cumsum(sizes) - sizes
    firsts = np.searchsorted(owner, np.arange(len(rows)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0

    def of_words(distinct):
        size = sizes[distinct]
        inner = np.repeat(starts[distinct] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return whole[distinct], trigrams[inner], size

    def logits(rows):
        distinct, places = _numbered_anew(rows)
        return network.logits(network.projected(network.inputs(of_words(distinct))), places)

    for epoch in range(EPOCHS):
        picked = [firsts + draw.integers(0, [len(r) for r in rows])]
        if epoch >= 2:
            scores = np.concatenate([logits(every[at : at + AT_ONCE]) for at in range(0, len(every), AT_ONCE)])
            order = np.lexsort((scores, owner))
            top = order[np.append(firsts[1:], len(owner)) - 1]
            # random windows of toxic texts may be clean
            picked = [top, picked[0][labels == 0]]
        else:
            picked.append(firsts + draw.integers(0, [len(r) for r in rows]))
        chosen = draw.permutation(np.concatenate(picked))
        for at in range(0, len(chosen), BATCH):
            some = chosen[at : at + BATCH]
            distinct, places = _numbered_anew(every[some])
            grads = network.gradients(of_words(distinct), places, labels[owner[some]])
            step += 1
            for name, grad in grads.items():
                first, second = moments[name]
                first += 0.1 * (grad - first)
                second += 0.01 * (grad * grad - second)
                unbiased = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                network.p[name] -= (RATE * unbiased * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
    return network


class Scorer:
    """Scores of texts; what words add to the gates is kept from batch to batch."""

    ROOM = 150_000

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.network = Network()
        self.network.p = parameters
        self._forget()

    def _forget(self) -> None:
        self.words, self.added = Words(), self.network.projected(np.zeros((0, 2 * DEPTH), np.float32))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        if len(self.words.numbers) > self.ROOM:
            self._forget()
        before = len(self.words.numbers)
        rows = [windows(numbers) for numbers in self.words(texts)]
        if len(self.words.numbers) > before:
            fresh = self.network.projected(self.network.inputs(self.words.buckets(before)))
            self.added = np.concatenate([self.added[:, :-1], fresh], axis=1)
        sizes = [len(r) for r in rows]
        logits = self.network.logits(self.added, np.concatenate(rows))
        return _sigmoid(np.maximum.reduceat(logits, np.cumsum(sizes) - sizes)).astype(float)


def _portions(texts, size: int = 1 << 20):
    """Runs of texts of about ``size`` bytes."""
    run, total = [], 0
    for text in texts:
        run.append(text.as_py() or b"")
        total += len(run[-1]) + 20
        if total >= size:
            yield run
            run, total = [], 0
    if run:
        yield run


def _score(shared, text: str | None, name: str):
    """Rows with the score of their column ``text``, or of the last one instead of it, a portion at a time."""

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for batch in batches:
            kept, names, start = batch.columns, batch.schema.names, 0
            texts = kept[-1] if text is None else batch.column(text)
            if text is None:
                kept, names = kept[:-1], names[:-1]
            else:
                texts = texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())
            for portion in _portions(texts):
                scores = scorer(portion) if scorer else np.zeros(len(portion))
                some = [column.slice(start, len(portion)) for column in kept]
                yield pa.RecordBatch.from_arrays([*some, pa.array(scores, pa.float64())], names=[*names, name])
                start += len(portion)

    return run


def _scored(docs: DataFrame, shared, text_col: str, name: str) -> DataFrame:
    """``docs`` with a column ``name``, new there; a text column of strings goes to the tasks once."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    own = dict(docs.dtypes).get(text_col) == "string"
    rows = docs if own else docs.withColumn(name, text_bytes(text_col))
    return rows.mapInArrow(_score(shared, text_col if own else None, name), f"{kinds}, `{name}` double")


def fit(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Parameters learned from labelled rows where the condition ``held_out`` on ``doc_id`` doesn't hold."""
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(~held_out)
    known = known.withColumn("place", F.xxhash64("doc_id"))
    found = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    found = found.filter(F.octet_length("text") <= LONGEST)
    sample = None
    for label in (0, 1):
        some = known.filter(F.col("toxic") == label).orderBy("place", "doc_id").limit(PER_LABEL)
        rows = found.join(some, "doc_id").orderBy("place", "doc_id", "text").limit(PER_LABEL).select("text", "toxic")
        sample = rows if sample is None else sample.unionByName(rows)
    # one task trains on the bounded sample; the driver gets the parameters alone
    learned = sample.coalesce(1).mapInArrow(_train_on, "name string, shape array<int>, packed binary").collect()
    return {r["name"]: np.frombuffer(r["packed"], np.float32).reshape(r["shape"]) for r in learned} or None


def _train_on(batches):
    """``name, shape, packed``: the parameters learned from all rows; none without both labels."""
    rows = [row for batch in batches for row in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist())]
    rows.sort(key=lambda row: (row[1], zlib.crc32(row[0]), row[0]))
    if len({mark for _, mark in rows}) == 2:
        learned = train([text for text, _ in rows], np.array([mark for _, mark in rows], np.float32)).p
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(learned), pa.string()), pa.array([v.shape for v in learned.values()], pa.list_(pa.int32())),
                pa.array([v.astype(np.float32).tobytes() for v in learned.values()], pa.binary()),
            ],
            names=["name", "shape", "packed"],
        )


def scores(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score``; a column of that name is replaced."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, held_out, id_col, text_col))
    return _scored(docs, shared, text_col, "score")


def by_remainder(name: str = "doc_id"):
    """The rows whose labels aren't learned from."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, by_remainder(), id_col, text_col))
    score = unused("toxic_score", docs)
    rows = _scored(docs, shared, text_col, score)
    return rows.filter(F.col(score) < threshold).drop(score)


def op10_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score and class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = scores(docs, table(spark, sf_dir, "labels"), by_remainder())
    return scored.select(
        "doc_id", by_remainder().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

"""Token counts by a finite-state transducer.

The transducer reads a piece byte by byte. Its state is the part of the prefix that a token may still reach back
into (the longest ending that starts some token), with the last token at each place in it and how many
tokens each place has fewer than the end. A transition carries the change in the number of tokens of the prefix, so the sum over a
piece's transitions is its number of tokens. Tokens are of bounded length, so there are finitely many states; a task
compiles those it reaches, and starts over when its table is full.

Texts are read in chunks. A chunk is a map from the state before it to the state after it and a count. Where the chunk
has a boundary that ends a piece whatever stands before it, the state after the chunk is the same for all states before it;
so a map is ``(head, count, tail)``: what precedes the first such boundary, the tokens between, and what follows the last.
The open text ``tail`` names the state after the chunk. Maps compose associatively, and are combined pairwise, level by level.

Missing texts count as empty and have no tokens. Special strings inside texts are one token each, as the library has it.
"""

from __future__ import annotations

import functools
import json

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.bpe import Vocabulary, byte_letters
from lodestat.llm.pieces import BOUNDARY, Remembered, pieces, portions
from lodestat.llm.rows import table
from lodestat.session import store

FILE = "byte_bpe_50k.json"
CHUNK = 1 << 16
LIMIT = 1024


class Transducer:
    """States are numbers; ``step`` compiles a transition when it is first taken."""

    ROOM = 1_000_000

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.starts = {token[:n] for token in vocabulary.ids for n in range(len(token) + 1)}
        self._reset()

    def _reset(self) -> None:
        """``taken``: state * 256 + byte to next state and count; a state is (open bytes, last tokens, arrears)."""
        start = (b"", (-1,), (0,))
        self.taken: dict[int, tuple[int, int]] = {}
        self.states = [start]
        self.numbers = {start: 0}

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        opened, lasts, arrears = self.states[state]
        vocabulary = self.vocabulary
        opened += bytes((byte,))
        for place, last in enumerate(lasts):
            token = vocabulary.endings.get(opened[place:], -1)
            # -1 as the last token: the piece begins here, and any token may
            if token >= 0 and (last < 0 or vocabulary.together(last, token)):
                break
        else:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        emitted = 1 - arrears[place]
        skip = 0
        while opened[skip:] not in self.starts:
            skip += 1
        lasts, arrears = (*lasts, token), (*(a + emitted for a in arrears), 0)
        key = (opened[skip:], lasts[skip:], arrears[skip:])
        number = self.numbers.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        self.taken[state << 8 | byte] = number, emitted
        return number, emitted

    def count(self, piece: bytes) -> int:
        if piece in self.vocabulary.ids:
            return 1
        if len(self.taken) > self.ROOM:
            self._reset()
        taken, state, total = self.taken, 0, 0
        for byte in piece:
            state, emitted = taken.get(state << 8 | byte) or self._compile(state, byte)
            total += emitted
        return total


class Counter:
    """Tokens of texts, and the maps of their chunks."""

    def __init__(self, vocabulary: Vocabulary, specials: tuple[str, ...] = ()):
        self.transducer = Transducer(vocabulary)
        self.specials = specials
        self._known = Remembered(lambda found: (self.transducer.count(p.encode()) for p in found))

    def _split(self, text: str) -> tuple[list[str], int]:
        """Pieces of a text, and the number of special strings in it."""
        parts, special = [text], 0
        for mark in self.specials:
            parts = [part for whole in parts for part in whole.split(mark)]
        if len(parts) == 1:
            return pieces(text), 0
        special = len(parts) - 1
        return [piece for part in parts for piece in pieces(part)], special

    def counts(self, texts):
        for portion in portions(texts):
            split = [self._split(text) for text in portion]
            self._known.cover(set().union(*(found for found, _ in split)))
            for found, special in split:
                yield sum(map(self._known.__getitem__, found)) + special

    def count(self, text: str) -> int:
        return next(self.counts([text]))

    def maps(self, chunks):
        """``(head, count, tail)`` of each chunk; count and tail are None where the chunk has no certain boundary."""
        for portion in portions(chunks):
            ends = []
            for chunk in portion:
                first = BOUNDARY.search(chunk)
                last = chunk_end(chunk) if first else None
                ends.append((first.start(), last) if first else None)
            counted = self.counts(c[e[0]:e[1]] for c, e in zip(portion, ends) if e)
            for chunk, end in zip(portion, ends):
                yield (chunk[: end[0]], next(counted), chunk[end[1] :]) if end else (chunk, None, None)

    def compose(self, first, second):
        """The map of two neighbouring chunks."""
        head, count, tail = first
        if count is None:
            return (head + second[0], *second[1:]) if second[1] is not None else (head + second[0], None, None)
        if second[1] is None:
            return self._closed(head, count, tail + second[0])
        # a boundary may also lie between the chunks: the count of the joined text has it
        return head, count + self.count(tail + second[0]) + second[1], second[2]

    def _closed(self, head, count, tail):
        """Keep of an open text what follows its last certain boundary."""
        end = chunk_end(tail)
        return (head, count + self.count(tail[:end]), tail[end:]) if end else (head, count, tail)

    def scan(self, maps) -> tuple:
        """The composition of consecutive maps, pairwise, level by level."""
        maps = list(maps) or [("", None, None)]
        while len(maps) > 1:
            pairs = [self.compose(*maps[k : k + 2]) for k in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        return maps[0]

    def total(self, state_map) -> int:
        """Tokens of a text whose map, from its start, this is."""
        head, count, tail = state_map
        return self.count(head) + (count + self.count(tail) if count is not None else 0)


def chunk_end(text: str) -> int:
    """The last certain boundary in ``text``, 0 without one."""
    end = len(text)
    while end > 0:
        start = max(0, end - 256)
        found = [m.start() for m in BOUNDARY.finditer(text, max(0, start - 1)) if m.start() > 0]
        if found:
            return found[-1]
        end = start
    return 0


def read_json(path: str) -> tuple[Vocabulary, tuple[str, ...]]:
    """Vocabulary and special strings of a JSON tokeniser. Merges go in the order of the file."""
    with open(path, encoding="utf-8") as file:
        kept = json.load(file)
    letters = byte_letters()
    ids = {bytes(letters[c] for c in token): i for token, i in kept["model"]["vocab"].items()}
    merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in kept["model"]["merges"]]
    order = {i: -1 for i in ids.values()}
    for place, pair in enumerate(merges):
        order[ids[bytes(letters[c] for c in "".join(pair))]] = place
    specials = tuple(t["content"] for t in kept["added_tokens"] if t["special"])
    return Vocabulary(ids, order), specials


@functools.cache
def counter(path: str) -> Counter:
    """One per Python worker."""
    return Counter(*read_json(path))


def _chunk_maps(path: str | None):
    def run(batches):
        count = counter(path or public_tokenizers.path(FILE))
        for batch in batches:
            *kept, texts = batch.columns
            head, inner, tail = zip(*count.maps(texts.to_pylist())) if len(texts) else ((), (), ())
            columns = [*kept, pa.array(head, pa.string()), pa.array(inner, pa.int64()), pa.array(tail, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "head", "inner", "tail"])

    return run


def _composed(path: str | None):
    def run(key, rows):
        count = counter(path or public_tokenizers.path(FILE))
        parts = sorted(rows.select(["chunk", "head", "inner", "tail"]).to_pylist(), key=lambda r: r["chunk"])
        whole = count.scan((r["head"], r["inner"], r["tail"]) for r in parts)
        values = [rows.column(n)[0].as_py() for n in ("doc_id", "n_bytes")]
        names = ["doc_id", "n_bytes", "n_tokens"]
        kinds = [rows.schema.field("doc_id").type, pa.int64(), pa.int64()]
        return pa.table([pa.array([v], k) for v, k in zip([*values, count.total(whole)], kinds)], names=names)

    return run


def _totals(path: str | None):
    """Tokens of texts that are one chunk."""

    def run(batches):
        count = counter(path or public_tokenizers.path(FILE))
        for batch in batches:
            maps = zip(*(batch.column(n).to_pylist() for n in ("head", "inner", "tail")))
            tokens = pa.array([count.total(m) for m in maps], pa.int64())
            columns = [batch.column(n) for n in ("doc_id", "n_bytes")]
            yield pa.RecordBatch.from_arrays([*columns, tokens], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, chunk: int = CHUNK
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row; ``chunk``: characters of a chunk."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    cuts = F.sequence(F.lit(0), F.floor(F.greatest(F.char_length("text") - 1, F.lit(0)) / chunk).cast("int"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text"
    ).select(
        "uid", "doc_id", "n_bytes", F.size(cuts).alias("chunks"), F.explode(cuts).alias("chunk"), "text"
    ).withColumn("text", F.when(F.col("chunks") == 1, F.col("text")).otherwise(
        F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk))
    ))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"uid long, doc_id {kind}, n_bytes long, chunks int, chunk int, head string, inner long, tail string"
    maps = store(rows.mapInArrow(_chunk_maps(path), schema), "chunk-maps")
    out = f"doc_id {kind}, n_bytes long, n_tokens long"
    single = maps.filter("chunks = 1").select("doc_id", "n_bytes", "head", "inner", "tail")
    several = maps.filter("chunks > 1").groupBy("uid").applyInArrow(_composed(path), out)
    return single.mapInArrow(_totals(path), out).unionByName(several)


def op3_count_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed the context of a model."""
    counted = token_counts(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)

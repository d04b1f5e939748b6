"""Best-fit packing of documents into token sequences, after a dominance reduction.

A document's tokens end with a separator. What is longer than a sequence is cut so that all but its first piece fill
one. Pieces differ only in length, so the whole instance is one count per length, however many pieces there are. On it the
procedure of Martello and Toth fixes sets of at most three pieces that dominate every other set with their largest piece:
some best packing has them, so they leave the instance for good. Best fit, longest first, packs the rest. All copies
of a step are taken at once, and the result is a list of ``(times, contents)``, as short as there are lengths.

Pieces get their places by rank among those of their length: a task numbers its own, sums over the tasks number all, and
a range of ranks leads to a run of sequences. No piece meets another, so a length that a third of the pieces have is no hot key.
The ranks hang on the order of a task's input alone, and are written once with the pieces; a lost executor can't change them.

Missing and empty texts are the separator alone. Rows with equal or missing ids are documents of their own.
Only ``limit`` counts reach the driver. A text is encoded a portion at a time; its ids, four bytes a token, lie in one row or less.
"""

from __future__ import annotations

import bisect
import functools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from lodestat.layout import bounded_broadcast
from lodestat.llm.bpe import byte_letters
from lodestat.llm.pieces import BOUNDARY
from lodestat.llm.rows import table
from lodestat.session import store

FILE = "byte_bpe_50k.json"
LIMIT = 2048
SEPARATOR = 0
PORTION = 1 << 18  # characters of a text encoded at a time
ROWS = 2_000  # pieces of a batch

# ---- the instance: counts per length ----


class Stock:
    """Pieces that are left, as counts per length."""

    def __init__(self, counts: dict[int, int]):
        self.left = {size: n for size, n in counts.items() if n > 0}
        self.sizes = sorted(self.left)

    def take(self, sizes: Iterable[int], times: int) -> None:
        for size in sizes:
            self.left[size] -= times
            if not self.left[size]:
                del self.left[size]
                self.sizes.remove(size)

    def times(self, sizes: tuple[int, ...]) -> int:
        """How often ``sizes`` can be taken."""
        return min(self.left[size] // sizes.count(size) for size in sizes)

    def without(self, size: int) -> Stock:
        other = Stock({})
        other.left = {**self.left, size: self.left[size] - 1}
        other.sizes = self.sizes if other.left[size] else [s for s in self.sizes if s != size]
        return other

    def at_most(self, size: int) -> int:
        """The longest of at most ``size``, 0 if there is none."""
        place = bisect.bisect_right(self.sizes, size)
        return self.sizes[place - 1] if place else 0

    def shortest(self, n: int, above: int = 0) -> list[int]:
        """The ``n`` shortest pieces longer than ``above``, copies counted; fewer if there are no more."""
        found: list[int] = []
        for size in self.sizes[bisect.bisect_right(self.sizes, above) :]:
            found += [size] * min(n - len(found), self.left[size])
            if len(found) == n:
                break
        return found

    def fullest_pair(self, room: int) -> int:
        """The greatest sum of two pieces within ``room``, 0 if no two fit."""
        best, low, high = 0, 0, len(self.sizes) - 1
        while low <= high:
            small, large = self.sizes[low], self.sizes[high]
            if small + large > room:
                high -= 1
            elif low == high and self.left[small] < 2:
                break
            else:
                best, low = max(best, small + large), low + 1
        return best


def dominating(stock: Stock, size: int, limit: int) -> tuple[int, ...] | None:
    """Up to three pieces, one of ``size``, that dominate every set with a piece of that size; None if no rule says so.

    A set dominates another if the other's pieces can be parted so that each part fits in place of one of its pieces.
    """
    room, rest = limit - size, stock.without(size)
    longest = rest.at_most(room)
    if not longest:
        return (size,)
    shortest = rest.shortest(3)
    if longest == room or sum(shortest[:2]) > room or len(shortest) < 2:
        return size, longest
    if sum(shortest) > room or len(shortest) < 3:  # no three more fit
        if longest >= rest.fullest_pair(room):
            return size, longest
        second = rest.without(longest).at_most(room - longest)
        if second:
            above = rest.shortest(2, second)
            if len(above) < 2 or sum(above) > room:  # every pair that fits has one of at most the second
                return size, longest, second
    return None


def reduced(stock: Stock, limit: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Take dominating sets out of ``stock`` until no rule holds; yields ``(times, sizes)``.

    What is taken leaves fewer pieces, so a rule that held still holds while copies of its set are left.
    """
    going = True
    while going:
        going = False
        for size in reversed(list(stock.sizes)):
            while size in stock.left and (found := dominating(stock, size, limit)):
                times = stock.times(found)
                stock.take(found, times)
                yield times, found
                going = True


def best_fit(stock: Stock, limit: int) -> Iterator[tuple[int, tuple[tuple[int, int], ...]]]:
    """Each piece, longest first, into the sequence with the least room that takes it; yields ``(times, ((size, copies), ...))``.

    Sequences with the same contents are one entry. A sequence that got a piece has still less room, so it is
    filled with the same length for as long as that fits.
    """
    open_: dict[int, list] = {}  # room to [(times, contents)]
    rooms: list[int] = []

    def put(room: int, times: int, contents: tuple) -> None:
        if times:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((times, contents))

    for size in reversed(stock.sizes):
        left = stock.left[size]
        while left:
            place = bisect.bisect_left(rooms, size)
            if place < len(rooms):
                room = rooms[place]
                times, contents = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[place]
            else:
                room, times, contents = limit, left, ()
            copies = room // size
            full = min(times, left // copies)
            put(room - copies * size, full, (*contents, (size, copies)))
            left -= full * copies
            times -= full
            if times and left and left < copies:
                put(room - left * size, 1, (*contents, (size, left)))
                times, left = times - 1, 0
            if contents:  # those that nothing was put into
                put(room, times, contents)
    for entries in open_.values():
        yield from entries


def packed_lengths(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Sequences for ``counts`` pieces per length, as ``(times, ((size, copies), ...))``."""
    if any(size > limit or size < 1 for size in counts):
        raise ValueError(f"lengths must be between 1 and {limit}")
    stock = Stock(counts)
    fixed = [(times, tuple((s, sizes.count(s)) for s in dict.fromkeys(sizes))) for times, sizes in reduced(stock, limit)]
    return fixed + list(best_fit(stock, limit))


def slots(sequences) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first, beyond, copies, sequence, place)``: pieces of a length, ranked ``first`` to before ``beyond``, lie
    ``copies`` to a sequence, from ``sequence`` on, at ``place`` and after one another."""
    found, ranks, sequence = [], {}, 0
    for times, contents in sequences:
        place = 0
        for size, copies in contents:
            first = ranks.get(size, 0)
            ranks[size] = first + times * copies
            found.append((size, first, ranks[size], copies, sequence, place))
            place += size * copies
        sequence += times
    return found


# ---- tokens ----


@functools.cache
def coder(path: str) -> tiktoken.Encoding:
    """The JSON vocabulary's encoder, one per Python worker; special strings are one token, as the file's own library has it."""
    with open(path, encoding="utf-8") as file:
        kept = json.load(file)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in kept["added_tokens"] if t["special"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in kept["model"]["vocab"].items() if token not in special}
    merged = ["".join(pair if isinstance(pair, list) else pair.split(" ")) for pair in kept["model"]["merges"]]
    ids = [kept["model"]["vocab"][token] for token in merged]
    if ids != sorted(ids):
        raise ValueError("ids don't follow the order of merges")
    return tiktoken.Encoding("json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def portions_of(text: str, characters: int = PORTION) -> Iterator[str]:
    """``text`` in parts that end where a token surely does; whole if there is no such place."""
    start = 0
    while len(text) - start > characters:
        found = BOUNDARY.search(text, start + characters)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encoded(text: str, path: str) -> np.ndarray:
    """Token ids of a whole text, as little-endian unsigned 32-bit numbers, with the separator."""
    code = coder(path)
    parts = [np.asarray(code.encode(part, allowed_special="all"), "<u4") for part in portions_of(text)]
    return np.concatenate([*parts, np.array([SEPARATOR], "<u4")])


def cuts(n: int, limit: int) -> range:
    """Where the pieces of ``n`` tokens begin, after the first at 0."""
    return range(n % limit or limit, n, limit)


def _cut_batches(path: str | None, limit: int):
    names = ["doc_id", "piece", "start", "length", "ids", "part", "rank"]

    def run(batches):
        part, ranks = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        place = path or public_tokenizers.path(FILE)

        def batch(kind, rows):
            columns = list(zip(*rows))
            kinds = [kind, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for texts in batches:
            kind, rows = texts.schema.field(0).type, []
            for doc, text in zip(*texts.columns):
                ids = encoded(text.as_py(), place)
                starts = [0, *cuts(len(ids), limit)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc, piece, start, end - start, ids[start:end].tobytes(), part, int(ranks[end - start])))
                    ranks[end - start] += 1
                    if len(rows) == ROWS:
                        yield batch(kind, rows)
                        rows = []
            if rows:
                yield batch(kind, rows)

    return run


# ---- tables ----


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, piece, start, length, ids, part, rank``: what is to be packed, kept in the shared folder.

    ``ids`` are little-endian unsigned 32-bit numbers; ``rank`` counts the pieces of a length within the task ``part``.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fields = [
        texts.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids", BinaryType()), StructField("part", IntegerType()), StructField("rank", LongType()),
    ]
    return store(texts.mapInArrow(_cut_batches(path, limit), StructType(fields)), "pieces")


def assigned(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``cut``, any table with the ``length, part, rank`` of pieces, with ``sequence_id, offset`` in their place."""
    spark = cut.sparkSession
    sizes = store(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    places = slots(packed_lengths(counts, limit))
    kept = spark.createDataFrame(places, "length long, _first long, _beyond long, _copies long, _sequence long, _place long")
    ranked = cut.join(bases, ["length", "part"]).withColumn("_rank", F.col("_base") + F.col("rank"))
    known = ranked.join(bounded_broadcast(kept, len(places), 64), "length")
    inside = known.filter((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_beyond")))
    nth = F.col("_rank") - F.col("_first")
    kept_columns = [c for c in cut.columns if c not in ("part", "rank")]
    return inside.select(
        *kept_columns,
        (F.col("_sequence") + (nth - nth % F.col("_copies")) / F.col("_copies")).cast("long").alias("sequence_id"),
        (F.col("_place") + nth % F.col("_copies") * F.col("length")).alias("offset"),
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` of every piece."""
    return assigned(pieces(docs, id_col, text_col, path, limit), limit)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the token sequences themselves. A group holds one sequence, never more than its limit."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def op11_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document; the ids of a piece as a checksum."""
    cut = pieces(table(spark, sf_dir, "documents"))
    return assigned(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "rank"))

"""Near-duplicate documents by a size-aware join of their shingle sets.

Sets are the distinct runs of ``WORDS`` words. Two link when ``100 * intersection >= PERCENT * union``. Documents with equal
sets are one set from the start, known by the set's hash and size. Sets fall in two classes, and a pair is found by the
class of its larger set:

* Small sets write a key for every subset that a partner could share with them in full. In a bucket of one key, the smallest set
  links to whatever links at all; sizes alone decide, since the key is the intersection.
* Large sets are put into inverted lists, under their rarest shingles only: as many as make sure that partners meet
  (all but ``PERCENT`` of a set, and one). The order is by counts of shingles frequent in some task, else by hash. Lists
  of one set are dropped.

The boundary between the classes is where keys and list entries cost least, over the sizes of all documents.

Lists of more than ``SHORT`` sets are first answered by stars: each set is compared with a hub of its list, and linked sets
become one component. The first hub is the set in which least comes before the list's shingle, so the one that has the least of its own;
later ones are drawn. After ``HUBS`` turns they go on as long as a turn ends an eighth of the pairs whose components differ. Then such pairs of all lists
are compared. So every link between sets of different components is checked, while a list of thousands of near copies costs a few
comparisons for each of its sets.

Places in the common order bound what sets that meet at a shingle can share, so shingles that come late in a set lead to few
pairs. Of a pair, the rarest shingles are compared first: those up to the point that both have listed are known to be shared or not, and the
others of the smaller rest may be shared at most. Pairs that can't link by this are dropped; whole sets decide the others.

Words: ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Texts of fewer words have their whole sequence as one shingle;
missing texts and texts without words have an empty set, link with nothing, and are their own component. Missing ids take
part; the component's name is its smallest id, and missing only where all its ids are. Repeated rows are rows with equal sets.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.layout import bounded_broadcast
from lodestat.llm.links import components
from lodestat.llm.rows import table, text_bytes, unused
from lodestat.session import settle, store

WORDS, PERCENT = 4, 85
HUBS = 2
SHORT = 8  # sets of a list whose pairs are compared without stars
PART = 1 << 22  # bytes of texts or sets that a task works on at a time
FEW_SETS = 1 << 16  # as many names go to the tasks that read the texts
FREQUENT = 2  # distinct sets of one batch from which a shingle is reported
KNOWN_FREQUENT = 1 << 20  # as many of them, the most frequent, are put last; the order affects work alone
SMALLEST_LARGE, LARGEST_SMALL = 6, 19
LIST_COST = 4  # of a list entry, which leads to comparisons, against a key


class WordHashes(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


class Shingler:
    """Sets of hashed shingles."""

    def __init__(self, words: int = WORDS, room: int = 200_000):
        self.words, self.room, self.known = words, room, WordHashes()

    def __call__(self, text: bytes) -> np.ndarray:
        """The sorted hashes of the text's set."""
        tokens = text.lower().split()
        known = self.known
        if len(known) > self.room:
            known.clear()
        hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        if not tokens:
            return hashes
        width = min(self.words, len(tokens))
        out = np.full(len(tokens) - width + 1, 0x9E3779B97F4A7C15 + width, np.uint64)
        for place in range(width):
            out = (out ^ hashes[place : place + len(out)]) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
        return np.unique(out)


def set_hash(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), 1) - (1 << 63)


def least_shared(size: int, percent: int = PERCENT) -> int:
    """The fewest elements that a set shares with any partner."""
    return -(-percent * size // 100)


def subset_keys(found: np.ndarray, percent: int = PERCENT):
    """``(key, size)`` of every subset that a partner could share in full."""
    total = np.bitwise_xor.reduce(found * np.uint64(0x9E3779B97F4A7C15)) if len(found) else np.uint64(0)
    mixed = [int(v) for v in found * np.uint64(0x9E3779B97F4A7C15)]
    plain = [int(v) for v in found]
    whole = sum(plain)
    for left_out in range(len(found) - least_shared(len(found), percent) + 1):
        for gone in itertools.combinations(range(len(found)), left_out):
            first = int(total)
            for place in gone:
                first ^= mixed[place]
            second = (whole - sum(plain[place] for place in gone)) & (1 << 64) - 1
            yield (first << 64 | second).to_bytes(16, "big"), len(found) - left_out


def _parts(batches, column: str, size: int | None = None):
    """The rows of batches, so many at a time that a column of theirs has about ``size`` bytes."""
    size = size or PART
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
        begin = 0
        while begin < len(ends):
            end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + size, "left")) + 1
            yield batch.slice(begin, end - begin)
            begin = end


def _repeated(sets: list[np.ndarray]):
    """The values that several sets have, and in how many; in order."""
    values = np.concatenate([np.zeros(0, np.uint64), *sets])
    values.sort()
    same = np.flatnonzero(values[1:] == values[:-1])
    return np.unique(values[same]), np.unique(values[same], return_counts=True)[1] + 1


def _sizes(words: int):
    """``doc_id, n, set_id, text`` of each row, and ``shingle, n`` of shingles frequent in a part, with ``doc`` False."""

    def run(batches):
        shingle = Shingler(words)
        for batch in _parts(batches, "text", 4 * PART):
            ids, sets, lengths, names = batch.column("doc_id"), {}, [], []
            for text in batch.column("text"):
                found = shingle(text.as_py())
                lengths.append(len(found))
                names.append(set_hash(found))
                sets[names[-1]] = found
            yield pa.RecordBatch.from_arrays(
                [pa.array([True] * len(ids), pa.bool_()), ids, pa.array(lengths, pa.int64()), pa.array(names, pa.int64()), batch.column("text")],
                names=["doc", "doc_id", "n", "set_id", "text"],
            )
            values, counts = _repeated(list(sets.values()))
            often = counts >= FREQUENT
            values = pa.array(values[often].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([False] * len(values), pa.bool_()), pa.nulls(len(values), ids.type),
                    pa.array(counts[often].astype(np.int64)), values, pa.nulls(len(values), batch.column("text").type),
                ],
                names=["doc", "doc_id", "n", "set_id", "text"],
            )

    return run


def choose_boundary(counts: dict[int, int], percent: int = PERCENT) -> int:
    """The largest small size: where keys of small sets and list entries of large ones are cheapest."""

    def cost(boundary: int) -> int:
        total = 0
        for size, count in counts.items():
            gone = size - least_shared(size, percent)
            if size <= boundary:
                total += count * sum(math.comb(size, k) for k in range(gone + 1))
            if size >= least_shared(boundary + 1, percent):
                total += count * LIST_COST * (gone + 1)
        return total

    return min(range(SMALLEST_LARGE - 1, LARGEST_SMALL + 1), key=cost)


def _entries(words: int, percent: int, boundary: int, shared):
    """``set_id, n, keys, shared, prefix, counts`` of each set, once a task.

    ``keys`` and their sizes ``shared`` are a small set's subset keys. ``prefix`` has the rarest shingles of a set that takes part
    in lists, and ``counts`` their known counts, in the common order: by count, then hash.
    """

    def run(batches):
        shingle, (frequent, known), seen = Shingler(words), shared.value, set()
        least = least_shared(boundary + 1, percent)
        for batch in _parts(batches, "text"):
            columns = [[] for _ in range(6)]
            for name, text in zip(batch.column("set_id").to_pylist(), batch.column("text")):
                if name in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                found = shingle(text.as_py())
                size = len(found)
                made = list(subset_keys(found, percent)) if size <= boundary else []
                prefix = counts = np.zeros(0, np.int64)
                if size >= least:
                    counts = np.zeros(size, np.int64)
                    if len(frequent):
                        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                        counts = np.where(frequent[at] == found, known[at], 0)
                    rarest = np.lexsort((found, counts))[: size - least_shared(size, percent) + 1]
                    prefix, counts = found[rarest].view(np.int64), counts[rarest]
                for column, value in zip(columns, (name, size, [k for k, _ in made], [k for _, k in made], prefix, counts)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["set_id", "n", "keys", "shared", "prefix", "counts"]
            )

    return run


def _frequent(rows: DataFrame):
    """Sorted hashes of the most frequent shingles and their counts, at most ``KNOWN_FREQUENT`` of them."""
    found = rows.filter("not doc").groupBy("set_id").agg(F.sum("n").alias("n"))
    found = found.orderBy(F.desc("n"), "set_id").limit(KNOWN_FREQUENT).toArrow()
    values = np.asarray(found.column("set_id"), np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], np.asarray(found.column("n"), np.int64)[order]


BLOOM_BITS = 24


def _bitmaps(key, rows):
    bits = np.zeros(1 << 16, np.uint8)
    bits[np.asarray(rows.column("slot")) & 0xFFFF] = 1
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["block", "bits"])


def _bloom(ids: DataFrame) -> np.ndarray:
    """A bit for each low part of ``set_id`` that occurs: 2 MB, whatever the number of sets."""
    slots = ids.select((F.col("set_id").bitwiseAND((1 << BLOOM_BITS) - 1)).cast("int").alias("slot")).distinct()
    blocks = slots.withColumn("block", F.shiftright("slot", 16)).groupBy("block").applyInArrow(_bitmaps, "block int, bits binary")
    out = np.zeros(1 << BLOOM_BITS - 3, np.uint8)
    for row in blocks.collect():  # in one job, whatever the number of partitions
        out[row["block"] << 13 : (row["block"] + 1) << 13] = np.frombuffer(row["bits"], np.uint8)
    return out


def _wanted_sets(words: int, shared):
    def run(batches):
        shingle, bits, seen = Shingler(words), shared.value, set()
        for batch in _parts(batches, "text"):
            names, sets = [], []
            ids, texts = batch.column("set_id").to_numpy(), batch.column("text")
            slot = ids & (1 << BLOOM_BITS) - 1
            for place in np.flatnonzero(bits[slot >> 3] >> (7 - (slot & 7)) & 1).tolist():
                name = int(ids[place])
                if name not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    sets.append(shingle(texts[place].as_py()).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["set_id", "found"])

    return run


def _linked(percent: int):
    def run(batches):
        for batch in _parts(batches, "left_set"):
            keep = []
            for left, right in zip(batch.column("left_set"), batch.column("right_set")):
                one, two = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "linked"]
            )

    return run


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked`` of each pair of sets, kept."""
    left = sets.select(F.col("set_id").alias("a"), F.col("found").alias("left_set"))
    right = sets.select(F.col("set_id").alias("b"), F.col("found").alias("right_set"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left_set", "right_set")
    return store(both.mapInArrow(_linked(percent), "a long, b long, linked boolean"), "jaccard-compared")


def _subset_links(entries: DataFrame, percent: int) -> DataFrame:
    """Links of small sets: in a bucket, those of its smallest set."""
    keys = F.explode(F.arrays_zip("keys", "shared")).alias("made")
    buckets = entries.select("set_id", "n", keys).select("set_id", "n", F.col("made.keys").alias("key"), "made.shared")
    heads = buckets.groupBy("key", "shared").agg(F.min(F.struct("n", "set_id")).alias("head"), F.max("set_id").alias("last"), F.min("set_id").alias("first"))
    heads = store(heads.filter("first <> last").select("key", "shared", "head"), "jaccard-buckets")
    met = buckets.join(heads, ["key", "shared"]).filter(
        F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("n") + F.col("head.n") - F.col("shared"))
    )
    return met.select(F.col("head.set_id").alias("a"), F.col("set_id").alias("b")).filter("a <> b").distinct()


def _similar_size(one, other, percent: int):
    return F.lit(100) * F.least(one, other) >= F.lit(percent) * F.greatest(one, other)


def _arrays(lists: pa.ListArray):
    """Each list of numbers as an array, without a copy."""
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return (values[begin:end] for begin, end in itertools.pairwise(ends.tolist()))


def _may_link(percent: int):
    """Pairs whose rarest shingles don't rule a link out."""

    def run(batches):
        for batch in batches:
            sides = [_arrays(batch.column(f"{side}_{name}")) for side in ("a", "b") for name in ("prefix", "counts")]
            sizes = zip(batch.column("a_n").to_pylist(), batch.column("b_n").to_pylist())
            keep = []
            for one, one_counts, two, two_counts, (n_one, n_two) in zip(*sides, sizes):
                one, two = one.view(np.uint64), two.view(np.uint64)
                # both have listed all that they hold up to here, in the common order
                count, last = min((one_counts[-1], one[-1]), (two_counts[-1], two[-1]))
                both = len(np.intersect1d(one, two, assume_unique=True))
                rest = min(
                    n - int(((counts < count) | ((counts == count) & (values <= last))).sum())
                    for n, counts, values in ((n_one, one_counts, one), (n_two, two_counts, two))
                )
                most = both + rest
                keep.append(100 * most >= percent * (n_one + n_two - most))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class Comparer:
    """Answers which pairs of sets link; the texts of sets that need comparing are split anew, by the sets' names."""

    def __init__(self, texts: DataFrame, entries: DataFrame, words: int, percent: int):
        self.texts, self.words, self.percent = texts, words, percent
        self.entries = entries.select("set_id", "n", "prefix", "counts")
        self.sets: DataFrame | None = None

    def _side(self, name: str) -> DataFrame:
        return self.entries.select(
            F.col("set_id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("n", "prefix", "counts"))
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` that link, kept."""
        pairs = store(pairs, "jaccard-pairs")
        both = pairs.join(self._side("b"), "b").join(self._side("a"), "a")
        likely = store(both.mapInArrow(_may_link(self.percent), "a long, b long"), "jaccard-likely")
        ids = store(likely.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "jaccard-ids")
        if ids.isEmpty():
            return likely
        return compare(likely, self._split(ids), self.percent).filter("linked").select("a", "b")

    def _split(self, ids: DataFrame) -> DataFrame:
        """``set_id, found`` of these sets, kept. Those of earlier calls are there."""
        new = ids if self.sets is None else store(ids.join(self.sets.select("set_id"), "set_id", "left_anti"), "jaccard-ids")
        count = new.count()
        if count:
            texts = self.texts
            if count <= FEW_SETS:
                texts = texts.join(bounded_broadcast(new, FEW_SETS), "set_id", "left_semi")
            bits = texts.sparkSession.sparkContext.broadcast(_bloom(new))
            made = texts.mapInArrow(_wanted_sets(self.words, bits), "set_id long, found binary")
            made = store(made.join(new, "set_id").groupBy("set_id").agg(F.first("found").alias("found")), "jaccard-sets")
            bits.destroy()
            self.sets = made if self.sets is None else self.sets.unionByName(made)
        return self.sets


def _enough_left(n: str, place: str, other_n: str, other_place: str, percent: int):
    """Whether sets whose first common shingle, in the common order, is at these places may still link.

    They share it and no more than follows it in either. Later common shingles leave less, so a pair that may link is met at
    its first one at the latest.
    """
    most = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place))
    return F.lit(100 + percent) * most >= F.lit(percent) * (F.col(n) + F.col(other_n))


def _open_lists(named: DataFrame) -> DataFrame:
    """``key, sets, pairs`` of lists whose sets are of several components: all sets, and pairs of different components."""
    each = named.groupBy("key", "root").agg(F.count("*").alias("n"))
    sums = each.groupBy("key").agg(F.sum("n").alias("sets"), F.sum(F.col("n") * F.col("n")).alias("square"))
    pairs = ((F.col("sets") * F.col("sets") - F.col("square")) / 2).alias("pairs")
    return sums.select("key", "sets", pairs).filter("pairs > 0")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of known ones, as one edge per set, and new links."""
    return components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _pairs_left(rest: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of sets of one list and different components that may link; ``key, set_id, n, place, root`` are the lists.

    A set first meets the components of its list, by their sets' sizes, and then the sets of those that it may link with. So
    sets of one component don't meet, however many they are. Sets of which too little is left for a larger partner stand on one side alone.
    """
    smaller = rest.filter(_enough_left("n", "place", "n", "place", percent)).select(
        "key", *(F.col(c).alias(f"other_{c}") for c in ("set_id", "n", "place", "root"))
    )
    groups = smaller.groupBy("key", "other_n", "other_root").agg(F.min("other_place").alias("other_place"))
    near = rest.join(groups, "key").filter("root <> other_root and other_n <= n")
    near = near.filter(_similar_size(F.col("n"), F.col("other_n"), percent))
    near = near.filter(_enough_left("n", "place", "other_n", "other_place", percent)).drop("other_place")
    met = near.join(smaller, ["key", "other_n", "other_root"]).filter("other_n < n or other_set_id < set_id")
    met = met.filter(_enough_left("n", "place", "other_n", "other_place", percent))
    return met.select(F.least("set_id", "other_set_id").alias("a"), F.greatest("set_id", "other_set_id").alias("b")).distinct()


def set_components(texts: DataFrame, boundary: int, frequent, words: int, percent: int) -> DataFrame:
    """``node, root`` of every set that links with another, of ``set_id, text``; sets aren't empty."""
    context = texts.sparkSession.sparkContext
    schema = "set_id long, n long, keys array<binary>, shared array<int>, prefix array<long>, counts array<long>"
    made = texts.mapInArrow(_entries(words, percent, boundary, context.broadcast(frequent)), schema)
    raw = store(made, "jaccard-entries")
    links = store(_subset_links(raw, percent), "jaccard-links")

    # copies of a set in several tasks count once
    entries = raw.filter("size(prefix) > 0")
    lists = entries.select(F.posexplode("prefix").alias("place", "key"), "set_id", "n")
    several = lists.groupBy("key").agg(F.min("set_id").alias("first"), F.max("set_id").alias("last"))
    several = store(several.filter("first <> last").select("key"), "jaccard-lists")
    members = store(lists.join(several, "key").distinct(), "jaccard-members")
    if members.isEmpty():
        return components(links)
    known = store(
        entries.groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("n", "prefix", "counts"))), "jaccard-prefixes"
    )
    compare_all = Comparer(texts, known, words, percent)

    roots, compared, before = components(links), None, math.inf
    for turn in itertools.count():
        named = members.join(roots, members["set_id"] == roots["node"], "left")
        named = store(named.select("key", "set_id", "n", "place", F.coalesce("root", "set_id").alias("root")), "jaccard-named")
        opened = store(_open_lists(named), "jaccard-open")
        left = opened.filter(F.col("sets") > SHORT).agg(F.sum("pairs")).first()[0] or 0
        if not left or turn >= HUBS and 8 * left > 7 * before:
            break
        before = left
        # in the first turn the set with the least before the shingle, then any
        order = F.col("place") / F.col("n") if turn == 0 else F.lit(0.0)
        chosen = F.min(F.struct(order.alias("order"), F.xxhash64("set_id", F.lit(turn)).alias("draw"), "set_id", "n", "place", "root")).alias("hub")
        long = named.join(opened.filter(F.col("sets") > SHORT), "key", "left_semi")
        hubs = store(long.groupBy("key").agg(chosen), "jaccard-hubs")
        met = long.join(hubs, "key").filter(F.col("root") != F.col("hub.root"))
        met = met.filter(_similar_size(F.col("n"), F.col("hub.n"), percent))
        met = met.filter(_enough_left("n", "place", "hub.n", "hub.place", percent))
        met = met.select(F.least("set_id", "hub.set_id").alias("a"), F.greatest("set_id", "hub.set_id").alias("b")).distinct()
        pairs = store(met if compared is None else met.join(compared, ["a", "b"], "left_anti"), "jaccard-stars")
        compared = pairs if compared is None else compared.unionByName(pairs)
        roots = _joined(roots, compare_all.links(pairs))

    # all that is left: pairs of one list in different components
    rest = store(named.join(opened, "key", "left_semi"), "jaccard-rest")
    met = _pairs_left(rest, percent)
    return _joined(roots, compare_all.links(met if compared is None else met.join(compared, ["a", "b"], "left_anti")))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest id that links lead to."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    made = texts.mapInArrow(_sizes(words), f"doc boolean, doc_id {kind}, n long, set_id long, text binary")
    both = store(made, "jaccard-sizes")
    rows = both.filter("doc").select("doc_id", F.col("n").alias("n_shingles"), "set_id")
    # sizes up to a small bound matter to the choice; larger ones are large in any case
    counts = rows.filter(F.col("n_shingles").between(1, 2 * LARGEST_SMALL)).groupBy("n_shingles").count().collect()
    boundary = choose_boundary({r["n_shingles"]: r["count"] for r in counts}, percent)
    named = both.filter("doc and n > 0").select("set_id", "text")
    roots = set_components(named, boundary, _frequent(both), words, percent)

    some = rows.filter("n_shingles > 0").join(roots, rows["set_id"] == roots["node"], "left")
    some = some.select("doc_id", "n_shingles", F.coalesce("root", "set_id").alias("root"))
    lowest = store(some.groupBy("root").agg(F.min("doc_id").alias("component_id")), "jaccard-lowest")
    none = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.join(lowest, "root").select("doc_id", "n_shingles", "component_id").unionByName(none)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one row of each group, that of the smallest id, with all their columns."""
    uid = unused("row_uid", docs)
    rows = store(docs.withColumn(uid, F.monotonically_increasing_id()), "jaccard-rows")
    name = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(uid).alias("row_key"))
    slim = rows.select(name.alias("doc_id"), F.col(text_col).alias("text"))

    def kept_keys():
        kept = near_groups(slim, **settings).filter(F.col("doc_id.row_key") == F.col("component_id.row_key"))
        return kept.select(F.col("doc_id.row_key").alias("row_key"))

    kept = settle(docs.sparkSession, kept_keys, "jaccard-kept")
    return rows.join(kept, rows[uid] == kept["row_key"], "left_semi").select(*docs.columns)


def op6_size_aware_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies."""
    return near_groups(table(spark, sf_dir, "documents"))

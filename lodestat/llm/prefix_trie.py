"""A prefix trie of conversations: who shares which first turns, and what sharing saves.

Turns are coded by a dictionary, sequences of codes are dealt by range and sorted, and each shard builds ternary search trees
of at most ``TURNS`` turns, balanced since of the sorted sequences the median goes in first. A node of such a tree stands for
one prefix. Nodes come after their parents, so one pass backwards adds up members, leaves and savings without recursion.

A prefix may run on into the next tree only along the first or the last sequence of its own. Nodes off these two paths are
done. Those on them leave as partial sums, a few per tree, and are merged in the order of the trees: a stack holds the prefix
that is open, and a node is done when another one takes its place. So what a third of all conversations have in common is cut like
anything else: trees count its members, and the merge adds up a row per tree.

A conversation is one row of two numbers a turn. Its rows come by turn (missing ones first), then by digest of role and text;
a missing role or text is empty, rows without a conversation id belong to none and are left out, equal rows count each. Turns are
told apart by SHA-256. No rows give no nodes.
The digest of the members that end at a node is made in their order, so that of a hot node passes the merge as text, a part a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from lodestat.llm.rows import table
from lodestat.session import store

TURNS = 100_000  # of the distinct sequences of a tree
MEMBERS = 50_000  # conversations of a tree
BLOCK, MOST = 100, 5  # conversations with a common head, turns of a head at most
SLICE = 256
NOBODY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

# ---- trees ----


class Ternary:
    """A ternary search tree; node 0 is the prefix without turns, all others stand for the prefix that ends in their key."""

    def __init__(self):
        self.keys, self.low, self.high, self.down = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.sizes = [-1], [0], [0]
        self.ends: dict[int, list[int]] = {}

    def _node(self, key: int, size: int, parent: int) -> int:
        for column, value in (
            (self.keys, key), (self.low, -1), (self.high, -1), (self.down, -1),
            (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.sizes, size),
        ):
            column.append(value)
        return len(self.keys) - 1

    def insert(self, turns: list[int], sizes: list[int]) -> int:
        """The node of the whole sequence, made with all before it where it isn't there."""
        keys, low, high, down = self.keys, self.low, self.high, self.down
        node = 0
        for key, size in zip(turns, sizes):
            at, side, last = down[node], down, node
            while at >= 0 and keys[at] != key:
                side, last = (low if key < keys[at] else high), at
                at = side[at]
            if at < 0:
                at = side[last] = self._node(key, size, node)
            node = at
        return node

    def path(self, node: int) -> list[int]:
        """From the root to ``node``."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def planted(rows: list[tuple[list[int], list[int], list[int]]]) -> tuple[Ternary, dict[int, int]]:
    """The tree of sorted, distinct ``(turns, sizes, members)``, and the numbers of the nodes that may run on, in the order of
    the first sequence and then the last."""
    tree, spans, nodes = Ternary(), [(0, len(rows))], {}
    while spans:
        start, end = spans.pop()
        if start < end:
            middle = (start + end) // 2
            turns, sizes, members = rows[middle]
            nodes[middle] = tree.insert(turns, sizes)
            tree.ends[nodes[middle]] = members
            spans += [(middle + 1, end), (start, middle)]
    edge = [*tree.path(nodes[0]), *tree.path(nodes[len(rows) - 1])]
    return tree, {node: number for number, node in enumerate(dict.fromkeys(edge))}


def harvested(tree: Ternary, open_: dict[int, int], first: int) -> Iterator[tuple]:
    """Rows of :data:`PARTS`: done nodes, and open ones with what lies below them off the paths; numbers from ``first`` on."""
    n = len(tree.keys)
    count, least = [0] * n, [None] * n
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node, members in tree.ends.items():
        count[node], least[node] = len(members), members[0]
    for node in range(n - 1, 0, -1):
        above = tree.parent[node]
        count[above] += count[node]
        least[above] = least[node] if least[above] is None else min(least[above], least[node])
        if node not in open_:
            leaves[node] = leaves[node] or 1
            saved[node] += (count[node] - 1) * tree.sizes[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    for node in range(n):
        ends = ",".join(map(str, tree.ends.get(node, ()))).encode()
        sums = count[node], children[node], leaves[node], saved[node]
        if node in open_:
            yield True, first + open_[node], least[node], tree.depth[node], None, *sums, None, tree.keys[node], tree.sizes[node], ends
        else:
            above = tree.parent[node]
            known, at = (None, first + open_[above]) if above in open_ else (least[above], None)
            yield False, at, least[node], tree.depth[node], known, *sums, hashlib.sha256(ends).hexdigest(), None, None, None


PARTS = StructType(
    [StructField("open", BooleanType()), StructField("number", LongType())]
    + [StructField(name, StringType() if name == "ends_sha256" else LongType()) for name in NODE]
    + [StructField("turn_id", LongType()), StructField("size", LongType()), StructField("ends", BinaryType()), StructField("part", IntegerType())]
)
ARROW = {LongType(): pa.int64(), StringType(): pa.string(), BinaryType(): pa.binary(), BooleanType(): pa.bool_(), IntegerType(): pa.int32()}


def _written(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = [ARROW[f.dataType] for f in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)


def _in_batches(rows, schema: StructType, most: int = 5_000, room: int = 4 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) == most or size > room:
            yield _written(held, schema)
            held, size = [], 0
    if held:
        yield _written(held, schema)


def trees(rows, turns: int = TURNS, members: int = MEMBERS) -> Iterator[list]:
    """Sorted ``(turns, sizes, member)`` in runs for one tree each, as distinct sequences with their members."""
    run, n_turns, n_members = [], 0, 0
    for sequence, sizes, member in rows:
        if run and (n_turns >= turns or n_members >= members):
            yield run
            run, n_turns, n_members = [], 0, 0
        if run and run[-1][0] == sequence:
            run[-1][2].append(member)
        else:
            run.append((sequence, sizes, [member]))
            n_turns += len(sequence)
        n_members += 1
    if run:
        yield run


def _grown(turns: int, members: int):
    """Over the sorted sequences of a shard."""

    def rows(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, SLICE).columns))

    def run(batches):
        part = TaskContext.get().partitionId()

        def parts():
            number = 0
            for sequences in trees(rows(batches), turns, members):
                tree, open_ = planted(sequences)
                for row in harvested(tree, open_, number):
                    yield *row, part
                number += len(open_)

        yield from _in_batches(parts(), PARTS)

    return run


# ---- the nodes between trees ----


class Open:
    """A node of which further parts may come."""

    def __init__(self, number: int, parent: Open | None, depth: int, turn: int, size: int):
        self.number, self.parent, self.depth, self.turn, self.size = number, parent, depth, turn, size
        self.least, self.ends = None, None
        self.count = self.children = self.leaves = self.saved = 0

    def add(self, least, count, children, leaves, saved, ends: bytes) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.count += count
        self.children += children
        self.leaves += leaves
        self.saved += saved
        if ends:
            if self.ends:
                self.ends.update(b",")
            else:
                self.ends = hashlib.sha256()
            self.ends.update(ends)

    def done(self) -> tuple:
        """Its row of :data:`MERGED`; its sums go to its parent."""
        self.leaves = self.leaves or 1
        self.saved += (self.count - 1) * self.size
        if self.parent:
            self.parent.children += 1
            self.parent.leaves += self.leaves
            self.parent.saved += self.saved
        digest = self.ends.hexdigest() if self.ends else NOBODY
        above = self.parent.number if self.parent else None
        return self.number, above, self.least, self.depth, self.count, self.children, self.leaves, self.saved, digest, None, None


MERGED = StructType(
    [StructField(n, LongType()) for n in ("node", "above", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [StructField("ends_sha256", StringType()), StructField("part", IntegerType()), StructField("number", LongType())]
)


def merged(parts) -> Iterator[tuple]:
    """Rows of :data:`MERGED` of sorted ``part, number, depth, turn_id, size, conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends``: done nodes, and the node that each part belongs to."""
    stack: list[Open] = []
    nodes = 0
    for part, number, depth, turn, size, *sums in parts:
        if depth < len(stack) and stack[depth].turn != turn:
            while len(stack) > depth:
                yield stack.pop().done()
        if depth == len(stack):
            stack.append(Open(nodes, stack[-1] if stack else None, depth, turn, size))
            nodes += 1
        stack[depth].add(*sums)
        yield stack[depth].number, *[None] * 8, part, number
    while stack:
        yield stack.pop().done()


def _merge_batches(batches):
    rows = (row for b in batches for k in range(0, b.num_rows, SLICE) for row in zip(*(c.to_pylist() for c in b.slice(k, SLICE).columns)))
    yield from _in_batches(merged(rows), MERGED)


# ---- tables ----


def sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns, sizes``: the codes of a conversation's turns in order, and the code points of their texts.

    Texts stay where they are; the dictionary and the rows that meet it hold digests. Codes go in the order of digests.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.char_length(text).alias("size"),
    ).filter(F.col("conv_id").isNotNull())
    rows = store(rows, "turns")
    ordered = rows.select("digest").distinct().repartitionByRange("digest").sortWithinPartitions("digest")
    codes = store(ordered.withColumn("code", F.monotonically_increasing_id()), "turn-codes")
    inside = F.sort_array(F.collect_list(F.struct("turn", "code", "size")))
    return rows.join(codes, "digest").groupBy("conv_id").agg(inside.alias("rows")).select(
        "conv_id", F.col("rows.code").alias("turns"), F.col("rows.size").cast("array<long>").alias("sizes")
    )


def headed(convs: DataFrame) -> DataFrame:
    """Each conversation with its first turns taken from the first of its hundred: as many as a checksum of its id says, if
    there are so many."""
    n = (F.crc32(F.col("conv_id").cast("string")) % (MOST + 1)).cast("int")
    heads = convs.filter(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("_block"), F.slice("turns", 1, MOST).alias("_turns"), F.slice("sizes", 1, MOST).alias("_sizes")
    )
    both = convs.withColumn("_block", F.col("conv_id") - F.col("conv_id") % BLOCK).join(heads, "_block", "left").withColumn("_n", n)

    def built(name):
        none = F.array().cast("array<long>")
        rest = F.slice(F.col(name), F.col("_n") + 1, F.greatest(F.size(name), F.lit(1)))
        return F.concat(F.slice(F.coalesce(F.col(f"_{name}"), none), F.lit(1), F.col("_n")), rest)

    return both.select("conv_id", built("turns").alias("turns"), built("sizes").alias("sizes"))


def nodes(convs: DataFrame, turns: int = TURNS, members: int = MEMBERS) -> DataFrame:
    """The nodes of the trie over ``conv_id, turns, sizes``, with the columns :data:`NODE`."""
    dealt = convs.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id").select("turns", "sizes", "conv_id")
    parts = store(dealt.mapInArrow(_grown(turns, members), PARTS), "trie-parts")
    edges = parts.filter("open").select(
        "part", "number", "depth", "turn_id", "size", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"
    )
    between = store(
        edges.repartition(1).sortWithinPartitions("part", "number").mapInArrow(_merge_batches, MERGED), "trie-edges"
    )
    top = between.filter("part IS NULL")
    known = top.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    refs = between.filter("part IS NOT NULL").select(F.col("node").alias("above"), "part", "number").join(known, "above")
    done = parts.filter("NOT open")
    below = done.filter("number IS NOT NULL").drop("parent_conv_id").join(refs, ["part", "number"])
    found = [done.filter("number IS NULL"), below, top.join(known, "above", "left")]
    first, *rest = (f.select(*NODE) for f in found)
    for other in rest:
        first = first.unionByName(other)
    return first


def trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of conversations as they are."""
    return nodes(store(sequences(df, conv_col, turn_col, role_col, text_col), "conversations"))


def op13_ternary_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that share heads."""
    own = store(sequences(table(spark, sf_dir, "conversations")), "conversations")
    return nodes(store(headed(own), "headed"))


# The checksum of a decimal number, bit by bit; 3988292384 is the polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda sum, byte: list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda bits, none: xor(bits >> 1, (bits & 1) * 3988292384))), 4294967295)"""

OP13_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, {_CRC} % 6 AS h,
    list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS turns
  FROM rows GROUP BY conv_id),
built AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, s[1:d] AS p, d = len(s) AS ended FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM built)),
nodes AS (
  SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY p),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
marked AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children,
    CASE WHEN depth > 0 THEN (n_convs - 1) * length(nodes.p[depth].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN kids USING (p)),
sums AS (
  SELECT p[1:a] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT p, n_children, saved, unnest(range(depth + 1)) AS a FROM marked) GROUP BY 1)
SELECT m.conv_id, m.depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums USING (p) LEFT JOIN nodes above ON m.depth > 0 AND above.p = m.p[1:m.depth - 1]
"""

"""Repair of conversation structure by the cheapest edits, found by a Viterbi search that settles edits as it goes.

Roles of a repaired conversation read ``(s?(ua)+)?``: perhaps a system row, then user and assistant in turn, or nothing at
all. A row can be kept (0), given the role that comes next (2) or deleted (3; a must where it is blank, or repeats
an earlier row); an empty row of the role that comes next can be inserted anywhere (2). A row that is cut off and not deleted
costs 1 more. Of the cheapest ways the one whose edits, written as letters, come first in ASCII is taken.

The search has one survivor per state of that pattern: a leaf in a tree of edits that leads back to the start. A node
counts its children; what no survivor needs any more is dropped, and as soon as all survivors share an ancestor the
edits up to it are settled and leave the task. So a conversation is read as a stream, in memory for the edits still open. Equal
costs are told apart by all of their open edits, from the last common ancestor on. A survivor that can't win whatever
follows is dropped, else the way that deletes everything would keep all edits open. Only open rows hold on to their texts.

Rows meet by conversation, once, and are sorted there by Spark, which spills; one conversation's rows pass one task, since its
digest is made in its order. Rows come by turn (missing ones first), then role and text. A missing role or text is one space;
a missing conversation id is a conversation of its own. The letter of an empty role is empty, and no neighbour makes it legal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lodestat.llm.rows import table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
SLICE = 256  # rows turned into Python values at a time

START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})  # by state and role letter
SPOKEN = (USER, USER, ASSISTANT, USER)  # the state after a row of the role that comes next
ENDS = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# How much dearer the rest can be from one state (row) than from another (column), at most: a system row deleted instead of
# kept, or rows inserted.
EXCESS = ((0, 0, 2, 0), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))


class Node:
    """An edit; ``role`` and ``row`` are what it leaves of a row."""

    __slots__ = ("parent", "edit", "role", "row", "depth", "children", "survives")

    def __init__(self, parent: Node | None, edit: str = "", role: str | None = None, row=None):
        self.parent, self.edit, self.role, self.row = parent, edit, role, row
        self.depth = parent.depth + 1 if parent else 0
        self.children: set[Node] = set()
        self.survives = False


def earlier(a: Node, b: Node) -> bool:
    """Whether the edits that lead to ``a`` come before those that lead to ``b``."""
    shorter = a.depth < b.depth
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    if a is b:
        return shorter
    while a.parent is not b.parent:
        a, b = a.parent, b.parent
    return a.edit < b.edit


class Repair:
    """One conversation's search. ``take`` and ``finish`` give the edits that got settled, as ``(edit, role, row)``."""

    def __init__(self):
        self.root = Node(None)
        self.best: dict[int, tuple[int, Node]] = {}
        self._survive({START: (0, self.root)})

    def _better(self, found: dict, state: int, cost: int, node: Node) -> bool:
        if state in found and (found[state][0] < cost or found[state][0] == cost and not earlier(node, found[state][1])):
            return False
        found[state] = (cost, node)
        return True

    def _survive(self, found: dict[int, tuple[int, Node]]) -> None:
        """Insert rows where that helps, drop states that can't win, and make the rest the survivors."""
        going = True
        while going:
            going = False
            for state, (cost, node) in list(found.items()):
                said = SPOKEN[state]
                going |= self._better(found, said, cost + INSERT_COST, Node(node, INSERT, NAMES[said]))
        kept = {
            state: (cost, node)
            for state, (cost, node) in found.items()
            if all(cost <= other + EXCESS[r][state] for r, (other, _) in found.items())
        }
        before = [node for _, node in self.best.values()]
        self.best = kept
        for node in before:
            node.survives = False
        for _, node in kept.values():
            node.survives = True
            while node.parent and node not in node.parent.children:
                node.parent.children.add(node)
                node = node.parent
        for node in before:
            while node.parent and not node.children and not node.survives:
                node.parent.children.discard(node)
                node = node.parent

    def _settled(self) -> Iterator[tuple]:
        while not self.root.survives and len(self.root.children) == 1:
            self.root = self.root.children.pop()
            self.root.parent = None
            yield self.root.edit, self.root.role, self.root.row

    def take(self, letter: str, drop: bool, cut: bool, role: str, row) -> Iterator[tuple]:
        """The next row, by its role's letter; ``drop``: it must go; ``cut``: it is cut off."""
        found: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.best.items():
            self._better(found, state, cost + DELETE_COST, Node(node, DELETE))
            if not drop:
                after = KEPT[state].get(letter)
                if after is not None:
                    self._better(found, after, cost + cut * CUT_COST, Node(node, KEEP, role, row))
                said = SPOKEN[state]
                self._better(found, said, cost + REROLE_COST + cut * CUT_COST, Node(node, REROLE, NAMES[said], row))
        self._survive(found)
        return self._settled()

    def finish(self) -> tuple[int, list[tuple]]:
        """The cost, and the edits that were open."""
        end: dict[int, tuple[int, Node]] = {}
        for state in ENDS:
            if state in self.best:
                self._better(end, START, *self.best[state])
        cost, node = end[START]
        open_ = []
        while node is not self.root:
            open_.append((node.edit, node.role, node.row))
            node = node.parent
        return cost, open_[::-1]


class Conversation:
    """Counts and search of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.turn = self.letter = None
        self.turns, self.cost = 0, 0
        self.audit, self.digest, self.rows = bytearray(), hashlib.sha256(), 0

    def _kept(self, edits) -> Iterator[tuple]:
        """Note settled edits; gives the rows they leave as ``(conv, place, turn, role, text, edit)``."""
        for edit, role, row in edits:
            self.audit += edit.encode()
            if edit != DELETE:
                turn, text = row or (None, "")
                self.digest.update((f"{chr(10) if self.rows else ''}{role}:{text}").encode())
                yield self.conv, self.rows, turn, role, text, edit
                self.rows += 1

    def take(self, turn, role: str, text: str, nth: int) -> Iterator[tuple]:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.turn = turn
        letter = role[:1]
        self.illegal += self.letter is not None and self.letter + letter not in LEGAL
        self.letter = letter
        bare = text.rstrip(SPACE)
        blank, again = not bare, nth > 1
        cut = not blank and not again and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut
        return self._kept(self.repair.take(letter, blank or again, cut, role, (turn, text)))

    def finish(self) -> Iterator[tuple]:
        self.cost, edits = self.repair.finish()
        return self._kept(edits)

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        counts = gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return self.conv, *counts, self.audit.decode(), self.digest.hexdigest()


def read(batches) -> Iterator[tuple[Conversation | None, Iterator[tuple]]]:
    """From sorted rows, what they settle; at the end of a conversation with it, else with None."""
    now = None
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            for conv, turn, role, text, nth, gone in zip(*(c.to_pylist() for c in part.columns)):
                if now is None or conv != now.conv:
                    if now:
                        yield now, now.finish()
                    now = Conversation(conv)
                if not gone:
                    yield None, now.take(turn, role, text, nth)
    if now:
        yield now, now.finish()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _written(rows: list[tuple], schema: StructType, kind) -> pa.RecordBatch:
    kinds = [kind, *(pa.int64() if isinstance(f.dataType, LongType) else pa.string() for f in schema.fields[1:])]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)


def _over(schema: StructType, whole: bool, size: int = 1 << 20):
    """Over sorted rows: a line per conversation, or (``whole``) the rows it is left with; batches of about ``size`` characters."""

    def run(batches):
        kind, rows, held = None, [], 0

        def typed():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for done, kept in read(typed()):
            for row in kept:
                if whole:
                    rows.append(row)
                    held += 100 + len(row[4])
                    if held > size:
                        yield _written(rows, schema, kind)
                        rows, held = [], 0
            if done and not whole:
                rows.append(done.summary())
                held += 200 + len(done.audit)
            if held > size:
                yield _written(rows, schema, kind)
                rows, held = [], 0
        if rows:
            yield _written(rows, schema, kind)

    return run


def _marked(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The columns that count, under own names; ``gone``: the row only stands for its conversation."""
    return df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        F.lit(False).alias("gone"),
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """The damage of :func:`damage`, with dropped rows as ``gone`` and without text."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(key) % 20
    copies = F.when(F.col("fate") == 3, F.array_repeat(F.lit(1), 2)).otherwise(F.array(F.lit(1)))
    marked = rows.withColumn("fate", fate).select("conv_id", "turn", "role", "text", "fate", F.explode(copies))
    text = (
        F.when(F.col("fate") <= 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") == 0).alias("gone"))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows by conversation, turn, role and text; ``nth``: the how manieth row with this role and text it is.

    One shuffle: what is dealt by conversation is so by conversation, role and text too.
    """
    same = Window.partitionBy("conv_id", "role", "text", "gone").orderBy("turn")
    dealt = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    ordered = dealt.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "nth")
    return ordered.select("conv_id", "turn", "role", "text", "nth", "gone")


def _audited(rows: DataFrame) -> DataFrame:
    fields = [rows.schema["conv_id"], *(StructField(c, LongType()) for c in COUNTS)]
    schema = StructType([*fields, StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    return _sorted(rows).mapInArrow(_over(schema, whole=False), schema)


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with known faults, for trials: by a checksum of conversation and turn (missing: a space) a
    twentieth of the rows each is dropped, emptied, stripped of its sentence ends, repeated, or made the user's."""
    return _damaged(_marked(df, conv_col, turn_col, role_col, text_col)).filter(~F.col("gone")).drop("gone")


def audit(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A line per conversation: ``conv_id``, its faults, the ``cost`` and letters of its edits, the digest of what they leave."""
    return _audited(_marked(df, conv_col, turn_col, role_col, text_col))


def repaired(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place, turn, role, text, edit``: the rows of the repaired conversations, inserted ones without turn."""
    rows = _marked(df, conv_col, turn_col, role_col, text_col)
    names = (("place", LongType()), ("turn", LongType()), ("role", StringType()), ("text", StringType()), ("edit", StringType()))
    schema = StructType([rows.schema["conv_id"], *(StructField(n, k) for n, k in names)])
    return _sorted(rows).mapInArrow(_over(schema, whole=True), schema)


def op12_survivor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of every conversation after damage; one whose rows are all dropped has zeros."""
    rows = _marked(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return _audited(_damaged(rows))


# The checksum of the damage, bit by bit; 3988292384 is the polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
  lambda sum, byte: list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda bits, none: xor(bits >> 1, (bits & 1) * 3988292384))), 4294967295)"""


def _way(state: str, cost: str, edit: str, row: str | None = None, when: str = "true") -> str:
    """A way on from ``state``: its cost, its edits as letters, and the rows it leaves."""
    left = f"list_append({state}.o, {row})" if row else f"{state}.o"
    return f"CASE WHEN {when} AND {state}.c IS NOT NULL THEN {{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'o': {left}}} END"


def _best(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w.c IS NOT NULL))[1]"


def _inserted(state: str, said: str) -> str:
    return _way(state, "2", INSERT, f"'{said}:'")


def _stepped(state: int) -> str:
    """The cheapest way to ``state`` with one more row, which is ``letter, role, text, dropped, cut``."""
    ways = [_way(f"s{state}", "3", DELETE)]
    for before, after in enumerate(KEPT):
        for letter, to in after.items():
            if to == state:
                ways.append(_way(f"s{before}", "cut", KEEP, "role || ':' || text", f"NOT dropped AND letter = '{letter}'"))
        if SPOKEN[before] == state:
            ways.append(_way(f"s{before}", "2 + cut", REROLE, f"'{NAMES[state]}:' || text", "NOT dropped"))
    return f"{_best(*ways)} AS n{state}"


OP12_SQL = rf"""
WITH RECURSIVE hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS fate FROM conversations)),
numbered AS (
  SELECT *, left(role, 1) AS letter, NOT regexp_matches(text, '[^ 	-]') AS blank,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM hurt),
marked AS MATERIALIZED (
  SELECT *, blank OR again AS dropped,
    CASE WHEN NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 1 ELSE 0 END AS cut,
    lag(letter) OVER (PARTITION BY conv_id ORDER BY k) || letter AS pair
  FROM numbered),
walk(conv_id, k, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'e': '', 'o': []::VARCHAR[]}}, NULL::STRUCT(c INTEGER, e VARCHAR, o VARCHAR[]),
    {{'c': 2, 'e': 'I', 'o': ['user:']}}, {{'c': 4, 'e': 'II', 'o': ['user:', 'assistant:']}} FROM conversations
  UNION ALL
  SELECT conv_id, k, n0, n1, m2, {_best("n3", _inserted("m2", "assistant"))} FROM (
    SELECT conv_id, k, n0, n1, n3,
      {_best("n2", _inserted("n0", "user"), _inserted("n1", "user"), _inserted("n3", "user"))} AS m2 FROM (
      SELECT walk.conv_id, marked.k, {", ".join(_stepped(q) for q in range(4))}
      FROM walk JOIN marked ON marked.conv_id IS NOT DISTINCT FROM walk.conv_id AND marked.k = walk.k + 1))),
ended AS (
  SELECT conv_id, {_best("s0", "s3")} AS way FROM walk QUALIFY k = max(k) OVER (PARTITION BY conv_id)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, sum(cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0) AS illegal, way.c::BIGINT AS cost, way.e AS audit,
  sha256(array_to_string(way.o, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM e.conv_id
"""

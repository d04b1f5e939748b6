import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lodestat.llm import prefix_trie

ROWS = "conv_id long, turn long, role string, text string"


def turns_of(rows):
    """Turns (role, text) by conversation, in order."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            found.setdefault(conv, []).append(((turn is not None, turn or 0), digest, (role, text)))
    return {conv: tuple(t for *_, t in sorted(turns)) for conv, turns in found.items()}


def headed(turns):
    built = {}
    for conv, own in turns.items():
        n = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        built[conv] = turns.get(base, ())[:n] + own[n:]
    return built


def plain(built):
    """All nodes of the trie, one prefix after the other."""
    members, ends = {}, {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
        ends.setdefault(turns, []).append(conv)
    rows = []
    for node, convs in members.items():
        below = [p for p in members if p[: len(node)] == node]
        kids = [p for p in below if len(p) == len(node) + 1]
        leaves = sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        text = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs), len(node), parent, len(convs), len(kids), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(rows, key=repr)


def made(draw, n, deep=5, wide=3):
    """Conversations of which many share heads or are copies."""
    rows = []
    for conv in draw.sample(range(-250, 2000), n):
        for turn in range(draw.randint(1, deep)):
            rows.append((conv, turn, draw.choice(("user", "assistant")), "t" * draw.randint(0, wide)))
    return rows


@pytest.mark.parametrize("turns, members", ((1, 1), (3, 2), (10, 100), (1000, 1000)))
def test_trees_and_merge_are_a_plain_trie(turns, members):
    draw = random.Random(turns)
    for _ in range(20):
        built = turns_of(made(draw, draw.randint(1, 60)))
        codes = {t: k for k, t in enumerate(sorted({t for s in built.values() for t in s}))}
        rows = sorted(([codes[t] for t in s], [len(t[1]) for t in s], conv) for conv, s in built.items())
        done, edges, number = [], [], 0
        for run in prefix_trie.trees(rows, turns, members):
            tree, open_ = prefix_trie.planted(run)
            for row in prefix_trie.harvested(tree, open_, number):
                (edges if row[0] else done).append(row)
            number += len(open_)
        parts = [(0, r[1], r[3], r[10], r[11], r[2], *r[5:9], r[12]) for r in sorted(edges, key=lambda r: r[1])]
        merged = list(prefix_trie.merged(parts))
        top = {r[0]: r for r in merged if r[9] is None}
        at = {r[10]: top[r[0]] for r in merged if r[9] is not None}
        found = [(r[2], r[3], r[4] if r[1] is None else at[r[1]][2], *r[5:10]) for r in done]
        found += [(r[2], r[3], None if r[1] is None else top[r[1]][2], *r[4:9]) for r in top.values()]
        assert sorted(found, key=repr) == plain(built)


def test_trees_are_balanced():
    rows = [([k], [1], [k]) for k in range(1023)]
    tree, _ = prefix_trie.planted(rows)
    height, level = 0, [tree.down[0]]
    while level := [side for node in level for side in (tree.low[node], tree.high[node]) if side >= 0]:
        height += 1
    assert height <= 10


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.NODE).collect()), key=repr)


def test_tables_with_hot_heads_and_copies(spark):
    draw = random.Random(3)
    rows = made(draw, 120) + [(c, t, "user", "same") for c in range(3000, 3200) for t in range(4)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    built = turns_of(rows)
    assert rows_of(prefix_trie.trie(df)) == plain(built)
    convs = prefix_trie.sequences(df)
    assert rows_of(prefix_trie.nodes(convs, turns=20, members=7)) == plain(built)
    assert rows_of(prefix_trie.nodes(prefix_trie.headed(convs), turns=20, members=7)) == plain(headed(built))


def test_odd_conversations(spark):
    rows = [
        (None, 1, "user", "x"), (1, None, "user", None), (1, None, None, None), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"),
        (2, None, "user", ""), (100, 5, "user", "word " * 50_000), (101, 5, "user", "word " * 50_000), (150, 0, "", "u"), (-3, 0, "a", "\x00é"),
    ] + [(700, k, "user", "long") for k in range(500)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"turns": F.lit(1), "digest": F.lit("x"), "a b`c": F.struct(F.lit(1).alias("my field"))})
    built = turns_of(rows)
    assert rows_of(prefix_trie.trie(df)) == plain(built)
    assert rows_of(prefix_trie.nodes(prefix_trie.headed(prefix_trie.sequences(df)))) == plain(headed(built))
    none = spark.createDataFrame([], ROWS)
    assert prefix_trie.trie(none).count() == 0


def test_query_is_a_plain_trie(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    query = prefix_trie.op13_ternary_trie(spark, folder)
    assert query.columns == list(prefix_trie.NODE)
    assert rows_of(query) == plain(headed(turns_of(rows)))

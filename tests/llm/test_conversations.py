import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lodestat.llm import conversation_repair as repair

SPACES = " \t\n\x0b\x0c\r"
ROWS = "conv_id long, turn long, role string, text string"


def legal(letters):
    return not letters or letters.removeprefix("s") != "" and letters.removeprefix("s") == "ua" * (len(letters.removeprefix("s")) // 2)


def faults(rows):
    """First fault of each (turn, role, text): blank, duplicate, truncated or none."""
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        found.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def every_way(rows):
    """Cheapest (cost, edits, rows) of all edits, tried one by one with at most two insertions in a gap."""
    marks, best = faults(rows), None
    for edits in itertools.product(*["D" if m in ("b", "d") else "DKR" for m in marks]):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            letters, audit, cost, left = "", "", 0, []
            for (_, role, text), edit, mark, extra in zip([*rows, (None, "", "")], [*edits, ""], [*marks, ""], inserts):
                steps = [("I", "", "")] * extra + [(edit, role, text)] * bool(edit)
                for step, was, kept in steps:
                    audit += step
                    cost += {"I": 2, "K": 0, "R": 2, "D": 3}[step] + (mark == "t" and step in "KR")
                    if step in "IR":
                        was = "assistant" if letters[-1:] == "u" else "user"
                    if step != "D":
                        letters += was[:1] or "-"
                        left.append(f"{was}:{kept}")
            if legal(letters) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(left)
    return best


def searched(rows):
    """The same by keeping the best whole string per state, for longer conversations."""
    def closed(found):
        for _ in range(3):
            for letters, (cost, audit, left) in list(found.items()):
                role = "assistant" if letters == "u" else "user"
                way = cost + 2, audit + "I", (*left, f"{role}:")
                found[role[0]] = min(found.get(role[0], way), way)
        return found

    found = closed({"": (0, "", ())})
    for (_, role, text), mark in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, left) in found.items():
            ways = [(state, (cost + 3, audit + "D", left))]
            if mark not in ("b", "d"):
                cut = mark == "t"
                if role[:1] == "s" and state == "" or role[:1] == "u" and state != "u" or role[:1] == "a" and state == "u":
                    ways.append((role[0], (cost + cut, audit + "K", (*left, f"{role}:{text}"))))
                said = "assistant" if state == "u" else "user"
                ways.append((said[0], (cost + 2 + cut, audit + "R", (*left, f"{said}:{text}"))))
            for to, way in ways:
                after[to] = min(after.get(to, way), way)
        found = closed(after)
    cost, audit, left = min(found[s] for s in ("", "a") if s in found)
    return cost, audit, "\n".join(left)


def damaged(rows):
    """Rows of (conv, turn, role, text) after damage, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else text.translate({ord(c): None for c in ".!?"}) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def expected(rows):
    marks, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    letters = [r[:1] for _, r, _ in rows]
    cost, audit, left = searched(rows)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (
        gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, hashlib.sha256(left.encode()).hexdigest()
    )


def made(draw, n, roles=("user", "assistant", "system", "tool", "", " ")):
    texts = ("Yes.", "No", " ", "", "Why?\n", "a b", "So! ")
    weights = (6, 6, 2, 1, 1, 1)[: len(roles)]
    return [(k, draw.choices(roles, weights)[0], draw.choice(texts) + draw.choice(["", "x", "y."])) for k in range(n)]


def run(rows):
    """Cost, edits and text of a conversation as the operator's search has them."""
    conv, left = repair.Conversation(1), []
    seen = {}
    for turn, role, text in rows:
        nth = seen[role, text] = seen.get((role, text), 0) + 1
        left += [f"{r[3]}:{r[4]}" for r in conv.take(turn, role, text, nth)]
    left += [f"{r[3]}:{r[4]}" for r in conv.finish()]
    assert conv.digest.hexdigest() == hashlib.sha256("\n".join(left).encode()).hexdigest()
    return conv.cost, conv.audit.decode(), "\n".join(left)


@pytest.mark.parametrize("seed", range(4))
def test_edits_are_the_cheapest_of_all(seed):
    draw = random.Random(seed)
    for _ in range(40):
        rows = made(draw, draw.randint(0, 4))
        assert run(rows) == searched(rows) == every_way(rows)


@pytest.mark.parametrize("roles", (("user", "assistant", "system"), ("user", "tool"), ("system", "user"), ("assistant",)))
def test_edits_of_long_conversations(roles):
    draw = random.Random(len(roles))
    for n in (1, 7, 30, 120):
        for _ in range(8):
            rows = made(draw, n, roles)
            assert run(rows) == searched(rows)


def test_open_edits_stay_few():
    draw, most = random.Random(7), 0
    search = repair.Repair()
    for k in range(20_000):
        role = draw.choice(["user", "assistant", "assistant", "system"])
        list(search.take(role[0], draw.random() < 0.1, draw.random() < 0.2, role, (k, "x")))
        most = max(most, max(node.depth for _, node in search.best.values()) - search.root.depth)
    assert most < 200


@pytest.fixture
def talks(spark):
    draw = random.Random(11)
    rows = [(c, *row) for c in range(60) for row in made(draw, draw.randint(1, 9))]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (60, None, "user", None), (61, 2, None, "So."), (61, 2, None, "So.")]
    rows += [(62, 5, "user", "word " * 40_000), (62, 1, "user", "Hm."), (62, None, "assistant", "Oh."), (63, 9, "user", "a"), (63, 9, "user", "b")]
    return rows + [(64, k, "user", "Same.") for k in range(300)]


def test_audit_after_damage_is_a_plain_ones(spark, talks):
    df = spark.createDataFrame(talks, ROWS).withColumns({"nth": F.lit("x"), "gone": F.lit(1), "a b`c": F.struct(F.lit(1).alias("my field"))})
    rows = repair._audited(repair._damaged(repair._marked(df.repartition(3), "conv_id", "turn", "role", "text"))).collect()
    want = {c: expected(r) for c, r in damaged(talks).items()}
    assert {r.conv_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_repaired_rows_are_those_of_the_audit(spark, talks):
    df = spark.createDataFrame(talks, ROWS)
    audits = {r.conv_id: r for r in repair.audit(df).collect()}
    kept = {}
    for r in sorted(repair.repaired(df).collect(), key=lambda r: r.place):
        kept.setdefault(r.conv_id, []).append(r)
    for conv, line in audits.items():
        rows = kept.get(conv, [])
        assert [r.place for r in rows] == list(range(len(rows)))
        assert "".join(r.edit for r in rows) == line.audit.replace("D", "")
        text = "\n".join(f"{r.role}:{r.text}" for r in rows)
        assert hashlib.sha256(text.encode()).hexdigest() == line.repaired_sha256
        assert legal("".join(r.role[:1] for r in rows))
        assert all((r.turn is None and r.text == "") == (r.edit == "I") for r in rows if conv not in (None, 60, 62))


def test_damage_gives_plain_rows(spark, talks):
    df = repair.damage(spark.createDataFrame(talks, ROWS))
    want = sorted(repr((c, *r)) for c, rows in damaged(talks).items() for r in rows)
    assert df.columns == ["conv_id", "turn", "role", "text"] and sorted(repr(tuple(r)) for r in df.collect()) == want


def test_empty_conversations(spark):
    none = spark.createDataFrame([], ROWS)
    assert repair.audit(none).count() == repair.repaired(none).count() == repair.damage(none).count() == 0


def test_query_audits_the_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: expected(r) for c, r in damaged(rows).items()}
    found = repair.op12_survivor_repair(spark, folder).collect()
    assert len(found) == len(want) and {r.conv_id: tuple(r)[1:] for r in found} == want

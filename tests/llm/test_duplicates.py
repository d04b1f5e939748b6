import collections
import random

import pytest
from pyspark.sql import functions as F

from lodestat.llm import decontaminate, exact_dedup, jaccard_join, links, sentence_spans
from tests_llm_brute import brute_components, brute_hits, by_norm

def test_exact_groups_of_odd_documents(odd, none):
    got = exact_dedup.exact_groups(odd).collect()
    groups = by_norm(odd.collect())
    want = []
    for group in groups.values():
        best = min(group, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        want += [(r.doc_id or -1, best.doc_id, len(group)) for r in group]
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size) for r in got) == sorted(want)
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.drop_exact_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_exact_copies(none).count() == 0


def test_digits_of_one_byte_and_shared_prefixes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST_DIGIT", 1)
    monkeypatch.setattr(exact_dedup, "GROWTH", 2)
    draw = random.Random(1)
    rows = [(k, "".join(draw.choices("ab ", k=draw.randint(0, 7)))) for k in range(300)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = collections.Counter(t.replace(" ", "") for _, t in rows)
    assert {r.doc_id: r.group_size for r in got} == {k: sizes[t.replace(" ", "")] for k, t in rows}


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)] + [(k, k + 1) for k in range(500, 600)]
    name = {}

    def root(x):
        name.setdefault(x, x)
        while name[x] != x:
            x = name[x]
        return x

    for a, b in pairs:
        name[max(root(a), root(b))] = min(root(a), root(b))
    got = links.components(spark.createDataFrame(pairs, "a long, b long"))
    want = {x: root(x) for x in list(name)}
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.root for r in got.collect()} == {x: r for x, r in want.items() if x not in alone}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows(seed):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(25):
        base = draw.choices(words, k=draw.choice([2, 4, 6, 9, 11, 13, 16, 19, 23, 40, 120]))
        for _ in range(draw.choice([1, 2, 6])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("boundary", (None, 5, 19))
def test_near_groups_agree_with_all_pairs(spark, monkeypatch, boundary):
    if boundary:
        monkeypatch.setattr(jaccard_join, "choose_boundary", lambda counts, percent: boundary)
    rows = [*near_rows(3), (900, None), (901, ""), (902, "A b"), (903, "a  B")]
    got = jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_near_groups_of_odd_documents(odd, none):
    got = jaccard_join.near_groups(odd).collect()
    assert len(got) == odd.count()
    one = {r.component_id for r in got if r.n_shingles == 3}
    assert one == {4}  # six words in any case and spacing, repeated, and without an id
    kept = jaccard_join.drop_near_copies(odd)
    assert kept.columns == odd.columns
    texts = collections.Counter(" ".join((r.text or "").lower().split())[:30] for r in kept.collect())
    assert texts["one two three four five six."] == 1 and texts["word word word word word word "] == 1 and texts[""] == 3
    assert jaccard_join.near_groups(none).count() == 0


def brute_repeats(rows):
    seen, out = {}, {}
    for k, text in sorted(rows):
        found, gone = sentence_spans.sentences(text or ""), set()
        for _, first, last in sentence_spans.runs(found):
            run = tuple(" ".join(text[s[0] : s[1]].lower().split()) for s in found[first : last + 1])
            if run in seen:
                gone |= set(range(first, last + 1))
            else:
                seen[run] = k
        out[k] = (len(found), len(gone))
    return out


def test_repeated_spans_agree_with_a_plain_loop(spark):
    draw = random.Random(4)
    parts = [" ".join(draw.choices("ab cd ef gh ij kl mn".split(), k=draw.randint(1, 20))) + draw.choice([". ", "\n", "! "]) for _ in range(30)]
    rows = [(k, "".join(draw.choices(parts, k=draw.randint(0, 12)))) for k in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sentence_spans.repeated_spans(frame).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in got} == brute_repeats(rows)


def test_shared_passage_is_cut_from_the_later_text(spark):
    draw = random.Random(5)
    def prose(n):
        return " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    passage = prose(30) + " " + prose(25)
    rows = [(2, prose(40) + ". " + passage + " " + prose(30), "x"), (1, prose(20) + ". " + passage + ". " + prose(9), "y")]
    got = {r.doc_id: r.text for r in sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, row_uid string")).collect()}
    assert got[1] == rows[1][1] and len(got[2].split()) < 40 + 55 + 30 - 25
    assert got[2].startswith(rows[0][1][:200]) and got[2].endswith(rows[0][1][-100:])


def test_repeats_of_odd_documents(odd, none):
    assert sentence_spans.repeated_spans(odd).count() == odd.count()
    cut = sentence_spans.remove_repeats(odd)
    assert sorted(cut.columns) == sorted(odd.columns) and cut.count() == odd.count()
    assert cut.filter("length(text) > 100000").count() == 0  # one word over and over repeats itself
    assert sentence_spans.repeated_spans(none).count() == 0


def test_winnowing_misses_no_window(spark):
    draw = random.Random(6)
    words = ["ab", "c1", "dé", "EF", "gh", "ij"]
    items = [(k, draw.choice([" ", ", "]).join(draw.choices(words, k=n))) for k, n in enumerate([3, 9, 10, 11, 14, 25, 40, 2])]
    items += [(8, None), (9, " .. "), (None, items[4][1]), (3, items[5][1])]
    rows = []
    for k in range(60):
        parts = [" ".join(draw.choices(words, k=draw.randint(0, 15)))]
        for _ in range(draw.randint(0, 2)):
            source = draw.choice([t for _, t in items if t]).split()
            at = draw.randint(0, len(source))
            parts += [" ".join(source[at : at + draw.randint(1, 14)]), " ".join(draw.choices(words, k=2))]
        rows.append((k, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    known = [(i, t) for i, t in items if i is not None]
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == {k: brute_hits(t, known) for k, t in rows}


def test_winnowing_of_odd_documents(spark, odd, none):
    items = spark.createDataFrame([(1, "two three four"), (1, "word " * 12), (2, None)], "item_id long, text string")
    got = decontaminate.contamination(odd, items).collect()
    want = [brute_hits(r.text if len(r.text or "") < 1000 else "word " * 30_000 + "end", [(1, "two three four")])[0] for r in odd.collect()]
    assert sorted(r.n_words for r in got) == sorted(want)
    assert {r.n_hit for r in got if r.n_words == 30_001} == {30_000}
    clean = decontaminate.drop_contaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == sum(not r.contaminated for r in got)
    assert decontaminate.contamination(none, items).count() == 0
    empty = decontaminate.drop_contaminated(odd, items.limit(0))
    assert empty.count() == odd.count()


def test_native_plans_have_no_python(spark, odd):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    plan = decontaminate.contamination(odd.select("doc_id", F.col("text")), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

import random

import corpus_pipeline


def shingles(text, size=5):
    words = text.lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_kept(rows):
    """The smallest id of each group that links of 5-word sets, 0.8 alike or more, hold together."""
    sets, name = {k: shingles(text) for k, text in rows}, {k: k for k, _ in rows}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                name[max(x, y)] = min(x, y)
    return {k for k in sets if root(k) == k}


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id for r in corpus_pipeline.keep_unlike(spark, docs, "").collect()}


def edited(words, edits):
    """A word changed at each of so many places, far from each other."""
    out, step = list(words), len(words) // edits
    for k in range(edits):
        out[k * step + step // 2] = f"new{k}"
    return out


def test_stage_drops_copies_just_above_the_line(spark):
    words = [f"a{k}" for k in range(1000)]
    half = [f"b{k}" for k in range(500)]
    rows = [(1, " ".join(words)), (2, " ".join(edited(words, 21))), (3, " ".join(half))]
    rows += [(4, " ".join(half + [f"c{k}" for k in range(100)])), (5, " ".join(half + [f"d{k}" for k in range(140)]))]
    rows += [(6, " ".join(edited(words, 30)))]
    assert brute_kept(rows) == {1, 3, 5, 6} and kept(spark, rows) == {1, 3, 5, 6}


def test_stage_agrees_with_five_words_and_four_fifths(spark):
    draw, rows = random.Random(8), []
    words = [f"w{k}" for k in range(400)]
    for _ in range(30):
        base = draw.choices(words, k=draw.choice([1, 4, 5, 7, 9, 12, 15, 19, 24, 40, 90, 200]))
        for _ in range(draw.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(draw.randint(0, 1 + len(base) // 40)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy + draw.choices(words, k=draw.randint(0, 1 + len(base) // 8)))))
    rows += [(len(rows), None), (len(rows) + 1, "")]
    rows = [(k, text) for k, text in rows]
    want = brute_kept([(k, text or "") for k, text in rows])
    assert kept(spark, rows) == want and len(want) < len(rows)

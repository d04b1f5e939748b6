"""Plain versions that operators are held against."""

import collections
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def by_norm(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r.text or "")].append(r)
    return groups


def brute_components(rows):
    sets = {}
    for k, text in rows:
        words = [w for w in SPACE.split((text or "").translate(UPPER)) if w]
        sets[k] = frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()
    name = {k: k for k in sets}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                name[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def brute_hits(text, items):
    split = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = [w for w in split.split((text or "").translate(UPPER)) if w]
    hit, found = set(), set()
    for item, content in items:
        its = [w for w in split.split((content or "").translate(UPPER)) if w]
        size = min(10, len(its))
        for k in range(len(its) - size + 1 if its else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == its[k : k + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)

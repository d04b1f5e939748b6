import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestat.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.FILE))


def fewest(items, limit):
    """Sequences of a best packing, all ways tried."""
    items, best = sorted(items, reverse=True), len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in {r: i for i, r in enumerate(rooms) if r >= items[k]}.values():
            rooms[room] -= items[k]
            go(k + 1, rooms)
            rooms[room] += items[k]
        go(k + 1, [*rooms, limit - items[k]])

    go(0, [])
    return best


def counted(items):
    return {size: items.count(size) for size in set(items)}


def contents_fit(counts, limit):
    found, total = {}, 0
    for times, contents in packing.packed_lengths(counts, limit):
        assert times > 0 and sum(size * n for size, n in contents) <= limit
        total += times
        for size, n in contents:
            found[size] = found.get(size, 0) + times * n
    assert found == {size: n for size, n in counts.items() if n}
    return total


@pytest.mark.parametrize("limit", (10, 23, 50))
def test_reduction_keeps_a_best_packing(limit):
    draw, more = random.Random(limit), 0
    for _ in range(250):
        items = [draw.randint(1, limit) for _ in range(draw.randint(0, 9))]
        stock, least = packing.Stock(counted(items)), fewest(items, limit)
        fixed = sum(times for times, _ in packing.reduced(stock, limit))
        assert fixed + fewest([s for s, n in stock.left.items() for _ in range(n)], limit) == least
        more += contents_fit(counted(items), limit) - least
    assert more <= 5


def test_copies_taken_at_once_are_as_good_as_one_by_one():
    draw = random.Random(4)
    for _ in range(60):
        items = [draw.choice((3, 4, 5, 9, 11)) for _ in range(draw.randint(0, 14))]
        assert contents_fit(counted(items), 20) <= fewest(items, 20) + 1


def test_best_fit_is_a_plain_one():
    draw = random.Random(5)
    for _ in range(100):
        items = sorted((draw.randint(1, 40) for _ in range(draw.randint(0, 60))), reverse=True)
        rooms = []
        for size in items:
            fitting = [(room, k) for k, room in enumerate(rooms) if room >= size]
            if fitting:
                rooms[min(fitting)[1]] -= size
            else:
                rooms.append(40 - size)
        packed = list(packing.best_fit(packing.Stock(counted(items)), 40))
        left = sorted(40 - sum(s * n for s, n in contents) for times, contents in packed for _ in range(times))
        assert left == sorted(rooms)


def test_many_lengths_stay_few_entries():
    draw = random.Random(6)
    counts = {size: draw.randint(0, 10**9) for size in range(1, 2049)}
    sequences = packing.packed_lengths(counts)
    assert contents_fit(counts, 2048) >= -(-sum(s * n for s, n in counts.items()) // 2048)
    assert len(packing.slots(sequences)) < 20_000
    with pytest.raises(ValueError):
        packing.packed_lengths({2049: 1})


def test_ids_are_the_librarys(tokenizer):
    draw = random.Random(7)
    letters = ["ab ", " ", "\n", "é", "中", "<|endoftext|>", "<|endof", "'s", "12", "!?", "x" * 50]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(400)] + ["", "q" * 5000, " " * 5000]
    path = public_tokenizers.path(packing.FILE)
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert packing.encoded(text, path).tolist() == want
        parts = list(packing.portions_of(text, 40))
        assert "".join(parts) == text
        assert [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids] == want[:-1]


def held(rows, docs, tokenizer, limit):
    """Asserts that ``rows`` pack ``docs``, a list of (doc_id, text); gives the number of sequences."""
    want, at = [], {}
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        ends = range(len(ids) % limit or limit, len(ids) + 1, limit)
        for piece, (start, end) in enumerate(zip([0, *ends], ends)):
            want.append((doc, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= limit
    return len(at)


def test_odd_documents(spark, odd, none, tokenizer):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    clash = odd.withColumns({"part": F.lit(1), "rank": F.lit("x"), "a b`c": F.struct(F.lit(1).alias("my field"))})
    packed = packing.pack(clash, limit=512)
    rows = packed.select("doc_id", "piece", "start", "length", F.crc32("ids"), "sequence_id", "offset").collect()
    total = sum(r.length for r in rows)
    assert held(rows, docs, tokenizer, 512) <= -(-total // 512) + 1
    whole = packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in whole) == total and all(len(r.ids) == 4 * r.n_tokens for r in whole)
    assert packing.pack(none).count() == packing.sequences(packing.pack(none)).count() == 0


def test_query_packs_the_table(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    query = packing.op11_dominance_packing(spark, folder)
    assert query.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = query.collect()
    assert held(rows, docs, tokenizer, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1

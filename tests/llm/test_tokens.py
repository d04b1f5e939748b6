import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestat.llm import count_transducer, prefix_bpe

LETTERS = "ab  \n\t'stredl1290é 　 \x1cK\U0001f600中文,.!?-_ñß"


def texts(count, seed=1, extra=()):
    draw = random.Random(seed)
    made = ["".join(draw.choices([*LETTERS, *extra], k=draw.randint(0, 50))) for _ in range(count)]
    return [*made, "", "a" * 3000, " " * 700, "x\n\n  y's 'LL", "ab" * 2000 + " end"]


@pytest.fixture(scope="module")
def library():
    lines = open(public_tokenizers.path(prefix_bpe.FILE), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.encoder(public_tokenizers.path(prefix_bpe.FILE))


@pytest.fixture(scope="module")
def counter():
    return count_transducer.counter(public_tokenizers.path(count_transducer.FILE))


def test_encoding_is_the_librarys(encoder, library):
    sample = texts(1500)
    found = list(encoder.encode_all(sample))
    assert found == [library.encode_ordinary(t) for t in sample]
    assert [encoder.decode(f).decode() for f in found] == sample


def test_appends_and_edits_are_exact(encoder, library):
    draw = random.Random(2)
    for text in texts(120, seed=3):
        data = text.encode()
        grown = prefix_bpe.Prefixes(encoder.vocabulary)
        for byte in data[:60]:
            grown.append(bytes((byte,)))
        assert grown.last == prefix_bpe.Prefixes(encoder.vocabulary, data[:60]).last
        start, end = sorted((draw.randint(0, len(text)), draw.randint(0, len(text))))
        new = draw.choice(["", "the", " \n", "é"])
        changed = text[:start] + new + text[end:]
        assert encoder.edit(text, encoder.encode(text), start, end, new) == library.encode_ordinary(changed)


def test_counts_are_the_librarys(counter):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(count_transducer.FILE))
    sample = texts(1500, seed=4, extra=("<|endoftext|>", "<|endof"))
    want = [len(e) for e in tokenizer.encode_batch(sample, add_special_tokens=False)]
    assert list(counter.counts(sample)) == want


@pytest.mark.parametrize("size", (1, 2, 5, 40))
def test_chunk_maps_compose(counter, size):
    for text in texts(150, seed=5, extra=("<|endoftext|>",)):
        text = text[:300]
        maps = list(counter.maps(text[k : k + size] for k in range(0, len(text), size)))
        assert counter.total(counter.scan(maps)) == counter.count(text)
        if len(maps) > 2:  # grouping makes no difference
            left = counter.compose(counter.compose(*maps[:2]), maps[2])
            right = counter.compose(maps[0], counter.compose(*maps[1:3]))
            assert counter.total(left) == counter.total(right)


def test_small_room_changes_nothing(counter):
    small = count_transducer.Counter(counter.transducer.vocabulary, counter.specials)
    small.transducer.ROOM, small._known.room = 50, 10
    sample = texts(100, seed=6)
    assert list(small.counts(sample)) == list(counter.counts(sample))


def test_counts_of_odd_documents(odd, none, counter):
    rows = count_transducer.token_counts(odd, chunk=1000).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), counter.count(r.text or "")) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert count_transducer.token_counts(none).count() == 0


def test_digests_of_odd_documents(odd, none, library):
    def digests(text):
        ids = library.encode_ordinary(text)
        joined = ",".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    rows = prefix_bpe.encode_digests(odd).collect()
    want = sorted((r.doc_id or -1, *digests(r.text or "")) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    whole = prefix_bpe.encode(odd.withColumn("token_ids", F.lit(1)))
    assert whole.columns == [*odd.columns, "token_ids", "decoded"] and whole.count() == odd.count()
    assert prefix_bpe.encode(none).count() == 0

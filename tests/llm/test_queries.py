"""The registered queries over the smallest tables, against plain versions of their contracts."""

import base64
import collections
import hashlib
import math
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from tests_llm_brute import UPPER, brute_components
from tokenizers import Tokenizer

from lodestat.llm import context_mixing, count_transducer, jaccard_join, prefix_bpe, secret_scan, sentence_spans

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def by_id(df):
    rows = df.collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op2_base_spans(spark, docs):
    kinds = {
        "assign": (re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 12),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
    }
    found = by_id(secret_scan.op2_ownership_secrets(spark, FOLDER))
    assert found.keys() == docs.keys()
    for doc, text in docs.items():
        spans = []
        for order, (kind, (pattern, group, least)) in enumerate(kinds.items()):
            spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text) if len(m[group]) >= least]
        listed = [s for *_, s in sorted(spans)]
        row = found[doc]
        assert row.base_sha256 == sha(",".join(listed))
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s.startswith(k + ":") for s in listed) for k in kinds)
        assert set(listed) <= set(row.spans.split(",")) | {""}


def test_op3_counts(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(count_transducer.FILE))
    found = by_id(count_transducer.op3_count_transducer(spark, FOLDER))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) for d, t in docs.items()}
    assert {d: (r.n_bytes, r.n_tokens, r.over_limit) for d, r in found.items()} == {
        d: (len(docs[d].encode()), n, n > 1024) for d, n in want.items()
    }


def test_op4_digests(spark, docs):
    lines = open(public_tokenizers.path(prefix_bpe.FILE), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(prefix_bpe.op4_prefix_bpe(spark, FOLDER))
    assert found.keys() == docs.keys()
    for doc, text in docs.items():
        ids = library.encode_ordinary(text)
        assert tuple(found[doc])[1:] == (len(ids), sha(",".join(map(str, ids))), sha(text))


def test_op5_spans_are_repeats(spark, docs):
    """Each removed span stands, word for word, in an earlier document or earlier in its own."""
    found = by_id(sentence_spans.op5_sentence_spans(spark, FOLDER))
    assert found.keys() == docs.keys() and any(r.has_repeats for r in found.values())
    plain = {d: " ".join(t.lower().split()) for d, t in docs.items()}
    for doc, row in found.items():
        spans = [tuple(map(int, s.split(":"))) for s in row.removed.split(",") if s]
        assert spans == sorted(spans) and row.has_repeats == bool(spans) == (row.n_removed > 0)
        assert row.n_chars_removed == sum(end - start for start, end in spans)
        for start, end in spans:
            first = " ".join(docs[doc][start:end].lower().split()[:16])
            own = plain[doc].find(first)
            assert any(first in plain[other] for other in docs if other < doc) or plain[doc].find(first, own + 1) > own


def test_op6_components(spark, docs):
    found = by_id(jaccard_join.op6_size_aware_jaccard(spark, FOLDER))
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == brute_components(docs.items())


def test_op1_base_scores(spark, docs):
    found = by_id(context_mixing.op1_context_mixing(spark, FOLDER))
    tokens = {d: [*WORD.findall(t.translate(UPPER)), None] for d, t in docs.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    counts = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total = sum(counts.values())
    assert found.keys() == docs.keys()
    for doc, words in tokens.items():
        row = found[doc]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[doc], len(words), sum(counts[w] > 0 for w in words), total)
        assert row.base_score == pytest.approx(base) and row.score < 0

"""Byte-level BPE by dynamic programming over prefixes.

Each prefix of a piece has one valid encoding, hence one last token. ``Prefixes`` stores that token per prefix: the next one
is the only token that ends there and may follow the last token of what stands before it. Appending bytes leaves
earlier entries as they are, so it is exact and costs the new bytes alone; after an edit, the entries before the edit stay.
Reading the last tokens backwards gives the encoding.

Missing texts count as empty; an empty text has no tokens, and the digests of no bytes. Any UTF-8 text is encoded
whole, in time proportional to its length.
"""

from __future__ import annotations

import functools
import hashlib
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.bpe import Vocabulary
from lodestat.llm.pieces import BOUNDARY, Remembered, pieces, portions
from lodestat.llm.rows import table, unused

FILE = "byte_bpe_multi_50k.tiktoken"
AT_ONCE = 1 << 19  # characters of texts encoded together


class Prefixes:
    """The last token of every prefix of a growing byte string, as one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        endings, together, lengths = self.vocabulary.endings, self.vocabulary.together, self.vocabulary.bytes_of
        last, known = self.last, len(self.last)
        data = self.data = self.data + more
        for end in range(known + 1, len(data) + 1):
            found, start = [], end - 1
            while start >= 0 and (token := endings.get(data[start:end])) is not None:
                if token >= 0:
                    found.append(token)
                start -= 1
            for token in reversed(found):
                before = end - len(lengths[token])
                if before == 0 or together(last[before - 1], token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace bytes ``start`` to ``end``; only entries after ``start`` are worked out anew."""
        rest = self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new + rest)

    def ids(self) -> list[int]:
        whole = self.vocabulary.ids.get(self.data)
        if whole is not None:
            return [whole]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to ids and back, with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._ids = Remembered(self._encode_pieces)
        self._strings = Remembered(self._write_pieces)

    def _encode_pieces(self, sorted_pieces):
        """Ids of each piece. Neighbours share a prefix, whose entries are worked out once."""
        shared, before = Prefixes(self.vocabulary), ""
        for piece in sorted_pieces:
            common = len(os.path.commonprefix((before, piece)).encode())
            shared.edit(common, len(shared.data), piece.encode()[common:])
            before = piece
            yield shared.ids()

    def _write_pieces(self, sorted_pieces):
        for ids in self._encode_pieces(sorted_pieces):
            yield len(ids), ",".join(map(str, ids)).encode(), self.decode(ids)

    @staticmethod
    def _looked_up(texts, known: Remembered):
        """The results for the pieces of each text."""
        for portion in portions(texts, AT_ONCE):
            split = [pieces(text) for text in portion]
            known.cover(set().union(*split))
            for found in split:
                yield [known[piece] for piece in found]

    def encode_all(self, texts):
        for parts in self._looked_up(texts, self._ids):
            yield [i for part in parts for i in part]

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def digests(self, texts):
        """Number of tokens, digest of the ids, digest of the bytes that they decode to, of each text."""
        for parts in self._looked_up(texts, self._strings):
            ids = hashlib.sha256(b",".join([part[1] for part in parts])).hexdigest()
            yield sum([part[0] for part in parts]), ids, hashlib.sha256(b"".join([part[2] for part in parts])).hexdigest()

    def edit(self, text: str, ids: list[int], start: int, end: int, new: str) -> list[int]:
        """Ids of ``text`` with characters ``start`` to ``end`` replaced; those of pieces off the edit stay."""
        left = max((m.start() for m in BOUNDARY.finditer(text, 0, start)), default=0)
        right = next((m.start() for m in BOUNDARY.finditer(text, end) if m.start() > end), len(text))
        head, tail = len(text[:left].encode()), len(text[right:].encode())
        lengths, first, after = self.vocabulary.bytes_of, 0, len(ids)
        while head > 0:
            head -= len(lengths[ids[first]])
            first += 1
        while tail > 0:
            after -= 1
            tail -= len(lengths[ids[after]])
        return ids[:first] + self.encode(text[left:start] + new + text[end:right]) + ids[after:]


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(Vocabulary.from_ranks(path))


def _each_text(path: str | None, results):
    """Batches with the columns that ``results(encoder, texts)`` gives in place of the last column, the texts.

    Each portion of texts makes a batch of its own, so what a task holds doesn't follow the batches that it gets.
    """

    def run(batches):
        codec = encoder(path or public_tokenizers.path(FILE))
        for batch in batches:
            *kept, texts = batch.columns
            start = 0
            for portion in portions((text.as_py() for text in texts), AT_ONCE):
                made = results(codec, portion)
                some = [column.slice(start, len(portion)) for column in kept]
                yield pa.RecordBatch.from_arrays([*some, *made.values()], names=[*batch.schema.names[:-1], *made])
                start += len(portion)

    return run


def _digest_columns(codec: Encoder, texts):
    found = list(codec.digests(texts))
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    kinds = (pa.int64(), pa.string(), pa.string())
    return {n: pa.array([f[i] for f in found], k) for i, (n, k) in enumerate(zip(names, kinds))}


def _id_columns(codec: Encoder, texts):
    ids, decoded = [], []
    for found in codec.encode_all(texts):
        ids.append(pa.array(found, pa.int32()))
        decoded.append(codec.decode(found))
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return {
        "token_ids": pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([*ids, pa.array([], pa.int32())])),
        "decoded": pa.array(decoded, pa.binary()),
    }


def _with_columns(docs: DataFrame, results, extra: str, text_col: str, path: str | None) -> DataFrame:
    text = unused("text_", docs)
    rows = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    if text_col not in docs.columns:
        raise ValueError(f"no column {text_col}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(_each_text(path, results), f"{schema}, {extra}" if schema else extra)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` and ``decoded``, the bytes that these give."""
    docs = docs.drop("token_ids", "decoded")
    return _with_columns(docs, _id_columns, "token_ids array<int>, decoded binary", text_col, path)


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _with_columns(rows, _digest_columns, extra, "text", path).drop("text")


def op4_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    return encode_digests(table(spark, sf_dir, "documents"))

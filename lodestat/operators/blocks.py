"""Work on batches of rows in parts of bounded entries, and rows packed into such parts for loops that read them many times.

A batch that Spark hands to a task has a fixed number of rows, however long they are. Arrays that a task makes for it follow
its entries, so it is cut into runs of rows first. A loop packs its rows once: a block holds the arrays of a run, is kept by
the executors, and reaches a task as it is, one at a time. Blocks are read anew by every pass, so their entries are packed
without loss: integers in the least type that holds them, numbers as places among the block's distinct ones.
"""

from __future__ import annotations

import operator
import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.core.rdd import RDD
from pyspark.sql import DataFrame

from lodestat.operators.slices import SLICE

ENTRIES = 1 << 17
# Entries of a packed block; its arrays stay in a core's cache.
BLOCK = 1 << 15
# Vectors of all tasks go to the driver as they are up to so many bytes.
GATHERED = 32 * 1024 * 1024


def cut(batches: Iterable, column: str, most: int | None = None) -> Iterator:
    """The batches in runs of rows with about ``most`` entries of a list column, one row at least."""
    most = most or ENTRIES
    for whole in batches:
        ends = whole.column(column).offsets.to_numpy()
        start = 0
        while start < whole.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
            end = min(end, whole.num_rows)
            yield whole.slice(start, end - start)
            start = end


def arrays(batch, key: str, *lists: str) -> tuple:
    """The values of ``key``, the entries of each row, and all entries of each list."""
    found = [batch.column(name) for name in lists]
    keys = batch.column(key)
    keys = keys.to_numpy() if keys.type == "double" else keys.to_pylist()
    return keys, np.diff(found[0].offsets.to_numpy()), *[f.flatten().to_numpy() for f in found]


class Coded(NamedTuple):
    """Numbers as places in a table of the distinct ones."""

    codes: np.ndarray
    table: np.ndarray


def small(entries: np.ndarray) -> np.ndarray | Coded:
    """The same entries in fewer bytes, as :meth:`Room.filled` reads them."""
    if not len(entries):
        return entries
    if entries.dtype.kind in "iu":
        low, high = int(entries.min()), int(entries.max())
        kind = np.min_scalar_type(high) if low >= 0 else entries.dtype
        return entries.astype(kind)
    # by their bits, so that a zero keeps its sign
    table, codes = np.unique(entries.view(f"u{entries.dtype.itemsize}"), return_inverse=True)
    made = Coded(codes.astype(np.min_scalar_type(len(table))), table.view(entries.dtype))
    return made if made.codes.nbytes + made.table.nbytes < entries.nbytes else entries


class Room:
    """Arrays that are filled anew with each block, so that a task doesn't make them for every one."""

    def __init__(self) -> None:
        self._held: dict[tuple, np.ndarray] = {}

    def of(self, name: str, n: int, kind: type = np.float64, *width: int) -> np.ndarray:
        """``n`` rows of whatever was there."""
        key = (name, np.dtype(kind), width)
        held = self._held.get(key)
        if held is None or len(held) < n:
            held = self._held[key] = np.empty((n, *width), kind)
        return held[:n]

    def filled(self, name: str, entries: np.ndarray | Coded, kind: type = np.float64) -> np.ndarray:
        """The entries, packed or not."""
        if isinstance(entries, Coded):
            places = self.filled(f"{name}-codes", entries.codes, np.intp)
            return entries.table.astype(kind, copy=False).take(places, out=self.of(name, len(places), kind), mode="clip")
        found = self.of(name, len(entries), kind)
        found[:] = entries
        return found

    def places(self, name: str, entries: np.ndarray, size: int) -> np.ndarray:
        """Positions in an array of ``size``."""
        found = self.filled(name, entries, np.intp)
        if len(found) and not (0 <= found.min() and found.max() < size):
            raise IndexError(f"a position outside of 0 to {size - 1}")
        return found


def row_sums(entries: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each row's entries, which lie one after the other."""
    out, ends = np.zeros(len(sizes)), np.cumsum(sizes, dtype=np.int64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(entries, ends[some] - sizes[some])
    return out


def entries_of(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the entries of some rows lie among those of all."""
    n, ends = sizes[rows].astype(np.int64), np.cumsum(sizes, dtype=np.int64)
    return np.repeat(ends[rows] - np.cumsum(n), n) + np.arange(n.sum())


class Sums:
    """Sums by position in an array of ``size``. Entries wait until there are enough for a pass over the whole array."""

    def __init__(self, size: int) -> None:
        self.total = np.zeros(size)
        self.most, self.n, self.room = min(size, 1 << 20), 0, Room()

    def add(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Arrays to be filled with ``n`` positions and what is added there."""
        if self.n and self.n + n > self.most:
            self.finish()
        here = max(self.most, n)
        found = [self.room.of("at", here, np.intp), self.room.of("added", here)]
        self.n += n
        return tuple(part[self.n - n : self.n] for part in found)

    def finish(self) -> np.ndarray:
        places, added = self.room.of("at", self.n, np.intp), self.room.of("added", self.n)
        self.total += np.bincount(places, weights=added, minlength=len(self.total))
        self.n = 0
        return self.total


def packed(rows: DataFrame, key: str, *lists: str) -> RDD:
    """The :func:`arrays` of all rows, a tuple for each block, with their entries packed (:func:`small`)."""

    def run(batches):
        import pyarrow as pa

        for batch in cut(batches, lists[0], BLOCK):
            keys, sizes, *entries = arrays(batch, key, *lists)
            block = pickle.dumps((keys, small(sizes), *map(small, entries)), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

    return rows.select(key, *lists).mapInArrow(run, "block binary").rdd.map(lambda row: pickle.loads(row["block"]))


def chosen(blocks: Iterable, choose: Callable) -> Iterator:
    """Blocks of the rows that ``choose`` marks in a block, which it gets with unpacked entries."""
    room, waiting, n = Room(), [], 0

    def joined():
        keys, sizes, *lists = (np.concatenate(parts) for parts in zip(*waiting))
        waiting.clear()
        return keys, small(sizes), *map(small, lists)

    for keys, sizes, *lists in blocks:
        lists = [room.filled(f"{k}", part, np.float64 if k else np.int64) for k, part in enumerate(lists)]
        rows = np.flatnonzero(choose(keys, sizes, *lists))
        at = entries_of(rows, sizes)
        waiting.append((np.asarray(keys)[rows], sizes[rows], *(part[at] for part in lists)))
        n += len(at)
        if n >= BLOCK:
            yield joined()
            n = 0
    if waiting:
        yield joined()


def per_core(blocks: RDD) -> RDD:
    """Blocks in at most one partition a core, without a shuffle, so that sums of tasks follow cores."""
    return blocks.coalesce(blocks.context.defaultParallelism)


def total(vectors: RDD, size: int) -> np.ndarray:
    """The sum of all vectors, one a partition, on the driver.

    Few go there as they are, and are added in the order of partitions. Of more than ``GATHERED`` allows, slices are added
    where they arrive, those of zeros stay behind.
    """

    def slices(found):
        for vector in found:
            for k in range(-(-size // SLICE)):
                part = vector[k * SLICE : (k + 1) * SLICE]
                if part.any():
                    yield k, part

    out, n = np.zeros(size), vectors.getNumPartitions()
    if n * out.nbytes <= GATHERED:
        for vector in vectors.collect():
            out += vector
        return out
    for number, part in vectors.mapPartitions(slices).reduceByKey(operator.add, max(1, min(n, -(-size // SLICE)))).collect():
        out[number * SLICE : number * SLICE + len(part)] = part
    return out

"""Blocks of neighbouring rows, and names that are counted over all of them.

A block is one row of a stored table, with an array for each column, bucketed by block: the
texts are moved once and then joined to what is found about them without a shuffle.  A block
counts its names by itself first, so a name that stands in a third of all documents is one
row for each block; the frequent names of a block go back to it as one array.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import map_batches

COUNTED = "block long, a long, b long, times long"


def together(texts: list, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of the texts of bounded size; a longer text is a range of its own."""
    low, total = 0, 0
    for at, text in enumerate(texts):
        more = len(text or "")
        if at > low and total + more > most:
            yield low, at
            low, total = at, 0
        total += more
    if low < len(texts):
        yield low, len(texts)


def in_blocks(frame: DataFrame, stage: StageArea, name: str, rows: int, size: int) -> DataFrame:
    """``block`` and the columns as arrays, of so many rows and characters of ``text`` at most."""
    columns = frame.columns
    place = columns.index("text")

    def make():
        def run(batches):
            task = TaskContext.get().partitionId() << 32
            number, block, total = 0, [], 0
            for batch in batches:
                for row in zip(*(one.to_pylist() for one in batch.columns), strict=True):
                    more = len(row[place] or "")
                    if block and (len(block) >= rows or total + more > size):
                        yield task + number, *map(list, zip(*block, strict=True))
                        number, block, total = number + 1, [], 0
                    block.append(row)
                    total += more
            if block:
                yield task + number, *map(list, zip(*block, strict=True))

        return run

    ddl = ", ".join(["block long", *(f"{name} array<{kind}>" for name, kind in frame.dtypes)])
    return stage.bucketed(map_batches(frame, ddl, make), name, "block", compression="zstd")


def map_blocks(blocks: DataFrame, ddl: str, each, packed: bool = False) -> DataFrame:
    """``each``'s results for every block, a dictionary of Arrow scalars."""

    def make():
        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    yield from each({name: batch.column(name)[at] for name in batch.schema.names})

        return run

    return map_batches(blocks, ddl, make, packed=packed)


def numbers(row: dict, name: str) -> np.ndarray:
    """An array of numbers; nothing where there is none."""
    found = row[name].values
    return np.empty(0, np.int64) if found is None else found.to_numpy()


def column(row: dict, name: str, field: str) -> np.ndarray:
    """A field of an array of structs, as numbers; nothing where there is no array."""
    found = row[name].values
    if found is None:
        return np.empty(0, np.int64)
    return found.field(field).to_numpy(zero_copy_only=False)


def counts(block: int, a: np.ndarray, b: np.ndarray, times: np.ndarray, most: int) -> pa.RecordBatch:
    """Names of a block, each once, with their counts up to ``most``, which is all that is asked."""
    order = np.lexsort((b, a))
    a, b, times = a[order], b[order], times[order]
    opens = np.ones(len(a), bool)
    opens[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(opens)
    summed = np.add.reduceat(times, first) if len(first) else times
    columns = [np.full(len(first), block), a[first], b[first], np.minimum(summed, most)]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in columns], names=["block", "a", "b", "times"]
    )


def places_among(a: np.ndarray, b: np.ndarray, known_a: np.ndarray, known_b: np.ndarray) -> np.ndarray:
    """Where each pair stands among the known ones; -1 for those that do not."""
    found = np.full(len(a), -1)
    if not len(known_a):
        return found
    order = np.lexsort((known_b, known_a))
    known_a, known_b = known_a[order], known_b[order]
    low, high = np.searchsorted(known_a, a, "left"), np.searchsorted(known_a, a, "right")
    # More than one step only where first fingerprints collide.
    for step in range(int((high - low).max(initial=0))):
        some = np.flatnonzero(low + step < high)
        some = some[known_b[low[some] + step] == b[some]]
        found[some] = order[low[some] + step]
    return found


def frequent(counted: DataFrame, name: str, least: int, totals_too: bool = False) -> DataFrame:
    """``block`` and, as an array, ``a, b, first`` of its names that stand so often.

    ``counted`` has ``block, a, b, times``, a row for each block and name.  The first
    block with a name is marked; ``total`` is added if asked for.
    """
    over = Window.partitionBy("a", "b")
    totals = counted.withColumns(
        {"total": F.sum("times").over(over), "least": F.min("block").over(over)}
    )
    first = (F.col("block") == F.col("least")).alias("first")
    one = F.struct("a", "b", first, *(["total"] if totals_too else []))
    found = totals.where(F.col("total") >= least).select("block", one.alias("one"))
    return found.groupBy("block").agg(F.collect_list("one").alias(name))


# --- names that only have to be frequent --------------------------------------------------

NAME_BITS = 40
_NAME_BYTES = NAME_BITS // 8


class Names:
    """A block's distinct names of 40 bits in rising order, cut into parts of their range.

    A part of a block travels as one row: the steps between its names, byte by byte, so that
    the upper bytes (mostly zero) compress.  What comes back is one bit for each of them.
    """

    def __init__(self, names: np.ndarray, parts: int):
        self.names, self.times = np.unique(names, return_counts=True)
        part = (self.names >> np.uint64(NAME_BITS - 24)) * np.uint64(parts) >> np.uint64(24)
        self.parts, starts = np.unique(part, return_index=True)
        self.bounds = [*starts.tolist(), len(self.names)]

    def sent(self, block: int, most: int) -> Iterator[tuple]:
        """``block, part, names, times`` with counts up to ``most``, which is all that is asked."""
        for at, part in enumerate(self.parts.tolist()):
            some = slice(self.bounds[at], self.bounds[at + 1])
            steps = np.diff(self.names[some], prepend=np.uint64(0)).astype("<u8")
            planes = steps.view(np.uint8).reshape(-1, 8)[:, :_NAME_BYTES].T
            times = np.minimum(self.times[some], most).astype("<u4")
            yield block, part, planes.tobytes(), times.tobytes()

    def chosen(self, row: dict, name: str) -> np.ndarray:
        """The names whose bits are set in what came back."""
        found = {one["part"]: one["bits"] for one in row[name].as_py() or []}
        kept = [np.empty(0, np.uint64)]
        for at, part in enumerate(self.parts.tolist()):
            some = self.names[self.bounds[at] : self.bounds[at + 1]]
            bits = np.unpackbits(np.frombuffer(found[part], np.uint8), count=len(some))
            kept.append(some[bits.view(bool)])
        return np.concatenate(kept)


def among(known: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of the names are known; those are in rising order."""
    if not len(known):
        return np.zeros(names.shape, bool)
    return known[np.minimum(np.searchsorted(known, names), len(known) - 1)] == names


SENT = "block long, part long, names binary, times binary"


def _received(names: bytes) -> np.ndarray:
    planes = np.frombuffer(names, np.uint8).reshape(_NAME_BYTES, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :_NAME_BYTES] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def enough(sent: DataFrame, name: str, least: int) -> DataFrame:
    """``block`` and, as an array, the bits of its names that stand so often in all blocks.

    ``sent`` has a row for each block and part.  A part holds all names of its range, so
    the number of parts, not that of blocks, bounds what a task sorts at a time.
    """
    dealt = sent.repartition("part").sortWithinPartitions("part")

    def make():
        def run(batches):
            rows = (
                row
                for batch in batches
                for row in zip(*(one.to_pylist() for one in batch.columns), strict=True)
            )
            for part, group in groupby(rows, key=itemgetter(1)):
                blocks, _, names, times = zip(*group, strict=True)
                names = [_received(one) for one in names]
                ends = np.cumsum([len(one) for one in names])
                together_ = np.concatenate(names)
                order = np.argsort(together_)
                opens = np.flatnonzero(np.diff(together_[order], prepend=np.uint64(1 << NAME_BITS)))
                counts_ = np.frombuffer(b"".join(times), "<u4").astype(np.int64)[order]
                often = np.add.reduceat(counts_, opens) >= least
                bits = np.empty(len(order), bool)
                bits[order] = np.repeat(often, np.diff(np.append(opens, len(order))))
                for block, low, high in zip(blocks, [0, *ends[:-1]], ends, strict=True):
                    yield block, part, np.packbits(bits[low:high]).tobytes()

        return run

    found = map_batches(dealt, "block long, part long, bits binary", make)
    return found.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias(name))

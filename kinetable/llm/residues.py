"""Hard negatives by exact inner products in a residue number system.

Components are made integers, ``floor(256 x)``.  Products of the integer matrices are taken
modulo several primes below 1024, in float32: with residues of at most 511 and 64 dimensions
at a time no sum passes 2^24, so every one is exact.  Mixed-radix digits (Chinese
remaindering) give the signed 64-bit scores back.  As many primes are used as the largest
norm of the table asks for.

Anchors are a stated query set against all rows.  Both are dealt into groups of bounded size,
and each group of anchors meets each group of rows in a cell: the anchors of a cell come
first and are held, the rows pass in blocks.  A cell keeps a few rows for each anchor, and
a window over the cells' rows selects.  The first pass finds each anchor's positives, the
second the negatives within the bounds that a positive's score sets.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no
part, nor do rows whose sum of squares reaches 2^62, as their scores might not fit a long.
A vector shorter than another counts as having zeros behind.  Rows that share an id are rows
of their own: each may be an anchor, a positive or a negative, and equal ones are tied.  Extra
columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import map_batches


@dataclass(frozen=True)
class Settings:
    anchors_every: int = 50
    # Rows with such ids get the next label.
    relabelled_every: int = 7
    labels: int = 10
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    # A negative's score lies within these percentages of the positive's.
    least_percent: int = 50
    most_percent: int = 95
    # Anchors and rows of a cell, and rows multiplied at once.
    anchor_group: int = 16_384
    row_group: int = 16_384
    block: int = 2_048


# --- residue arithmetic ------------------------------------------------------------------

_LARGEST = 1 << 62
_CHUNK = 64


def primes_for(bound: int) -> list[int]:
    """Primes below 1024, from the largest, whose product passes four times the bound."""
    found, product, number = [], 1, 1023
    while product <= 4 * bound:
        if all(number % divisor for divisor in range(2, 32)):
            found.append(number)
            product *= number
        number -= 1
    return found


def _residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues nearest to zero, in float32."""
    half = prime // 2
    return ((values + half) % prime - half).astype(np.float32)


class Operand:
    """A matrix of integers as one float32 matrix for each prime."""

    def __init__(self, values: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_residues(values, prime) for prime in primes]

    def widened(self, columns: int) -> Operand:
        """With columns of zeros up to that number."""
        more = columns - self.parts[0].shape[1]
        if more > 0:
            self.parts = [np.pad(part, ((0, 0), (0, more))) for part in self.parts]
        return self


def exact_products(left: Operand, right: Operand) -> np.ndarray:
    """All inner products of the rows of both, as signed 64-bit integers."""
    primes = left.primes
    columns = max(left.parts[0].shape[1], right.parts[0].shape[1])
    left, right = left.widened(columns), right.widened(columns)
    found = []
    for prime, one, two in zip(primes, left.parts, right.parts, strict=True):
        total = np.zeros((len(one), len(two)), np.float32)
        for at in range(0, columns, _CHUNK):
            part = one[:, at : at + _CHUNK] @ two[:, at : at + _CHUNK].T
            total += part - np.float32(prime) * np.rint(part / np.float32(prime))
        found.append(total.astype(np.int64) % prime)
    return _from_residues(found, primes)


def _from_residues(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed numbers from their residues, by mixed-radix digits."""
    digits = []
    for place, (residue, prime) in enumerate(zip(residues, primes, strict=True)):
        digit = residue
        for known, earlier in zip(digits, primes[:place], strict=True):
            digit = (digit - known) * pow(earlier, -1, prime) % prime
        digits.append(digit)
    total = np.zeros(residues[0].shape, np.uint64)
    weight = 1
    for digit, prime in zip(digits, primes, strict=True):
        total += digit.astype(np.uint64) * np.uint64(weight % (1 << 64))
        weight *= prime
    # Numbers stay below a quarter of the product, so the last digit tells the sign.
    negative = 2 * digits[-1] >= primes[-1]
    total[negative] -= np.uint64(weight % (1 << 64))
    return total.view(np.int64)


# --- cells ----------------------------------------------------------------------------------


def _vectors(embeddings: DataFrame, settings: Settings, stage: StageArea) -> DataFrame:
    """``row, vec_id, label, vector, norm`` of the rows that take part."""
    sound = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    scaled = F.transform(
        "embedding", lambda x: F.floor(F.lit(float(settings.scale)) * x.cast("double"))
    )
    sizes = F.aggregate(
        "embedding",
        F.lit(0.0),
        lambda total, x: total + F.pow(F.lit(float(settings.scale)) * x.cast("double"), 2.0),
    )
    moved = (F.col("label") + 1) % settings.labels
    known = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    known = known.where("vec_id is not null and label is not null and embedding is not null")
    # Rounding down moves a component by less than one.
    room = F.sqrt(sizes) + F.sqrt(F.size("embedding").cast("double"))
    known = known.where(sound).where(room < float(1 << 31) * 0.999)
    rows = known.select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        F.when(F.col("vec_id") % settings.relabelled_every == 0, moved)
        .otherwise(F.col("label"))
        .alias("label"),
        scaled.cast("array<long>").alias("vector"),
        room.alias("norm"),
    )
    return stage.table(rows, "vectors")


def _dealt(name: str, count: int, size: int) -> tuple[Column, int]:
    groups = max(1, -(-count // size))
    return F.pmod(F.xxhash64(name), F.lit(groups)).cast("int"), groups


def _cells(anchors: DataFrame, rows: DataFrame, settings: Settings, ddl: str, make) -> DataFrame:
    """``make()``'s function over the rows of each cell, after ``held`` has its anchors.

    ``anchors`` has the columns of ``rows`` and ``asked``, an array.
    """
    anchor_group, anchor_groups = _dealt("row", anchors.count(), settings.anchor_group)
    row_group, row_groups = _dealt("row", rows.count(), settings.row_group)

    def every(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    names = ("row", "vec_id", "label", "vector", "asked")
    kind = anchors.schema["asked"].dataType
    held = anchors.select(
        anchor_group.alias("cell_a"), every(row_groups).alias("cell_b"), F.lit(0).alias("kind"), *names
    )
    passing = rows.withColumn("asked", F.lit(None).cast(kind)).select(
        every(anchor_groups).alias("cell_a"), row_group.alias("cell_b"), F.lit(1).alias("kind"), *names
    )
    dealt = held.union(passing).repartition("cell_a", "cell_b")
    # In the order of ties, so that places decide them within a cell.
    dealt = dealt.sortWithinPartitions("cell_a", "cell_b", "kind", "vec_id", "row")

    def made():
        cell_of = make()

        def run(batches) -> Iterator[tuple]:
            current, cell, anchors_so_far = None, None, []
            for batch in batches:
                keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
                edges = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
                cuts = sorted({0, len(keys[0]), *edges.tolist()})
                cuts = [
                    at
                    for low, high in zip(cuts, cuts[1:], strict=False)
                    for at in range(low, high, settings.block)
                ] + [len(keys[0])]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    key, is_row = tuple(keys[:2, low]), keys[2, low]
                    part = batch.slice(low, high - low)
                    if key != current:
                        if cell:
                            yield from cell.results()
                        current, cell, anchors_so_far = key, None, []
                    if not is_row:
                        anchors_so_far.append(part)
                    elif anchors_so_far or cell:
                        if cell is None:
                            cell = cell_of(anchors_so_far)
                            anchors_so_far = []
                        cell.meet(part)
            if cell:
                yield from cell.results()

        return run

    return map_batches(dealt, ddl, made)


def _matrix(lists: list) -> np.ndarray:
    """Lists of integers as one matrix, with zeros behind the shorter ones."""
    sizes = np.concatenate([np.diff(column.offsets.to_numpy()) for column in lists])
    flat = np.concatenate([column.flatten().to_numpy() for column in lists])
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.arange(width) < sizes[:, None]] = flat
    return found


class _Cell:
    """The anchors of a cell, and the scores of a block of rows with them."""

    def __init__(self, batches: list, primes: list[int]):
        self.primes = primes
        self.rows, self.ids, self.labels = (
            np.concatenate([batch.column(i).to_numpy() for batch in batches]) for i in (3, 4, 5)
        )
        self.asked = [one for batch in batches for one in batch.column(7).to_pylist()]
        self.operand = Operand(_matrix([batch.column(6) for batch in batches]), primes)

    def scores(self, batch):
        rows, ids, labels = (batch.column(i).to_numpy() for i in (3, 4, 5))
        products = exact_products(self.operand, Operand(_matrix([batch.column(6)]), self.primes))
        return rows, ids, labels, products


def _best(scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the greatest scores, the first of equal ones first."""
    places = np.arange(len(scores))
    if len(scores) > count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        places = np.flatnonzero(scores >= least)
    return places[np.lexsort((places, -scores[places]))][:count]


class _Positives(_Cell):
    """For each anchor, the best other rows of its label."""

    def __init__(self, batches, primes, settings):
        super().__init__(batches, primes)
        self.count = settings.positives
        self.found: list[list[tuple]] = [[] for _ in self.rows]

    def meet(self, batch) -> None:
        rows, ids, labels, products = self.scores(batch)
        for label in np.unique(labels):
            columns = np.flatnonzero(labels == label)
            for anchor in np.flatnonzero(self.labels == label).tolist():
                others = columns[rows[columns] != self.rows[anchor]]
                scores = products[anchor, others]
                best = _best(scores, self.count)
                more = zip(
                    (-scores[best]).tolist(), ids[others[best]].tolist(), rows[others[best]].tolist(),
                    strict=True,
                )
                # Sorted by score downwards, then by id and row.
                self.found[anchor] = sorted([*self.found[anchor], *more])[: self.count]

    def results(self) -> Iterator[tuple]:
        for row, vec_id, found in zip(self.rows.tolist(), self.ids.tolist(), self.found, strict=True):
            for score, other, other_row in found:
                yield row, vec_id, -score, other, other_row


class _Negatives(_Cell):
    """For each anchor and positive, the best rows of other labels within the bounds."""

    def __init__(self, batches, primes, settings):
        super().__init__(batches, primes)
        self.settings = settings
        # Equal scores ask the same.
        self.bounds = [sorted({one["score"] for one in asked}) for asked in self.asked]
        self.found: list[dict[int, list]] = [{score: [] for score in scores} for scores in self.bounds]

    def _limits(self, score: int) -> tuple[int, int]:
        low = -(-self.settings.least_percent * score // 100)
        return low, self.settings.most_percent * score // 100

    def meet(self, batch) -> None:
        rows, ids, labels, products = self.scores(batch)
        count = self.settings.negatives
        for label in np.unique(self.labels):
            columns = np.flatnonzero(labels != label)
            if not len(columns):
                continue
            for anchor in np.flatnonzero(self.labels == label).tolist():
                scores = products[anchor, columns]
                for score in self.bounds[anchor]:
                    low, high = self._limits(score)
                    places = np.flatnonzero((scores >= low) & (scores <= high))
                    if not len(places):
                        continue
                    best = places[_best(scores[places], count)]
                    more = zip(
                        (-scores[best]).tolist(), ids[columns[best]].tolist(),
                        rows[columns[best]].tolist(), strict=True,
                    )
                    kept = self.found[anchor]
                    kept[score] = sorted([*kept[score], *more])[:count]

    def results(self) -> Iterator[tuple]:
        for row, vec_id, asked, found in zip(
            self.rows.tolist(), self.ids.tolist(), self.asked, self.found, strict=True
        ):
            for one in asked:
                for score, other, other_row in found[one["score"]]:
                    yield row, vec_id, one["rank"], one["vec_id"], one["score"], -score, other, other_row


def _first(frame: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The best rows of each key, ranked from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other", "other_row")
    ranked = frame.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= count)


def hard_negatives(
    embeddings: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    settings = settings or Settings()
    stage = stage or StageArea(embeddings.sparkSession)
    vectors = _vectors(embeddings, settings, stage)
    largest = vectors.agg(F.max("norm")).first()[0] or 0.0
    # A score is at most the product of two norms; one more covers their rounding.
    primes = primes_for(min(_LARGEST, int(largest * largest * 1.001) + 1))
    rows = vectors.select("row", "vec_id", "label", "vector")
    anchors = rows.where(F.col("vec_id") % settings.anchors_every == 0)
    asked = "array<struct<rank:int,vec_id:long,score:long>>"

    found = _cells(
        anchors.withColumn("asked", F.lit(None).cast(asked)),
        rows,
        settings,
        "row long, anchor_id long, score long, other long, other_row long",
        lambda: lambda batches: _Positives(batches, primes, settings),
    )
    positives = _first(found, ["row"], settings.positives)
    one = F.struct("rank", F.col("other").alias("vec_id"), "score")
    positives = stage.table(
        positives.groupBy("row").agg(F.collect_list(one).cast(asked).alias("asked")), "positives"
    )
    found = _cells(
        anchors.join(positives, "row"),
        rows,
        settings,
        "row long, anchor_id long, place int, positive_id long, positive_score long, "
        "score long, other long, other_row long",
        lambda: lambda batches: _Negatives(batches, primes, settings),
    )
    return _first(found, ["row", "place"], settings.negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

"""Quality by nearest labelled neighbours in a latent-semantic space.

A text is a bag of terms: its words and their shapes, hashed, and a few statements about
its layout (how often words or lines repeat, how many characters are symbols or capitals).
Bags are made once and stored; counting and scoring read them instead of the texts.
Term weights use document frequencies over all documents.  A truncated singular value
decomposition of the labelled sample gives the latent space.  The sample's vectors are
broadcast (at most ``Settings.sample`` rows of ``Settings.rank`` numbers), every document
gets its exact cosines with all of them in blocks, and the labels of the nearest vote with
a power of the similarity.

Null texts count as empty; texts without a similar labelled row get the sample's share of
good rows.  Rows are scored one by one, so ties, repeated rows, extra columns and empty
tables change nothing.  Without labelled rows every score is one half.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import held_out, labelled_sample, map_batches, map_each


@dataclass(frozen=True)
class Settings:
    sample: int = 3000
    rank: int = 64
    word_terms: int = 1024
    shape_terms: int = 512
    neighbours: int = 15
    power: float = 8.0
    block: int = 512
    remembered: int = 300_000

    @property
    def layout_start(self) -> int:
        return self.word_terms + self.shape_terms

    @property
    def terms(self) -> int:
        return self.layout_start + len(LAYOUT) * len(STEPS)


# Statements about the layout, each in the steps of a share.
LAYOUT = ("repeated next word", "distinct words", "repeated lines", "symbols", "capitals", "bars")
STEPS = (0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
# A statement weighs as much as so many words.
LAYOUT_COUNT = 20

_SHAPE = (
    (re.compile(r"[0-9]+"), "9"),
    (re.compile(r"[^\W\d_]+"), "a"),
)


def _shape(word: str) -> str:
    """Letters and digits as one character each; capitals tell words apart."""
    kind = "U" if word.isupper() else "C" if word[:1].isupper() else "l"
    for pattern, short in _SHAPE:
        word = pattern.sub(short, word)
    return kind + word[:12]


class _Known(dict):
    """A word's term and its shape's, as one number, made when first asked for."""

    def __init__(self, settings: Settings):
        super().__init__()
        self.settings = settings

    def __missing__(self, word: str) -> int:
        plain = word.lower().strip(".,;:!?#*$%&|<>").encode("utf-8", "replace")
        shape = _shape(word).encode("utf-8", "replace")
        term = zlib.crc32(plain) % self.settings.word_terms
        self[word] = found = (
            term * self.settings.shape_terms + zlib.crc32(shape) % self.settings.shape_terms
        )
        return found


class Bag:
    """Term numbers and counts of a text; remembers the words it has seen."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self._known = _Known(settings)

    def _layout(self, text: str, words: list[str], distinct: int):
        lines = [line for line in text.split("\n") if line]
        capitals = sum(map(str.isupper, words))
        return (
            sum(map(operator.eq, words, words[1:])) / len(words),
            distinct / len(words),
            1 - len(set(lines)) / max(1, len(lines)),
            sum(map(text.count, "#*$%&<>!")) / len(text),
            capitals / len(words),
            words.count("|") / len(words),
        )

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        counted = Counter(words)
        if len(self._known) > self.settings.remembered:
            self._known.clear()
        both = np.fromiter(map(self._known.__getitem__, counted), np.int64, len(counted))
        plain, shapes = np.divmod(both, self.settings.shape_terms)
        terms = np.concatenate([plain, shapes + self.settings.word_terms])
        counts = np.fromiter(counted.values(), float, len(counted))
        sums = np.bincount(terms, np.concatenate([counts, counts]), self.settings.terms)
        for place, share in enumerate(self._layout(text, words, len(counted))):
            step = int(np.searchsorted(STEPS, share, "right")) - 1
            sums[self.settings.layout_start + place * len(STEPS) + step] = LAYOUT_COUNT
        terms = np.flatnonzero(sums)
        return terms, sums[terms]


def stored_bags(docs: DataFrame, settings: Settings, stage: StageArea) -> DataFrame:
    """``doc_id, terms, counts`` of each document, written once."""

    def make():
        bag = Bag(settings)

        def each(batches):
            for batch in batches:
                # Texts become Python strings one at a time.
                for doc_id, text in zip(*batch.columns, strict=True):
                    terms, counts = bag(text.as_py())
                    yield doc_id.as_py(), terms.astype(np.int16), counts.astype(np.int32)

        return each

    ddl = "doc_id long, terms array<smallint>, counts array<int>"
    return stage.table(map_batches(docs.select("doc_id", "text"), ddl, make), "bags")


def _lists(column) -> list[np.ndarray]:
    """The arrays of an Arrow list column, without copies."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[start:end] for start, end in zip(ends, ends[1:], strict=False)]


def document_frequencies(bags: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """How many documents have each term, over all of them; one number for each term."""

    def make():
        def each(batches):
            found, total = np.zeros(settings.terms, np.int64), 0
            for batch in batches:
                found += np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(found))
                total += batch.num_rows
            yield -1, total
            for term in np.flatnonzero(found):
                yield int(term), int(found[term])

        return each

    summed = map_batches(bags.select("terms"), "term int, n long", make).groupBy("term").agg(
        F.sum("n").alias("n")
    )
    counts = {row["term"]: row["n"] for row in summed.collect()}
    total = counts.pop(-1, 0)
    return np.array([counts.get(term, 0) for term in range(settings.terms)]), total


@dataclass(frozen=True)
class Space:
    """Term weights, the latent directions, and the labelled vectors of unit length."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def project(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors of texts in the latent space; zero where there is nothing to see."""
        found = np.stack(
            [
                (np.log1p(counts) * self.weights[terms]) @ self.directions[terms]
                for terms, counts in bags
            ]
        )
        lengths = np.linalg.norm(found, axis=1, keepdims=True)
        return found / np.where(lengths > 1e-12, lengths, 1)


def fit_space(docs: DataFrame, labels: DataFrame, stored: DataFrame, settings: Settings) -> Space:
    """The space of a bounded sample, with term weights of all documents' stored bags."""
    frequency, total = document_frequencies(stored, settings)
    weights = np.log((1 + total) / (1 + frequency)) + 0.1
    sample = labelled_sample(docs, labels, "quality", settings.sample)

    def make():
        bag = Bag(settings)

        def each(text, label):
            terms, counts = bag(text)
            return label, terms.tolist(), counts.tolist(), zlib.crc32(text.encode())

        return each

    ddl = "label int, terms array<int>, counts array<double>, place long"
    rows = map_each(sample, ddl, make).collect()
    rows = sorted((row for row in rows if row["terms"]), key=lambda row: (row["place"], row["terms"]))
    if not rows:
        return Space(weights, np.zeros((settings.terms, 1)), np.zeros((0, 1)), np.zeros(0))
    bags = [(np.array(row["terms"]), np.array(row["counts"])) for row in rows]
    matrix = np.zeros((len(rows), settings.terms))
    for line, (terms, counts) in zip(matrix, bags, strict=True):
        line[terms] = np.log1p(counts) * weights[terms]
        line /= np.linalg.norm(line)
    _, found = np.linalg.eigh(matrix.T @ matrix)
    space = Space(weights, found[:, ::-1][:, : settings.rank].copy(), np.zeros((0, 1)), np.zeros(0))
    labelled = np.array([row["label"] for row in rows], float)
    return Space(weights, space.directions, space.project(bags), labelled)


def vote(vectors: np.ndarray, space: Space, settings: Settings) -> np.ndarray:
    """Shares of good labels among the nearest rows, weighted by similarity."""
    if not len(space.labels):
        return np.full(len(vectors), 0.5)
    cosines = np.maximum(vectors @ space.vectors.T, 0)
    count = min(settings.neighbours, len(space.labels))
    nearest = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
    weight = np.take_along_axis(cosines, nearest, 1) ** settings.power
    good = (weight * space.labels[nearest]).sum(1)
    # A little of the prior, so that texts without a similar row get just that.
    return (good + 1e-6 * space.prior) / (weight.sum(1) + 1e-6)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings | None = None,
    stage: StageArea | None = None,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document."""
    settings = settings or Settings()
    stored = stored_bags(docs, settings, stage or StageArea(docs.sparkSession))
    space = fit_space(docs, labels, stored, settings)
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def make():
        space = shared.value

        def each(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, settings.block):
                    ids, terms, counts = batch.slice(start, settings.block).columns
                    bags = list(zip(_lists(terms), _lists(counts), strict=True))
                    found = np.clip(vote(space.project(bags), space, settings), 0, 1)
                    yield from zip(ids.to_pylist(), found.tolist(), strict=True)

        return each

    scored = map_batches(stored, "doc_id long, score double", make)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )

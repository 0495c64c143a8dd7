"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, report or other.  Insults are
learned: words and word beginnings that toxic texts have far more often than others.  Four
transducers are composed over the symbols of a clause.  The first marks insults and threats
inside the scope of a negation, the second those in reported speech, the third those with a
target near them, and the last collects the marked matches.  Each kind of match has a
weight; a text's score is the logistic function of its weighted matches.  Weights are learned
by logistic regression around those the grammar states: a target raises a match, negation
and reported speech lower it, and a threat counts without any example of one.  Words
without a match count nothing, however many there are.

The grammar is learned from at most ``Settings.sample`` labelled rows that are not held
out, by an id digest; its word table is bounded by them.  Scores use texts only.

Null and empty texts have no match and get the score of a text without one.  Rows are
scored one by one, so ties, repeated rows, extra columns and empty tables change nothing;
without any labelled row of both kinds, every score is one half below the threshold.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, map_each, map_rows

# --- symbols ---------------------------------------------------------------------------

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = range(7)

# Function words of the grammar in English, German, French and Spanish.
_WORDS = {
    TARGET: "you your yours u they them du dich dir ihr euch sie tu toi te vous vos usted "
    "ustedes vosotros tú ti",
    NEGATION: "not no never isn aren don nicht kein keine nie pas jamais aucun nunca ningún",
    REPORT: "said says told wrote quoted claimed sagte sagt schrieb dit écrit dijo dice "
    "escribió",
    THREAT: "kill hurt destroy die beat burn töten umbringen verletzen tuer frapper brûler "
    "matar golpear quemar",
}
SYMBOLS = {word: symbol for symbol, words in _WORDS.items() for word in words.split()}
# "die" and the like are articles or pronouns elsewhere, so only words of one reading stay.
AMBIGUOUS = frozenset("die sie te tu no dice".split())

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]+").findall
_LETTERS = re.compile(r"[^\W\d_]+").findall


@dataclass(frozen=True)
class Settings:
    sample: int = 8000
    shortest_prefix: int = 4
    longest_prefix: int = 6
    least_texts: int = 5
    # Companions are in this share of a feature's texts; copies have many.
    usual_share: float = 0.5
    most_companions: int = 10
    least_log_odds: float = 3.0
    scope: int = 3
    ridge: float = 1.0
    # The log odds of a text with one threat, and how marks move those of a match.
    threat: float = -1.0
    targeted: float = 2.0
    negated: float = -3.0
    reported: float = -2.5
    # How much more than other weights those of marked matches are held to these.
    trust: float = 10.0


@dataclass(frozen=True)
class Grammar:
    """Learned words and beginnings with their strength, and the weights of matches."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = ()
    bias: float = -1e-9


class Lexer:
    """Symbols and strengths of tokens; remembers the words it has seen."""

    def __init__(self, grammar: Grammar, settings: Settings, remembered: int = 500_000):
        self.grammar, self.settings, self.remembered = grammar, settings, remembered
        self._known: dict[str, tuple[int, float]] = {}
        self._raw: dict[str, bool] = {}

    def word(self, word: str) -> tuple[int, float]:
        known = self._known.get(word)
        if known is None:
            if len(self._known) > self.remembered:
                self._known.clear()
            known = self._known[word] = self._look_up(word)
        return known

    def _look_up(self, word: str) -> tuple[int, float]:
        strength = self.grammar.words.get(word, 0.0)
        for length in range(self.settings.shortest_prefix, self.settings.longest_prefix + 1):
            if len(word) >= length:
                strength = max(strength, self.grammar.prefixes.get(word[:length], 0.0))
        if strength:
            return INSULT, strength
        if word[0] in ".!?;:\n":
            return BREAK, 0.0
        return (OTHER if word in AMBIGUOUS else SYMBOLS.get(word, OTHER)), 1.0

    def has_match(self, text: str) -> bool:
        """Whether any clause can be accepted: it needs an insult or a threat."""
        known = self._raw
        for raw in set(text.split()):
            found = known.get(raw)
            if found is None:
                if len(known) > self.remembered:
                    known.clear()
                found = known[raw] = any(
                    self.word(word)[0] in (INSULT, THREAT) for word in _LETTERS(raw.lower())
                )
            if found:
                return True
        return False

    def clauses(self, text: str):
        """Lists of ``(symbol, strength)`` between clause breaks."""
        clause = []
        for token in _TOKEN(text.lower()):
            found = self.word(token)
            if found[0] == BREAK:
                if clause:
                    yield clause
                clause = []
            else:
                clause.append(found)
        if clause:
            yield clause


# --- transducers -------------------------------------------------------------------------

# Marks on a match; a match's kind is its symbol and the marks it got.
NEGATED, REPORTED, TARGETED = 1, 2, 4
KINDS = 16


def negation_scope(symbols, scope: int):
    """States count down from the scope; matches read above zero are marked."""
    state = 0
    for symbol, strength, marks in symbols:
        if symbol in (INSULT, THREAT) and state:
            marks |= NEGATED
        state = scope if symbol == NEGATION else max(0, state - 1)
        yield symbol, strength, marks


def reported_speech(symbols):
    """Two states: after a reporting word the rest of the clause is reported."""
    state = False
    for symbol, strength, marks in symbols:
        state = state or symbol == REPORT
        yield symbol, strength, marks | REPORTED * (state and symbol in (INSULT, THREAT))


def _after_target(symbols, scope: int) -> list[bool]:
    """States count down from the scope; a symbol read above zero is near a target."""
    state, found = 0, []
    for symbol, *_ in symbols:
        found.append(state > 0)
        state = scope if symbol == TARGET else max(0, state - 1)
    return found


def targeted(symbols, scope: int):
    """Matches within the scope after or before a target are marked.

    The same states run through the clause forwards and backwards.
    """
    read = list(symbols)
    after = _after_target(read, scope)
    before = reversed(_after_target(reversed(read), scope))
    for (symbol, strength, marks), *near in zip(read, after, before, strict=True):
        yield symbol, strength, marks | TARGETED * (symbol in (INSULT, THREAT) and any(near))


def matches(clause, scope: int):
    """The composition: ``(kind, strength)`` of what the grammar accepts in a clause."""
    symbols = ((symbol, strength, 0) for symbol, strength in clause)
    marked = targeted(reported_speech(negation_scope(symbols, scope)), scope)
    for symbol, strength, marks in marked:
        if symbol in (INSULT, THREAT):
            yield (symbol - INSULT) * 8 + marks, strength


def match_features(text: str | None, lexer: Lexer) -> np.ndarray | None:
    """Logarithms of summed strengths by kind of match; None without a match."""
    if not text or not lexer.has_match(text):
        return None
    sums = np.zeros(KINDS)
    for clause in lexer.clauses(text):
        for kind, strength in matches(clause, lexer.settings.scope):
            sums[kind] += strength
    return np.log1p(sums)


# --- learning ------------------------------------------------------------------------------


def _text_features(text: str, settings: Settings) -> set[tuple[str, int]]:
    """Words as ``(word, 0)`` and their beginnings as ``(beginning, 1)``."""
    words = set(_LETTERS(text.lower()))
    found = {(word, 0) for word in words}
    for length in range(settings.shortest_prefix, settings.longest_prefix + 1):
        found.update((word[:length], 1) for word in words if len(word) >= length)
    return found


def _lexicon(sample: DataFrame, settings: Settings) -> tuple[dict, dict]:
    """Words and beginnings that set toxic texts apart, with their log odds."""

    def make():
        def each(rows):
            counted = {0: Counter(), 1: Counter()}
            for text, label in rows:
                counted[label].update(_text_features(text, settings))
            for feature in counted[1].keys() | counted[0].keys():
                yield *feature, counted[1][feature], counted[0][feature]

        return each

    counted = sample.groupBy("label").agg(F.count("*").alias("n")).collect()
    totals = {row["label"]: row["n"] for row in counted}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    counts = map_rows(sample, "feature string, is_prefix int, toxic long, clean long", make)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1)
    )
    found = (
        counts.groupBy("feature", "is_prefix")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= settings.least_texts)
        .withColumn("odds", odds)
        .where(F.col("odds") >= settings.least_log_odds)
        .collect()
    )
    odds_of = {(row["feature"], row["is_prefix"]): row["odds"] for row in found}
    return _independent(sample.where("label = 1"), odds_of, settings)


def _independent(toxic: DataFrame, odds_of: dict, settings: Settings) -> tuple[dict, dict]:
    """The features whose texts have little else in common.

    Words that stand in copies of one toxic text come with each other in most of their
    texts; insults come with changing companions.
    """

    def make():
        def each(rows):
            for text, _ in rows:
                found = _text_features(text, settings) & odds_of.keys()
                yield [word for word, _ in found], [kind for _, kind in found]

        return each

    rows = map_rows(toxic, "features array<string>, kinds array<int>", make).collect()
    texts = [set(zip(row["features"], row["kinds"], strict=True)) for row in rows]
    holders: dict[tuple, list[set]] = {}
    for features in texts:
        for feature in features:
            holders.setdefault(feature, []).append(features)
    lexicon = ({}, {})
    for feature, held in holders.items():
        together = Counter(other for features in held for other in features)
        usual = settings.usual_share * len(held)
        stem = feature[0][: settings.shortest_prefix]
        stems = {
            other[: settings.shortest_prefix]
            for (other, _), number in together.items()
            if number >= usual
        }
        if len(stems - {stem}) <= settings.most_companions:
            lexicon[feature[1]][feature[0]] = odds_of[feature]
    return lexicon


def _fit(
    rows: np.ndarray, labels: np.ndarray, ridge: np.ndarray, prior: np.ndarray
) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's iterations, shrunk towards the prior but for the bias."""
    data = np.hstack([rows, np.ones((len(rows), 1))])
    shrink = np.diag([*ridge, 1e-6])
    prior = np.append(prior, 0.0)
    weight = prior.copy()
    for _ in range(40):
        guess = 1 / (1 + np.exp(-np.clip(data @ weight, -30, 30)))
        slope = data.T @ (guess - labels) + shrink @ (weight - prior)
        bend = (data * (guess * (1 - guess) + 1e-9)[:, None]).T @ data + shrink
        step = np.linalg.solve(bend, slope)
        weight -= step / max(1.0, np.abs(step).max() / 4)
    return weight[:-1], float(weight[-1])


def _prior(plain_insult: float, bias: float, settings: Settings) -> np.ndarray:
    """The grammar's own weights by kind: what a kind is worth without an example.

    A threat's word has strength one, and its score is stated; an insult's worth is learned
    and its marks move it as they move a threat.
    """
    moves = np.array(
        [
            settings.negated * bool(marks & NEGATED)
            + settings.reported * bool(marks & REPORTED)
            + settings.targeted * bool(marks & TARGETED)
            for marks in range(8)
        ]
    )
    threats = (settings.threat + moves - bias) / np.log1p(1.0)
    insults = plain_insult + moves / np.log1p(settings.least_log_odds)
    return np.concatenate([insults, threats])


def _weigh(
    rows: np.ndarray, labels: np.ndarray, settings: Settings
) -> tuple[tuple[float, ...], float]:
    """Weights of the kinds: those of plain insults first, then all around the prior."""
    ridge = np.full(KINDS, settings.ridge)
    weights, bias = _fit(rows, labels, ridge, np.zeros(KINDS))
    # What marks do is better known than learned from a few examples.
    ridge[1:] *= settings.trust
    for _ in range(5):  # the prior follows the bias, which settles
        prior = _prior(max(float(weights[0]), 0.0), bias, settings)
        weights, bias = _fit(rows, labels, ridge, prior)
    return tuple(weights.tolist()), bias


def learn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Grammar:
    """The grammar of a bounded sample of labelled rows; copies of a text count once."""
    settings = settings or Settings()
    sample = labelled_sample(docs, labels, "toxic", settings.sample)
    sample = sample.groupBy("text").agg(F.max("label").alias("label")).select("text", "label")
    words, prefixes = _lexicon(sample, settings)
    if not words and not prefixes:
        return Grammar()
    lexicon = Grammar(words, prefixes)

    def make():
        lexer = Lexer(lexicon, settings)

        def each(text, label):
            found = match_features(text, lexer)
            return label, [0.0] * KINDS if found is None else found.tolist()

        return each

    rows = map_each(sample, "label int, found array<double>", make).collect()
    weights, bias = _weigh(
        np.array([row["found"] for row in rows]),
        np.array([row["label"] for row in rows], float),
        settings,
    )
    return Grammar(words, prefixes, weights, bias)


def score_documents(
    docs: DataFrame, grammar: Grammar, settings: Settings | None = None
) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_matches`` for each document."""
    settings = settings or Settings()
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def make():
        known = shared.value
        lexer = Lexer(known, settings)
        weights = np.asarray(known.weights or [0.0] * KINDS)

        def each(doc_id, text):
            found = match_features(text, lexer)
            total = known.bias + (0.0 if found is None else float(found @ weights))
            return doc_id, float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

        return each

    scored = map_each(docs.select("doc_id", "text"), "doc_id long, score double", make)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Scores of all documents by a grammar learned from the labelled ones."""
    return score_documents(docs, learn(docs, labels, settings), settings)

"""What the clause grammar makes of threats, targets, negation and reports; time on long texts."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import licences, pii, toxicity
from kinetable.llm.toxicity import INSULT, KINDS, NEGATED, REPORTED, TARGETED

SETTINGS = toxicity.Settings()
LEXICON = {"idiot": 5.0, "moron": 4.0}


@pytest.fixture(scope="module")
def grammar():
    """Weights from 400 texts with a plain insult in the toxic ones, and nothing else."""
    rows = np.zeros((400, KINDS))
    labels = np.array([1.0] * 40 + [0.0] * 360)
    rows[:40, 0] = np.log1p(5.0)
    weights, bias = toxicity._weigh(rows, labels, SETTINGS)
    return toxicity.Grammar(LEXICON, {}, weights, bias)


@pytest.fixture(scope="module")
def score(grammar):
    lexer = toxicity.Lexer(grammar, SETTINGS)

    def of(text):
        found = toxicity.match_features(text, lexer)
        total = grammar.bias + (0.0 if found is None else float(found @ np.array(grammar.weights)))
        return 1 / (1 + np.exp(-total))

    return of


def test_no_kind_weighs_nothing(grammar):
    assert all(abs(weight) > 0.1 for weight in grammar.weights)


def test_threats_count_without_an_example(score):
    harmless = score("the garden is green")
    threat = score("I will kill you tomorrow.")
    assert threat > 0.5 > harmless
    assert threat > score("we kill time")  # no target near it
    assert score("she said I will kill you tomorrow.") < threat
    assert score("I will not kill you tomorrow.") < threat
    assert score("I would never kill you, she said") < 0.5


def test_insults_by_their_clause(score):
    plain = score("the idiot left")
    assert score("you are an idiot") > plain > 0.5
    assert score("you are not an idiot") < plain
    assert score("he said you are an idiot") < score("you are an idiot")
    assert score("") == score("nothing at all")


def test_marks_move_all_kinds_alike(grammar):
    weights = np.array(grammar.weights).reshape(2, 8)
    for marks in range(8):
        for mark, sign in ((NEGATED, -1), (REPORTED, -1), (TARGETED, 1)):
            if not marks & mark:
                assert (sign * (weights[:, marks | mark] - weights[:, marks]) > 0).all()


def test_states_mark_what_is_near_a_target():
    rng = random.Random(1)
    for _ in range(300):
        symbols = [(rng.choice([0, 0, 1, 2, 3]), 1.0, 0) for _ in range(rng.randrange(15))]
        scope = rng.randrange(1, 5)
        targets = [place for place, (symbol, *_) in enumerate(symbols) if symbol == 3]
        for place, (symbol, _, marks) in enumerate(toxicity.targeted(symbols, scope)):
            near = any(abs(place - target) <= scope for target in targets)
            assert bool(marks & TARGETED) == (near and symbol in (1, 2))


def test_loose_spans_keep_clear_of_base_spans(monkeypatch):
    rng = random.Random(2)
    for _ in range(300):
        def spans(count):
            starts = [rng.randrange(60) for _ in range(count)]
            return [(start, start + rng.randrange(1, 9)) for start in sorted(starts)]

        base = {"email": spans(4), "card": spans(3), "phone": []}
        loose = {"phone": spans(8)}
        monkeypatch.setattr(pii, "base_spans", lambda _, base=base: base)
        monkeypatch.setattr(pii, "loose_spans", lambda _, loose=loose: loose)
        taken = [span for spans_ in base.values() for span in spans_]
        found = [span[1:3] for span in pii._candidates("") if span[3]]
        assert found == [
            (start, end)
            for start, end in loose["phone"]
            if not any(a < end and start < b for a, b in taken)
        ]


def seconds(work, *arguments):
    times = []
    for _ in range(3):
        started = time.process_time()
        work(*arguments)
        times.append(time.process_time() - started)
    return min(times)


def test_time_is_linear_in_the_clause():
    lexer = toxicity.Lexer(toxicity.Grammar(LEXICON, {}, (1.0,) * KINDS), SETTINGS)
    once, fourfold = (
        seconds(toxicity.match_features, "you idiot " * count, lexer) for count in (25_000, 100_000)
    )
    # Sixteen times as much if it were quadratic.
    assert fourfold < 8 * once + 0.05


def test_time_is_linear_in_the_spans():
    def all_of(count):
        text = "a.b@c.org 555-010-2030 " * count
        return sum(1 for _ in pii._candidates(text))

    once, fourfold = (seconds(all_of, count) for count in (10_000, 40_000))
    # Sixteen times as much if it were quadratic.
    assert fourfold < 8 * once + 0.05


def test_reported_states():
    symbols = [(INSULT, 1.0, 0), (toxicity.REPORT, 1.0, 0), (INSULT, 1.0, 0)]
    assert [marks for *_, marks in toxicity.reported_speech(symbols)] == [0, 0, REPORTED]


def test_time_is_linear_in_a_line_of_licence_words(spark):
    def lines_of(count):
        frame = spark.createDataFrame([("under the " * count,)], "text string")
        frame.select(licences.unwrapped(F.col("text"))).collect()

    lines_of(10)
    started = time.perf_counter()
    lines_of(100_000)
    # One line of a megabyte took about an hour when every "under" was tried.
    assert time.perf_counter() - started < 60

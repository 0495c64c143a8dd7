"""Recompression, residue products and rolled-up phrases, beside plain versions and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from compare import difference

from kinetable.llm import blocks, catalog, phrases, recompression, residues, sketches
from kinetable.llm.words import hashed_words

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="tables not present")
DOCS = "doc_id long, text string, lang string, kept string, _row int, block long, a long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@needs_tables
@pytest.mark.parametrize(
    "name", ["op11_recompression", "op12_residue_products", "op13_rolled_up_phrases"]
)
def test_query_equals_its_sql(spark, name):
    frame = catalog.QUERIES[name](spark, SF)
    assert difference(frame, SF, catalog.ORACLE[name]) is None


# --- words ------------------------------------------------------------------------------


def test_words_are_those_of_the_pattern():
    text = " one\ttwo\n\x0bthree \x85  x é" + "y" * 300 + " " + "z" * 8 + " " + "z" * 9 + " \x1c"
    raw = text.encode()
    starts, first, second = hashed_words(raw)
    found = list(WORD.finditer(raw))
    assert starts.tolist() == [match.start() for match in found]
    words = [match[0] for match in found]
    pairs = list(zip(first.tolist(), second.tolist(), strict=True))
    assert len(set(pairs)) == len(set(words)) == len(words)
    # The same word has the same hashes anywhere.
    again = hashed_words(b"   " + b" ".join(reversed(words)))
    assert list(zip(again[1].tolist(), again[2].tolist(), strict=True))[::-1] == pairs
    assert [len(part) for part in hashed_words(b"")] == [0, 0, 0]
    assert [len(part) for part in hashed_words(b" \n")] == [0, 0, 0]


def test_words_of_one_length_do_not_collide():
    words = [bytes(random.Random(i).choices(range(33, 127), k=8)) for i in range(20_000)]
    _, first, _ = hashed_words(b" ".join(words))
    assert len(set(first.tolist())) == len(set(words))


# --- recompression ------------------------------------------------------------------------


def plain_removal(texts, length):
    split = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts]
    times = Counter(
        tuple(words[i : i + length]) for words in split for i in range(len(words) - length + 1)
    )
    for words in split:
        gone = set()
        for i in range(len(words) - length + 1):
            if times[tuple(words[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone)
        yield len(words), len(gone), hashlib.sha256(kept).hexdigest()


def removal_rows(spark, rows, settings):
    """What the operator and the plain version give, as sorted rows."""
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = recompression.removal_digests(docs, settings).collect()
    expected = zip(rows, plain_removal([row[1] for row in rows], settings.length), strict=True)
    key = str
    return sorted(map(tuple, found), key=key), sorted(
        ((row[0], *values) for row, values in expected), key=key
    )


def random_texts(seed, count, vocabulary, longest):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(vocabulary)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(longest))) for _ in range(count)]
    for _ in range(count // 3):
        one, other = rng.randrange(count), rng.randrange(count)
        taken = texts[one].split()
        start = rng.randrange(len(taken) + 1)
        texts[other] += "\n" + " ".join(taken[start : start + rng.randrange(60)])
    return texts


@pytest.mark.parametrize(
    ("length", "low_rounds", "vocabulary"), [(35, 4, 400), (5, 1, 6), (8, 2, 30), (12, 3, 2)]
)
def test_removal_equals_a_plain_version(spark, length, low_rounds, vocabulary):
    settings = recompression.Settings(
        length=length, low_rounds=low_rounds, block_rows=7, block_size=4000, together=700
    )
    texts = random_texts(length, 60, vocabulary, 150)
    rows = [(i, text, "en", "x", 1, 5, 6) for i, text in enumerate(texts)]
    found, expected = removal_rows(spark, rows, settings)
    assert found == expected
    assert any(row[2] for row in found)


def test_removal_of_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [
        (1, passage, "en", "x", 1, 1, 1),
        (1, passage, "en", "x", 1, 1, 1),
        (None, "before " + passage + " after", None, None, None, None, None),
        (2, None, None, None, None, None, None),
        (3, "", "en", "", 0, 0, 0),
        (4, " \n\t ", "en", "", 0, 0, 0),
        (None, None, None, None, None, None, None),
        (5, " ".join(f"p{i}" for i in range(34)), "en", "x", 1, 1, 1),
        # One run, and runs of two and of three words, that no symbol ends inside of.
        (6, "long " * 30_000, "en", "x", 1, 1, 1),
        (7, "to and fro " * 3_000, "en", "x", 1, 1, 1),
        (8, "same " * 35, "de", "x", 1, 1, 1),
        (9, "same " * 10 + "x" * 100_000 + " end", "de", "x", 1, 1, 1),
        (10, "😀 中 " * 40, "de", "x", 1, 1, 1),
    ] + [(100 + i, f"{i} {passage} {i}", "en", "x", 1, 1, 1) for i in range(300)]
    for settings in (recompression.Settings(), recompression.Settings(block_rows=11, together=50)):
        found, expected = removal_rows(spark, rows, settings)
        assert found == expected


def test_removal_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    found = recompression.removal_digests(none)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert found.collect() == []


def test_kept_words(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, f"a  b {passage}\nc"), (2, passage), (3, "d  e")], "doc_id long, text string"
    )
    found = {row["doc_id"]: row for row in recompression.deduplicated(docs).collect()}
    assert {key: row["kept"] for key, row in found.items()} == {1: "a b c", 2: "", 3: "d e"}
    assert {key: row["n_removed"] for key, row in found.items()} == {1: 40, 2: 40, 3: 0}


def test_equal_passages_are_parsed_alike():
    """Symbols whose context lies in a passage are the same wherever it stands."""
    rng = random.Random(5)
    passage = [f"p{rng.randrange(40)}" for _ in range(80)]
    texts = [
        " ".join([f"{side}{i}" for i in range(n)] + passage + [f"{side}z{i}" for i in range(n)])
        for side, n in (("a", 7), ("b", 12))
    ]
    settings = recompression.Settings()
    seen = []
    for text, n in zip(texts, (7, 12), strict=True):
        piece = recompression.Piece([text])
        parse = recompression.low_parse(piece, settings)
        inside = (parse.low >= 1 + n) & (parse.high <= 1 + n + 80)
        seen.append(
            list(zip(parse.names[inside].tolist(), (parse.start[inside] - n).tolist(), strict=True))
        )
        assert (np.diff(parse.low) >= 0).all() and (np.diff(parse.high) >= 0).all()
    assert seen[0] == seen[1] and len(seen[0]) > 10


def test_a_hot_passage_is_one_row_for_each_block(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(i, f"{i} {passage}") for i in range(400)], "doc_id long, text string"
    ).repartition(2)
    settings = recompression.Settings(block_rows=100)
    from kinetable.sources.staging import StageArea

    stored = blocks.in_blocks(docs, StageArea(spark), "texts", 100, 1 << 20)
    names = recompression._low_names(stored, settings)
    most = names.groupBy("a").count().agg({"count": "max"}).first()[0]
    assert most == stored.count() <= 6
    plan = stored.join(blocks.frequent(names, "low", 2), "block", "left")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in shown


# --- residue products --------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 300, 1 << 20, 1 << 27])
@pytest.mark.parametrize("columns", [1, 3, 64, 65, 200])
def test_products_are_exact(size, columns):
    rng = np.random.default_rng(columns)
    left = rng.integers(-size, size + 1, (9, columns))
    right = rng.integers(-size, size + 1, (11, columns))
    left[0], right[0] = size, size
    left[1], right[1] = -size, -size
    primes = residues.primes_for(columns * size * size)
    assert all(prime < 1024 for prime in primes)
    found = residues.exact_products(
        residues.Operand(left, primes), residues.Operand(right, primes)
    )
    expected = left.astype(object) @ right.T.astype(object)
    assert (found.astype(object) == expected).all()


def plain_negatives(rows, positives=5, negatives=3):
    vectors = []
    for vec_id, embedding, label, *_ in rows:
        if vec_id is None or label is None or embedding is None:
            continue
        if any(x is None or not math.isfinite(x) for x in embedding):
            continue
        scaled = [math.floor(256 * x) for x in embedding]
        if sum(x * x for x in scaled) >= 1 << 62:
            continue
        vectors.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, scaled))
    for place, (anchor, label, vector) in enumerate(vectors):
        if anchor % 50:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, other[2], strict=False)), other[0], other[1])
            for at, other in enumerate(vectors)
            if at != place
        ]
        scores.sort()
        for score, positive, _ in [one for one in scores if one[2] == label][:positives]:
            found = [
                one
                for one in scores
                if one[2] != label and 50 * -score <= 100 * -one[0] <= 95 * -score
            ]
            for rank, (other, negative, _) in enumerate(found[:negatives], 1):
                yield anchor, positive, rank, negative, -score, -other


VECTORS = "vec_id long, embedding array<float>, label int, row long, vector string, rank int"


@pytest.mark.parametrize("groups", [{}, {"anchor_group": 3, "row_group": 20, "block": 7}])
def test_negatives_equal_a_plain_version(spark, groups):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        # Few values, so that many scores are tied.
        embedding = [rng.choice([0.0, 0.25, 0.5, -0.125]) for _ in range(rng.choice([4, 4, 6]))]
        rows.append((i - 100, embedding, rng.randrange(3), 1, "x", 2))
    rows += [
        (50, [0.5, 0.5, 0.5, 0.5], 1, 1, "x", 2),
        (50, [0.5, 0.5, 0.5, 0.5], 1, 1, "x", 2),
        (None, [0.5, 0.5], 1, 1, "x", 2),
        (300, None, 1, 1, "x", 2),
        (350, [0.5, None], 1, 1, "x", 2),
        (400, [0.5, float("nan")], 1, 1, "x", 2),
        (450, [0.5, float("inf")], 1, 1, "x", 2),
        (500, [0.5, 0.5], None, 1, "x", 2),
        (550, [], 1, 1, "x", 2),
        (600, [3e30, 1.0], 1, 1, "x", 2),
        (650, [1e6, 0.25], 2, 1, "x", 2),
        (651, [0.9e6, 0.25], 2, 1, "x", 2),
        (652, [0.7e6, 0.25], 1, 1, "x", 2),
    ]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = residues.hard_negatives(frame, residues.Settings(**groups))
    expected = sorted(plain_negatives(rows))
    assert sorted(map(tuple, found.collect())) == expected
    assert len(expected) > 50


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert residues.hard_negatives(none).collect() == []
    alone = spark.createDataFrame([(50, [1.0], 1, 1, "x", 2)], VECTORS)
    assert residues.hard_negatives(alone).collect() == []


# --- phrases ------------------------------------------------------------------------------------


def plain_collocations(rows, settings):
    frequency, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [word for word in re.split("[ \t]+", piece) if word]
            totals[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    frequency[lang, tuple(words[at : at + size])] += 1
    candidates = {
        key: f for key, f in frequency.items() if len(key[1]) > 1 and f >= settings.least
    }
    dropped = set()
    for (lang, words), f in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = lang, words[at : at + size]
                if 100 * f >= settings.percent * candidates[inner]:
                    dropped.add(inner)
    scored = {}
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = frequency[lang, words[:k]], frequency[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        if (lang, words) not in dropped:
            scored[lang, words] = a, min(cuts)
    for lang in sorted({lang for lang, _ in scored}):
        of_lang = [
            (-score, -a, " ".join(words).encode("utf-8", "surrogatepass"), left, right)
            for (other, words), (a, (score, _, left, right)) in scored.items()
            if other == lang
        ]
        for rank, (score, a, phrase, left, right) in enumerate(sorted(of_lang)[: settings.ranked], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


def phrase_rows():
    rng = random.Random(9)
    words = ["Ab", "b", "É", "c\x00d", "中", "don't", "x-y"]
    rows = [
        ("".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ". ", "\n"]) for _ in range(40)), lang)
        for lang in ("en", "en", "en", "de", None)
        for _ in range(20)
    ]
    return rows + [
        (None, "en"),
        ("", "en"),
        (" \t\n.", "fr"),
        ("alone", "it"),
        ("go go go go go go go go go go", "en"),
        ("same words here " * 5_000, "en"),
        ("y" * 50_000 + " b", "en"),
        ("a b", ""),
    ]


@pytest.mark.parametrize(
    "change", [{}, {"block_rows": 5, "block_size": 300, "together": 100, "ranked": 20, "parts": 3}]
)
def test_phrases_equal_a_plain_version(spark, change):
    settings = phrases.Settings(least=4, **change)
    rows = phrase_rows()
    docs = spark.createDataFrame(
        [(text, lang, "x", 1, "y", 2) for text, lang in rows],
        "text string, lang string, phrase string, f long, word string, block long",
    ).repartition(3)
    found = phrases.collocations(docs, settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = sorted(plain_collocations(rows, settings))
    assert sorted(map(tuple, found.collect())) == expected
    assert {row[0] for row in expected} >= {"en", "de", "und"}


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(none).collect() == []
    few = spark.createDataFrame([("one two", "en")], "text string, lang string")
    assert phrases.collocations(few).collect() == []


def test_windows_are_cut_where_no_longer_phrase_is_frequent(spark):
    """Frequent pairs in ever new triples: pairs are stored, not every window of four words."""
    from kinetable.sources.staging import StageArea

    rng = random.Random(4)
    after = {word: rng.sample(range(300), 3) for word in range(300)}
    texts = []
    for _ in range(60):
        words = [rng.randrange(300)]
        while len(words) < 400:
            words.append(rng.choice(after[words[-1]]))
        texts.append(" ".join(f"w{word}" for word in words))
    settings = phrases.Settings(least=20, block_rows=10)
    stage = StageArea(spark)
    docs = spark.createDataFrame([(text, "en") for text in texts], "text string, lang string")
    found = phrases.collocations(docs, settings, stage)
    assert sorted(map(tuple, found.collect())) == sorted(
        plain_collocations([(text, "en") for text in texts], settings)
    )
    stored = spark.read.parquet(f"{stage.path}/top-order")
    assert stored.where("word is null and w2 is not null").count() < 2_500


@pytest.mark.parametrize("parts", [1, 7])
def test_names_come_back_as_bits(spark, parts):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << blocks.NAME_BITS, 50, np.uint64)
    inside = [
        np.concatenate([rng.choice(common, 40), rng.integers(0, 1 << blocks.NAME_BITS, 9_000, np.uint64)])
        for _ in range(4)
    ]
    inside.append(np.array([0, (1 << blocks.NAME_BITS) - 1] * 3, np.uint64))
    sent = [row for at, one in enumerate(inside) for row in blocks.Names(one, parts).sent(at, 3)]
    found = blocks.enough(spark.createDataFrame(sent, blocks.SENT), "bits", 3)
    table = found.toArrow().to_batches()
    rows = {}
    for batch in table:
        for at in range(batch.num_rows):
            rows[batch["block"][at].as_py()] = {"bits": batch["bits"][at]}
    times = Counter(np.concatenate(inside).tolist())
    for at, one in enumerate(inside):
        expected = sorted(name for name in set(one.tolist()) if times[name] >= 3)
        assert blocks.Names(one, parts).chosen(rows[at], "bits").tolist() == expected
    assert blocks.Names(np.empty(0, np.uint64), parts).chosen({"bits": pa.scalar(None)}, "bits").size == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    """2,000,000 times a frequency of ten million million passes 64 bits."""
    large = 10**13
    counted = spark.createDataFrame(
        [
            ("en", 1, 11, None, None, None, large + 7),
            ("en", 1, 12, None, None, None, large + 2),
            ("en", 2, 11, 12, None, None, large),
        ],
        "lang string, size int, w1 long, w2 long, w3 long, w4 long, f long",
    )
    (row,) = phrases._scored(counted, phrases.Settings()).collect()
    assert row["score"] == 2_000_000 * large // (2 * large + 9) == 999_999
    assert (row["a"], row["l"], row["r"]) == (large, large + 7, large + 2)


# --- memory of sketch blocks ----------------------------------------------------------------------


def test_sketch_blocks_stay_small():
    rng = np.random.default_rng(1)
    member = pa.struct(
        [
            ("set_key", pa.binary()),
            ("root", pa.binary()),
            ("n", pa.int64()),
            ("sketch", pa.list_(pa.int64())),
            ("bits", pa.list_(pa.int64())),
        ]
    )

    def side(count):
        return [
            {
                "set_key": rng.bytes(16),
                "root": rng.bytes(16),
                "n": 300,
                "sketch": np.sort(rng.integers(-(1 << 62), 1 << 62, 64)).tolist(),
                "bits": rng.integers(0, 1 << 62, 64).tolist(),
            }
            for _ in range(count)
        ]

    kind = pa.list_(member)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([side(2048)], kind), pa.array([side(2048)], kind)], names=["left", "right"]
    )
    tracemalloc.start()
    list(sketches._block_pairs(sketches.Settings(words=2), False)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6

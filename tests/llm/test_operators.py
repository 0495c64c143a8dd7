"""The corpus operators on small tables, beside plain versions of what they compute."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import difference
from pyspark.sql import functions as F

import corpus_pipeline
from kinetable.llm import (
    bpe,
    catalog,
    compression,
    covertree,
    licences,
    mixing,
    neighbours,
    pii,
    sketches,
    suffixes,
    toxicity,
)

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="tables not present")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, _row int"
_RNG = np.random.default_rng(2)
PROSE = " ".join("".join(_RNG.choice(list("etaoinshrdlu"), n)) for n in _RNG.integers(2, 9, 120))
ODD_ROWS = [
    (1, PROSE, "en", "a", 5, "x", 1),
    (1, PROSE, "en", "a", 5, "x", 1),
    (None, PROSE + " end", "en", None, None, None, None),
    (2, None, None, None, None, None, None),
    (3, "", "en", "b", 0, "", 0),
    (4, " \n\t ", "en", "b", 4, "", 0),
    (5, "one", "en", "b", 3, "", 0),
    (6, "Mail a.b@c.org or +1 (555) 010-2030, 4111 1111 1111 1111, 10.0.0.255. " + PROSE,
     "en", "\U0001f600", 9, "", 0),
    (7, "long " * 30_000, "en", "a", 1, "", 0),
    (8, "x" * 100_000, "en", "a", 1, "", 0),
    (9, "# é 中文 \u00a0 | " + PROSE * 3, "en", "a", 1, "", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, COLUMNS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_counts(text):
    words = words_of(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def check_rules(frame):
    texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    found = compression.compression_rules(frame).collect()
    assert [row["doc_id"] for row in found] == [doc_id for doc_id, _ in texts]
    for row, (_, text) in zip(found, texts, strict=True):
        counts = plain_counts(text)
        assert tuple(row)[1:6] == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row["kept"] and row["base_failed"])


def test_rules_on_odd_rows(odd, none):
    check_rules(odd)
    assert compression.compression_rules(none).count() == 0
    kept = compression.keep_compressible(odd)
    assert kept.columns == odd.columns
    assert {row["doc_id"] for row in kept.collect()} == {1, None, 6}


@needs_tables
def test_rules_on_the_table(docs):
    check_rules(docs)


def test_bands_reject_repetition_and_noise():
    judge = compression.Judge(compression.Bands())
    noise = np.random.default_rng(1).integers(33, 126, 4000)
    assert not judge.in_bands(5000, *judge.ratios(b"ab " * 2000))
    assert not judge.in_bands(4000, *judge.ratios(noise.astype(np.uint8).tobytes()))


def prose(size, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("etaoinshrdlucmfw"), n)) for n in rng.integers(2, 9, 900)]
    return " ".join(rng.choice(words, size))[:size]


@pytest.mark.parametrize("columns", [8, 20, 64, 76, 10**6])
@pytest.mark.parametrize("clean, junk", [(6000, 12000), (6000, 5000)])
def test_bands_reject_encoded_bytes_in_clean_prose(columns, clean, junk):
    judge = compression.Judge(compression.Bands())
    code = base64.b64encode(np.random.default_rng(3).bytes(junk)).decode()[:junk]
    lines = "\n".join(code[at : at + columns] for at in range(0, junk, columns))
    for text in (prose(clean, 4) + "\n" + lines, lines + "\n" + prose(clean, 4)):
        found = judge(text)
        assert not found[5] and not found[6]
    assert judge(prose(clean + junk, 4))[6]


@pytest.mark.parametrize("block, times, clean", [(300, 14, 8000), (900, 5, 8000), (60, 40, 3000)])
def test_bands_reject_repeated_blocks_in_clean_prose(block, times, clean):
    judge = compression.Judge(compression.Bands())
    repeated = "\n".join([prose(block, 6)] * times)
    for text in (prose(clean, 5) + "\n" + repeated, repeated + "\n" + prose(clean, 5)):
        found = judge(text)
        assert not found[5] and not found[6]


def test_last_part_counts_by_its_bytes():
    judge = compression.Judge(compression.Bands())
    junk = base64.b64encode(np.random.default_rng(3).bytes(3000)).decode()
    assert judge(prose(2048, 4) + junk[:1000])[8:] == (2, 1)
    assert judge(prose(2048, 4) + junk[:100])[8:] == (1, 0)
    # A bad rest of a twentieth of the text does not reject it.
    assert judge(prose(8 * 2048, 4) + junk[:800])[6:10:2] == (True, 9)


def linked_components(sets, percent=80):
    """Component of each place by links between all pairs of sets."""
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if one and 100 * both >= percent * (len(one) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def shingles(text, length):
    words = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if 0 < len(words) < length:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(length)), strict=False))


def check_near(rows, found, length):
    rows = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))
    sets = [shingles(text, length) for _, text in rows]
    roots = linked_components(sets)
    ids = [row[0] for row in rows]
    wanted = Counter(
        (i, len(s), ids[root] if s else i) for i, s, root in zip(ids, sets, roots, strict=True)
    )
    assert wanted == Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_of_odd_rows(odd, none):
    found = sketches.near_duplicates(odd, sketches.Settings(words=2)).collect()
    check_near([row[:2] for row in ODD_ROWS], found, 2)
    assert sketches.near_duplicates(none).count() == 0
    kept = sketches.keep_one_of_each(odd, sketches.Settings(words=2))
    assert kept.columns == odd.columns
    assert Counter(row["doc_id"] for row in kept.collect()) == Counter([1, 2, 3, 4, 5, 7, 8])


@needs_tables
def test_near_duplicates_of_the_table(spark, docs):
    rows = [tuple(row) for row in docs.select("doc_id", "text").where("doc_id < 300").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(rows, sketches.near_duplicates(frame, sketches.Settings(words=2)).collect(), 2)


def test_small_sets_share_a_list(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e f"), (3, "b c d e f g h"), (4, "z"), (5, "Z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(rows, sketches.near_duplicates(frame, sketches.Settings(words=2, block=2)).collect(), 2)


def plain_removal(texts, length=400):
    data = [(text or "").encode() for text in texts]
    times = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i] += 1
                gone[min(i + length, len(b))] -= 1
        mask = np.cumsum(gone)[: len(b)] > 0
        runs = int(np.sum(mask & ~np.concatenate([[False], mask[:-1]]))) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        yield len(b), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(
    "settings", [{}, {"group": 1}, {"small": 1}, {"block_rows": 2, "block_size": 3000}]
)
def test_repeated_strings_of_odd_rows(spark, none, settings):
    rng = np.random.default_rng(3)
    letters = ["".join(rng.choice(list("abcd efé"), 900)) for _ in range(4)]
    texts = [row[1] for row in ODD_ROWS if len(row[1] or "") < 20_000] + [
        letters[0] + letters[1], letters[1][100:700] + letters[2], letters[0][:399],
        letters[3] + letters[1][50:460] + "!", letters[2][300:] + letters[0][200:650], "ab" * 700,
    ]
    # Long texts, and one that stands a thousand times.
    texts += [letters[1][:200] + "x" * 30_000, "lengthy " * 5_000, letters[2][100:]]
    texts += [letters[3] + "tail"] * 1000
    rows = [(i, text, "c", i) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, context string, block long")
    frame = frame.repartition(2)
    found = suffixes.removal_digests(frame, suffixes.Settings(**settings)).orderBy("doc_id")
    assert [tuple(row)[1:] for row in found.collect()] == list(plain_removal(texts))
    assert suffixes.removal_digests(none).count() == 0


def test_strings_of_large_groups_are_not_stored(spark):
    """Contexts that share most of a passage come back as bits of a block, not as strings."""
    from kinetable.sources.staging import StageArea

    rng = np.random.default_rng(8)
    prose = ["".join(rng.choice(list("abcdefgh "), 700)) for _ in range(42)]
    texts = [one[:300] + prose[40][:390] + one[300:] for one in prose[:40]]
    texts += [one[:200] + prose[41][:460] + one[200:] for one in prose[:20]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stage = StageArea(spark)
    settings = suffixes.Settings(group=4, block_rows=20)
    found = suffixes.removal_digests(frame, settings, stage).orderBy("doc_id")
    assert [tuple(row)[1:] for row in found.collect()] == list(plain_removal(texts))
    assert 0 < spark.read.parquet(f"{stage.path}/strings").count() <= 60


def test_colliding_hashes_are_sorted_by_bytes(monkeypatch):
    wanted = suffixes.sort_suffixes([b"banana", b"band", b"bandana", b"an"])
    monkeypatch.setattr(suffixes, "prefix_hashes", lambda data: np.zeros(len(data) + 1))
    assert suffixes.sort_suffixes([b"banana", b"band", b"bandana", b"an"]) == wanted
    assert wanted == ([3, 0, 1, 2], [0, 0, 3, 4])


def plain_spans(text):
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        yield "email", *m.span()
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            yield "ip", *m.span()
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            yield "card", *m.span()
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            yield "phone", *m.span()


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab1290.+-@ ()"), rng.integers(0, 60)))
        found = [(kind, *span) for kind, spans in pii.base_spans(text).items() for span in spans]
        assert found == list(plain_spans(text)), text


def test_personal_data_of_odd_rows(odd, none):
    found = by_id(pii.personal_data(odd))
    assert tuple(found[6])[1:5] == (1, 1, 1, 1)
    assert found[2]["spans"] == "" and found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(none).count() == 0
    cleaned = pii.redact_documents(odd)
    assert cleaned.columns == odd.columns
    text = by_id(cleaned)[6]["text"]
    assert text.startswith("Mail [EMAIL] or [PHONE], [CARD], [IP]. ")
    assert by_id(cleaned)[6]["n_chars"] == len(text)


@pytest.fixture(scope="module")
def encoders():
    lines = Path(catalog.VOCABULARY).read_bytes()
    ranks = bpe.parse_ranks(lines)
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_encoding_equals_the_library(encoders):
    own, library = encoders
    rng = np.random.default_rng(7)
    letters = list("abcdeéß中文 \n\t1234!?'s\u00a0😀\0")
    for _ in range(1500):
        text = "".join(rng.choice(letters, rng.integers(0, 60)))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_prefix_tables_follow_edits(encoders):
    own, _ = encoders
    rng = np.random.default_rng(9)
    for _ in range(200):
        data, new = (bytes(rng.choice(list(b"the anre"), n)) for n in rng.integers(0, 30, 2))
        start, end = sorted(rng.integers(0, len(data) + 1, 2).tolist())
        table = bpe.PrefixTable(own.vocabulary, data)
        table.replace(start, end, new)
        whole = bpe.PrefixTable(own.vocabulary, data[:start] + new + data[end:])
        assert (table.data, table.last) == (whole.data, whole.last)


def test_digests_of_odd_rows(odd, none, encoders):
    own, library = encoders
    found = bpe.encoding_digests(odd, catalog.VOCABULARY, public_tokenizers.PATTERN)
    for row, (doc_id, text, *_) in zip(found.collect(), ODD_ROWS, strict=True):
        ids = library.encode_ordinary(text or "")
        assert row["doc_id"] == doc_id and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    args = none, catalog.VOCABULARY, public_tokenizers.PATTERN
    assert bpe.encoding_digests(*args).count() == 0
    assert bpe.encode_documents(odd, *args[1:]).count() == len(ODD_ROWS)


def test_mix_of_odd_rows(odd, none):
    found = mixing.mix_sources(odd).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(0 <= row["taken"] <= 3 * row["size"] for row in found)
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(odd).count() == sum(row["copies"] for row in found)


@needs_tables
def test_mix_equals_its_sql(spark):
    name = "op8_entropy_mix"
    assert difference(catalog.QUERIES[name](spark, SF), SF, catalog.ORACLE[name]) is None


def check_vectors(rows, found):
    usable = [
        (i, v, label) for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    links, sets = Counter(), {}
    for i, v, label in usable:
        near = {
            j for j, w, other in usable
            if other == label and len(v) == len(w)
            and np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.93
        }
        links[i], sets[i] = len(near - {i}), near
    roots = {i: i for i, _, _ in rows}
    for _ in rows:
        for i, near in sets.items():
            roots[i] = min(roots[j] for j in near | {i})
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {
        i: (links[i], roots[i], roots[i] == i) for i, _, _ in rows
    }


@pytest.mark.parametrize("cell", [1000, 4])
def test_close_vectors(spark, cell):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(6, 8))
    vectors = [(base[i % 6] + rng.normal(size=8) * 0.08 * (i % 4)).tolist() for i in range(40)]
    rows = [(i, vector, i % 2) for i, vector in enumerate(vectors)]
    rows += [(100, vectors[0], 0), (101, vectors[0], 0), (102, None, 0), (103, [0.0] * 8, 0)]
    rows += [(104, vectors[0], None), (105, [None] + [1.0] * 7, 0), (106, [float("nan")] * 8, 0)]
    rows += [(107, [2 * x for x in vectors[0]], 0), (108, [1.0, 2.0], 0), (109, [2.0, 4.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check_vectors(rows, covertree.close_vectors(frame, covertree.Settings(cell=cell)).collect())
    assert covertree.close_vectors(frame.limit(0)).count() == 0


def test_licences(spark, odd, none):
    lines = {
        1: ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        2: ("Code: released under the MIT License", "MIT"),
        3: ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
        4: ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
        5: ("Her driving license was not valid in the city.", "unknown"),
    }
    rows = [(i, f"Some prose.\n{line}\n") for i, (line, _) in lines.items()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(licences.licence_paragraphs(frame))
    assert {i: found[i]["family"] for i in lines} == {i: f for i, (_, f) in lines.items()}
    assert all(found[i]["confirmed"] == (lines[i][1] != "unknown") for i in lines)
    assert licences.licence_paragraphs(odd).where("confirmed").count() == 0
    assert licences.licence_paragraphs(none).count() == 0
    plan = licences.licence_paragraphs(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
GPL_TEXT = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL_TEXT = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_wrapped_licences_and_tags(spark):
    texts = {"MIT": MIT_TEXT, "BSD": BSD_TEXT, "GPL": GPL_TEXT, "LGPL": LGPL_TEXT, "MPL-2.0": MPL_TEXT}
    cases = [(family, f"{head}\n\n{text}\n\nSome prose.") for family, text in texts.items()
             for head in ("Some prose.", "Copyright (c) 2020 Someone")]
    cases += [(family, "/*\n" + "".join(f" * {line}\n" for line in text.split("\n")) + " */\nint x;")
              for family, text in texts.items()]
    cases += [(family, "#!/bin/sh\r\n" + "".join(f"# {line}\r\n" for line in text.split("\n")))
              for family, text in texts.items()]
    tags = {"MIT": "MIT", "BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD", "MPL-2.0": "MPL-2.0",
            "GPL-2.0-only": "GPL", "GPL-3.0-or-later": "GPL", "LGPL-2.1-only": "LGPL",
            "Apache-2.0": "Apache-2.0", "CC-BY-4.0": "CC-BY", "CC-BY-SA-4.0": "CC-BY-SA"}
    cases += [(family, f"// SPDX-License-Identifier: {tag}\nint x;") for tag, family in tags.items()]
    frame = spark.createDataFrame(
        [(i, text) for i, (_, text) in enumerate(cases)], "doc_id long, text string"
    )
    found = licences.licence_paragraphs(frame).where("confirmed").collect()
    got = {i: {row["family"] for row in found if row["doc_id"] == i} for i in range(len(cases))}
    assert got == {i: {family} for i, (family, _) in enumerate(cases)}


def test_plain_pairs_equal_the_columns(spark):
    rows = [(text,) for texts in licences.NOTICES.values() for text in texts]
    frame = spark.createDataFrame(rows, "text string")
    pairs = licences._pairs(licences.word_list(F.col("text")))
    for row in frame.select("text", pairs.alias("pairs")).collect():
        assert licences.plain_pairs(row["text"]) == sorted(set(row["pairs"]))


def test_lines_with_a_licence_each_stay_apart(spark):
    text = (
        "Code: released under the MIT License\nData: licensed under CC BY-NC 4.0\n"
        "Docs: licensed under the Apache License, Version 2.0\n"
        "// SPDX-License-Identifier: MPL-2.0\n// SPDX-License-Identifier: GPL-2.0-only"
    )
    frame = spark.createDataFrame([(1, text), (2, text.lower())], "doc_id long, text string")
    found = licences.licence_paragraphs(frame).where("confirmed").collect()
    for doc_id in (1, 2):
        assert [row["family"] for row in found if row["doc_id"] == doc_id] == [
            "MIT", "CC-BY-NC", "Apache-2.0", "MPL-2.0", "GPL"
        ]


def accuracy(rows, labels, target):
    known = {row["doc_id"]: row[target] for row in labels.collect()}
    judged = [r["predicted"] == known[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in known]
    return sum(judged) / len(judged)


@needs_tables
def test_classifiers_on_held_out_rows(docs, labels, odd, none):
    assert accuracy(toxicity.toxicity(docs, labels).collect(), labels, "toxic") > 0.95
    assert accuracy(neighbours.quality(docs, labels).collect(), labels, "quality") > 0.95
    for operator in (toxicity.toxicity, neighbours.quality):
        scores = operator(odd, labels).collect()
        assert len(scores) == len(ODD_ROWS)
        assert all(0 <= row["score"] <= 1 for row in scores)
        assert operator(none, labels).count() == 0
        assert operator(odd, labels.limit(0)).count() == len(ODD_ROWS)


def test_transducers_mark_matches():
    symbols = [(toxicity.NEGATION, 0), (toxicity.OTHER, 0), (toxicity.INSULT, 2.0)]
    assert list(toxicity.matches(symbols, 3)) == [(toxicity.NEGATED, 2.0)]
    symbols = [(toxicity.REPORT, 0), (toxicity.TARGET, 0), (toxicity.INSULT, 1.0)]
    wanted = toxicity.REPORTED | toxicity.TARGETED
    assert list(toxicity.matches(symbols, 3)) == [(wanted, 1.0)]


def test_pipeline_stages_on_odd_rows(spark, odd, none):
    for frame in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, frame, "")
            assert result.columns == frame.columns
            result.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, "").count() == frame.count()


@needs_tables
def test_pipeline_of_the_table(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    kept = {row["doc_id"] for row in rows}
    rules = {r["doc_id"] for r in catalog.op1_compression_bands(spark, SF).collect() if r["kept"]}
    assert kept <= rules and len(kept) > 0.6 * len(rules)

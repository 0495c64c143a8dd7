"""The pipeline's rows on a small table, stage by stage beside plain steps."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from test_operators import linked_components, shingles

import corpus_pipeline
from kinetable.llm import catalog, compression, mixing, pii

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaoinshrdlu"), n)) for n in rng.integers(2, 9, 400)]

    def prose(count):
        return " ".join(rng.choice(words, count))

    rows = [(i, prose(int(rng.integers(60, 300))), "en", f"s{i % 3}", 0) for i in range(40)]
    for i in range(40, 60):  # near copies of some of them
        text = rows[i % 10][1].split()
        text[int(rng.integers(len(text)))] = "changed"
        rows.append((i, " ".join(text), "en", f"s{i % 4}", 0))
    rows += [
        (60, rows[3][1], "de", "s0", 0),
        (61, rows[3][1].upper(), "de", "s0", 0),
        (62, prose(80) + " mail a.b@c.org or 10.0.0.255 " + prose(10), "en", None, 0),
        (63, "few words", "en", "s1", 0),
        (64, None, "en", "s1", None),
        (65, "", "en", "s1", 0),
        (66, prose(70) + " é 中文 😀", None, "s2", 0),
        (None, prose(90), "en", "s2", 0),
    ]
    return rows


def test_pipeline_equals_plain_steps(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rules = compression.compression_rules(docs).where("kept").select("doc_id").collect()
    allowed = {row["doc_id"] for row in rules}
    left = sorted(
        (row for row in rows if row[0] in allowed), key=lambda row: (row[0] is None, row[0] or 0)
    )
    assert {63, 64, 65}.isdisjoint(allowed) and len(left) > 50
    roots = linked_components([shingles(row[1], 5) for row in left])
    left = [row for place, row in enumerate(left) if roots[place] == place]
    assert len(left) < 50

    redacted = pii.redact_documents(spark.createDataFrame(left, COLUMNS))
    texts = {row["doc_id"]: row["text"] for row in redacted.collect()}
    assert "a.b@c.org" not in texts[62] and "10.0.0.255" not in texts[62]
    assert sum(texts[row[0]] != row[1] for row in left) == 1
    mixed = mixing.mix_sources(redacted).collect()

    with open(catalog.VOCABULARY, "rb") as lines:
        split = (line.split() for line in lines if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in split}
    library = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = Counter()
    for row in mixed:
        text = texts[row["doc_id"]]
        ids = library.encode_ordinary(text)
        digests = ",".join(map(str, ids)).encode(), text.encode()
        key = (row["doc_id"], len(ids), *(hashlib.sha256(one).hexdigest() for one in digests))
        expected[key] += row["copies"]
    assert found == +expected


def test_stages_bound_the_batches_of_a_session(spark, tmp_path):
    docs = spark.range(0, 5_000, 1, 1).selectExpr("id doc_id", "'some words' text", "'web' source")
    chosen = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["doc_id"])

    for name in corpus_pipeline.BATCH:
        spark.conf.unset(name)
    try:
        spark.conf.set(chosen, "5m")
        for _, stage in corpus_pipeline.STAGES[:1]:
            stage(spark, docs, str(tmp_path))
        rows = docs.select("doc_id").mapInArrow(sizes, "doc_id long").collect()
        assert max(row["doc_id"] for row in rows) <= 1_000 and len(rows) >= 5
        assert spark.conf.get(chosen) == "5m"
    finally:
        for name in corpus_pipeline.BATCH:
            spark.conf.unset(name)

from __future__ import annotations

import hashlib

import pytest

from kinetable.operators import splits


def expected_ranks(subjects, seed=42):
    return sorted(subjects, key=lambda s: hashlib.sha256(f"{seed}:{s}".encode()).digest())


def assigned(spark, subjects, train=0.70, validation=0.15):
    frame = spark.createDataFrame([(s,) for s in subjects], "subject_id int")
    found = splits.subject_splits(
        frame, seed=42, train_fraction=train, validation_fraction=validation
    )
    return sorted(found.collect(), key=lambda row: row["subject_rank"])


def test_published_subjects(spark):
    rows = assigned(spark, [s for s in range(1600, 1651) for _ in range(3)])
    assert [row["subject_id"] for row in rows] == expected_ranks(range(1600, 1651))
    assert [row["subject_rank"] for row in rows] == list(range(51))
    of_split = {
        split: [row["subject_id"] for row in rows if row["split"] == split]
        for split in ("train", "validation", "test")
    }
    assert len(of_split["train"]) == 35
    assert of_split["validation"] == [1601, 1623, 1613, 1608, 1650, 1626, 1649, 1641]
    assert of_split["test"] == [1644, 1606, 1648, 1645, 1631, 1637, 1621, 1620]


@pytest.mark.parametrize("count", [1, 2, 3, 7, 20, 40, 5000])
def test_ranks_and_cuts_against_a_plain_sort(spark, count):
    subjects = range(-3, count - 3)
    rows = assigned(spark, subjects)
    order = expected_ranks(subjects)
    train_end, validation_end = int(count * 0.70), int(count * (0.70 + 0.15))
    expected = [
        (s, i, "train" if i < train_end else "validation" if i < validation_end else "test")
        for i, s in enumerate(order)
    ]
    assert [tuple(row) for row in rows] == expected


def test_one_subject_is_test(spark):
    assert [tuple(row) for row in assigned(spark, [1600] * 5)] == [(1600, 0, "test")]


def skewed_features(spark, rows=60_000):
    return spark.range(0, rows, 1, 12).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 500) as int) as subject_id",
        "substr('ABC', cast(id % 3 as int) + 1, 1) as activity",
        "id as window_id",
        "repeat('x', 50) as padding",
    )


@pytest.fixture
def stored(spark, tmp_path, monkeypatch):
    """A third of the rows on one subject, and the stored subject table."""
    monkeypatch.setattr(splits, "HOT_SHARE", 100)
    features = skewed_features(spark)
    ranked = splits.ranked_subjects(
        features, seed=42, train_fraction=0.7, validation_fraction=0.15
    )
    ranked.write.parquet(f"{tmp_path}/ranked")
    return features, spark.read.parquet(f"{tmp_path}/ranked")


def test_a_small_subject_table_is_broadcast(stored):
    features, ranked = stored
    joined = splits.attach_splits(features, ranked)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    pairs = joined.select("subject_id", "split").distinct()
    assert pairs.count() == pairs.select("subject_id").distinct().count() == 500


def test_a_large_subject_table_is_shuffled_without_its_hot_subjects(stored):
    features, ranked = stored
    joined = splits.attach_splits(features, ranked, broadcast_rows=499)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "LeftAnti" in plan
    everything = splits.attach_splits(features, ranked)
    assert joined.columns == everything.columns
    assert joined.count() == 60_000
    assert joined.exceptAll(everything).isEmpty()
    assert [row["subject_id"] for row in ranked.where("is_hot").collect()] == [7]


def test_subjects_are_hashed_after_they_are_distinct(spark):
    """The readings must not be hashed, and their subjects are collected once."""
    table = splits.subject_splits(
        skewed_features(spark), seed=42, train_fraction=0.7, validation_fraction=0.15
    )
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert "sha2" not in plan


def test_summary(spark):
    rows = [(1, "A", "train"), (1, "B", "train"), (2, "A", "train"), (3, "C", "test"), (3, "C", "test")]
    frame = spark.createDataFrame(rows, "subject_id int, activity string, split string")
    found = {(row["metric"], row["key"]): row["value"] for row in splits.dataset_summary(frame).collect()}
    assert found == {
        ("feature_windows", "all"): 5,
        ("subjects", "all"): 3,
        ("activities", "all"): 3,
        ("split_windows", "train"): 3,
        ("split_windows", "test"): 2,
        ("split_subjects", "train"): 2,
        ("split_subjects", "test"): 1,
    }


def test_summary_of_nothing_counts_zero(spark):
    frame = spark.createDataFrame([], "subject_id int, activity string, split string")
    found = {(row["metric"], row["key"]): row["value"] for row in splits.dataset_summary(frame).collect()}
    assert found == {
        ("feature_windows", "all"): 0,
        ("subjects", "all"): 0,
        ("activities", "all"): 0,
    }

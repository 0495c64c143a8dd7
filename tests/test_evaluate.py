from __future__ import annotations

import json
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from kinetable.operators import evaluate


def cells_of(spark, pairs):
    return evaluate.confusion_counts(spark.createDataFrame(pairs, "actual string, predicted string"))


@pytest.fixture
def small(spark):
    return cells_of(spark, [("A", "A"), ("A", "B"), ("B", "B"), ("B", "B")])


def test_counts_and_dense_table(small):
    assert sorted(map(tuple, small.collect())) == [("A", "A", 1), ("A", "B", 1), ("B", "B", 2)]
    dense = evaluate.dense_confusion(small, ["A", "B"])
    assert sorted(map(tuple, dense.collect())) == [
        ("A", "A", 1),
        ("A", "B", 1),
        ("B", "A", 0),
        ("B", "B", 2),
    ]
    assert "Join" not in dense._jdf.queryExecution().executedPlan().toString()


def test_per_class_and_macro(small):
    per_class = evaluate.per_class_metrics(small, ["A", "B"])
    found = {row["activity"]: tuple(row)[1:] for row in per_class.collect()}
    assert found["A"] == pytest.approx((1.0, 0.5, 2 / 3, 2))
    assert found["B"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    macro = evaluate.macro_metrics(per_class).first()
    assert tuple(macro) == pytest.approx((5 / 6, 0.75, 11 / 15))


def test_unseen_labels_score_zero(small):
    per_class = evaluate.per_class_metrics(small, ["A", "B", "C"])
    found = {row["activity"]: tuple(row)[1:] for row in per_class.collect()}
    assert found["C"] == (0.0, 0.0, 0.0, 0)
    assert evaluate.macro_metrics(per_class).first()["macro_recall"] == pytest.approx(0.5)


def test_labels_outside_the_list_are_left_out(spark):
    cells = cells_of(spark, [("A", "A"), ("A", "Z"), ("Z", "A")])
    (row,) = evaluate.per_class_metrics(cells, ["A"]).collect()
    assert tuple(row) == ("A", 1.0, 1.0, 1.0, 1)


def test_normalized_rows(small):
    found = {tuple(row)[:2]: row["fraction"] for row in evaluate.normalized_confusion(small, ["A", "B", "C"]).collect()}
    assert found[("A", "A")] == found[("A", "B")] == 0.5
    assert found[("B", "B")] == 1.0
    assert [found[("C", label)] for label in "ABC"] == [0.0, 0.0, 0.0]


def test_overall_matches_the_mllib_evaluator(spark):
    rng = random.Random(3)
    pairs = [(float(rng.randrange(4)), float(rng.randrange(5))) for _ in range(500)]
    predictions = spark.createDataFrame(pairs, "label double, prediction double")
    named = evaluate.named_predictions(predictions, list("ABCDE"))
    overall = evaluate.overall_metrics(evaluate.confusion_counts(named)).first()
    evaluator = MulticlassClassificationEvaluator()
    assert overall["test_predictions"] == 500
    for metric, name in (("accuracy", "accuracy"), ("weighted_f1", "f1")):
        expected = evaluator.setMetricName(name).evaluate(predictions)
        assert overall[metric] == pytest.approx(expected, abs=1e-12)


def test_one_hot_pair_is_combined_before_the_shuffle(spark):
    pairs = spark.range(0, 9000, 1, 9).selectExpr(
        "if(id % 3 = 0, 'A', substr('BCD', cast(id % 3 as int), 1)) as actual", "'A' as predicted"
    )
    cells = evaluate.confusion_counts(pairs)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert sum(row["count"] for row in cells.collect()) == 9000


def test_ranking_is_from_worst_to_best_with_names(small):
    per_class = evaluate.per_class_metrics(small, ["A", "B", "Z"])
    rows = sorted(evaluate.class_f1_ranking(per_class).collect())
    assert [(row["rank"], row["activity"], row["activity_name"]) for row in rows] == [
        (1, "Z", "Z"),
        (2, "A", "Walking"),
        (3, "B", "Jogging"),
    ]


def test_records_hold_everything(small):
    record = evaluate.metrics_record(
        small,
        ["A", "B"],
        model="m",
        feature_columns=["x_mean"],
        split_counts={"train": 7, "test": 4},
        training_seconds=1.5,
        inference_seconds=2.0,
    ).first()
    assert record["accuracy"] == 0.75
    assert record["macro_recall"] == 0.75
    assert record["test_predictions"] == 4
    assert record["predictions_per_second"] == 2.0
    assert record["split_counts"] == {"train": 7, "test": 4}
    assert [entry["activity"] for entry in record["per_class"]] == ["A", "B"]
    (confusion,) = evaluate.confusion_record(small, ["A", "B"], "m").toJSON().collect()
    assert json.loads(confusion)["rows"][1] == {"actual": "A", "predicted": "B", "count": 1}


def test_no_throughput_without_time(small):
    record = evaluate.metrics_record(small, ["A"], model="m", inference_seconds=0.0).first()
    assert record["predictions_per_second"] is None

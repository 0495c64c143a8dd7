"""Predictions from stored numbers, beside small plain versions and MLlib."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kinetable.operators import evaluate, learn, replay
from kinetable.sources import artifacts

SETTINGS = learn.ModelSettings(max_iter=200, num_trees=7, max_depth=6)
NODES = "tree int, node int, feature int, threshold double, left int, right int, counts array<double>"


@pytest.fixture(scope="module")
def features(spark):
    frame = spark.range(900).select(
        (F.col("id") % 30).cast("int").alias("subject_id"),
        F.substring(F.lit("ABC"), (F.col("id") % 3).cast("int") + 1, F.lit(1)).alias("activity"),
        F.col("id").alias("window_id"),
        ((F.col("id") % 3) + 2 * F.rand(1)).alias("x_mean"),
        (F.rand(2) * (F.col("id") % 2)).alias("y_mean"),
        F.lit(4.0).alias("z_mean"),
        F.when(F.col("id") % 30 < 20, "train")
        .when(F.col("id") % 30 < 25, "validation")
        .otherwise("test")
        .alias("split"),
    )
    return frame.cache()


@pytest.fixture(scope="module")
def forest(features, tmp_path_factory):
    (fitted,) = learn.fit_models(features, ("random_forest",), settings=SETTINGS, seed=42)
    path = str(tmp_path_factory.mktemp("forest") / "model")
    artifacts.save_pipeline(fitted.pipeline, path)
    return fitted, path


def test_nodes_make_whole_trees(spark, forest):
    fitted, path = forest
    nodes = replay.forest_nodes(spark, path).collect()
    trees = {}
    for node in nodes:
        trees.setdefault(node["tree"], {})[node["node"]] = node
    assert sorted(trees) == list(range(7))
    for number, tree in trees.items():
        model = fitted.pipeline.stages[-1].trees[number]
        assert len(tree) == model.numNodes
        assert sorted(tree) == list(range(len(tree)))
        for node in tree.values():
            if node["left"] is None:
                assert node["feature"] is node["right"] is None
                continue
            parts = tree[node["left"]]["counts"], tree[node["right"]]["counts"]
            assert [a + b for a, b in zip(*parts, strict=True)] == pytest.approx(node["counts"])


def test_walk_votes_as_the_forest_does(spark, features, forest):
    fitted, path = forest
    rows = fitted.pipeline.transform(learn.of_split(features, "test"))
    rows = rows.withColumns(
        {"values": vector_to_array("features"), "theirs": vector_to_array("rawPrediction")}
    )
    table = replay.forest_table(replay.forest_nodes(spark, path), 3)
    assert table.count() == 1
    voted = replay.forest_votes(rows, table, SETTINGS.max_depth)
    plan = voted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    found = voted.collect()
    assert len(found) == 150
    for row in found:
        assert row["voted"] == row["prediction"]
        assert row["votes"] == pytest.approx(row["theirs"])
    # Depth is what bounds the walk: one step stops below the roots.
    short = replay.forest_votes(rows, table, 1).collect()
    assert any(row["votes"] != pytest.approx(row["theirs"]) for row in short)


def test_walk_by_hand(spark):
    nodes = spark.createDataFrame(
        [
            (0, 0, 1, 0.5, 1, 2, [3.0, 1.0]),
            (0, 1, None, None, None, None, [3.0, 0.0]),
            (0, 2, None, None, None, None, [0.0, 1.0]),
            (1, 0, None, None, None, None, [1.0, 3.0]),
        ],
        NODES,
    )
    rows = spark.createDataFrame(
        [(1, [9.0, 0.5]), (2, [9.0, 0.6]), (3, [9.0, float("nan")]), (4, [9.0])],
        "id int, values array<double>",
    )
    found = replay.forest_votes(rows, replay.forest_table(nodes, 2), 3)
    votes = {row["id"]: (row["votes"], row["voted"]) for row in found.collect()}
    # At the threshold to the left; NaN is above all; rows of another width find no forest.
    assert votes == {1: ([1.25, 0.75], 0.0), 2: ([0.25, 1.75], 1.0), 3: ([0.25, 1.75], 1.0)}


def test_tied_votes_go_to_the_first_label(spark):
    nodes = spark.createDataFrame([(0, 0, None, None, None, None, [2.0, 2.0])], NODES)
    rows = spark.createDataFrame([([1.0],)], "values array<double>")
    (row,) = replay.forest_votes(rows, replay.forest_table(nodes, 1), 2).collect()
    assert (row["votes"], row["voted"]) == ([0.5, 0.5], 0.0)


def test_regression_chances_by_hand(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), ([800.0, 0.0],)], "values array<double>")
    weights, intercepts = [[1.0, 0.0], [0.0, 1.0]], [0.5, -0.5]
    first, large = replay.regression_chances(rows, weights, intercepts).collect()
    assert first["chances"] == pytest.approx([0.5, 0.5])
    assert first["scored"] == 0.0
    assert large["chances"] == pytest.approx([1.0, 0.0])


@pytest.mark.parametrize(("reg_param", "elastic"), [(0.05, 0.0), (0.01, 1.0), (0.02, 0.5)])
def test_regression_is_replayed_and_at_its_optimum(features, reg_param, elastic):
    settings = learn.ModelSettings(
        max_iter=500, reg_param=reg_param, elastic_net_param=elastic
    )
    (fitted,) = learn.fit_models(features, ("logistic_regression",), settings=settings, seed=42)
    model = fitted.pipeline.stages[-1]
    numbers = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
    test = replay.prepared_rows(fitted.pipeline, learn.of_split(features, "test"))
    theirs = fitted.pipeline.stages[-1].transform(test)
    ours = replay.regression_chances(
        theirs.withColumn("theirs", vector_to_array("probability")), *numbers
    )
    for row in ours.collect():
        assert row["chances"] == pytest.approx(row["theirs"])
        assert row["scored"] == row["prediction"]
    train = replay.prepared_rows(fitted.pipeline, learn.of_split(features, "train"))
    settled = {"reg_param": reg_param, "elastic_net_param": elastic}
    slopes = replay.regression_slopes(train, *numbers, **settled).collect()
    assert len(slopes) == 3 * 4
    assert {row["feature"] for row in slopes} == {-1, 0, 1, 2}
    assert max(abs(row["slope"]) for row in slopes) < 2e-3
    # Away from the optimum there is a slope.
    moved = [[weight + 0.3 for weight in row] for row in numbers[0][:1]] + numbers[0][1:]
    steep = replay.regression_slopes(train, moved, numbers[1], **settled).collect()
    assert max(abs(row["slope"]) for row in steep) > 2e-2


def test_evaluator_agrees_with_counted_metrics(spark):
    pairs = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0)]
    predictions = spark.createDataFrame(pairs, "label double, prediction double")
    labels = ["A", "B", "C", "D"]
    theirs = {row["activity"]: row for row in evaluate.evaluator_metrics(predictions, labels).collect()}
    assert set(theirs) == {"A", "B", "C"}
    indexed = predictions.groupBy("label", "prediction").agg(F.count("*").alias("count"))
    cells = evaluate.named_predictions(indexed, labels).select("actual", "predicted", "count")
    for row in evaluate.per_class_metrics(cells, labels).collect():
        if row["activity"] in theirs:
            other = theirs[row["activity"]]
            for name in ("precision", "recall", "f1"):
                assert math.isclose(row[name], other[name], abs_tol=1e-12)
    overall = evaluate.overall_metrics(cells).first()
    assert overall["accuracy"] == pytest.approx(theirs["A"]["accuracy"])
    assert overall["weighted_f1"] == pytest.approx(theirs["A"]["weighted_f1"])

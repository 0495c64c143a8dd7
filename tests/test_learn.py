from __future__ import annotations

import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from kinetable.operators import learn

SETTINGS = learn.ModelSettings(max_iter=20, num_trees=5, max_depth=4)


@pytest.fixture(scope="module")
def features(spark):
    frame = spark.range(600).select(
        (F.col("id") % 30).cast("int").alias("subject_id"),
        F.substring(F.lit("ABC"), (F.col("id") % 3).cast("int") + 1, F.lit(1)).alias("activity"),
        F.col("id").alias("window_id"),
        ((F.col("id") % 3) * 2 + F.rand(1)).alias("x_mean"),
        F.rand(2).alias("y_mean"),
        F.lit(4.0).alias("z_mean"),
        F.when(F.col("id") % 30 < 20, "train")
        .when(F.col("id") % 30 < 25, "validation")
        .otherwise("test")
        .alias("split"),
    )
    return frame.cache()


def test_split_counts_are_checked(features):
    assert learn.checked_split_counts(features) == {"train": 400, "validation": 100, "test": 100}
    with pytest.raises(ValueError, match="validation"):
        learn.checked_split_counts(features.where("split <> 'validation'"))


def test_unknown_model(features):
    with pytest.raises(ValueError, match="svm"):
        learn.fit_models(features, ("svm",), seed=42)


@pytest.mark.parametrize("name", learn.MODELS)
def test_shared_preparation_equals_one_pipeline(features, name):
    (fitted,) = learn.fit_models(features, (name,), settings=SETTINGS, seed=42)
    columns = ["x_mean", "y_mean", "z_mean"]
    assert fitted.columns == columns
    assert len(fitted.pipeline.stages) == 4
    train = learn.of_split(features, "train")
    prepared = Pipeline(stages=learn.preparation(columns).getStages()).fit(train)
    keys = ["subject_id", "activity", "window_id"]
    partitions = SETTINGS.partitions_for(train.count())
    examples = learn.dealt(prepared.transform(train), keys, partitions)
    model = learn.classifier(name, SETTINGS, 42).fit(examples)
    whole = PipelineModel(stages=[*prepared.stages, model])
    test = learn.of_split(features, "test")
    ours = learn.predict(fitted.pipeline, test, ("window_id",)).collect()
    theirs = learn.predict(whole, test, ("window_id",)).collect()
    assert sorted(ours) == sorted(theirs)
    assert sum(row["label"] == row["prediction"] for row in ours) > 90


def test_a_model_depends_on_rows_and_settings_only(features):
    settings = replace(SETTINGS, rows_per_partition=60)

    def trees(frame):
        (fitted,) = learn.fit_models(frame, ("random_forest",), settings=settings, seed=42)
        text = fitted.pipeline.stages[-1].toDebugString.split("\n", 1)[1]
        # The scaler's sums may differ in their last bit.
        return re.sub(r"[0-9]+[.][0-9]+", lambda found: f"{float(found.group()):.9f}", text)

    shuffled = features.orderBy(F.rand(3)).repartition(7)
    assert trees(features) == trees(shuffled) == trees(features.coalesce(1))


def test_labels_are_alphabetical_and_from_train(features):
    (fitted,) = learn.fit_models(
        features, ("logistic_regression",), settings=SETTINGS, seed=42
    )
    assert fitted.labels == ["A", "B", "C"]
    rows = learn.label_index(learn.of_split(features, "train")).collect()
    assert sorted(map(tuple, rows)) == [("A", 0.0), ("B", 1.0), ("C", 2.0)]
    strange = learn.of_split(features, "test").withColumn("activity", F.lit("Z"))
    with pytest.raises(Exception, match="Unseen label"):
        learn.predict(fitted.pipeline, strange).collect()


def test_scaling_uses_train_statistics_only(features):
    scaled = learn.scaled_features(features, ("window_id", "split"))
    train = scaled.where("split = 'train'").agg(
        F.avg("x_mean"), F.stddev_samp("x_mean"), F.max("z_mean"), F.min("z_mean")
    )
    mean, deviation, *constant = train.first()
    assert mean == pytest.approx(0.0, abs=1e-9)
    assert deviation == pytest.approx(1.0)
    assert constant == [0.0, 0.0]


def test_partitions_follow_rows_and_settings():
    assert learn.ModelSettings().partitions_for(0) == 1
    assert learn.ModelSettings().partitions_for(2048) == 1
    assert learn.ModelSettings().partitions_for(12_690) == 7
    assert learn.ModelSettings().partitions_for(10**12) == 4096
    assert learn.ModelSettings(rows_per_partition=100).partitions_for(400) == 4


def test_evaluation(features):
    counts = learn.checked_split_counts(features)
    (fitted,) = learn.fit_models(
        features, ("logistic_regression",), settings=SETTINGS, seed=42
    )
    cells, record = learn.evaluate_model(fitted, features, split_counts=counts)
    assert "Scan ExistingRDD" in cells._jdf.queryExecution().executedPlan().toString()
    row = record.first()
    assert row["test_predictions"] == 100 == sum(cell["count"] for cell in cells.collect())
    assert row["split_counts"] == counts
    assert row["labels"] == ["A", "B", "C"]
    assert row["accuracy"] > 0.9
    assert row["inference_seconds"] > 0


def test_a_fitted_pipeline_survives_saving(features, tmp_path):
    (fitted,) = learn.fit_models(features, ("random_forest",), settings=SETTINGS, seed=42)
    fitted.pipeline.write().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    test = learn.of_split(features, "test")
    assert sorted(learn.predict(loaded, test, ("window_id",)).collect()) == sorted(
        learn.predict(fitted.pipeline, test, ("window_id",)).collect()
    )


def test_logistic_regression_is_at_the_optimum(features):
    """The regularised likelihood has no slope left, computed without MLlib."""
    settings = learn.ModelSettings(max_iter=200, reg_param=0.05)
    (fitted,) = learn.fit_models(
        features, ("logistic_regression",), settings=settings, seed=42
    )
    train = learn.of_split(features, "train").toPandas()
    columns = ["x_mean", "y_mean", "z_mean"]
    values = train[columns].to_numpy()
    spread = values.std(axis=0, ddof=1)
    scaled = (values - values.mean(axis=0)) / np.where(spread > 0, spread, 1.0)
    truth = np.eye(3)[train["activity"].map({"A": 0, "B": 1, "C": 2})]

    model = fitted.pipeline.stages[-1]
    weights = model.coefficientMatrix.toArray()
    scores = scaled @ weights.T + model.interceptVector.toArray()
    chances = np.exp(scores - scores.max(axis=1, keepdims=True))
    chances /= chances.sum(axis=1, keepdims=True)
    slope = (chances - truth).T @ scaled / len(train) + settings.reg_param * weights
    assert np.abs(slope).max() < 1e-4
    assert np.abs((chances - truth).mean(axis=0)).max() < 1e-4

    test = learn.of_split(features, "test")
    found = learn.predict(fitted.pipeline, test, tuple(columns)).toPandas()
    rows = (found[columns].to_numpy() - values.mean(axis=0)) / np.where(spread > 0, spread, 1.0)
    expected = (rows @ weights.T + model.interceptVector.toArray()).argmax(axis=1)
    assert (found["prediction"] == expected).all()


def test_random_forest_takes_the_vote_of_its_trees(features):
    (fitted,) = learn.fit_models(features, ("random_forest",), settings=SETTINGS, seed=42)
    forest = fitted.pipeline.stages[-1]
    assert forest.getNumTrees == 5
    assert max(tree.depth for tree in forest.trees) <= 4
    rows = fitted.pipeline.transform(learn.of_split(features, "test")).collect()
    for row in rows[:30]:
        votes = sum(
            tree.predictRaw(row["features"]).toArray() / tree.predictRaw(row["features"]).toArray().sum()
            for tree in forest.trees
        )
        assert row["prediction"] == votes.argmax()

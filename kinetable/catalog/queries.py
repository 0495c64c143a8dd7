"""The registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import submit
from ..operators import evaluate, learn, records, replay, splits, windows
from ..operators.fusion import WINDOW_KEYS, fuse_sensors, fuse_sensors_by_join, model_columns
from ..plans import jobs
from ..plans.settings import JobSettings
from ..sources import artifacts
from ..sources.staging import StageArea
from ..sources.text import read_lines
from . import fixtures
from .fixtures import LABELS, SENSORS, SETTINGS, TIE_BREAK

Query = Callable[[SparkSession, str], DataFrame]


def rounded(frame: DataFrame, *, exact: tuple[str, ...] = ("_min", "_max")) -> DataFrame:
    """Double columns rounded to 6 places for comparison.

    Means of a few short decimals can lie exactly between two rounded values, where the
    last bit decides.  The small addend moves them off that point, here and in the SQL,
    and also rules out negative zero.  Minima and maxima are input values and stay
    exact, unless ``exact`` says otherwise.
    """

    def shown(name: str, kind: str):
        if kind != "double" or name.endswith(exact):
            return F.col(name)
        return (F.round(F.col(name) + F.lit(TIE_BREAK), 6) + F.lit(0.0)).alias(name)

    return frame.select(*(shown(name, kind) for name, kind in frame.dtypes))


# --- parse ---------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_records(fixtures.raw_lines(spark, sf_dir))


def _line_folders(spark: SparkSession, sf_dir: str) -> str:
    """The lines as text files under their source folders; returns their glob."""
    base = f"{StageArea(spark).path}/raw"
    lines = fixtures.raw_lines(spark, sf_dir)
    folder = F.regexp_extract("source_file", "/raw/(.*)/a.txt", 1)
    # Four folders: two sound ones, one unknown device, one unknown sensor.
    for name in ("Watch/accel", "Watch/gyro", "tablet/accel", "watch/light"):
        lines.where(folder == name).select("value").write.mode("errorifexists").text(
            f"{base}/{name}"
        )
    return f"{base}/*/*/*.txt"


def parse_records(spark, sf_dir):
    return _parsed(spark, sf_dir)


def parse_text_files(spark, sf_dir):
    lines = read_lines(spark, _line_folders(spark, sf_dir))
    return records.parse_records(lines).drop("source_file")


def parse_quality(spark, sf_dir):
    return records.parse_quality(_parsed(spark, sf_dir))


def valid_records(spark, sf_dir):
    return records.valid_records(_parsed(spark, sf_dir), SETTINGS.device, SENSORS)


# --- windows, fusion and splits ------------------------------------------------


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_features(
        fixtures.samples(spark, sf_dir),
        window_seconds=SETTINGS.window_seconds,
        minimum_samples=SETTINGS.minimum_samples,
    )


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuse_sensors(_windows(spark, sf_dir), SENSORS)


def _split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = StageArea(spark)
    stored = stage.table(_windows(spark, sf_dir), "windows")
    return jobs.with_subject_splits(fuse_sensors(stored, SENSORS), SETTINGS, stage)


def _feature_files(spark: SparkSession, sf_dir: str) -> str:
    path = f"{StageArea(spark).path}/features"
    artifacts.write_features(_split_features(spark, sf_dir), path)
    return path


def _stored_split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split features as the training jobs get them: from files."""
    return artifacts.read_features(spark, _feature_files(spark, sf_dir))


def window_features(spark, sf_dir):
    return rounded(_windows(spark, sf_dir))


def fused_features(spark, sf_dir):
    return rounded(_fused(spark, sf_dir))


def fused_features_join(spark, sf_dir):
    stored = StageArea(spark).table(_windows(spark, sf_dir), "windows")
    return rounded(fuse_sensors_by_join(stored, SENSORS))


def subject_splits(spark, sf_dir):
    return splits.subject_splits(
        _fused(spark, sf_dir),
        seed=SETTINGS.seed,
        train_fraction=SETTINGS.train_fraction,
        validation_fraction=SETTINGS.validation_fraction,
    )


def split_features(spark, sf_dir):
    return rounded(_split_features(spark, sf_dir))


def split_counts(spark, sf_dir):
    return splits.split_counts(_split_features(spark, sf_dir))


def dataset_summary(spark, sf_dir):
    return splits.dataset_summary(_split_features(spark, sf_dir))


def prepared_features(spark, sf_dir):
    lines = fixtures.raw_lines(spark, sf_dir)
    return rounded(jobs.prepare_features(lines, SETTINGS, StageArea(spark)).features)


def prepared_quality(spark, sf_dir):
    tallied = windows.tallied_windows(
        _parsed(spark, sf_dir),
        device=SETTINGS.device,
        sensors=SENSORS,
        window_seconds=SETTINGS.window_seconds,
    )
    return windows.tallied_quality(tallied)


def _prepared_run(spark: SparkSession, sf_dir: str, settings: JobSettings = SETTINGS) -> str:
    """The output folder of the whole job over text files."""
    output = f"{StageArea(spark).path}/run"
    jobs.prepare(spark, _line_folders(spark, sf_dir), output, settings)
    return output


def prepare_job(spark, sf_dir):
    output = _prepared_run(spark, sf_dir)
    return rounded(artifacts.read_features(spark, f"{output}/features"))


def prepare_job_single_sensor(spark, sf_dir):
    """The job with one sensor, whose windows pass without fusion."""
    output = _prepared_run(spark, sf_dir, replace(SETTINGS, sensors=("accel",)))
    return rounded(artifacts.read_features(spark, f"{output}/features"))


def prepare_job_summary(spark, sf_dir):
    """The counts in the stored data summary as ``(metric, key, value)``."""
    output = _prepared_run(spark, sf_dir)
    summary = artifacts.read_summary(spark, f"{output}/data_summary_json")
    entry = "struct<metric: string, key: string, value: bigint>"

    def of_map(metric: str):
        return F.transform(
            F.map_entries(metric),
            lambda pair: F.struct(F.lit(metric), pair["key"], pair["value"]).cast(entry),
        )

    maps = [of_map(name) for name in ("parse_counts", "split_windows", "split_subjects")]
    totals = [
        F.struct(F.lit(name), F.lit("all"), F.col(name)).cast(entry)
        for name in ("feature_windows", "subjects", "activities", "lines")
    ]
    return summary.select(F.inline(F.concat(F.array(*totals), *maps)))


def feature_roundtrip(spark, sf_dir):
    return rounded(_stored_split_features(spark, sf_dir))


# --- evaluation ----------------------------------------------------------------


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(fixtures.predictions(spark, sf_dir))


def confusion(spark, sf_dir):
    return _cells(spark, sf_dir)


def confusion_dense(spark, sf_dir):
    return evaluate.dense_confusion(_cells(spark, sf_dir), LABELS)


def confusion_normalized(spark, sf_dir):
    return rounded(evaluate.normalized_confusion(_cells(spark, sf_dir), LABELS))


def per_class_metrics(spark, sf_dir):
    return rounded(evaluate.per_class_metrics(_cells(spark, sf_dir), LABELS))


def macro_metrics(spark, sf_dir):
    return rounded(
        evaluate.macro_metrics(evaluate.per_class_metrics(_cells(spark, sf_dir), LABELS))
    )


def overall_metrics(spark, sf_dir):
    return rounded(evaluate.overall_metrics(_cells(spark, sf_dir)))


def class_f1_ranking(spark, sf_dir):
    per_class = evaluate.per_class_metrics(_cells(spark, sf_dir), LABELS)
    return rounded(evaluate.class_f1_ranking(per_class))


def _stored_metrics(pairs: DataFrame, model: str, folder: str) -> str:
    cells = evaluate.confusion_counts(pairs)
    path = f"{folder}/{model}/metrics_json"
    artifacts.write_record(evaluate.metrics_record(cells, LABELS, model=model), path)
    return path


def metrics_json_roundtrip(spark, sf_dir):
    """The whole metrics object as read back, a row for each class in it."""
    features = _stored_split_features(spark, sf_dir)
    record = evaluate.metrics_record(
        _cells(spark, sf_dir),
        LABELS,
        model="fixture",
        feature_columns=model_columns(features),
        split_counts=learn.checked_split_counts(features),
    )
    path = f"{StageArea(spark).path}/fixture/metrics_json"
    artifacts.write_record(record, path)
    metrics = artifacts.read_metrics(spark, path)
    return rounded(
        metrics.select(
            "model",
            "accuracy",
            "weighted_f1",
            "macro_precision",
            "macro_recall",
            "macro_f1",
            "test_predictions",
            F.array_join("labels", ",").alias("labels"),
            F.array_join("feature_columns", ",").alias("feature_columns"),
            *(F.try_element_at("split_counts", F.lit(name)).alias(f"{name}_windows") for name in learn.SPLITS),
            F.inline("per_class"),
        )
    )


def confusion_json_roundtrip(spark, sf_dir):
    path = f"{StageArea(spark).path}/confusion_json"
    record = evaluate.confusion_record(_cells(spark, sf_dir), LABELS, "fixture")
    artifacts.write_record(record, path)
    return artifacts.read_confusion(spark, path)


def experiment_summary(spark, sf_dir):
    """Two conditions (all events, and purchases left out) by two sets of predictions."""
    stage = StageArea(spark)
    pairs = fixtures.predictions(spark, sf_dir)
    always_a = pairs.withColumn("predicted", F.lit("A"))
    runs = {}
    for condition, kept in (("all", F.lit(True)), ("no C", F.col("actual") != "C")):
        runs[condition] = [
            _stored_metrics(frame.where(kept), model, f"{stage.path}/{condition}")
            for model, frame in (("guess", pairs), ("constant", always_a))
        ]
    path = f"{stage.path}/experiment_summary"
    table = jobs.experiment_table(spark, runs, path)
    stored = spark.read.schema(table.schema).option("header", True).csv(path)
    return rounded(stored.select("condition", "model", "accuracy", "macro_f1", "test_windows"))


# --- models --------------------------------------------------------------------


def label_index(spark, sf_dir):
    return learn.label_index(learn.of_split(_stored_split_features(spark, sf_dir), "train"))


def scaled_features(spark, sf_dir):
    features = _stored_split_features(spark, sf_dir)
    return rounded(learn.scaled_features(features, WINDOW_KEYS), exact=())


def _fitted(name: str, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, learn.Fitted]:
    features = _stored_split_features(spark, sf_dir)
    (fitted,) = learn.fit_models(features, (name,), settings=SETTINGS.models, seed=SETTINGS.seed)
    return features, fitted


def _near(one, other):
    return F.abs(one - other) <= 1e-9


def _all_near(one: str, other: str):
    apart = F.zip_with(one, other, lambda x, y: F.abs(x - y))
    return (F.size(one) == F.size(other)) & (F.array_max(apart) <= 1e-9)


def lr_predictions(spark, sf_dir):
    """Test rows with MLlib's prediction and the one made of the coefficients.

    ``at_optimum`` says that no slope of the regularised likelihood is left, so the
    coefficients are the ones that the train rows determine.
    """
    features, fitted = _fitted("logistic_regression", spark, sf_dir)
    model = fitted.pipeline.stages[-1]
    numbers = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
    settings = SETTINGS.models
    train = replay.prepared_rows(fitted.pipeline, learn.of_split(features, "train"))
    slopes = replay.regression_slopes(
        train,
        *numbers,
        reg_param=settings.reg_param,
        elastic_net_param=settings.elastic_net_param,
    )
    steepest = slopes.agg(F.max(F.abs("slope"))).first()[0]
    predicted = fitted.pipeline.transform(learn.of_split(features, "test"))
    predicted = predicted.withColumns(
        {"values": vector_to_array("features"), "theirs": vector_to_array("probability")}
    )
    ours = replay.regression_chances(predicted, *numbers)
    return ours.select(
        *(key for key in WINDOW_KEYS),
        "label",
        (F.col("prediction") == F.col("scored")).alias("same_prediction"),
        _all_near("theirs", "chances").alias("same_chances"),
        F.lit(steepest < 1e-3).alias("at_optimum"),
    )


def rf_predictions(spark, sf_dir):
    """Test rows with MLlib's vote and that of a walk through the stored trees."""
    features, fitted = _fitted("random_forest", spark, sf_dir)
    path = f"{StageArea(spark).path}/model"
    artifacts.save_pipeline(fitted.pipeline, path)
    nodes = replay.forest_nodes(spark, path)
    predicted = fitted.pipeline.transform(learn.of_split(features, "test"))
    predicted = predicted.withColumns(
        {"values": vector_to_array("features"), "theirs": vector_to_array("rawPrediction")}
    )
    forest = replay.forest_table(nodes, len(fitted.columns))
    voted = replay.forest_votes(predicted, forest, SETTINGS.models.max_depth)
    return voted.select(
        *(key for key in WINDOW_KEYS),
        "label",
        (F.col("prediction") == F.col("voted")).alias("same_prediction"),
        _all_near("theirs", "votes").alias("same_votes"),
        F.lit(SETTINGS.models.num_trees).alias("trees"),
        F.round(F.aggregate("votes", F.lit(0.0), lambda x, y: x + y), 6).alias("votes"),
    )


def model_comparison(spark, sf_dir):
    """The stored metrics of both models, class by class, against MLlib's evaluator.

    The predictions are those of the stored pipelines, loaded again.
    """
    files = _feature_files(spark, sf_dir)
    stage = StageArea(spark)
    output = f"{stage.path}/run"
    metrics = jobs.train(spark, files, output, SETTINGS)
    test = learn.of_split(artifacts.read_features(spark, files), "test")
    theirs = []
    for name in learn.MODELS:
        pipeline = artifacts.load_pipeline(f"{output}/{name}/model")
        pairs = learn.predict(pipeline, test).select("label", "prediction")
        pairs = stage.table(pairs, f"predictions-{name}")
        found = evaluate.evaluator_metrics(pairs, list(pipeline.stages[0].labels))
        theirs.append(found.withColumn("model", F.lit(name)))
    theirs = theirs[0].unionByName(theirs[1])
    measures = ("accuracy", "weighted_f1", "precision", "recall", "f1")
    theirs = theirs.withColumnsRenamed({name: f"their_{name}" for name in measures})
    ours = metrics.select(
        "model",
        "accuracy",
        "weighted_f1",
        "macro_f1",
        "test_predictions",
        "split_counts",
        F.inline("per_class"),
    )
    together = ours.join(theirs, ["model", "activity"], "left")
    # A class without test rows scores zero here and is unknown to the evaluator.
    unseen = F.col("support") == 0
    zero = (F.col("recall") == 0) & (F.col("f1") == 0)
    macro = F.avg("f1").over(Window.partitionBy("model"))
    return together.select(
        "model",
        "activity",
        "support",
        "test_predictions",
        F.try_element_at("split_counts", F.lit("train")).alias("train_windows"),
        *(
            F.when(unseen, zero).otherwise(_near(F.col(name), F.col(f"their_{name}"))).alias(f"same_{name}")
            for name in measures
        ),
        _near(F.col("macro_f1"), macro).alias("same_macro_f1"),
    )


def run_job(spark, sf_dir):
    """The submitted job from text files to the comparison, read back from what it wrote.

    ``(artifact, metric, key, value)``: counts in the features, the summary, and each
    model's metrics, confusion and comparison objects.
    """
    given = submit.arguments(
        [
            "run",
            *("--raw", _line_folders(spark, sf_dir)),
            *("--output", f"{StageArea(spark).path}/runs"),
            *("--window-seconds", str(SETTINGS.window_seconds)),
            *("--minimum-samples", str(SETTINGS.minimum_samples)),
            *("--max-iter", "5", "--num-trees", "3", "--max-depth", "3"),
        ]
    )
    output = submit.execute(spark, given)

    def entry(artifact: str, metric: str, key, value):
        return F.struct(
            F.lit(artifact).alias("artifact"),
            F.lit(metric).alias("metric"),
            (key if isinstance(key, Column) else F.lit(key)).alias("key"),
            F.col(value).cast("bigint").alias("value"),
        )

    features = artifacts.read_features(spark, f"{output}/features")
    counted = features.groupBy("split", "activity").agg(F.count("*").alias("n"))
    rows = [counted.select(entry("features", "windows", F.concat_ws("/", "split", "activity"), "n"))]
    summary = artifacts.read_summary(spark, f"{output}/data_summary_json")
    rows.append(summary.select(entry("data_summary", "lines", "all", "lines")))
    rows.append(summary.select(entry("data_summary", "windows", "all", "feature_windows")))
    comparison = artifacts.read_comparison(spark, f"{output}/comparison_json", learn.MODELS)
    for model in learn.MODELS:
        cells = artifacts.read_confusion(spark, f"{output}/{model}/confusion_json")
        actual = cells.groupBy("actual").agg(F.sum("count").alias("n"))
        rows.append(actual.select(entry(f"{model}/confusion", "actual", F.col("actual"), "n")))
        for artifact, metrics in (
            (f"{model}/metrics", artifacts.read_metrics(spark, f"{output}/{model}/metrics_json")),
            (f"{model}/comparison", comparison.select(f"{model}.*")),
        ):
            support = metrics.select(F.inline("per_class"))
            rows.append(support.select(entry(artifact, "support", F.col("activity"), "support")))
            splits_of = metrics.select(F.explode("split_counts").alias("split", "n"))
            rows.append(splits_of.select(entry(artifact, "windows", F.col("split"), "n")))
    united = reduce(DataFrame.union, (frame.toDF("one") for frame in rows))
    return united.select("one.*")


def model_roundtrip(spark, sf_dir):
    """Test rows predicted by a fitted pipeline and by the same one read from files."""
    features = _stored_split_features(spark, sf_dir)
    (fitted,) = learn.fit_models(
        features, ("random_forest",), settings=SETTINGS.models, seed=SETTINGS.seed
    )
    path = f"{StageArea(spark).path}/model"
    artifacts.save_pipeline(fitted.pipeline, path)
    keys = ("subject_id", "device", "window_id")
    once = learn.predict(
        fitted.pipeline, learn.of_split(features, "test"), (*keys, *fitted.columns)
    ).withColumnsRenamed({"label": "first_label", "prediction": "first_prediction"})
    again = artifacts.load_pipeline(path).transform(once)
    return again.select(
        *keys,
        "activity",
        "label",
        (F.col("label") == F.col("first_label")).alias("same_label"),
        (F.col("prediction") == F.col("first_prediction")).alias("same_prediction"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        parse_records,
        parse_text_files,
        parse_quality,
        valid_records,
        window_features,
        fused_features,
        fused_features_join,
        subject_splits,
        split_features,
        split_counts,
        dataset_summary,
        prepared_features,
        prepared_quality,
        prepare_job,
        prepare_job_single_sensor,
        prepare_job_summary,
        feature_roundtrip,
        confusion,
        confusion_dense,
        confusion_normalized,
        per_class_metrics,
        macro_metrics,
        overall_metrics,
        class_f1_ranking,
        metrics_json_roundtrip,
        confusion_json_roundtrip,
        experiment_summary,
        label_index,
        scaled_features,
        lr_predictions,
        rf_predictions,
        model_comparison,
        model_roundtrip,
        run_job,
    )
}

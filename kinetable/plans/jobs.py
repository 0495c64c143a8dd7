"""Prepare features from raw lines, train on them, or both."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import confusion_record
from ..operators.fusion import fuse_sensors, model_columns
from ..operators.learn import (
    MODELS,
    checked_split_counts,
    evaluate_model,
    fit_models,
)
from ..operators.records import parse_records
from ..operators.splits import attach_splits, dataset_summary, ranked_subjects
from ..operators.windows import accepted_windows, tallied_quality, tallied_windows
from ..sources.artifacts import (
    comparison_record,
    experiment_rows,
    read_features,
    read_metrics,
    save_pipeline,
    write_csv,
    write_features,
    write_record,
)
from ..sources.folders import refuse_existing
from ..sources.staging import StageArea
from ..sources.text import read_lines
from .settings import JobSettings


@dataclass(frozen=True)
class Prepared:
    """Split features and the parse counts behind them, both still lazy."""

    features: DataFrame
    quality: DataFrame


def with_subject_splits(features: DataFrame, settings: JobSettings, stage: StageArea) -> DataFrame:
    """Features with rank and split; give it a frame that is stored, or cheap over one.

    Ranking reads the subjects of the features first, without their other columns.  The
    subject table is stored, so that its size is known before the join.
    """
    ranked = ranked_subjects(
        features,
        seed=settings.seed,
        train_fraction=settings.train_fraction,
        validation_fraction=settings.validation_fraction,
    )
    return attach_splits(features, stage.table(ranked, "ranked_subjects"))


def prepare_features(
    lines: DataFrame,
    settings: JobSettings,
    stage: StageArea,
    observed: Observation | None = None,
) -> Prepared:
    """Raw lines to split features with a single pass over the lines.

    The pass ends in a stored window table, far smaller than the lines.  Quality counts,
    subject ranking and fusion read that, each only the columns it needs.  ``observed``
    gets the number of ``lines`` from that pass, as the sum over the windows it writes;
    it is for reports of speed, as a repeated task may count twice.
    """
    tallied = tallied_windows(
        parse_records(lines),
        device=settings.device,
        sensors=list(settings.sensors),
        window_seconds=settings.window_seconds,
    )
    if observed:
        counted = F.coalesce(F.sum("sample_count"), F.lit(0).cast("bigint"))
        tallied = tallied.observe(observed, counted.alias("lines"))
    tallied = stage.table(tallied, "windows")
    windows = accepted_windows(tallied, minimum_samples=settings.minimum_samples)
    fused = fuse_sensors(windows, list(settings.sensors))
    return Prepared(with_subject_splits(fused, settings, stage), tallied_quality(tallied))


def _literal(value) -> Column:
    """A setting or a count, or a list or dictionary of a few, as a column."""
    if isinstance(value, dict):
        parts = [F.lit(part) for pair in sorted(value.items()) for part in pair]
        return F.create_map(*parts).cast("map<string,bigint>")
    if isinstance(value, list | tuple):
        return F.array(*map(F.lit, value)).cast("array<string>")
    return F.lit(value)


def summary_record(features: DataFrame, details: dict) -> DataFrame:
    """The data summary as one row; ``details`` are further values for it."""

    def of_metric(metric: str, value: Column) -> Column:
        return F.when(F.col("metric") == metric, value)

    def total(metric: str) -> Column:
        return F.max(of_metric(metric, F.col("value"))).alias(metric)

    def by_split(metric: str) -> Column:
        # One entry per split.
        entries = F.collect_list(of_metric(metric, F.struct("key", "value")))
        return F.map_from_entries(F.array_sort(entries)).alias(metric)

    record = dataset_summary(features).agg(
        *map(total, ("feature_windows", "subjects", "activities")),
        *map(by_split, ("split_windows", "split_subjects")),
    )
    return record.withColumns({name: _literal(value) for name, value in details.items()})


def prepare(spark: SparkSession, raw: str, output: str, settings: JobSettings) -> DataFrame:
    """Parse, window, fuse and split; write ``features`` and ``data_summary_json``."""
    refuse_existing(spark, output)
    started = time.perf_counter()
    stage = StageArea(spark, below=output)
    lines = Observation("lines")
    try:
        prepared = prepare_features(read_lines(spark, raw), settings, stage, lines)
        write_features(prepared.features, f"{output}/features")
        seconds = time.perf_counter() - started
        quality = {str(row["_parse_ok"]).lower(): row["count"] for row in prepared.quality.collect()}
    finally:
        stage.remove()
    features = read_features(spark, f"{output}/features", prepared.features.schema)
    details = {
        "raw_path": raw,
        "device": settings.device,
        "sensors": list(settings.sensors),
        "window_seconds": settings.window_seconds,
        "minimum_samples": settings.minimum_samples,
        "parse_counts": quality,
        "feature_columns": model_columns(features),
        "preprocessing_seconds": seconds,
        "lines": lines.get["lines"],
        "lines_per_second": lines.get["lines"] / seconds if seconds else None,
    }
    write_record(summary_record(features, details), f"{output}/data_summary_json")
    return features


def compare_models(
    features: DataFrame, settings: JobSettings, output: str, names: tuple[str, ...] = MODELS
) -> DataFrame:
    """Fit, evaluate and store each model; returns one metrics row per model.

    The validation rows are counted but choose nothing: the comparison is fixed.
    """
    spark = features.sparkSession
    refuse_existing(spark, *(f"{output}/{name}" for name in (*names, "comparison_json")))
    counts = checked_split_counts(features)
    stage = StageArea(spark, below=output)
    paths = {}
    try:
        for fitted in fit_models(
            features,
            names,
            settings=settings.models,
            seed=settings.seed,
            stage=stage.table,
        ):
            folder = f"{output}/{fitted.name}"
            cells, record = evaluate_model(fitted, features, split_counts=counts)
            save_pipeline(fitted.pipeline, f"{folder}/model")
            write_record(record, f"{folder}/metrics_json")
            confusion = confusion_record(cells, fitted.labels, fitted.name)
            write_record(confusion, f"{folder}/confusion_json")
            paths[fitted.name] = f"{folder}/metrics_json"
    finally:
        stage.remove()
    metrics = read_metrics(spark, list(paths.values()))
    write_record(comparison_record(metrics, list(paths)), f"{output}/comparison_json")
    return metrics


def train(
    spark: SparkSession, features_path: str, output: str, settings: JobSettings
) -> DataFrame:
    """Summarise stored features and compare the models on them."""
    refuse_existing(spark, output)
    features = read_features(spark, features_path)
    summary = summary_record(features, {"prepared_feature_path": features_path})
    write_record(summary, f"{output}/data_summary_json")
    return compare_models(features, settings, output)


def run(spark: SparkSession, raw: str, output: str, settings: JobSettings) -> DataFrame:
    """Prepare and compare in one job; the models read the written features."""
    refuse_existing(spark, output)
    return compare_models(prepare(spark, raw, output, settings), settings, output)


def experiment_table(
    spark: SparkSession, runs: dict[str, list[str]], output: str | None = None
) -> DataFrame:
    """One row per condition and model from stored metrics, also as CSV if asked.

    ``runs`` maps a condition name to the metrics paths of its run.
    """
    if not runs:
        raise ValueError("no run to tabulate")
    if output:
        refuse_existing(spark, output)
    tables = [experiment_rows(read_metrics(spark, paths), name) for name, paths in runs.items()]
    table = reduce(DataFrame.unionByName, tables)
    if output:
        write_csv(table, output)
    return table

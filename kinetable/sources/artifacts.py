"""Write-once results and the readers for them.

Every writer refuses a path that already exists.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SUMMARY_COLUMNS = (
    "condition",
    "model",
    "accuracy",
    "macro_f1",
    "training_seconds",
    "inference_seconds",
    "test_windows",
)

METRICS_SCHEMA = """
    model string, accuracy double, weighted_f1 double,
    macro_precision double, macro_recall double, macro_f1 double,
    training_seconds double, inference_seconds double, predictions_per_second double,
    test_predictions bigint, labels array<string>, feature_columns array<string>,
    split_counts map<string,bigint>,
    per_class array<struct<activity: string, f1: double, precision: double,
                           recall: double, support: bigint>>
"""

SUMMARY_SCHEMA = """
    feature_windows bigint, subjects bigint, activities bigint,
    split_windows map<string,bigint>, split_subjects map<string,bigint>,
    parse_counts map<string,bigint>, raw_path string, prepared_feature_path string,
    device string, sensors array<string>, window_seconds bigint, minimum_samples bigint,
    feature_columns array<string>, preprocessing_seconds double,
    lines bigint, lines_per_second double
"""


def new_run_id() -> str:
    """UTC second of the call, as the name of a run folder."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")


def write_features(features: DataFrame, path: str) -> None:
    """Features as Parquet, in a folder per split if they have one.

    Training and evaluation then list and read the files of their split only.
    """
    writer = features.write.mode("errorifexists")
    if "split" in features.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)


def read_features(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Stored features; the schema is only needed where there may be no rows at all."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def sorted_struct(frame: DataFrame) -> Column:
    """All columns as one struct in name order, so JSON keys come out sorted."""
    return F.struct(*sorted(frame.columns))


def write_record(record: DataFrame, path: str) -> None:
    """A one-row frame as a single JSON object with sorted keys."""
    line = F.to_json(sorted_struct(record), {"ignoreNullFields": "false"}).alias("value")
    record.select(line).coalesce(1).write.mode("errorifexists").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """A small frame as one CSV file with a header."""
    rows.coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def read_metrics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Metrics objects, one per file, on one line or pretty-printed."""
    return spark.read.schema(METRICS_SCHEMA).option("multiLine", True).json(path)


def read_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Data summaries, one per file, on one line or pretty-printed."""
    return spark.read.schema(SUMMARY_SCHEMA).option("multiLine", True).json(path)


def read_confusion(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Confusion cells: a file with an array or lines of cells, or one with ``rows``."""
    cell = "actual string, predicted string, count bigint"
    schema = f"{cell}, rows array<struct<{cell}>>"
    stored = spark.read.schema(schema).option("multiLine", True).json(path)
    single = F.array(F.struct("actual", "predicted", "count"))
    return stored.select(F.inline(F.coalesce("rows", single)))


def read_comparison(spark: SparkSession, path: str, models: Sequence[str]) -> DataFrame:
    """A comparison object: a column for each model, holding its metrics."""
    fields = ", ".join(f"{name} struct<{_as_fields(METRICS_SCHEMA)}>" for name in models)
    return spark.read.schema(fields).option("multiLine", True).json(path)


def _as_fields(schema: str) -> str:
    return StructType.fromDDL(schema).simpleString().removeprefix("struct<").removesuffix(">")


def comparison_record(metrics: DataFrame, models: list[str]) -> DataFrame:
    """Metrics rows as one row with a column per model."""
    whole = sorted_struct(metrics)
    return metrics.agg(
        *(F.first(F.when(F.col("model") == name, whole), True).alias(name) for name in models)
    )


def save_pipeline(pipeline: PipelineModel, path: str) -> None:
    pipeline.write().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def experiment_rows(metrics: DataFrame, condition: str) -> DataFrame:
    """Metrics objects as rows of the experiment table, under one condition name."""
    return metrics.select(
        F.lit(condition).alias("condition"),
        *SUMMARY_COLUMNS[1:-1],
        F.col("test_predictions").alias("test_windows"),
    )

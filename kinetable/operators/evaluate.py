"""Classification metrics from a confusion count table.

Predictions are read once, by ``confusion_counts``; everything else works on its
result, which has at most one row per pair of labels.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.activities import activity_name
from ..functions.expressions import guarded_ratio


def _label_array(labels: list[str]) -> Column:
    return F.array(*(F.lit(label) for label in labels))


def named_predictions(predictions: DataFrame, labels: list[str]) -> DataFrame:
    """Label and prediction indices as label names ``actual`` and ``predicted``."""
    names = _label_array(labels)
    return predictions.withColumns(
        {
            "actual": F.get(names, F.col("label").cast("int")),
            "predicted": F.get(names, F.col("prediction").cast("int")),
        }
    )


def confusion_counts(pairs: DataFrame) -> DataFrame:
    """Number of rows per pair of actual and predicted label."""
    return pairs.groupBy("actual", "predicted").agg(F.count("*").alias("count"))


def dense_confusion(cells: DataFrame, labels: list[str]) -> DataFrame:
    """One row for every pair of the given labels, zero where nothing was counted."""
    names = _label_array(labels)
    grid = cells.sparkSession.range(1).select(F.explode(names).alias("actual"))
    grid = grid.select("actual", F.explode(names).alias("predicted"))
    zeros = grid.select("*", F.lit(0).cast("bigint").alias("count"), F.lit(1).alias("listed"))
    counted = cells.select("actual", "predicted", "count", F.lit(0).alias("listed"))
    # The condition on an aggregate stays here; one on the labels would be pushed down
    # and tested on every prediction.
    summed = zeros.union(counted).groupBy("actual", "predicted")
    summed = summed.agg(F.sum("count").alias("count"), F.max("listed").alias("listed"))
    return summed.where(F.col("listed") == 1).drop("listed")


def normalized_confusion(cells: DataFrame, labels: list[str]) -> DataFrame:
    """The dense table as fractions of each actual label; an empty row stays 0.0."""
    row_total = F.sum("count").over(Window.partitionBy("actual"))
    fraction = guarded_ratio(F.col("count"), row_total)
    return dense_confusion(cells, labels).select(
        "actual", "predicted", fraction.alias("fraction")
    )


def _label_totals(cells: DataFrame) -> DataFrame:
    """Times a label was meant, predicted, and both."""
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(none)

    def share(label: str, meant: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(label).alias("activity"),
            meant.alias("meant"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    shares = cells.select(
        F.inline(
            F.array(
                share("actual", F.col("count"), none, hit),
                share("predicted", none, F.col("count"), none),
            )
        )
    )
    return shares.groupBy("activity").agg(
        F.sum("meant").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )


def _scored(cells: DataFrame) -> DataFrame:
    """Per label: support, hits and the three scores."""
    totals = _label_totals(cells)
    scored = totals.withColumns(
        {
            "precision": guarded_ratio(F.col("hits"), F.col("predicted")),
            "recall": guarded_ratio(F.col("hits"), F.col("support")),
        }
    )
    product = F.lit(2.0) * F.col("precision") * F.col("recall")
    return scored.withColumn("f1", guarded_ratio(product, F.col("precision") + F.col("recall")))


def per_class_metrics(cells: DataFrame, labels: list[str]) -> DataFrame:
    """Precision, recall, F1 and support of each given label, also of unseen ones."""
    scored = _scored(dense_confusion(cells, labels))
    return scored.select("activity", "precision", "recall", "f1", "support")


def _macro_means() -> list[Column]:
    return [F.avg(name).alias(f"macro_{name}") for name in ("precision", "recall", "f1")]


def _overall_measures() -> list[Column]:
    support = F.sum("support")
    return [
        guarded_ratio(F.sum("hits"), support).alias("accuracy"),
        guarded_ratio(F.sum(F.col("f1") * F.col("support")), support).alias("weighted_f1"),
        support.alias("test_predictions"),
    ]


def macro_metrics(per_class: DataFrame) -> DataFrame:
    """Unweighted means over the label list."""
    return per_class.agg(*_macro_means())


def overall_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, support-weighted F1 and number of predictions."""
    return _scored(cells).agg(*_overall_measures())


def class_f1_ranking(per_class: DataFrame) -> DataFrame:
    """Classes from the lowest F1 up, with readable names; ties go by label."""
    # One row per class, so one task may order them.
    order = Window.orderBy("f1", "activity")
    return per_class.select(
        F.row_number().over(order).alias("rank"),
        "activity",
        activity_name(F.col("activity")).alias("activity_name"),
        "f1",
    )


def metrics_record(
    cells: DataFrame,
    labels: list[str],
    *,
    model: str,
    feature_columns: list[str] | None = None,
    split_counts: dict[str, int] | None = None,
    training_seconds: float | None = None,
    inference_seconds: float | None = None,
) -> DataFrame:
    """All metrics of one model as a single row, ready for the JSON writer."""
    by_class = F.struct("activity", "f1", "precision", "recall", "support")
    record = _scored(dense_confusion(cells, labels)).agg(
        *_overall_measures(),
        *_macro_means(),
        F.array_sort(F.collect_list(by_class)).alias("per_class"),
    )
    counts = [F.lit(part) for pair in sorted((split_counts or {}).items()) for part in pair]
    inference = F.lit(inference_seconds).cast("double")
    return record.withColumns(
        {
            "model": F.lit(model),
            "labels": _label_array(labels),
            "feature_columns": _label_array(feature_columns or []).cast("array<string>"),
            "split_counts": F.create_map(*counts).cast("map<string,bigint>"),
            "training_seconds": F.lit(training_seconds).cast("double"),
            "inference_seconds": inference,
            "predictions_per_second": F.try_divide(F.col("test_predictions"), inference),
        }
    )


def evaluator_metrics(predictions: DataFrame, labels: list[str]) -> DataFrame:
    """``activity, accuracy, weighted_f1, precision, recall, f1`` as MLlib's evaluator has them.

    One row for each label with test rows, for comparison with the metrics from counts;
    the evaluator reads ``label`` and ``prediction`` once for each of them.
    """
    evaluator = MulticlassClassificationEvaluator()

    def of(metric: str, label: float = 0.0) -> float:
        evaluator.setParams(metricName=metric, metricLabel=label)
        return evaluator.evaluate(predictions)

    overall = of("accuracy"), of("f1")
    by_label = ("precisionByLabel", "recallByLabel", "fMeasureByLabel")
    seen = sorted(row["label"] for row in predictions.select("label").distinct().collect())
    rows = [
        (labels[int(label)], *overall, *(of(metric, label) for metric in by_label)) for label in seen
    ]
    kinds = "activity string, accuracy double, weighted_f1 double, "
    return predictions.sparkSession.createDataFrame(
        rows, kinds + "precision double, recall double, f1 double"
    )


def confusion_record(cells: DataFrame, labels: list[str], model: str) -> DataFrame:
    """The dense table of one model as a single row, cells in label order."""
    cell = F.struct("actual", "predicted", "count")
    rows = dense_confusion(cells, labels).agg(F.array_sort(F.collect_list(cell)).alias("rows"))
    return rows.select(F.lit(model).alias("model"), "rows")

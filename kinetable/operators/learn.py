"""MLlib classifiers over window features, fitted on train subjects only."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import metrics_record, named_predictions
from .fusion import WINDOW_KEYS, model_columns

SPLITS = ("train", "validation", "test")
MODELS = ("logistic_regression", "random_forest")


@dataclass(frozen=True)
class ModelSettings:
    """Hyperparameters of both classifiers; the defaults are the published ones."""

    max_iter: int = 80
    reg_param: float = 0.05
    elastic_net_param: float = 0.0
    num_trees: int = 80
    max_depth: int = 12
    feature_subset_strategy: str = "sqrt"
    # Node statistics held per task and pass, as MLlib has it.  Once it binds, nodes are
    # split in other groups, which can change the trees.
    max_memory_mb: int = 512
    # Bagging is seeded per partition, so what decides their number is part of a model's
    # settings: rows of a partition, and the most partitions.  Cores play no part.
    rows_per_partition: int = 2048
    most_partitions: int = 4096

    def partitions_for(self, rows: int) -> int:
        """Partitions of that many train rows; few rows make few, as each costs a task."""
        return max(1, min(self.most_partitions, -(-rows // self.rows_per_partition)))


@dataclass(frozen=True)
class Fitted:
    """A fitted four-stage pipeline and the time its fit took."""

    name: str
    pipeline: PipelineModel
    seconds: float
    columns: list[str] = field(default_factory=list)

    @property
    def labels(self) -> list[str]:
        return list(self.pipeline.stages[0].labels)


def preparation(columns: list[str]) -> Pipeline:
    """Label index in alphabetical order, feature vector, standardised vector."""
    return Pipeline(
        stages=[
            StringIndexer(
                inputCol="activity",
                outputCol="label",
                stringOrderType="alphabetAsc",
                handleInvalid="error",
            ),
            VectorAssembler(
                inputCols=columns, outputCol="unscaled_features", handleInvalid="error"
            ),
            StandardScaler(
                inputCol="unscaled_features", outputCol="features", withMean=True, withStd=True
            ),
        ]
    )


def classifier(name: str, settings: ModelSettings, seed: int):
    """The unfitted classifier of that name."""
    if name == "logistic_regression":
        return LogisticRegression(
            family="multinomial",
            maxIter=settings.max_iter,
            regParam=settings.reg_param,
            elasticNetParam=settings.elastic_net_param,
        )
    if name == "random_forest":
        return RandomForestClassifier(
            seed=seed,
            numTrees=settings.num_trees,
            maxDepth=settings.max_depth,
            featureSubsetStrategy=settings.feature_subset_strategy,
            maxMemoryInMB=settings.max_memory_mb,
        )
    raise ValueError(f"unknown model {name!r}; known models are {', '.join(MODELS)}")


def of_split(features: DataFrame, split: str) -> DataFrame:
    return features.where(F.col("split") == split)


def checked_split_counts(features: DataFrame) -> dict[str, int]:
    """Rows per split in one pass; an empty split is an error."""
    counted = features.groupBy("split").count().where(F.col("split").isin(*SPLITS))
    counts = dict.fromkeys(SPLITS, 0) | {row["split"]: row["count"] for row in counted.collect()}
    empty = [split for split, rows in counts.items() if rows == 0]
    if empty:
        raise ValueError(f"no rows in split {', '.join(empty)}: {counts}")
    return counts


def dealt(examples: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """``label, features`` in partitions and an order that follow from the rows alone."""
    values = vector_to_array("features")
    rows = examples.repartition(partitions, *keys or [values])
    return rows.sortWithinPartitions(*keys, "label", values).select("label", "features")


def fit_models(
    features: DataFrame,
    names: tuple[str, ...] = MODELS,
    *,
    settings: ModelSettings | None = None,
    seed: int,
    stage=None,
) -> Iterator[Fitted]:
    """Fit the named classifiers on the train rows, each as it is asked for.

    Index, vector and scaling are the same for all of them, so they are fitted once
    and every returned pipeline carries them.  A model's seconds include that share.
    ``stage(frame, name)`` stores the examples, so that fits do not prepare them again.

    Examples are counted, dealt by their keys into partitions of ``rows_per_partition``
    and sorted there, so a model depends on the rows and the settings, not on files,
    their order or cores.
    """
    settings = settings or ModelSettings()
    estimators = [(name, classifier(name, settings, seed)) for name in names]
    columns = model_columns(features)
    keys = [name for name in (*WINDOW_KEYS, "sensor") if name in features.columns]
    train = of_split(features, "train").select("*")

    started = time.perf_counter()
    prepared = preparation(columns).fit(train)
    examples = prepared.transform(train).select(*keys, "label", "features")
    if stage:
        examples = stage(examples, "examples")
    examples = dealt(examples, keys, settings.partitions_for(examples.count()))
    preparation_seconds = time.perf_counter() - started

    def fit(name: str, estimator) -> Fitted:
        started = time.perf_counter()
        model = estimator.fit(examples)
        seconds = preparation_seconds + time.perf_counter() - started
        return Fitted(name, PipelineModel(stages=[*prepared.stages, model]), seconds, columns)

    return (fit(name, estimator) for name, estimator in estimators)


def predict(pipeline: PipelineModel, rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Optional key columns, then activity, label and prediction."""
    return pipeline.transform(rows).select(*keys, "activity", "label", "prediction")


def evaluate_model(
    fitted: Fitted, features: DataFrame, *, split_counts: dict[str, int]
) -> tuple[DataFrame, DataFrame]:
    """Confusion counts and the metrics row of one model on the test rows.

    The test rows are read once, to be predicted and counted; that is the time given as
    inference.  The counts are at most one row for each pair of labels, and every
    metric is derived from them.
    """
    predictions = predict(fitted.pipeline, of_split(features, "test"))
    indexed = predictions.groupBy("label", "prediction").agg(F.count("*").alias("count"))
    started = time.perf_counter()
    counted = indexed.collect()
    seconds = time.perf_counter() - started
    indexed = features.sparkSession.createDataFrame(counted, indexed.schema)
    cells = named_predictions(indexed, fitted.labels).select("actual", "predicted", "count")
    record = metrics_record(
        cells,
        fitted.labels,
        model=fitted.name,
        feature_columns=fitted.columns,
        split_counts=split_counts,
        training_seconds=fitted.seconds,
        inference_seconds=seconds,
    )
    return cells, record


def label_index(train: DataFrame) -> DataFrame:
    """Activity codes and the label number the models use for them."""
    indexer = preparation(["unused"]).getStages()[0]
    indexed = indexer.fit(train).transform(train.select("activity"))
    return indexed.select("activity", "label").distinct()


def scaled_features(features: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """All rows with their features standardised by train mean and deviation."""
    columns = model_columns(features)
    stages = preparation(columns).getStages()[1:]
    fitted = Pipeline(stages=stages).fit(of_split(features, "train"))
    scaled = fitted.transform(features).select(*keys, vector_to_array("features").alias("scaled"))
    return scaled.select(*keys, *(F.col("scaled")[i].alias(name) for i, name in enumerate(columns)))

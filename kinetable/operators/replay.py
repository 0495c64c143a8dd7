"""Predictions made anew from the numbers of a fitted model, beside those of MLlib.

A stored forest is a table of nodes, a regression two arrays; a prediction is then an
expression over them, without the model object.  So a stored model can be checked, or
used where MLlib is not, and a fit can be checked at its optimum.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _largest(values: Column) -> Column:
    """Place of the largest value from 0, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def prepared_rows(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows with ``values``, the scaled vector that the classifier sees, as an array."""
    prepared = PipelineModel(stages=pipeline.stages[:-1]).transform(rows)
    return prepared.withColumn("values", vector_to_array("features"))


# --- forest -----------------------------------------------------------------------------


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``tree, node, feature, threshold, left, right, counts`` of a stored random forest.

    ``path`` is the folder of a saved pipeline whose last stage is the forest.  A leaf has
    no feature and no children; ``counts`` are the train rows of each label at a node.
    """
    stored = spark.read.parquet(f"{path}/stages/*_RandomForestClassifier_*/data")
    node = "nodeData"
    inner = F.col(f"{node}.leftChild") >= 0
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col(f"{node}.id").alias("node"),
        F.when(inner, F.col(f"{node}.split.featureIndex")).alias("feature"),
        F.get(f"{node}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.when(inner, F.col(f"{node}.leftChild")).alias("left"),
        F.when(inner, F.col(f"{node}.rightChild")).alias("right"),
        F.col(f"{node}.impurityStats").alias("counts"),
    )


def forest_table(nodes: DataFrame, width: int) -> DataFrame:
    """All trees as one row ``width, trees``; a tree is its nodes in order.

    Its size is bounded by the model's settings: trees times nodes of the depth.
    """
    node = F.struct("node", "feature", "threshold", "left", "right", "counts")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    tree = F.struct("tree", "nodes")
    return trees.agg(
        # Of an aggregate the optimiser makes no literal, so the join stays one on a key.
        F.max(F.lit(width)).alias("width"),
        F.array_sort(F.collect_list(tree)).alias("trees"),
    )


def forest_votes(rows: DataFrame, forest: DataFrame, depth: int) -> DataFrame:
    """The rows with ``votes`` and ``voted``, by a walk through every tree.

    Each tree gives its leaf's shares of the labels, added up in the order of the trees.
    Nothing is shuffled: the forest's single row goes to the rows of its width.
    """

    def leaf(tree: Column, values: Column) -> Column:
        nodes = tree["nodes"]

        def step(at: Column, _: Column) -> Column:
            node = F.get(nodes, at)
            goes_left = F.get(values, node["feature"]) <= node["threshold"]
            moved = F.when(goes_left, node["left"]).otherwise(node["right"])
            return F.when(node["left"].isNull(), at).otherwise(moved)

        place = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
        return F.get(nodes, place)["counts"]

    def shares(tree: Column) -> Column:
        counts = leaf(tree, F.col("values"))
        total = _sum(counts)
        return F.transform(counts, lambda count: count / total)

    together = rows.withColumn("width", F.size("values")).join(F.broadcast(forest), "width")
    given = F.transform("trees", shares)
    nothing = F.transform(F.get(given, F.lit(0)), lambda _: F.lit(0.0))
    votes = F.aggregate(
        given, nothing, lambda sums, more: F.zip_with(sums, more, lambda one, two: one + two)
    )
    counted = together.withColumn("votes", votes).drop("width", "trees")
    return counted.withColumn("voted", _largest(F.col("votes")))


# --- logistic regression -------------------------------------------------------------------


def _numbers(values) -> Column:
    return F.array(*(F.lit(float(value)) for value in values))


def regression_chances(rows: DataFrame, weights, intercepts) -> DataFrame:
    """The rows with ``chances`` and ``scored``, from ``values`` and the coefficients."""

    def score(of_label, intercept) -> Column:
        products = F.zip_with("values", _numbers(of_label), lambda value, weight: value * weight)
        return _sum(products) + F.lit(float(intercept))

    scores = F.array(*(score(*pair) for pair in zip(weights, intercepts, strict=True)))
    scored = rows.withColumn("scores", scores)
    # The largest is taken away first, so that no power overflows.
    powers = F.transform("scores", lambda one: F.exp(one - F.array_max("scores")))
    scored = scored.withColumn("powers", powers)
    chances = F.transform("powers", lambda power: power / _sum(F.col("powers")))
    scored = scored.withColumns({"chances": chances, "scored": _largest(F.col("scores"))})
    return scored.drop("scores", "powers")


def regression_slopes(
    examples: DataFrame, weights, intercepts, *, reg_param: float, elastic_net_param: float = 0.0
) -> DataFrame:
    """``label, feature, slope``: what is left of the objective's derivative at the weights.

    ``examples`` have ``label`` and ``values``.  One aggregate over them: each contributes
    the difference of chance and truth times each value (and times one for the intercept,
    whose feature is -1).  The regularisation is added, and its corner at zero allowed for.
    At the optimum every slope is zero.
    """
    chanced = regression_chances(examples, weights, intercepts)

    def of_label(chance: Column, label: Column) -> Column:
        missed = chance - F.when(F.col("label") == label, 1.0).otherwise(0.0)
        return F.transform(F.concat("values", F.array(F.lit(1.0))), lambda value: value * missed)

    parts = F.flatten(F.transform("chances", of_label))
    summed = chanced.select(F.posexplode(parts).alias("place", "part"))
    means = summed.groupBy("place").agg(F.avg("part").alias("mean"))
    columns = len(weights[0]) + 1
    flat = [weight for row in weights for weight in (*row, 0.0)]
    weight = F.get(_numbers(flat), F.col("place"))
    feature = F.col("place") % columns
    smooth = F.col("mean") + reg_param * (1 - elastic_net_param) * weight
    corner = reg_param * elastic_net_param
    at_zero = F.greatest(F.abs(smooth) - corner, F.lit(0.0))
    slope = F.when(weight == 0, at_zero).otherwise(smooth + corner * F.signum(weight))
    free = feature == columns - 1
    return means.select(
        F.floor(F.col("place") / columns).cast("int").alias("label"),
        F.when(free, -1).otherwise(feature).alias("feature"),
        F.when(free, F.col("mean")).otherwise(slope).alias("slope"),
    )

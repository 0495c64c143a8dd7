"""Assign whole subjects to train, validation and test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import split_digest

# Subjects are ranked inside ranges of their digest.  Digests are uniform, so the
# ranges are even whatever the subjects are, and 16**3 ranges fit in one small table.
_RANGE_DIGITS = 3

# Less than 100 bytes each as a hash table, so at most 100 MB on every executor.
BROADCAST_SUBJECTS = 1_000_000
HOT_SHARE = 1_000


def ranked_subjects(
    features: DataFrame, *, seed: int, train_fraction: float, validation_fraction: float
) -> DataFrame:
    """``(subject_id, subject_rank, split, is_hot)`` for every subject of the frame.

    Rank is the position in digest order over all subjects.  It is the position
    inside the subject's digest range plus the number of subjects in the ranges
    before, so no task ever sorts all subjects.  Hot subjects hold more than
    1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE of them.
    """
    digested = features.groupBy("subject_id").agg(F.count("*").alias("windows"))
    digested = digested.withColumn("digest", split_digest("subject_id", seed))
    digested = digested.withColumn("digest_range", F.substring("digest", 1, _RANGE_DIGITS))

    # At most 4,096 rows, whatever the input: fit for one task and for a broadcast.
    in_order = Window.orderBy("digest_range")
    ranges = digested.groupBy("digest_range").agg(
        F.count("*").alias("members"), F.sum("windows").alias("windows_in_range")
    )
    everywhere = Window.partitionBy()
    ranges = ranges.select(
        "digest_range",
        (F.sum("members").over(in_order) - F.col("members")).alias("members_before"),
        F.sum("members").over(everywhere).alias("subjects"),
        F.sum("windows_in_range").over(everywhere).alias("all_windows"),
    )

    in_range = Window.partitionBy("digest_range").orderBy("digest")
    ranked = digested.withColumn("position", F.row_number().over(in_range) - 1)
    # Every range has its row.  An inner join would have Spark derive a not-null filter
    # on the digest and push the hashing down to every single reading.
    ranked = ranked.join(F.broadcast(ranges), "digest_range", "left")
    rank = F.col("members_before") + F.col("position")

    # Fractions stay doubles and the products are cut off, not rounded.
    train_end = F.floor(F.col("subjects") * F.lit(float(train_fraction)))
    validation_end = F.floor(
        F.col("subjects") * F.lit(float(train_fraction) + float(validation_fraction))
    )
    split = (
        F.when(rank < train_end, F.lit("train"))
        .when(rank < validation_end, F.lit("validation"))
        .otherwise(F.lit("test"))
    )
    is_hot = F.col("windows") * F.lit(HOT_SHARE) > F.col("all_windows")
    return ranked.select(
        "subject_id",
        rank.cast("int").alias("subject_rank"),
        split.alias("split"),
        is_hot.alias("is_hot"),
    )


def subject_splits(
    features: DataFrame, *, seed: int, train_fraction: float, validation_fraction: float
) -> DataFrame:
    """``(subject_id, subject_rank, split)`` for every subject of the frame."""
    ranked = ranked_subjects(
        features,
        seed=seed,
        train_fraction=train_fraction,
        validation_fraction=validation_fraction,
    )
    return ranked.drop("is_hot")


def attach_splits(
    features: DataFrame, ranked: DataFrame, *, broadcast_rows: int = BROADCAST_SUBJECTS
) -> DataFrame:
    """Features with the rank and split of their subject.

    ``ranked`` is a stored result of ``ranked_subjects`` for the same features; its
    rows are counted here.  Up to ``broadcast_rows`` subjects the table is broadcast
    and the features stay where they are.  Beyond that only the hot subjects are, and
    all others meet in a shuffled join, in which none of them is large.
    """
    columns = ["subject_id", "subject_rank", "split"]
    if ranked.count() <= broadcast_rows:
        return features.join(F.broadcast(ranked.select(columns)), "subject_id")

    hot = F.broadcast(ranked.where("is_hot").select(columns))
    of_hot = features.join(hot, "subject_id")
    others = features.join(hot.select("subject_id"), "subject_id", "left_anti")
    of_others = others.join(ranked.where("not is_hot").select(columns).hint("merge"), "subject_id")
    return of_hot.unionByName(of_others)


def split_counts(features: DataFrame) -> DataFrame:
    """Rows per split."""
    return features.groupBy("split").agg(F.count("*").alias("windows"))


def dataset_summary(features: DataFrame) -> DataFrame:
    """Windows, subjects and activities, overall and per split, as ``(metric, key, value)``.

    The first grouping folds all windows of a subject and activity into one row, so
    the distinct counts work on that small table and not on the windows.
    """
    folded = features.groupBy("split", "subject_id", "activity").agg(F.count("*").alias("windows"))
    subjects = F.count_distinct("subject_id").alias("subjects")
    overall = folded.agg(
        F.coalesce(F.sum("windows"), F.lit(0)).alias("windows"),
        subjects,
        F.count_distinct("activity").alias("activities"),
    )
    per_split = folded.groupBy("split").agg(F.sum("windows").alias("windows"), subjects)

    def entries(totals: DataFrame, key: Column, names: dict[str, str]) -> DataFrame:
        listed = [
            F.struct(F.lit(metric).alias("metric"), key.alias("key"), F.col(name).alias("value"))
            for metric, name in names.items()
        ]
        return totals.select(F.inline(F.array(*listed)))

    of_all = {"feature_windows": "windows", "subjects": "subjects", "activities": "activities"}
    of_split = {"split_windows": "windows", "split_subjects": "subjects"}
    return entries(overall, F.lit("all"), of_all).union(
        entries(per_split, F.col("split"), of_split)
    )

"""Sensor readings, text lines and predictions derived from the ``events`` table.

Every view covers the whole table.  ``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.learn import ModelSettings
from ..plans.settings import JobSettings

# Events are sparse, so windows are 15 days long and need three readings.
SETTINGS = JobSettings(
    window_seconds=1_296_000,
    minimum_samples=3,
    models=ModelSettings(max_iter=200, num_trees=5, max_depth=4),
)
SENSORS = ["accel", "gyro"]
TIE_BREAK = 1e-8
LABELS = ["A", "B", "C", "D", "E", "F"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _nanos() -> Column:
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return micros * F.lit(1000).cast("bigint")


def _activity() -> Column:
    return F.translate(F.substring("event_type", 1, 1), "cepsv", "ABCDE")


def _sensor() -> Column:
    return F.when(F.col("event_id") % 2 == 0, "accel").otherwise("gyro")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings, at epoch-scale nanoseconds."""
    return events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("subject_id"),
        _activity().alias("activity"),
        _nanos().alias("timestamp_ns"),
        F.lit("watch").alias("device"),
        _sensor().alias("sensor"),
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
        (F.col("event_id") % 3).cast("double").alias("z"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as text lines, a fixed share of them damaged in known ways."""
    defect = F.col("event_id") % 50

    def with_defects(sound: Column, damaged: dict[int, Column]) -> Column:
        chosen = F
        for number, value in damaged.items():
            chosen = chosen.when(defect == number, value)
        return chosen.otherwise(sound)

    subject = F.col("user_id").cast("string")
    activity = _activity()
    fields = [
        with_defects(subject, {9: F.lit("1.5")}),
        with_defects(
            activity,
            {
                1: F.lit("N"),
                7: F.lower(activity),
                10: F.concat(F.lit(" "), activity, F.lit(" ")),
            },
        ),
        with_defects(_nanos().cast("string"), {2: F.lit("x"), 3: F.lit("-5")}),
        with_defects(F.col("value").cast("string"), {11: F.lit("")}),
        F.get_json_object("props", "$.k"),
    ]
    last = F.concat(F.lit(","), (F.col("event_id") % 3).cast("string"))
    end = with_defects(
        F.concat(last, F.lit(";")),
        {0: F.lit(""), 5: F.concat(last, F.lit(";  ")), 6: last},
    )
    path = with_defects(
        F.concat(F.lit("/raw/Watch/"), _sensor(), F.lit("/a.txt")),
        {4: F.lit("/raw/tablet/accel/a.txt"), 8: F.lit("/raw/watch/light/a.txt")},
    )
    return events(spark, sf_dir).select(
        path.alias("source_file"), F.concat(F.concat_ws(",", *fields), end).alias("value")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of actual and predicted activity; the label F never occurs."""
    guess = F.substring(F.lit("ABCD"), (F.col("event_id") % 4).cast("int") + 1, F.lit(1))
    predicted = F.when(F.col("event_id") % 3 != 0, _activity()).otherwise(guess)
    return events(spark, sf_dir).select(
        "event_id", _activity().alias("actual"), predicted.alias("predicted")
    )

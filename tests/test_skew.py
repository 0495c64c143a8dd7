"""A third of all lines on one window and a third of them bad, through the whole job."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetable.operators.records import parse_records
from kinetable.operators.windows import tallied_windows
from kinetable.plans import jobs
from kinetable.plans.settings import JobSettings
from kinetable.sources.staging import StageArea

ROWS = 45_000
SETTINGS = JobSettings(window_seconds=10, minimum_samples=2)


def skewed_lines(spark):
    kind = F.col("id") % 3
    subject = F.when(kind == 0, F.lit(7)).otherwise(F.col("id") % 400)
    time = F.when(kind == 0, F.lit(0)).otherwise((F.col("id") % 50) * F.lit(10_000_000_000))
    line = F.concat_ws(
        ",",
        subject.cast("string"),
        F.when(kind == 1, "broken").otherwise("A"),
        time.cast("bigint").cast("string"),
        F.col("id").cast("string"),
        F.lit("1"),
        F.lit("2;"),
    )
    folder = F.when(F.col("id") % 2 == 0, "/watch/accel/a").otherwise("/watch/gyro/a")
    return spark.range(0, ROWS, 1, 12).select(line.alias("value"), folder.alias("source_file"))


def test_results_are_whole(spark):
    stage = StageArea(spark)
    prepared = jobs.prepare_features(skewed_lines(spark), SETTINGS, stage)
    quality = {row["_parse_ok"]: row["count"] for row in prepared.quality.collect()}
    assert quality == {True: ROWS * 2 // 3, False: ROWS // 3}
    hot = prepared.features.where("subject_id = 7 and window_id = 0").first()
    assert hot["accel_sample_count"] + hot["gyro_sample_count"] >= ROWS // 3
    stage.remove()


def test_few_rows_are_shuffled(spark):
    """Every task sends one row for the hot window and one for the bad lines."""
    tallied = tallied_windows(
        parse_records(skewed_lines(spark)),
        device="watch",
        sensors=["accel", "gyro"],
        window_seconds=10,
    )
    tallied.collect()
    plan = tallied._jdf.queryExecution().executedPlan()
    stage = plan.finalPhysicalPlan()
    while "ShuffleQueryStage" not in stage.nodeName():
        stage = stage.children().head()
    sent = stage.plan().metrics().apply("shuffleRecordsWritten").value()
    windows = tallied.count()
    assert windows < 3_000
    assert sent <= ROWS / 3 + 12 * 3

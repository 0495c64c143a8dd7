from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from kinetable.functions.expressions import time_bucket
from kinetable.operators import records, windows

SCHEMA = """subject_id int, activity string, timestamp_ns bigint, device string, sensor string,
            x double, y double, z double"""
STEP = 50_000_000


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def features(spark, rows, seconds=5, minimum=2):
    return windows.window_features(
        frame(spark, rows), window_seconds=seconds, minimum_samples=minimum
    ).collect()


def test_feature_names_and_order():
    assert len(windows.FEATURE_NAMES) == 18
    assert windows.FEATURE_NAMES[:5] == ("x_mean", "x_std", "x_min", "x_max", "y_mean")
    assert windows.FEATURE_NAMES[12:] == (
        "magnitude_mean",
        "magnitude_std",
        "energy_mean",
        "xy_corr",
        "xz_corr",
        "yz_corr",
    )


def test_a_window_with_two_constant_axes(spark):
    rows = [(7, "C", i * STEP, "watch", "gyro", -3.5, 0.5 * i * i, 0.25) for i in range(85)]
    (row,) = features(spark, rows, minimum=70)
    assert row["sample_count"] == 85
    assert row["window_id"] == 0
    assert row["y_mean"] == pytest.approx(1183.0)
    assert row["y_std"] == pytest.approx(1071.39311568319)
    assert (row["y_min"], row["y_max"]) == (0.0, 3528.0)
    assert row["x_std"] == row["z_std"] == 0.0
    assert row["xy_corr"] == row["xz_corr"] == row["yz_corr"] == 0.0
    assert None not in row


def test_against_plain_python(spark):
    rng = random.Random(7)
    rows = [
        (1, rng.choice("AB"), rng.randrange(60) * 10**9, "watch", rng.choice(["accel", "gyro"]))
        + tuple(rng.gauss(9.8, 2) for _ in range(3))
        for _ in range(600)
    ]
    groups: dict[tuple, list] = {}
    for row in rows:
        groups.setdefault((row[1], row[4], row[2] // (10 * 10**9)), []).append(row[5:])
    found = {
        (row["activity"], row["sensor"], row["window_id"]): row
        for row in features(spark, rows, seconds=10, minimum=20)
    }
    assert set(found) == {key for key, values in groups.items() if len(values) >= 20}
    for key, row in found.items():
        axes = dict(zip("xyz", zip(*groups[key], strict=True), strict=True))
        energy = [sum(value**2 for value in point) for point in groups[key]]
        expected = {"energy_mean": statistics.mean(energy)}
        magnitude = [math.sqrt(value) for value in energy]
        expected |= {
            "magnitude_mean": statistics.mean(magnitude),
            "magnitude_std": statistics.stdev(magnitude),
        }
        for axis, values in axes.items():
            expected |= {
                f"{axis}_mean": statistics.mean(values),
                f"{axis}_std": statistics.stdev(values),
                f"{axis}_min": min(values),
                f"{axis}_max": max(values),
            }
        for pair in ("xy", "xz", "yz"):
            expected[f"{pair}_corr"] = statistics.correlation(axes[pair[0]], axes[pair[1]])
        assert set(expected) == set(windows.FEATURE_NAMES)
        for name, value in expected.items():
            assert row[name] == pytest.approx(value, rel=1e-9), name


def test_minimum_is_inclusive_and_labels_do_not_mix(spark):
    rows = [(1, "A", i, "watch", "accel", 1.0, 1.0, 1.0) for i in range(3)]
    rows += [(1, "B", i, "watch", "accel", 1.0, 1.0, 1.0) for i in range(2)]
    found = features(spark, rows, minimum=3)
    assert [(row["activity"], row["sample_count"]) for row in found] == [("A", 3)]


def test_undefined_becomes_zero_and_infinity_stays(spark):
    rows = [
        (1, "A", 0, "watch", "accel", math.nan, math.inf, 1.0),
        (1, "A", 1, "watch", "accel", 1.0, 2.0, 2.0),
    ]
    (row,) = features(spark, rows)
    assert (row["x_mean"], row["x_std"], row["x_max"], row["x_min"]) == (0.0, 0.0, 0.0, 1.0)
    assert (row["y_mean"], row["y_max"], row["y_std"]) == (math.inf, math.inf, 0.0)
    assert row["energy_mean"] == 0.0
    assert row["xy_corr"] == 0.0


def test_one_sample_windows_have_no_spread(spark):
    (row,) = features(spark, [(1, "A", 0, "watch", "accel", 1.0, 2.0, 3.0)], minimum=1)
    assert (row["x_mean"], row["x_std"], row["xy_corr"]) == (1.0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("timestamp", "bucket"),
    [
        (1574085129999999999, 157408512),
        (1574085130000000000, 157408513),
        (0, 0),
        (-1, -1),
        (-10_000_000_000, -1),
        (-10_000_000_001, -2),
    ],
)
def test_buckets_are_exact_integers(spark, timestamp, bucket):
    row = spark.createDataFrame([(timestamp,)], "t bigint").select(time_bucket("t", 10)).first()
    assert row[0] == bucket


def test_one_pass_gives_windows_and_quality(spark):
    lines = spark.range(2000).select(
        F.concat_ws(
            ",",
            (F.col("id") % 3).cast("string"),
            F.when(F.col("id") % 7 == 0, "N").otherwise("A"),
            (F.col("id") * STEP).cast("string"),
            F.col("id").cast("string"),
            F.lit("1"),
            F.lit("2;"),
        ).alias("value"),
        F.when(F.col("id") % 2 == 0, "/watch/accel/a").otherwise("/phone/gyro/a").alias("source_file"),
    )
    parsed = records.parse_records(lines)
    tallied = windows.tallied_windows(
        parsed, device="watch", sensors=["accel", "gyro"], window_seconds=10
    )
    accepted = windows.accepted_windows(tallied, minimum_samples=20)
    separate = windows.window_features(
        records.valid_records(parsed, "watch", ["accel", "gyro"]),
        window_seconds=10,
        minimum_samples=20,
    )
    assert accepted.columns == separate.columns
    assert accepted.count() > 0
    assert sorted(accepted.collect()) == sorted(separate.collect())
    assert sorted(windows.tallied_quality(tallied).collect()) == sorted(
        records.parse_quality(parsed).collect()
    )


def test_a_hot_window_is_combined_before_the_shuffle(spark):
    rows = spark.range(0, 30_000, 1, 12).selectExpr(
        "cast(if(id % 3 = 0, 1, id % 1000) as int) as subject_id",
        "'A' as activity",
        "id as timestamp_ns",
        "'watch' as device",
        "'accel' as sensor",
        "cast(id as double) as x",
        "1.0D as y",
        "2.0D as z",
    )
    found = windows.window_features(rows, window_seconds=10, minimum_samples=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_covar_samp" in plan.split("Exchange hashpartitioning")[1]
    counts = {row["subject_id"]: row["sample_count"] for row in found.collect()}
    assert counts[1] >= 10_000
    assert sum(counts.values()) == 30_000


def test_buffers_fit_generated_code(spark):
    """Frames of more than 100 columns leave whole-stage code generation."""
    rows = frame(spark, [(1, "A", 0, "watch", "accel", 1.0, 2.0, 3.0)])
    found = windows.window_features(rows, window_seconds=10, minimum_samples=2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    aggregates = [line for line in plan.splitlines() if "HashAggregate" in line]
    assert len(aggregates) == 2
    assert all("*(" in line for line in aggregates)

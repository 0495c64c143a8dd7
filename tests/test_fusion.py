from __future__ import annotations

import pytest

from kinetable.operators import fusion
from kinetable.operators.windows import FEATURE_NAMES

SCHEMA = """subject_id int, activity string, device string, sensor string, window_id bigint,
            sample_count bigint, x_mean double"""


def sensors_frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("fuse", [fusion.fuse_sensors, fusion.fuse_sensors_by_join])
def test_matching_windows_become_one_row(spark, fuse):
    features = sensors_frame(
        spark,
        (7, "C", "watch", "gyro", 31, 88, -0.5),
        (7, "C", "watch", "accel", 31, 91, 6.25),
        (7, "C", "watch", "accel", 32, 90, 6.5),
        (8, "C", "watch", "gyro", 32, 87, -0.25),
    )
    fused = fuse(features, ["accel", "gyro"])
    assert fused.columns == [
        *fusion.WINDOW_KEYS,
        "accel_sample_count",
        "accel_x_mean",
        "gyro_sample_count",
        "gyro_x_mean",
    ]
    assert [tuple(row) for row in fused.collect()] == [(7, "C", "watch", 31, 91, 6.25, 88, -0.5)]
    assert fusion.model_columns(fused) == ["accel_x_mean", "gyro_x_mean"]


@pytest.mark.parametrize("fuse", [fusion.fuse_sensors, fusion.fuse_sensors_by_join])
def test_one_sensor_is_returned_as_it_is(spark, fuse):
    features = sensors_frame(spark, (1600, "A", "phone", "accel", 1, 100, 1.0))
    assert fuse(features, ["accel"]) is features


@pytest.mark.parametrize("fuse", [fusion.fuse_sensors, fusion.fuse_sensors_by_join])
def test_no_known_feature_is_an_error(spark, fuse):
    features = sensors_frame(spark, (1600, "A", "phone", "accel", 1, 100, 1.0)).drop("x_mean")
    with pytest.raises(ValueError, match="feature columns"):
        fuse(features, ["accel", "gyro"])


def test_the_join_form_pairs_repeated_windows(spark):
    features = sensors_frame(
        spark,
        (1, "A", "phone", "accel", 1, 100, 1.0),
        (1, "A", "phone", "accel", 1, 100, 2.0),
        (1, "A", "phone", "gyro", 1, 99, 3.0),
    )
    assert fusion.fuse_sensors_by_join(features, ["accel", "gyro"]).count() == 2


def test_three_sensors(spark):
    rows = [(1, "A", "w", sensor, 1, 10, float(i)) for i, sensor in enumerate("pqr")]
    rows += [(2, "A", "w", sensor, 1, 10, 0.0) for sensor in "pq"]
    (row,) = fusion.fuse_sensors(sensors_frame(spark, *rows), ["p", "q", "r"]).collect()
    assert (row["subject_id"], row["p_x_mean"], row["r_x_mean"]) == (1, 0.0, 2.0)


def test_model_columns_plain_then_by_sensor(spark):
    names = ["gyro_x_mean", "yz_corr", "accel_yz_corr", "accel_x_mean", "x_mean", "other"]
    frame = spark.createDataFrame([(0.0,) * len(names)], names)
    assert fusion.model_columns(frame) == [
        "x_mean",
        "yz_corr",
        "accel_x_mean",
        "accel_yz_corr",
        "gyro_x_mean",
    ]
    with pytest.raises(ValueError, match="no model feature"):
        fusion.model_columns(frame.select("other"))


def test_fusion_reads_its_input_once(spark, tmp_path):
    columns = ", ".join(f"1.0D as {name}" for name in FEATURE_NAMES)
    spark.sql(
        f"""select 1 as subject_id, 'A' as activity, 'watch' as device, 'accel' as sensor,
            2L as window_id, 3L as sample_count, {columns}"""
    ).write.parquet(f"{tmp_path}/windows")
    fused = fusion.fuse_sensors(spark.read.parquet(f"{tmp_path}/windows"), ["accel", "gyro"])
    plan = fused._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_a_repeated_window_is_not_blended(spark):
    features = sensors_frame(
        spark,
        (7, "C", "watch", "accel", 31, 10, 9.0),
        (7, "C", "watch", "accel", 31, 20, 2.0),
        (7, "C", "watch", "gyro", 31, 15, 1.0),
    )
    with pytest.raises(Exception, match="more than one row of a sensor"):
        fusion.fuse_sensors(features, ["accel", "gyro"]).collect()
    assert fusion.fuse_sensors_by_join(features, ["accel", "gyro"]).count() == 2

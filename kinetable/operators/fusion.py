"""Put the windows of several sensors side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .records import SENSORS
from .windows import FEATURE_NAMES

WINDOW_KEYS = ("subject_id", "activity", "device", "window_id")


def _fused_names(features: DataFrame) -> list[str]:
    present = [name for name in FEATURE_NAMES if name in features.columns]
    if not present:
        raise ValueError("the frame has none of the known feature columns to fuse")
    return ["sample_count", *present]


def fuse_sensors(features: DataFrame, sensors: list[str]) -> DataFrame:
    """One row per window that every sensor has, columns prefixed with the sensor name.

    With one row per window and sensor, as ``window_features`` gives, the inner join is a
    grouping: the readings are scanned and aggregated once, and only finished windows are
    shuffled again, for any number of sensors.  A second row for a window and sensor is an
    error.  Fewer than two sensors return the frame unchanged.
    """
    if len(sensors) < 2:
        return features
    names = _fused_names(features)

    def of_sensor(sensor: str, name: str) -> Column:
        value = F.when(F.col("sensor") == sensor, F.col(name))
        return F.max(value).alias(f"{sensor}_{name}")

    wanted = features.where(F.col("sensor").isin(*sensors))
    fused = wanted.groupBy(*WINDOW_KEYS).agg(
        *(of_sensor(sensor, name) for sensor in sensors for name in names),
        *(F.count_if(F.col("sensor") == sensor).alias(f"_{sensor}_rows") for sensor in sensors),
    )
    rows = [F.col(f"_{sensor}_rows") for sensor in sensors]
    repeated = F.raise_error(F.lit("a window has more than one row of a sensor"))
    complete = F.when(F.greatest(*rows) > 1, repeated.cast("boolean")).otherwise(F.least(*rows) > 0)
    return fused.where(complete).drop(*(f"_{sensor}_rows" for sensor in sensors))


def fuse_sensors_by_join(features: DataFrame, sensors: list[str]) -> DataFrame:
    """The same fusion as an inner join per sensor.

    For stored features, where reading one slice per sensor is cheap.  It also pairs
    up repeated windows, which ``fuse_sensors`` refuses.
    """
    if len(sensors) < 2:
        return features
    names = _fused_names(features)
    slices = [
        features.where(F.col("sensor") == sensor).select(
            *WINDOW_KEYS, *(F.col(name).alias(f"{sensor}_{name}") for name in names)
        )
        for sensor in sensors
    ]
    return reduce(lambda left, right: left.join(right, list(WINDOW_KEYS)), slices)


def model_columns(features: DataFrame) -> list[str]:
    """Feature columns of the frame in model order: plain names, then per sensor."""
    candidates = [*FEATURE_NAMES]
    candidates += [f"{sensor}_{name}" for sensor in SENSORS for name in FEATURE_NAMES]
    found = [name for name in candidates if name in features.columns]
    if not found:
        raise ValueError("the frame has no model feature columns")
    return found

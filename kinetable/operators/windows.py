"""Statistics of three-axis readings over tumbling time windows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import time_bucket, zero_if_undefined
from .records import AXES, is_selected

SAMPLE_KEYS = ("subject_id", "activity", "device", "sensor", "window_id")
AXIS_PAIRS = tuple(combinations(AXES, 2))

# The 18 feature names, in the order models read them.
FEATURE_NAMES = (
    *(f"{axis}_{statistic}" for axis in AXES for statistic in ("mean", "std", "min", "max")),
    "magnitude_mean",
    "magnitude_std",
    "energy_mean",
    *(f"{first}{second}_corr" for first, second in AXIS_PAIRS),
)


def _feature_measures() -> list[Column]:
    """One aggregate per feature name.

    A correlation is the covariance over the two deviations that are features
    already, so the aggregation buffer grows by three covariances only.  Dividing
    after the fact also leaves a constant axis to ``try_divide`` instead of an error.
    """
    measures = []
    for axis in AXES:
        measures += [F.avg(axis), F.stddev_samp(axis), F.min(axis), F.max(axis)]
    measures += [F.avg("magnitude"), F.stddev_samp("magnitude"), F.avg("energy")]
    for first, second in AXIS_PAIRS:
        spread = F.stddev_samp(first) * F.stddev_samp(second)
        measures.append(F.try_divide(F.covar_samp(first, second), spread))
    return measures


def _aggregate(samples: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sample count and the 18 features per key.

    All buffers have a fixed width, so Spark combines a window inside each input
    task first: a window holding a third of all rows still ships one row per task.
    """
    energy = sum((F.col(axis) * F.col(axis) for axis in AXES[1:]), F.col("x") * F.col("x"))
    with_energy = samples.select(*keys, *AXES, energy.alias("energy"))
    with_magnitude = with_energy.withColumn("magnitude", F.sqrt("energy"))
    features = [
        zero_if_undefined(measure).alias(name)
        for name, measure in zip(FEATURE_NAMES, _feature_measures(), strict=True)
    ]
    return with_magnitude.groupBy(*keys).agg(F.count("*").alias("sample_count"), *features)


def window_features(records: DataFrame, *, window_seconds: int, minimum_samples: int) -> DataFrame:
    """One row per subject, activity, device, sensor and window with enough samples."""
    samples = records.withColumn("window_id", time_bucket("timestamp_ns", window_seconds))
    windows = _aggregate(samples, SAMPLE_KEYS)
    return windows.where(F.col("sample_count") >= int(minimum_samples))


def tallied_windows(
    parsed: DataFrame, *, device: str, sensors: list[str], window_seconds: int
) -> DataFrame:
    """Windows of the selected readings together with counts of all other lines.

    Lines that are bad or not asked for fall into one group per flag value, with
    NULL keys.  So a single pass over the raw text gives the windows and the quality
    counts, and both are plain query results that a lost executor cannot distort.
    """
    keyed = parsed.withColumn("window_id", time_bucket("timestamp_ns", window_seconds))
    keyed = keyed.withColumn("wanted", is_selected(device, sensors))
    keys = [F.when(F.col("wanted"), F.col(key)).alias(key) for key in SAMPLE_KEYS]
    return _aggregate(keyed.select("_parse_ok", *keys, *AXES), ("_parse_ok", *SAMPLE_KEYS))


def tallied_quality(tallied: DataFrame) -> DataFrame:
    """Number of good and bad lines behind ``tallied_windows``."""
    return tallied.groupBy("_parse_ok").agg(F.sum("sample_count").alias("count"))


def accepted_windows(tallied: DataFrame, *, minimum_samples: int) -> DataFrame:
    """The windows in ``tallied_windows`` that have enough samples."""
    enough = F.col("sample_count") >= int(minimum_samples)
    return tallied.where(F.col("window_id").isNotNull() & enough).drop("_parse_ok")

"""Checked parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..operators.learn import ModelSettings
from ..operators.records import DEVICES, SENSORS


@dataclass(frozen=True)
class JobSettings:
    """What to read, how to window and split it, and how to train on it."""

    device: str = "watch"
    sensors: tuple[str, ...] = ("accel", "gyro")
    window_seconds: int = 10
    minimum_samples: int = 150
    seed: int = 42
    train_fraction: float = 0.70
    validation_fraction: float = 0.15
    test_fraction: float = 0.15
    models: ModelSettings = field(default_factory=ModelSettings)

    def __post_init__(self):
        fractions = (self.train_fraction, self.validation_fraction, self.test_fraction)
        if min(fractions) <= 0:
            raise ValueError(f"every split fraction must be above zero: {fractions}")
        if abs(sum(fractions) - 1.0) > 1e-9:
            raise ValueError(f"split fractions must add up to one: {fractions}")
        if self.window_seconds <= 0:
            raise ValueError("window_seconds must be above zero")
        if self.minimum_samples <= 1:
            raise ValueError("minimum_samples must be at least two")
        if self.device not in DEVICES:
            raise ValueError(f"device must be one of {DEVICES}: {self.device!r}")
        if not self.sensors or not set(self.sensors) <= set(SENSORS):
            raise ValueError(f"sensors must be some of {SENSORS}: {self.sensors}")
        if len(set(self.sensors)) != len(self.sensors):
            raise ValueError(f"a sensor is named twice: {self.sensors}")


FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Shuffled are windows, which are far smaller than the lines they are made of: so many
# bytes of text fill a shuffle partition.
TEXT_PER_PARTITION = 256 << 20
LEAST_PARTITIONS, MOST_PARTITIONS = 64, 100_000
# Until the input is known.
UNKNOWN_PARTITIONS = 4_000


def partitions_for(input_bytes: int) -> int:
    """Shuffle partitions to begin with for an input of that size.

    Adaptive execution joins small ones, but cannot split a grouping's partitions, so
    the number has to grow with the input.
    """
    wanted = -(-input_bytes // TEXT_PER_PARTITION)
    return max(LEAST_PARTITIONS, min(MOST_PARTITIONS, wanted))


def session_options(
    app_name: str,
    *,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> dict[str, str]:
    """Options for ``SparkSession.builder``; the launcher chooses the master.

    Without a number, the count of shuffle partitions is a ceiling that adaptive
    execution lowers to fit the data; a job sets it by ``partitions_for`` once it has
    listed its input.  Large input splits let the first aggregation
    fold more readings of a window before anything is shuffled; on small input Spark
    makes the splits smaller by itself, to keep every core busy.
    """
    options = {
        "spark.app.name": app_name,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "512m",
    }
    if shuffle_partitions is None:
        options[FIRST_PARTITIONS] = str(UNKNOWN_PARTITIONS)
    else:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        options["spark.driver.memory"] = driver_memory
    return options

"""Entry point for ``spark-submit``: ``submit.py prepare|train|run --output PATH ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from kinetable.operators.learn import ModelSettings
from kinetable.plans import jobs
from kinetable.plans.settings import (
    FIRST_PARTITIONS,
    JobSettings,
    partitions_for,
    session_options,
)
from kinetable.sources.artifacts import new_run_id
from kinetable.sources.text import input_bytes


def arguments(values: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=("prepare", "train", "run"))
    parser.add_argument("--raw", help="path or glob of the reading lines")
    parser.add_argument("--features", help="stored features, for train")
    parser.add_argument("--output", required=True, help="folder that gets a folder per run")
    parser.add_argument("--device", default="watch")
    parser.add_argument("--sensors", nargs="+", default=["accel", "gyro"])
    parser.add_argument("--window-seconds", type=int, default=10)
    parser.add_argument("--minimum-samples", type=int, default=150)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--max-iter", type=int, default=80)
    parser.add_argument("--num-trees", type=int, default=80)
    parser.add_argument("--max-depth", type=int, default=12)
    parser.add_argument("--train-fraction", type=float, default=0.70)
    parser.add_argument("--validation-fraction", type=float, default=0.15)
    parser.add_argument("--test-fraction", type=float, default=0.15)
    parser.add_argument("--reg-param", type=float, default=0.05)
    parser.add_argument("--elastic-net-param", type=float, default=0.0)
    parser.add_argument("--feature-subset-strategy", default="sqrt")
    parser.add_argument("--rows-per-partition", type=int, default=2048, help="train rows")
    parser.add_argument("--shuffle-partitions", type=int)
    given = parser.parse_args(values)
    missing = "features" if given.job == "train" else "raw"
    if not getattr(given, missing):
        parser.error(f"{given.job} needs --{missing}")
    return given


def settings_of(given: argparse.Namespace) -> JobSettings:
    return JobSettings(
        device=given.device,
        sensors=tuple(given.sensors),
        window_seconds=given.window_seconds,
        minimum_samples=given.minimum_samples,
        seed=given.seed,
        models=ModelSettings(
            max_iter=given.max_iter,
            num_trees=given.num_trees,
            max_depth=given.max_depth,
            reg_param=given.reg_param,
            elastic_net_param=given.elastic_net_param,
            feature_subset_strategy=given.feature_subset_strategy,
            rows_per_partition=given.rows_per_partition,
        ),
        train_fraction=given.train_fraction,
        validation_fraction=given.validation_fraction,
        test_fraction=given.test_fraction,
    )


def execute(spark: SparkSession, given: argparse.Namespace) -> str:
    """Run the job in a new folder below the output, and return that folder."""
    settings = settings_of(given)
    output = f"{given.output.rstrip('/')}/{new_run_id()}"
    if given.job == "train":
        jobs.train(spark, given.features, output, settings)
    else:
        getattr(jobs, given.job)(spark, given.raw, output, settings)
    return output


def main(values: list[str] | None = None) -> None:
    given = arguments(values)
    builder = SparkSession.builder
    options = session_options("kinetable", shuffle_partitions=given.shuffle_partitions)
    for name, value in options.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if given.shuffle_partitions is None and given.raw:
        # Known only now that there is a session to list the files with.
        first = partitions_for(input_bytes(spark, given.raw))
        spark.conf.set(FIRST_PARTITIONS, str(first))
    print(execute(spark, given))


if __name__ == "__main__":
    main()

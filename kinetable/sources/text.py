"""Reading lines with the file they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, source_file)`` for every line under a path, glob or list of them."""
    lines = spark.read.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files behind a path or glob, from their listing."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]

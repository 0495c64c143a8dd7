"""Looking at and removing folders on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on_file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(configuration), folder


def refuse_existing(spark: SparkSession, *paths: str) -> None:
    """An error if any of the paths exists.

    Writers refuse too, but only once everything before them has been computed.
    """
    for path in paths:
        system, folder = _on_file_system(spark, path)
        if system.exists(folder):
            raise FileExistsError(f"refusing to overwrite {path}")


def remove_folder(spark: SparkSession, path: str) -> None:
    system, folder = _on_file_system(spark, path)
    system.delete(folder, True)

"""Tables that cut a plan at a point it would otherwise be computed twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .folders import remove_folder


class StageArea:
    """A new folder for intermediate tables, on storage all executors share.

    The base is ``spark.checkpoint.dir`` of the session.  Where that is unset it is
    ``below``, the folder of a job's results, or else the warehouse folder; on a
    cluster that must not be a folder of each machine's own.  Written tables survive the loss of any executor, unlike cached
    blocks, and are read back with column pruning.
    """

    def __init__(self, spark: SparkSession, below: str | None = None):
        base = spark.conf.get("spark.checkpoint.dir", None) or below
        if not base:
            base = spark.conf.get("spark.sql.warehouse.dir")
            if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
                raise ValueError(
                    "set spark.checkpoint.dir to a folder that all executors share: "
                    f"{base} is one of each machine"
                )
        self.spark = spark
        self.path = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"

    def table(self, frame: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write the frame and return it as a read of the written files."""
        path = f"{self.path}/{name}"
        frame.write.mode("errorifexists").parquet(path, compression=compression)
        return self.spark.read.schema(frame.schema).parquet(path)

    def bucketed(
        self, frame: DataFrame, name: str, key: str, compression: str | None = None
    ) -> DataFrame:
        """Like ``table``, with files by the hash of a key, so joins on it need no shuffle.

        There are as many buckets as shuffle partitions, to which the other side of a
        join is dealt.  The catalog knows the table for the moment of its reading only.
        """
        table = f"stage_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = frame.write.format("parquet").bucketBy(buckets, key)
        if compression:
            writer = writer.option("compression", compression)
        writer.option("path", f"{self.path}/{name}").saveAsTable(table)
        stored = self.spark.table(table)
        self.spark.sql(f"drop table {table}")
        return stored

    def drop(self, name: str) -> None:
        """Delete one table, once nothing reads from it any more."""
        remove_folder(self.spark, f"{self.path}/{name}")

    def remove(self) -> None:
        """Delete the folder, once nothing reads from it any more."""
        remove_folder(self.spark, self.path)

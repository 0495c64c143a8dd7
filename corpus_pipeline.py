"""From raw documents to token ids, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinetable.llm import bpe, compression, mixing, pii, sketches
from kinetable.llm.catalog import VOCABULARY
from kinetable.sources.staging import StageArea


# Rows and bytes of the batches that go to Python, where the session sets none.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def bounded(spark: SparkSession) -> None:
    """Keep batches small: an executor holds those of all its tasks outside of its heap.

    The JVM and the Python workers both keep much of what they once took, and it adds up
    over five stages.
    """
    for name in BATCH.keys() - spark.conf.getAll.keys():
        spark.conf.set(name, BATCH[name])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the compression bands."""
    bounded(spark)
    return compression.keep_compressible(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    bounded(spark)
    return sketches.keep_one_of_each(docs, sketches.Settings(words=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with marks in the place of personal data."""
    bounded(spark)
    return pii.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    bounded(spark)
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of what they decode to."""
    bounded(spark)
    return bpe.encoding_digests(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

# Compression ratios and merges by rank have no SQL.  The tests compare the rows of a small
# table with plain steps: near duplicates by all pairs of sets, token ids by a library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    stage = StageArea(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = stage.table(function(spark, docs, sf_dir), f"after-{number}")
    return docs

"""What the corpus operators share: batches in and out of tasks, words, held-out rows."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows handed to Python at a time; bounds a worker's memory when texts are long.
ROWS_PER_PIECE = 256

# Bytes of strings and lists that are gathered into one batch of results.
BYTES_PER_BATCH = 4 << 20

# The white space of the word pattern: a space and the five controls from tab on.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="kinetable-py-")) / "kinetable_tasks.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(package.rglob("*.py")):
            packed.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def map_rows(
    frame: DataFrame, ddl: str, make: Callable[[], Callable[[Iterator[tuple]], Iterator[tuple]]]
) -> DataFrame:
    """``make()``'s function over the rows of each partition, in pieces.

    The function gets an iterator of row tuples in the frame's column order and yields
    output tuples.  It is made once per task, so it may keep caches of its own.
    """

    def rows(batches) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_PIECE):
                piece = batch.slice(start, ROWS_PER_PIECE)
                yield from zip(*(column.to_pylist() for column in piece.columns), strict=True)

    return map_batches(frame, ddl, lambda: lambda batches: make()(rows(batches)))


def _weight(row: tuple) -> int:
    """About the bytes of a row's strings and lists."""
    total = 0
    for value in row:
        if isinstance(value, str | bytes):
            total += len(value)
        elif isinstance(value, list):
            total += 32 * len(value)
    return total


def map_batches(frame: DataFrame, ddl: str, make: Callable, packed: bool = False) -> DataFrame:
    """Like ``map_rows``, but the made function gets the Arrow batches themselves.

    Results go back in batches bounded in rows and bytes.  With ``packed`` the function
    yields Arrow batches of its own.
    """
    ship(frame.sparkSession)
    arrow = to_arrow_schema(schema_of(ddl))

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind.type) for values, kind in zip(columns, arrow, strict=True)],
            schema=arrow,
        )

    def run(batches):
        if packed:
            yield from make()(batches)
            return
        found, size = [], 0
        for row in make()(batches):
            found.append(row)
            size += _weight(row)
            if len(found) >= ROWS_PER_PIECE * 16 or size >= BYTES_PER_BATCH:
                yield batch_of(found)
                found, size = [], 0
        if found:
            yield batch_of(found)

    return frame.mapInArrow(run, ddl)


def map_each(frame: DataFrame, ddl: str, make: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """One output tuple for each row, from the row's values."""

    def made():
        each = make()
        return lambda rows: (each(*row) for row in rows)

    return map_rows(frame, ddl, made)


def filter_rows(frame: DataFrame, column: str, make: Callable[[], Callable]) -> DataFrame:
    """The rows, unchanged, for whose value of ``column`` the made predicate holds."""
    ship(frame.sparkSession)
    place = frame.columns.index(column)

    def run(batches):
        keeps = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_PIECE):
                piece = batch.slice(start, ROWS_PER_PIECE)
                mask = [keeps(value) for value in piece.column(place).to_pylist()]
                yield piece.filter(pa.array(mask, pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """One row of five, by the checksum of the id as text; never used for learning."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def replace_texts(frame: DataFrame, make: Callable[[], Callable[[str | None], str | None]]):
    """The rows with new texts, and ``n_chars`` after them where it is a long column."""
    ship(frame.sparkSession)
    names = frame.columns
    place = names.index("text")
    chars = names.index("n_chars") if dict(frame.dtypes).get("n_chars") == "bigint" else None

    def run(batches):
        new = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_PIECE):
                piece = batch.slice(start, ROWS_PER_PIECE)
                texts = [new(text) for text in piece.column(place).to_pylist()]
                columns = list(piece.columns)
                columns[place] = pa.array(texts, columns[place].type)
                if chars is not None:
                    sizes = [None if text is None else len(text) for text in texts]
                    columns[chars] = pa.array(sizes, pa.int64())
                yield pa.RecordBatch.from_arrays(columns, schema=piece.schema)

    return frame.mapInArrow(run, frame.schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, limit: int
) -> DataFrame:
    """``(text, label)`` of at most ``limit`` rows not held out, chosen by an id's digest.

    Rows without an id or a label of 0 or 1 teach nothing.  ``limit`` bounds what is
    learned from, and so what a driver may hold; everything else covers all rows.
    """
    known = (
        labels.select("doc_id", F.col(target).alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(limit)
    )
    # One text per id, should an id be repeated.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (
        texts.join(F.broadcast(known), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
        .select("text", "label")
    )

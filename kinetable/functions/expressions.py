"""Column expressions that stay right whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NANOS_PER_SECOND = 1_000_000_000


def evaluate_once(frame: DataFrame, kept: list, computed: list[Column]) -> DataFrame:
    """``kept`` columns plus ``computed`` ones that later filters read as plain columns.

    Catalyst pushes a filter through a projection by copying the projected
    expressions into the condition, once per mention.  For a parsed line that means
    splitting the text again in every conjunct.  A one-row generator computes the
    columns a single time, and filters on other columns still move below it.
    """
    return frame.select(*kept, F.inline(F.array(F.struct(*computed))))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0.0 when the denominator is zero."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def zero_if_undefined(value: Column) -> Column:
    """NULL and NaN become 0.0; infinities stay."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def time_bucket(timestamp: str, seconds: int) -> Column:
    """Epoch-aligned bucket number of an integer nanosecond column.

    Integer arithmetic only: a double quotient puts nanoseconds just below a
    boundary into the next bucket once they pass 2**53.  ``div`` truncates toward
    zero, so a negative remainder is taken one bucket down.
    """
    width = int(seconds) * NANOS_PER_SECOND
    return F.expr(f"`{timestamp}` div {width}L - if(`{timestamp}` % {width}L < 0, 1L, 0L)")


def split_digest(subject: str, seed: int) -> Column:
    """Hex SHA-256 of ``seed:subject``; its text order is the order of the raw bytes."""
    return F.sha2(F.concat(F.lit(f"{int(seed)}:"), F.col(subject).cast("string")), 256)

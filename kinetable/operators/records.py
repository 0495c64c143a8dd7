"""Parse delimited reading lines, flag the bad ones and keep them countable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import evaluate_once

DEVICES = ("phone", "watch")
SENSORS = ("accel", "gyro")
AXES = ("x", "y", "z")
SAMPLE_COLUMNS = ("subject_id", "activity", "timestamp_ns", "device", "sensor", *AXES)


def _named_in_path(path: Column, names: tuple[str, ...]) -> Column:
    """First of ``names`` that is a folder on the path, else ``unknown``."""
    found = [F.when(path.contains(f"/{name}/"), F.lit(name)) for name in names]
    return F.coalesce(*found, F.lit("unknown"))


def _without_terminator(text: Column) -> Column:
    """Text without one closing semicolon and the blanks after it.

    Nearly always it is the final character; the pattern is for the rest.
    """
    plain = F.left(text, F.length(text) - 1)
    rare = F.regexp_replace(text, r";\s*$", "")
    return F.when(F.endswith(text, F.lit(";")), plain).otherwise(rare)


def _cut_at_point(text: Column, kind: str) -> Column:
    """The integer before a point; NULL unless digits and blanks are all that is around it.

    Digits are told from other characters by what is left without them.
    """
    blanks = F.lit(" \t\n\x0b\f\r")
    head = F.ltrim(F.substring_index(text, ".", 1), blanks)
    tail = F.rtrim(F.substr(text, F.instr(text, ".")), blanks)
    sign = F.translate(head, "0123456789", "")
    sound = (F.translate(tail, "0123456789", "") == ".") & sign.isin("", "+", "-")
    # A sign alone, or nothing, stands for zero before a point.
    number = F.when(head == sign, F.lit(0).cast(kind)).otherwise(head.try_cast(kind))
    return F.when(F.contains(text, F.lit(".")) & sound, number)


def _whole(text: Column, kind: str) -> Column:
    """Text as an integer; digits after a point are cut off, as a plain cast does."""
    return F.coalesce(text.try_cast(kind), _cut_at_point(text, kind))


def _is_valid() -> Column:
    activity = F.col("activity").rlike("^[A-S]$") & (F.col("activity") != "N")
    numbers = [F.col(name).isNotNull() for name in ("subject_id", "timestamp_ns", *AXES)]
    valid = (F.col("field_count") == 6) & activity & (F.col("timestamp_ns") >= 0)
    for number in numbers:
        valid = valid & number
    valid = valid & F.col("device").isin(*DEVICES) & F.col("sensor").isin(*SENSORS)
    return F.coalesce(valid, F.lit(False))


def parse_records(lines: DataFrame) -> DataFrame:
    """Typed readings with ``_parse_ok`` from lines ``(value, source_file)``.

    A line is ``subject,activity,timestamp,x,y,z;``.  Device and sensor come from the
    folders of the source path.  No row is dropped: what cannot be read is NULL and
    the flag is false.
    """
    located = evaluate_once(
        lines.select(
            F.col("value").alias("raw_line"),
            "source_file",
            F.trim("value").alias("trimmed"),
            F.lower("source_file").alias("path"),
        ),
        ["raw_line", "source_file", "trimmed"],
        [
            _named_in_path(F.col("path"), DEVICES).alias("device"),
            _named_in_path(F.col("path"), SENSORS).alias("sensor"),
        ],
    )
    fields = located.select(
        "raw_line",
        "source_file",
        "device",
        "sensor",
        F.split(_without_terminator(F.col("trimmed")), ",").alias("fields"),
    )

    def field(position: int) -> Column:
        # Short, as it is copied into every mention: a generated method that is too large
        # for the JIT costs more than all of the parsing.
        return F.get("fields", F.lit(position))

    typed = evaluate_once(
        fields,
        ["raw_line", "source_file", "device", "sensor"],
        [
            F.size("fields").alias("field_count"),
            _whole(field(0), "int").alias("subject_id"),
            F.trim(field(1)).alias("activity"),
            _whole(field(2), "bigint").alias("timestamp_ns"),
            *(field(3 + i).try_cast("double").alias(axis) for i, axis in enumerate(AXES)),
        ],
    )
    return typed.withColumn("_parse_ok", _is_valid())


def is_selected(device: str, sensors: list[str]) -> Column:
    """True for valid readings of one device and the wanted sensors."""
    return F.col("_parse_ok") & (F.col("device") == device) & F.col("sensor").isin(*sensors)


def valid_records(parsed: DataFrame, device: str, sensors: list[str]) -> DataFrame:
    """The selected readings, without the parser's own columns."""
    return parsed.where(is_selected(device, sensors)).select(*SAMPLE_COLUMNS)


def parse_quality(parsed: DataFrame) -> DataFrame:
    """Number of good and bad lines, one row per flag value."""
    return parsed.groupBy("_parse_ok").agg(F.count("*").alias("count"))

from __future__ import annotations

import math
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from kinetable.operators import records
from kinetable.sources.text import read_lines

WATCH = "file:/data/raw/watch/accel/a.txt"
GOOD = "1600,A,90426708196641,7.09,-2.992752E-4,8.19;"


def parsed(spark, *lines, path=WATCH):
    frame = spark.createDataFrame([(line, path) for line in lines], "value string, source_file string")
    return records.parse_records(frame).collect()


def test_a_good_line_is_typed(spark):
    (row,) = parsed(spark, GOOD)
    assert row.asDict() == {
        "raw_line": GOOD,
        "source_file": WATCH,
        "device": "watch",
        "sensor": "accel",
        "field_count": 6,
        "subject_id": 1600,
        "activity": "A",
        "timestamp_ns": 90426708196641,
        "x": 7.09,
        "y": -2.992752e-4,
        "z": 8.19,
        "_parse_ok": True,
    }


@pytest.mark.parametrize(
    "line",
    [
        "1600,A,5,1,2,3",
        "1600,A,5,1,2,3;",
        "1600,A,5,1,2,3;  ",
        "  1600,A,5,1,2,3;\t",
        "1600, A ,5,1,2,3;",
        "1600,S,0,1,2,3;",
        " 1600 ,A, 5 , 1 ,2,3;",
        "1600,A,5,NaN,Infinity,-Infinity;",
    ],
)
def test_accepted_lines(spark, line):
    (row,) = parsed(spark, line)
    assert row["_parse_ok"] is True


@pytest.mark.parametrize(
    "line",
    [
        "",
        ";",
        "1600,A,5,1,2",
        "1600,A,5,1,2,3,4;",
        "1600,N,5,1,2,3;",
        "1600,T,5,1,2,3;",
        "1600,a,5,1,2,3;",
        "1600,AB,5,1,2,3;",
        "1600,,5,1,2,3;",
        "x,A,5,1,2,3;",
        "1e1,A,5,1,2,3;",
        "99999999999,A,5,1,2,3;",
        "1600,A,x,1,2,3;",
        "1600,A,-5,1,2,3;",
        "1600,A,5,,2,3;",
        "1600,A,5,1,y,3;",
        "1600,A,5,1,2,;",
        "1600,A,5,1,2,3;;",
    ],
)
def test_rejected_lines_are_kept_and_flagged(spark, line):
    (row,) = parsed(spark, line)
    assert row["_parse_ok"] is False
    assert row["raw_line"] == line


def test_terminator_is_stripped_once(spark):
    rows = parsed(spark, "a,b;;", "a,b; ;", "a;b,c;", "a,b;x")
    assert [row["activity"] for row in rows] == ["b;", "b;", "c", "b;x"]


def test_special_readings_survive(spark):
    (row,) = parsed(spark, "1,A,5,NaN,Infinity,-Infinity;")
    assert math.isnan(row["x"])
    assert (row["y"], row["z"]) == (math.inf, -math.inf)


@pytest.mark.parametrize(
    ("path", "device", "sensor"),
    [
        ("/raw/Watch/GYRO/a", "watch", "gyro"),
        ("/raw/watch/phone/gyro/accel/a", "phone", "accel"),
        ("/raw/tablet/accel/a", "unknown", "accel"),
        ("/raw/phone/light/a", "phone", "unknown"),
        ("readings.txt", "unknown", "unknown"),
    ],
)
def test_device_and_sensor_come_from_the_folders(spark, path, device, sensor):
    (row,) = parsed(spark, GOOD, path=path)
    assert (row["device"], row["sensor"]) == (device, sensor)
    assert row["_parse_ok"] is ("unknown" not in (device, sensor))


def as_integer(text, bits):
    """As a plain cast reads it: digits after a point are cut off."""
    found = re.fullmatch(r"\s*([+-]?)([0-9]*)([.][0-9]*)?\s*", text)
    if not found or not (found[2] or found[3]):
        return None
    value = int(found[1] + (found[2] or "0"))
    return value if -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None


def as_double(text):
    try:
        return float(text.strip(" \t"))
    except ValueError:
        return None


def read_plainly(line):
    fields = re.sub(r";[ \t]*$", "", line.strip(" ")).split(",")
    get = dict(enumerate(fields)).get
    row = {
        "field_count": len(fields),
        "subject_id": as_integer(get(0, ""), 32),
        "activity": get(1).strip(" ") if len(fields) > 1 else None,
        "timestamp_ns": as_integer(get(2, ""), 64),
    } | {axis: as_double(get(3 + i, "")) for i, axis in enumerate("xyz")}
    row["_parse_ok"] = (
        len(fields) == 6
        and row["activity"] in set("ABCDEFGHIJKLMOPQRS")
        and None not in row.values()
        and row["timestamp_ns"] >= 0
    )
    return row


def test_random_lines_against_plain_python(spark):
    rng = random.Random(11)
    fields = ["1600", "A", "S", "N", "5", "90426708196641", "1.5", "-2.99E-4", "", " ", "x", "B;"]
    fields += ["99999999999", "-7", "+3", "\t4", ".5", "1.", "-", "A "]
    lines = []
    for _ in range(4000):
        if rng.random() < 0.5:
            parts = ["1600", rng.choice("ABN"), str(rng.randrange(10**14)), "0.5", "-1", "2"]
            for _ in range(rng.randrange(3)):
                parts[rng.randrange(6)] = rng.choice(fields)
        else:
            parts = [rng.choice(fields) for _ in range(rng.randrange(9))]
        lines.append(" " * rng.randrange(2) + ",".join(parts) + rng.choice(["", ";", "; ", ";;", ";\t", "; ;"]))
    rows = {row["raw_line"]: row.asDict() for row in parsed(spark, *set(lines))}
    assert len(rows) == len(set(lines))
    assert 100 < sum(row["_parse_ok"] for row in rows.values()) < len(rows) - 100
    for line, row in rows.items():
        expected = read_plainly(line)
        assert {name: row[name] for name in expected} == expected, line


def test_results_do_not_depend_on_ansi_mode(spark):
    lines = [GOOD, "", "x,A,5,1,2,3;", "1600,A,5"]
    strict = parsed(spark, *lines)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert parsed(spark, *lines) == strict
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_text_files_quality_and_selection(spark, tmp_path):
    for folder, text in {
        "phone/accel": f"{GOOD}\n\n{GOOD}\n",
        "watch/accel": f"{GOOD}\nbroken\n",
        "watch/gyro": GOOD,
    }.items():
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "data_1600.txt").write_text(text)
    frame = records.parse_records(read_lines(spark, f"{tmp_path}/*/*/*.txt"))
    quality = {row["_parse_ok"]: row["count"] for row in records.parse_quality(frame).collect()}
    assert quality == {True: 4, False: 2}
    selected = records.valid_records(frame, "watch", ["accel"])
    assert selected.columns == list(records.SAMPLE_COLUMNS)
    assert [(row["device"], row["sensor"]) for row in selected.collect()] == [("watch", "accel")]


def test_a_line_is_split_once_and_other_files_are_skipped_before(spark):
    frame = spark.range(10).selectExpr("cast(id as string) as value", "cast(id as string) as source_file")
    selected = records.valid_records(records.parse_records(frame), "watch", ["accel"])
    plan = selected._jdf.queryExecution().executedPlan().toString()
    # One branch for lines ending in the terminator, one for the others, in one split.
    assert plan.count("split(") == 1
    assert plan.index("split(") < plan.index("(device#") or "Filter ((device#" in plan
    assert "Python" not in plan


def _by_pattern(text, bits):
    """What the parser's integers mean: a cast, with digits after a point cut off."""
    blanks = " \t\n\x0b\f\r"
    found = re.fullmatch(rf"[{blanks}]*([+-]?[0-9]*)[.][0-9]*[{blanks}]*", text, re.ASCII)
    if found:
        text = "0" if found[1] in ("", "+", "-") else found[1]
    if not re.fullmatch(rf"[{blanks}]*[+-]?[0-9]+[{blanks}]*", text, re.ASCII):
        return None
    number = int(text)
    return number if -(1 << bits - 1) <= number < 1 << bits - 1 else None


def test_integers_without_patterns(spark):
    parts = ["", " ", "\t", "+", "-", "1", "007", "x", ".", "5", "\u0663", "2147483648", "e3", "1\n"]
    texts = sorted({"".join(some) for n in range(5) for some in product(parts, repeat=n) if n < 4 or
                    some[2] == "."})
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    found = rows.select(
        "text",
        records._whole(F.col("text"), "int").alias("small"),
        records._whole(F.col("text"), "bigint").alias("large"),
    ).collect()
    assert len(found) > 4_000
    for text, small, large in found:
        assert small == _by_pattern(text, 32), repr(text)
        assert large == _by_pattern(text, 64), repr(text)


def test_integers_need_no_regular_expression(spark):
    plan = spark.range(1).select(records._whole(F.col("id").cast("string"), "int"))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in shown and "RLIKE" not in shown

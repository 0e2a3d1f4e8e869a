"""Rounding and shift arithmetic against plain Python."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftlens.functions import columns as C

EPOCH = datetime(1970, 1, 1)


def us(t: datetime) -> int:
    return (t - EPOCH) // timedelta(microseconds=1)


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4])
def test_round_even_is_exact_on_ties(spark, digits):
    rnd = random.Random(digits)
    values = [2.675, 1.005, 0.125, 0.135, 12.35, 12.25, 0.5, 1.5, 2.5, -2.5, -0.125, 0.0, 1e9 + 0.05]
    values += [rnd.uniform(-500, 500) for _ in range(500)]
    values += [rnd.randrange(0, 200000) / 2000 for _ in range(2000)] + [rnd.randrange(10001) / 1e4 * 100 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", C.round_even(F.col("x"), digits).alias("y")).collect():
        expected = round(r.x, digits)
        assert r.y == expected and not (r.y == 0 and math.copysign(1, r.y) < 0), (r.x, digits)


def owner(t: datetime) -> tuple[str, str]:
    """(type, date) of the shift that owns an instant."""
    if t.hour < 7:
        return "night", str(t.date() - timedelta(days=1))
    return ("day" if t.hour < 19 else "night"), str(t.date())


def test_shift_assignment_and_window(spark):
    rnd = random.Random(1)
    times = [datetime(2024, 3, 31, h, m, s, f) for h in (0, 6, 7, 18, 19, 23) for m, s, f in ((0, 0, 0), (59, 59, 999999))]
    times += [datetime(2023, 12, 30) + timedelta(microseconds=rnd.randrange(3 * 10**12)) for _ in range(500)]
    df = spark.createDataFrame([(us(t),) for t in times], "us long").withColumn("ord", C.shift_of(F.col("us"), (7, 19)))
    rows = df.select(
        "us", C.shift_type(F.col("ord")).alias("kind"), C.shift_date_text(F.col("ord")).alias("day"),
        C.shift_start(F.col("ord"), (7, 19)).alias("s"), C.shift_end(F.col("ord"), (7, 19)).alias("e"),
        C.shift_label(F.col("ord")).alias("label"),
    ).collect()
    for r in rows:
        t = EPOCH + timedelta(microseconds=r.us)
        assert (r.kind, r.day) == owner(t)
        assert r.s <= r.us < r.e and r.e - r.s == 12 * 3600 * 10**6
        assert r.label == ("Day " if r.kind == "day" else "Night ") + r.day[5:]


def test_boundaries_are_strictly_between(spark):
    pairs = [
        (datetime(2024, 1, 1, 7), datetime(2024, 1, 1, 19)), (datetime(2024, 1, 1, 6, 59), datetime(2024, 1, 1, 19, 0, 1)),
        (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9)), (datetime(2024, 1, 1, 8), datetime(2024, 1, 3, 7)),
    ]
    df = spark.createDataFrame([(us(a), us(b)) for a, b in pairs], "a long, b long")
    got = [r.x for r in df.select(C.boundaries_between(F.col("a"), F.col("b"), (7, 19)).alias("x")).collect()]
    for (a, b), found in zip(pairs, got):
        marks = [datetime(2024, 1, d, h) for d in range(1, 5) for h in (7, 19)]
        assert found == [us(m) for m in marks if a < m < b]


def test_iso_week_over_new_year(spark):
    df = spark.createDataFrame([("2027-01-01",), ("2024-12-30",), ("2026-06-10",)], "d string").withColumn("d", F.to_date("d"))
    rows = df.select(C.iso_week(F.col("d")).alias("w"), C.week_label(F.col("d")).alias("l")).collect()
    assert [tuple(r) for r in rows] == [("2026-W53", "Week of Dec 28"), ("2025-W01", "Week of Dec 30"), ("2026-W24", "Week of Jun 08")]


def test_near_transition_does_not_wrap(spark):
    df = spark.createDataFrame([(m,) for m in (389, 390, 450, 451, 1110, 1170, 1171, 0, 1439)], "m int")
    got = [r.x for r in df.select(C.near_transition(F.col("m"), (7, 19)).alias("x")).collect()]
    assert got == [False, True, True, False, True, True, False, False, False]


def test_batch_end_label_uses_midday(spark):
    df = spark.createDataFrame([(us(datetime(2024, 1, 1, 12, 59, 59)),), (us(datetime(2024, 1, 1, 13)),)], "us long")
    assert [r.x for r in df.select(C.batch_end_label(F.col("us"), 13).alias("x")).collect()] == ["Night 12-31", "Day 01-01"]


def test_running_flag_forms(spark):
    df = spark.createDataFrame([("true",), ("True",), ("1",), ("False",), ("0",), (None,)], "x string")
    assert [r.y for r in df.select(C.as_flag(F.col("x")).alias("y")).collect()] == [True, True, True, False, False, None]

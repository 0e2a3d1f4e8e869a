"""Edge rules of OEE, causes and downtime on hand-made rows."""

from __future__ import annotations

import dataclasses
import pathlib

import numpy as np
import pytest
from conftest import at
from pyspark.sql import functions as F

from shiftlens.functions import causes
from shiftlens.functions.columns import MINUTE
from shiftlens.operators import downtime, intervals, oee
from shiftlens.config import LINE_A, LINE_B

A = "line_a"


def block(i, start, end, running, faults="x", kind="Auto", line=A):
    return (line, at(start), at(end) if end else None, running, faults, kind, i)


def test_boundary_and_zero_length_blocks(make_site):
    site = make_site(status_blocks=[
        block(1, "01-01 06:00:00", "01-01 07:00:00", False), block(2, "01-01 07:00:00", "01-01 07:00:00", False),
        block(3, "01-01 08:00:00", "01-01 08:00:00", False), block(4, "01-01 18:00:00", "01-01 20:00:00", False),
        block(5, "01-01 21:00:00", None, False),
    ])
    rows = intervals.block_shifts(site).select("start_id", "ord", (F.col("dur_us") / MINUTE).alias("m")).collect()
    got = sorted((r.start_id, r.m) for r in rows)
    assert got == [(1, 60.0), (3, 0.0), (4, 60.0), (4, 60.0)]
    total = {r.ord: r.total_stops for r in downtime.stop_summary(site).collect()}
    assert sorted(total.values()) == [1, 1, 2]


def test_availability_uses_fixed_length(make_site):
    site = make_site(status_blocks=[block(1, "01-01 07:00:00", "01-01 10:00:00", True), block(2, "01-01 10:00:00", "01-01 11:00:00", False)])
    r = oee.availability(site).collect()[0]
    assert (r.availability, r.running_hours, r.stopped_hours) == (25.0, 3.0, 1.0)


def test_speed_sample_on_a_closed_end_counts(make_site):
    site = make_site(
        status_blocks=[block(1, "01-01 08:00:00", "01-01 09:00:00", True), block(2, "01-01 18:00:00", "01-01 19:00:00", True)],
        ppm=[(A, at(t), v) for t, v in (
            ("01-01 07:59:59", 1.0), ("01-01 08:00:00", 2.0), ("01-01 09:00:00", 4.0), ("01-01 09:00:00.1", 8.0),
            ("01-01 19:00:00", 16.0), ("01-01 08:30:00", -1.0),
        )],
    )
    assert sorted(r.ppm for r in oee.running_samples(site).collect()) == [2.0, 4.0]


@pytest.mark.parametrize("rows, expected", [
    ([(0, 0), (100, 90), (150, 140), (10, 9), (30, 20)], (151 / 170 * 100, 151, 170)),  # the reset step adds nothing
    ([(100, 90)], (100.0, 0, 0)), ([(100, 90), (100, 90)], (100.0, 0, 0)), ([(5, 9), (100, 90), (None, 1), (120, 100)], (50.0, 10, 20)),
])
def test_quality_with_resets(make_site, rows, expected):
    site = make_site(output_stats=[(A, i, at(f"01-01 {8 + i}:00:00"), t, g) for i, (t, g) in enumerate(rows)])
    r = oee.quality(site).collect()[0]
    assert (r.quality, r.good_count, r.total_count) == (pytest.approx(expected[0]), expected[1], expected[2])


def decode(spark, site, faults, alarm=None, kind="Auto", line=A):
    df = spark.createDataFrame([(line, faults, alarm, kind)], "line_id string, faults string, alarm_text string, stop_type string")
    r = intervals.decoded(site, df).collect()[0]
    return r.label, r.segment, r.cluster


@pytest.mark.parametrize("faults, alarm, kind, line, expected", [
    ("x", None, "Auto", A, ("Unattributed", "unattributed", None)),
    (None, "No Alarm Text", "Auto", A, ("Unattributed", "unattributed", None)),
    ("", "2150 Pouch misfeed", "Auto", A, ("2150 Pouch misfeed", "foil", "Other")),
    ("x", "4 Closing area open", "Auto", A, ("4 Closing area open", "schubert", "Closing")),
    ("FC=@Fault_PLC1_0042@(Gripper no part) RC=1007", None, "Auto", A, ("RC=1007", "unattributed", None)),
    ("FC=@Fault_PLC1_42@(Gripper no part) RC=42", None, "Auto", A, ("Gripper no part", "hydration", "Gripper")),
    ("FC=@Fault_PLC1_0042@(Gripper no part) RC=42", None, "Auto", A, ("RC=42", "unattributed", None)),  # padded PLC1 form is no match
    ("FC=@Fault_0042@(Printer out) RC=42", None, "Auto", A, ("Printer out", "foil", "Printer")),
    ("FC=@Alarm_PLC1_9@", None, "Auto", A, ("Alarm_PLC1_9", "unattributed", None)),
    ("RC=1 RC=2 FC=@Warning_2@(Edge trim broken)", None, "Auto", A, ("RC=1", "foil", "Other")),  # segment of the second code, cluster of the label
    ("FC=@Fault_0042@(Printer out) RC=42", None, "MANUAL", A, ("Printer out", "manual", None)),
    ("FC=@Fault_0042@(Web torn) RC=42", None, "Auto", "line_b", ("Web torn", "web", "Web Torn")),
])
def test_decode(spark, make_site, faults, alarm, kind, line, expected):
    assert decode(spark, make_site(), faults, alarm, kind, line) == expected


def test_code_variants_order(spark):
    row = spark.range(1).select(causes.code_variants(F.lit(42)).alias("short"), causes.code_variants(F.lit(12345)).alias("long")).collect()[0]
    assert row.short[:4] == ["Fault_0042", "Fault_42", "Fault_PLC1_42", "Alarm_0042"]
    assert row.long[:3] == ["Fault_12345", "Fault_12345", "Fault_PLC1_12345"]


def test_secondary_code_weight_split(spark, make_site):
    from shiftlens.operators import attribution

    rows = spark.createDataFrame(
        [(A, 1, [7, 8], 10.0, "seven"), (A, 2, [], 5.0, "none")], "line_id string, start_id long, codes array<long>, w double, rc_label string"
    )
    lookup = spark.createDataFrame([(A, 7, "seven!")], "line_id string, code long, description string")
    equal = attribution.explode_codes(rows, lookup, "w")
    assert sorted((r.start_id, r.rc_label, r.w) for r in equal.collect()) == [(1, "RC=8", 5.0), (1, "seven!", 5.0), (2, "none", 5.0)]
    full = attribution.explode_codes(rows, lookup, "w", "primary_full")
    assert sorted((r.start_id, r.w) for r in full.collect()) == [(1, 0.0), (1, 10.0), (2, 5.0)]


def stops_site(make_site):
    """Latest shift is complete: blocks run past the night of the 2nd."""
    return make_site(
        status_blocks=[
            block(1, "01-01 07:00:00", "01-01 07:01:00", False, kind="Manual"), block(2, "01-01 07:01:00", "01-01 07:05:00", False),
            block(3, "01-01 07:05:00", "01-01 07:06:00", False), block(4, "01-01 07:06:00", "01-01 09:30:00", True),
            block(5, "01-01 09:30:00", "01-01 10:30:00", False, "FC=@Fault_0001@(Gripper) RC=1"), block(6, "01-01 10:30:00", "01-02 21:00:00", True),
        ],
        machine_state=[(A, at("01-01 07:00:30"), "Halted"), (A, at("01-01 07:05:00"), "Halted"), (A, at("01-01 10:30:00"), "Halted")],
        ppm=[(A, at("01-02 20:00:00"), 10.0)], output_stats=[(A, 1, at("01-02 20:00:00"), 1, 1)],
    )


def test_categories_overlap(make_site):
    site = stops_site(make_site)
    rows = downtime.categories(site, intervals.flagged_stops(site)).filter("count > 0").collect()
    # stop 1 is manual and halted: it counts in both; stop 3 is halted by the sample at its start
    assert {r.category: r["count"] for r in rows} == {"manual": 1, "halted": 2, "auto_long": 2}


def test_hours_and_segments_add_up(make_site):
    site = stops_site(make_site)
    hours = downtime.hourly(site)
    per_shift = {r.ord: r.us for r in hours.groupBy("ord").agg(F.sum("us").alias("us")).collect()}
    covered = {r.ord: r.us for r in intervals.block_shifts(site).groupBy("ord").agg(F.sum("dur_us").alias("us")).collect()}
    assert per_shift == covered
    assert hours.filter("segment = 'running'").groupBy("ord").count().agg(F.min("count")).collect()[0][0] == 12
    cells = downtime.segment_clusters(intervals.flagged_stops(site))
    segs = downtime.segments(site, cells)
    assert segs.groupBy("ord").count().select("count").distinct().collect()[0][0] == len(LINE_A.segments)
    assert segs.filter("segment = 'hydration'").agg(F.max("hours")).collect()[0][0] == 1.0


def test_top_stops_keep_ties_by_label(spark):
    rows = spark.createDataFrame(
        [(A, 1, "s", "c", f"l{i}", MINUTE * 60) for i in range(7)] + [(A, 1, "s", None, "none", 10**12)],
        "line_id string, ord long, segment string, cluster string, label string, dur_us long",
    )
    got = downtime.top_stops(rows).orderBy("rank").collect()
    assert [r.label for r in got] == ["l0", "l1", "l2", "l3", "l4"] and got[0].hours == 1.0


def test_different_bounds_are_refused(make_site):
    from dataclasses import replace

    with pytest.raises(ValueError):
        make_site(lines=[LINE_A, replace(LINE_B, bounds=(6, 18))])


def test_label_hours_round_each_stop(spark):
    rows = spark.createDataFrame(
        [(A, 1, "s", "c", "l", 200_000) for _ in range(100)], "line_id string, ord long, segment string, cluster string, label string, dur_us long"
    )
    r = downtime.top_stops(rows).collect()[0]
    assert (r["count"], r.hours) == (100, 0.01)  # 100 x round(0.0000556, 4), not round(0.00556, 2) of the plain sum
    tiny = rows.withColumn("dur_us", F.lit(100_000))
    assert downtime.top_stops(tiny).collect()[0].hours == 0.0


def test_a_line_without_panels_has_every_table(spark):
    from shiftlens.plans import star
    from shiftlens.sources.site import Site

    site = Site.from_events(spark, "/root/testdata/sf0.001")
    tables = star.build(site, lines_only=["line_b"])
    assert len(tables) == 16
    counts = {name: df.count() for name, df in tables.items()}
    assert counts["SPC"] == counts["EWMA"] == 0
    assert counts["Shifts"] > 50 and counts["Lines"] == 1
    # one row per week of the one line
    assert counts["WeeklySummary"] == tables["WeeklySummary"].select("Week").distinct().count() > 1
    site.close()


def test_halted_stops_without_a_reason_id(make_site):
    site = make_site(
        status_blocks=[
            block(None, "01-01 08:00:00", "01-01 08:10:00", False), block(5, "01-01 09:00:00", "01-01 09:10:00", False),
            block(None, "01-01 10:00:00", "01-01 10:10:00", False),
        ],
        machine_state=[(A, at("01-01 08:05:00"), "Halted"), (A, at("01-01 09:05:00"), "Halted")],
    )
    got = {r.s_us: r.halted for r in intervals.flagged_stops(site).select("s_us", "halted").collect()}
    assert [got[k] for k in sorted(got)] == [True, True, False]


def running_days(first, n):
    from datetime import timedelta

    return [(A, first + timedelta(hours=12 * i), first + timedelta(hours=12 * (i + 1)), True, "x", "Auto", i) for i in range(n)]


def test_three_windows_give_three_ideal_speeds(make_site):
    from datetime import timedelta

    first = at("01-01 07:00:00")
    speeds = [(A, first + timedelta(hours=12 * i + 1), float(200 - i)) for i in range(42)]
    stats = [(A, i, first + timedelta(hours=12 * i + 11, minutes=59), 10, 9) for i in range(42)] + [(A, 99, first + timedelta(hours=12 * 42), 20, 19)]
    profile = dataclasses.replace(LINE_A, excluded_days=("2024-01-15", "2024-01-08"))
    rows = running_days(first, 42)
    site = make_site(lines=[profile], status_blocks=rows, ppm=[*speeds, (A, first + timedelta(hours=12 * 42), 1.0)], output_stats=stats)
    ideal = {s: {r.week: r.ideal_ppm for r in oee.ideal_speed(site, s).collect()} for s in ("week", "published", "single")}
    p95 = lambda lo, hi: float(np.percentile([200.0 - i for i in range(lo, hi + 1)], 95))
    # shifts 0-41; days 7 and 14 (shifts 14, 15 and 28, 29) are excluded; week 0 holds shifts 28-41
    assert ideal["week"][0] == pytest.approx(p95(30, 41)) and ideal["published"][0] == pytest.approx(p95(17, 41))
    assert ideal["single"] == {0: pytest.approx(p95(28, 41))}
    empty = make_site(lines=[profile], status_blocks=rows, ppm=[(A, first + timedelta(hours=12 * 42), -1.0)], output_stats=stats)
    assert {r.ideal_ppm for r in oee.ideal_speed(empty, "published").collect()} == {100.0}


def test_since_keeps_whole_shifts_and_open_blocks(make_site):
    site = make_site(
        status_blocks=[
            block(1, "01-01 08:00:00", "01-01 09:00:00", True), block(2, "01-02 08:00:00", "01-02 09:00:00", True), block(3, "01-02 21:00:00", None, False),
        ],
        ppm=[(A, at("01-02 06:59:59"), 1.0), (A, at("01-02 07:30:00"), 2.0)],
    )
    later = site.since("2024-01-02 12:00:00")
    assert sorted(r.start_id for r in later.table("status_blocks").collect()) == [2, 3]
    assert [r.output_ppm for r in later.table("ppm").collect()] == [2.0]
    night = site.since("2024-01-02 03:00:00")
    assert [r.output_ppm for r in night.table("ppm").orderBy("t_stamp").collect()] == [1.0, 2.0]


def test_derived_sites_share_the_folder(make_site):
    site = make_site(status_blocks=[block(1, "01-01 08:00:00", "01-01 09:00:00", True)])
    only = site.only([A]).since("2024-01-01 07:00:00")
    only.stage("x", lambda: only.table("status_blocks").select("line_id"))
    root = pathlib.Path(site._stage.root)
    assert list(root.rglob("*.parquet"))
    site.close()
    assert not root.exists()


def test_a_lookback_of_zero_reads_all_history(make_site):
    from shiftlens.operators import spc

    panel = LINE_A.panels[0]
    name = panel.patterns[0].replace("%", "1")
    rows = [(A, i, i, at(f"{m:02d}-01 08:00:00"), name, i) for i, m in enumerate((1, 5, 9))]
    site = make_site(**{panel.table: rows})
    floors = {d: spc.lookback_floor(site.with_lookback(d)).filter(F.col("counter_table") == panel.table).first().floor_us for d in (0, 30)}
    assert floors[0] < floors[30] and spc.representative_rows(site.with_lookback(0)).filter(F.col("panel") == panel.key).count() == 3
    assert spc.representative_rows(site.with_lookback(30)).filter(F.col("panel") == panel.key).count() == 1

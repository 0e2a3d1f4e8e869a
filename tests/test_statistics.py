"""Anomaly scores, SPC mathematics, schedule and measures against plain Python."""

from __future__ import annotations

import random
import statistics
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shiftlens.operators import anomalies, measures, schedule, spc


def outlier(spark, current, values, key="seg:cl"):
    seg, cl = key.split(":")
    s1, s2 = sum(values), sum(v * v for v in values)
    cells = spark.createDataFrame([("l", seg, cl, current, s1, s2, len(values))], "line_id string, segment string, cluster string, share4 long, s1 long, s2 long, n long")
    return anomalies.outliers(cells, ["line_id"]).collect()


@pytest.mark.parametrize("current, values", [
    (3000, [1000, 1100, 900, 1050]), (0, [1000, 1100, 900, 1050]), (1200, [1000] * 13), (600, []), (600, [100]), (400, [0, 0, 0]), (501, [0, 0, 0]), (2000, [500, 3500, 2000]),
])
def test_z_score(spark, current, values):
    got = outlier(spark, current, values)
    if not values:
        assert got == []
        return
    cur, base = current / 1e4, [v / 1e4 for v in values]
    mean = sum(base) / len(base)
    std = max(statistics.stdev(base), 0.01) if len(base) > 1 else 0.01
    z = (cur - mean) / std
    if abs(z) >= 1.8 and (cur > 0.05 or mean > 0.05):
        r = got[0]
        assert (r.z_score, r.direction) == (pytest.approx(round(z, 1)), "above" if z > 0 else "below")
        assert r.current_share == round(cur * 100, 1) and r.baseline_mean == pytest.approx(round(mean * 100, 1))
    else:
        assert got == []


def test_rank_by_rounded_z_then_key(spark):
    rows = [("l", "b", "x", 3000, 0, 0, 3), ("l", "a", "x", 3000, 0, 0, 3), ("l", "c", "x", 5000, 0, 0, 3)]
    cells = spark.createDataFrame(rows, "line_id string, segment string, cluster string, share4 long, s1 long, s2 long, n long")
    got = anomalies.outliers(cells, ["line_id"]).orderBy("rank").collect()
    assert [r.segment for r in got] == ["c", "a", "b"]


def laney(d, n):
    p = sum(d) / sum(n)
    z = [((x / m - p) / (p * (1 - p) / m) ** 0.5) if p > 0 else 0 for x, m in zip(d, n)]
    moves = [abs(b - a) for a, b in zip(z, z[1:])]
    return p, max((sum(moves) / len(moves) if moves else 1.0) / 1.128, 0.01)


@pytest.mark.parametrize("d, n", [([1, 5, 3, 9], [200.0, 300.0, 150.5, 400.0]), ([0, 0, 0], [200.0, 300.0, 100.0]), ([4], [250.0])])
def test_laney_parameters(spark, d, n):
    df = spark.createDataFrame([("l", i, float(m), x) for i, (x, m) in enumerate(zip(d, n))], "line_id string, pos long, n double, d long")
    r = spc.laney_params(df, ["line_id"]).collect()[0]
    p, sigma = laney(d, n)
    assert r.p_bar == pytest.approx(p) and r.sigma_z == pytest.approx(sigma) and r.baseline_n == len(d)


def test_limits_flag_only_above(spark):
    df = spark.createDataFrame([(0.1, 1.0, 100.0, 20), (0.1, 1.0, 100.0, 0), (0.1, 1.0, 0.0, None)], "p_bar double, sigma_z double, n double, d long")
    got = spc.with_limits(df).collect()
    assert [r.ooc for r in got] == [True, False, False]
    assert got[0].ucl == pytest.approx(0.1 + 3 * 0.03) and got[1].lcl == pytest.approx(0.01) and got[2].ucl is None


def test_ewma_rounds_its_state(spark, make_site):
    rnd = random.Random(2)
    rejects = [rnd.randrange(30) for _ in range(45)]
    rows = [("line_a", "nozzle_spc", i, 0, i * 1000, 1500, 10, "x_1", r, 0, i + 1, 45, 1, 150.0) for i, r in enumerate(rejects)]
    subs = spark.createDataFrame(rows, "line_id string, panel string, block_id long, seg int, stamp_us long, peak long, divisor int, lane string, rejects long, ord long, no int, total_subgroups int, lane_no int, n_inspected double")
    anchors = spark.createDataFrame([("line_a", "nozzle_spc", 0, 44_000, 20_000), ("line_a", "nozzle_spc", 1, 5_000, 2_000), ("line_a", "nozzle_spc", 2, 1_000, 0)],
                                    "line_id string, panel string, week int, end_us long, base_us long")
    lanes = subs.select("line_id", "panel", "lane", "lane_no").distinct()
    got = spc.ewma_series(make_site(), subs, lanes, anchors, ["week"]).orderBy("week", "batch_idx").collect()
    for week, shown, base in ((0, rejects[15:45], rejects[:20]), (1, rejects[:6], rejects[:6])):
        rates = [r / 150.0 * 100 for r in shown]
        state, want = rates[0], [rates[0]]
        for x in rates[1:]:
            state = round(0.2 * x + 0.8 * state, 3)
            want.append(state)
        mine = [r for r in got if r.week == week]
        assert [r.ewma for r in mine] == want
        b = [r / 150.0 * 100 for r in base]
        half = 2.7 * statistics.stdev(b) * (0.2 / 1.8) ** 0.5
        assert mine[0].ucl == pytest.approx(round(statistics.mean(b) + half, 2)) and mine[0].lcl == pytest.approx(round(max(0, statistics.mean(b) - half), 2))
    assert not [r for r in got if r.week == 2]  # fewer than three points


def test_day_classes(spark, make_site):
    from conftest import at

    site = make_site(
        status_blocks=[("line_a", at("01-01 00:00:00"), at("01-01 01:59:00.9"), True, "x", "Auto", 1), ("line_a", at("01-02 00:00:00"), at("01-02 03:00:00"), True, "x", "Auto", 2),
                       ("line_a", at("01-03 00:00:00"), at("01-03 00:10:00"), True, "x", "Auto", 3), ("line_a", at("01-04 00:00:00"), None, True, "x", "Auto", 4)],
        output_stats=[("line_a", 1, at("01-01 00:00:00"), 0, 0), ("line_a", 2, at("01-01 23:00:00"), 4999, 0), ("line_a", 3, at("01-02 01:00:00"), 0, 0), ("line_a", 4, at("01-02 22:59:00"), 10, 0),
                      ("line_a", 5, at("01-03 00:30:00"), 0, 0), ("line_a", 6, at("01-03 22:30:00"), 6000, 0)],
    )
    got = {str(r.day): (r.classification, r.effective_hours) for r in schedule.schedule(site).collect()}
    assert got == {"2024-01-01": ("non_production", 0.0), "2024-01-02": ("partial", 21.98), "2024-01-03": ("full", 24.0), "2024-01-04": ("non_production", 0.0)}
    s = schedule.summary(schedule.schedule(site)).collect()[0]
    assert (s.total_days, s.non_production_days, s.effective_hours, s.excluded_hours, s.exclusion_pct) == (4, 2, 45.98, 50.02, 52.1)


def test_measures_are_ratios_of_sums(spark):
    rows = [("a", "k1", 6.0, 12, 50.0, 90, 100, 3, 1.5, 10.0), ("a", "k2", 3.0, 12, 80.0, 10, 20, 4, 2.5, 30.0), ("b", "k3", 0.0, 12, 0.0, 0, 0, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "LineId string, ShiftKey string, RunningHours double, ScheduledHours int, Performance double, GoodCount long, TotalCount long, TotalStops long, TotalDowntimeHours double, LongestStopMin double")
    got = {r.LineId: r for r in measures.evaluate(df, "Shifts", ["LineId"]).collect()}
    a = got["a"]
    assert (a.availability_pct, a.performance_pct, a.quality_pct) == (37.5, 60.0, pytest.approx(100 / 120 * 100))
    assert a.oee_pct == pytest.approx(37.5 * 60 * (100 / 120 * 100) / 10000) and a.shift_count == 2 and a.longest_stop_min == 30.0
    assert got["b"].quality_pct is None and got["b"].performance_pct is None and got["b"].availability_pct == 0.0


def test_no_measure_is_missing():
    assert sum(len(m) for m in measures.measure_definitions().values()) == 49


def test_headline_texts(spark, make_site):
    rows = [("line_a", "foil", "Printer", 12.0, 5.0, "above"), ("line_a", "foil", "Printer", 6.0, 5.0, "above"), ("line_a", "foil", "Printer", 1.0, 5.0, "below"), ("line_b", "web", "Splice", 9.0, 0.0, "above")]
    df = spark.createDataFrame(rows, "line_id string, segment string, cluster string, current_share double, baseline_mean double, direction string")
    got = {(r.current_share, r.headline, r.detail) for r in anomalies.with_headline(make_site(), df, "week").collect()}
    assert (12.0, "2× more Printer stops than usual (Foil)", "12.0% of this week's downtime, normally 5.0%") in got
    assert (6.0, "more Printer stops than usual (Foil)", "6.0% of this week's downtime, normally 5.0%") in got
    assert any(h == "Fewer Printer stops than usual (Foil)" for _, h, _ in got) and any(h == "more Splice stops than usual (Web / Reel)" for _, h, _ in got)


def test_shares_of_a_shift_sum_to_one(spark, make_site):
    from conftest import at

    blocks = [("line_a", at(f"01-01 {8 + i}:00:00"), at(f"01-01 {8 + i}:{10 + i}:00"), False, f"FC=@Fault_000{i}@(gripper {i}) RC={i}" if i % 2 else "x", "Auto", i) for i in range(6)]
    total = anomalies.profiles(make_site(status_blocks=blocks)).agg(F.sum("share4")).collect()[0][0]
    assert abs(total - 10000) <= 2


def test_slots_make_up_every_segment(spark):
    rnd = random.Random(6)
    pairs = [(a, a + d) for d in (1, 59, 60, 61, 3599, 3600, 3601, 7300, 90_000) for a in (rnd.randrange(10_000_000) for _ in range(12))]
    pairs += [(7200, 10_800), (7200, 7260), (59, 61), (60, 120), (0, 86_400), (3540, 3660)]
    df = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", spc.covering(F.col("lo"), F.col("hi")).alias("s"))
    for r in df.collect():
        seconds = sorted(x for level, slot in r.s for x in range(slot * 60**level, (slot + 1) * 60**level))
        assert seconds == list(range(r.lo, r.hi)) and len(r.s) <= 4 * 59 + (r.hi - r.lo) // 3600


def test_peaks_against_all_samples(spark, make_site):
    from conftest import at

    rnd = random.Random(7)
    start = 1_704_067_200
    samples = [("line_a", i, at("01-01 00:00:00") + timedelta(microseconds=us), n, n) for i, (us, n) in enumerate(
        (rnd.randrange(9_000) * 1_000_000 + rnd.choice((0, 0, 1, 500_000)), rnd.randrange(-2, 50)) for _ in range(900))]
    site = make_site(output_stats=samples)
    cuts = sorted(rnd.sample(range(9_000), 40))
    segs = [("line_a", "p", i, 0, (start + a) * 1_000_000, (start + b) * 1_000_000, i % 2 == 0) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    segs.append(("line_a", "p", 99, 0, segs[3][4], segs[3][4], True))
    df = spark.createDataFrame(segs, "line_id string, panel string, block_id long, seg int, lo long, hi long, closed boolean")
    got = {r.block_id: r.peak for r in spc.peaks(site, df).collect()}
    want = {}
    for _, _, block, _, lo, hi, closed in segs:
        inside = [n for _, _, t, n, _ in samples if n > 0 and lo <= (us := start * 1_000_000 + (t - at("01-01 00:00:00")) // timedelta(microseconds=1)) and (us < hi or closed and us == hi)]
        if inside:
            want[block] = max(inside)
    assert got == want
    plan = spc.second_peaks(site, (0, 1 << 60))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # panels do not multiply the samples
    site.close()

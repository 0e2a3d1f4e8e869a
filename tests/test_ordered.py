"""Chunked ordered operators against brute force, with hot chunks forced by a tiny limit."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlens.functions import ordered as O
from shiftlens.functions.columns import MINUTE, SECOND

COLD = O.Chunking(split_hot=False)
HOT = O.Chunking(hot_rows=5)


def series(spark, n=400, span=3 * 60 * MINUTE, seed=3):
    """Two thirds of the rows in one key, a third of those in a single minute."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "a" if rnd.random() < 0.7 else "b"
        t = rnd.randrange(MINUTE) if rnd.random() < 0.33 else rnd.randrange(span)
        rows.append((key, i, t, rnd.randrange(100)))
    return rows, spark.createDataFrame(rows, "k string, id long, us long, v long")


@pytest.mark.parametrize("chunking", [COLD, HOT])
@pytest.mark.parametrize("forward", [False, True])
def test_lag_and_lead_cross_chunks(spark, chunking, forward):
    rows, df = series(spark)
    out = O.with_previous(O.assign_chunks(df, ["k"], "us", chunking), ["k"], ["us", "id"], {"v": "p"}, forward=forward)
    got = {r.id: r.p for r in out.collect()}
    assert len(got) == len(rows)
    for key in "ab":
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]), reverse=forward)
        for before, row in zip([None, *own], own):
            assert got[row[1]] == (before[3] if before else None)


@pytest.mark.parametrize("chunking", [COLD, HOT])
def test_running_sums_restart_with_scope(spark, chunking):
    rows, df = series(spark)
    hour = 60 * MINUTE
    df = df.withColumn("scope", F.floor(F.col("us") / hour))
    out = O.with_running_sums(
        O.assign_chunks(df, ["k"], "us", chunking), ["k"], ["us", "id"], {"total": F.col("v")}, scope="scope"
    )
    got = {r.id: r.total for r in out.collect()}
    sums: dict = {}
    for k, i, t, v in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        sums[k, t // hour] = sums.get((k, t // hour), 0) + v
        assert got[i] == sums[k, t // hour]


def disjoint(rnd, span):
    cuts = sorted(rnd.sample(range(span), 40))
    return [(a, b) for a, b in zip(cuts[::2], cuts[1::2])]


@pytest.mark.parametrize("chunking", [COLD, HOT])
def test_point_in_interval(spark, chunking):
    rnd, span = random.Random(5), 180 * MINUTE
    spans = {k: disjoint(rnd, span) for k in "ab"}
    points = [(k, i, t) for i, (k, t) in enumerate(
        [(rnd.choice("ab"), rnd.randrange(span)) for _ in range(300)] + [("a", b) for _, b in spans["a"]] + [("a", a) for a, _ in spans["a"]]
    )]
    iv = spark.createDataFrame([(k, a, b) for k in spans for a, b in spans[k]], "k string, lo long, hi long")
    pt = spark.createDataFrame(points, "k string, id long, us long")
    out = O.latest_start_asof(pt, iv, ["k"], "us", "lo", "hi", chunking, payload=["id"]).filter("us <= iv_hi")
    got = {(r.id, r.iv_lo) for r in out.collect()}
    want = {(i, max(a for a, b in spans[k] if a <= t <= b)) for k, i, t in points if any(a <= t <= b for a, b in spans[k])}
    assert got == want


@pytest.mark.parametrize("chunking", [COLD, HOT])
def test_interval_hit_is_half_open(spark, chunking):
    rnd, span = random.Random(9), 120 * MINUTE
    spans = [(k, i, *sorted(rnd.sample(range(span), 2))) for i, k in enumerate("ab" * 60)]
    points = [("a", rnd.randrange(span)) for _ in range(25)] + [("b", hi) for k, _, _, hi in spans[:8] if k == "b"]
    points += [("b", lo) for k, _, lo, _ in spans[20:28] if k == "b"]
    iv = spark.createDataFrame(spans, "k string, id long, lo long, hi long")
    pt = spark.createDataFrame(points, "k string, us long")
    got = {r.id for r in O.intervals_hit(iv, pt, ["id"], ["k"], "us", "lo", "hi", chunking).collect()}
    assert got == {i for k, i, lo, hi in spans if any(pk == k and lo <= t < hi for pk, t in points)}


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 50, [1.0, 2.0, 3.0, 10.0], [float(x % 7) for x in range(1000)], list(np.random.default_rng(4).lognormal(size=5000)),
    [1e12, *np.random.default_rng(5).normal(50, 1, size=3000)],
])
@pytest.mark.parametrize("q, bins", [(0.0, 16), (0.5, 2), (0.95, 1024), (1.0, 16)])
def test_exact_percentile(spark, values, q, bins):
    from shiftlens.sources.staging import Stage

    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 3.0)], "k string, v double")
    kept = Stage(spark)
    got = {r.k: r.percentile for r in O.exact_percentile(df, ["k"], "v", q, kept.get, bins=bins).collect()}
    assert got["b"] == 3.0
    assert got["a"] == pytest.approx(float(np.percentile(values, q * 100)), rel=1e-12)
    kept.drop()


def test_percentile_orders_no_key_in_one_task(spark):
    from shiftlens.sources.staging import Stage

    df = spark.createDataFrame([("a", float(i * i % 7919), "x", 1.0) for i in range(4000)], "k string, v double, rank string, hi double")
    kept, plans = Stage(spark), []

    def stage(name, make):
        def planned():
            out = make()
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out

        return kept.get(name, planned)

    assert O.exact_percentile(df, ["k"], "v", 0.95, stage).count() == 1
    assert len(plans) >= 2 and not any("Window" in p or "Sort " in p for p in plans)
    assert all("partial_count" in p for p in plans)
    kept.drop()


def test_hot_chunks_become_seconds(spark):
    df = spark.createDataFrame([("a", i * SECOND // 2) for i in range(40)] + [("b", 0)], "k string, us long")
    starts = {(r.k, r.chunk_us) for r in O.assign_chunks(df, ["k"], "us", O.Chunking(hot_rows=10)).collect()}
    assert starts == {("a", s * SECOND) for s in range(20)} | {("b", 0)}


def test_hot_chunks_do_not_change_results(spark):
    from shiftlens.plans.registry import QUERIES
    from shiftlens.sources.site import Site

    usual = Site.from_events(spark, "/root/testdata/sf0.001")
    hot = Site.from_events(spark, "/root/testdata/sf0.001", chunking=O.Chunking(width=60 * MINUTE, hot_rows=1))
    for name in ("oee5_shift_oee", "joi5_halted_stops", "joi9_peak_in_range", "spc5_subgroups"):
        a, b = (sorted(map(tuple, QUERIES[name](s).collect()), key=str) for s in (usual, hot))
        assert a == b and a, name
    usual.close()
    hot.close()

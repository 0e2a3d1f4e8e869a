"""Documents: what a reader finds in the stored text, and what an SPC-only run touches."""

from __future__ import annotations

import json
import os

import pytest

from shiftlens import Site
from shiftlens.plans import documents, nested, week_documents

DATA = os.environ.get("SHIFTLENS_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def site(spark):
    made = Site.from_events(spark, DATA)
    yield made
    made.close()


def test_spc_only_reaches_no_other_stage(site):
    fresh = site._derived("alone")
    assert documents.spc_snapshot(fresh).count() == 2
    made = {n.removeprefix("alone/") for n in site._stage._tables if n.startswith("alone/")}
    assert any(n.startswith("spc.") for n in made)
    assert {n.split(".")[0] for n in made} <= {"spc", "calendar", "schedule"}, made


def test_stored_text_of_a_week(site, tmp_path):
    folder = str(tmp_path / "weeks")
    documents.write_documents(week_documents.week_documents(site), folder, by=week_documents.KEY)
    files = [p for p in (tmp_path / "weeks").rglob("*.json")]
    assert len({p.parent for p in files}) == week_documents.week_documents(site).count()
    newest = [json.loads(line) for p in files if "week=0" in str(p) for line in p.read_text().splitlines()]
    for doc in newest:
        assert set(doc["body"]) >= {"from", "to", "oee", "downtime_categories", "segment_downtime", "top_stops_by_cluster", "anomalies", "prior_week"}
        assert len(doc["shifts"]) == 14
        for row in doc["shifts"]:
            assert ("oee" in row) != row["skipped"]
        for panel in doc.get("weekly_spc", {}).values():
            for lane in panel["lanes"]:
                # a gap is null in its place, so every lane has the length of the axis
                assert all(len(values) == len(panel["labels"]) == panel["total_shifts"] for values in lane["points"].values())
                assert [r is None for r in lane["points"]["rate_pct"]] == [u is None for u in lane["points"]["ucl_pct"]]
            assert sum(r is not None for r in panel["lanes"][0]["points"]["rate_pct"]) == panel["shift_subgroups"] == len(panel["shift_table"])


def test_flat_tables_invert_nested_parts(spark):
    rows = [("a", 0, "press", "jam", 2, 1.5, 0.5, 1.0), ("a", 0, "press", "Other", 1, 0.2, 0.0, 0.2)]
    names = "line_id string, week int, segment string, cluster string, count long, hours double, halted_hours double, stopped_hours double"
    clus = spark.createDataFrame(rows, names)
    segs = spark.createDataFrame([("a", 0, "press", 3, 1.7, 0.5, 1.2), ("a", 0, "manual", 1, 0.4, 0.0, 0.4), ("a", 0, "idle", 0, 0.0, 0.0, 0.0)], names.replace("cluster string, ", ""))
    whole = nested.segments(segs, clus, ["line_id", "week"])
    assert sorted(map(tuple, nested.flat_segments(whole, ["line_id", "week"]).collect())) == sorted(map(tuple, segs.collect()))
    assert sorted(map(tuple, nested.flat_clusters(whole, ["line_id", "week"]).collect())) == sorted(rows)
    labels = spark.createDataFrame([("a", s, s.upper()) for s in ("press", "manual", "idle")], "line_id string, segment string, segment_label string")
    with_pseudo = sorted(map(tuple, nested.flat_clusters(whole, ["line_id", "week"], labels).collect()))
    assert with_pseudo == sorted([*rows, ("a", 0, "manual", "MANUAL", 1, 0.4, 0.0, 0.4)])


def test_hours_keep_their_order_and_pseudo_clusters(spark):
    cells = [(1, i, f"{i:02d}:00", "running", 30.0 + i) for i in range(12)] + [(1, 3, "03:00", "press", 4.0), (1, 3, "03:00", "manual", 2.0), (1, 5, "05:00", "idle", 0.0)]
    per_segment = spark.createDataFrame([("a", *c) for c in cells], "line_id string, ord long, hour_idx int, hour_label string, segment string, minutes double")
    per_cluster = spark.createDataFrame([("a", 1, 3, "03:00", "press", "jam", 4.0)], "line_id string, ord long, hour_idx int, hour_label string, segment string, cluster string, minutes double")
    whole = nested.hours(per_segment, per_cluster, ["line_id", "ord"])
    assert [h.hour_label for h in whole.first().hourly_breakdown] == [f"{i:02d}:00" for i in range(12)]
    flat = nested.flat_hours(whole, ["line_id", "ord"]).drop("clusters")
    assert sorted(tuple(r) for r in flat.select(*per_segment.columns).collect()) == sorted(tuple(r) for r in per_segment.collect())
    labels = spark.createDataFrame([("a", s, s.upper()) for s in ("press", "manual", "idle")], "line_id string, segment string, segment_label string")
    got = nested.flat_hour_clusters(whole, ["line_id", "ord"], labels).select("hour_idx", "segment", "cluster", "minutes")
    assert sorted(map(tuple, got.collect())) == [(3, "manual", "MANUAL", 2.0), (3, "press", "jam", 4.0)]

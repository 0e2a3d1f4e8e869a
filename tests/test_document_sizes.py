"""Sizes of the nested parts beside the heads of documents and snapshots."""

from __future__ import annotations

import dataclasses
import json

from conftest import at

from shiftlens.config import LINE_A
from shiftlens.plans import documents
from shiftlens.plans.registry import QUERIES

A = "line_a"


def test_shift_documents_count_their_breakdowns(make_site):
    """Day shifts stop for the gripper, the last one for the printer; nights have no block at all."""
    blocks = []
    for d in range(1, 18):
        reason = "FC=@Fault_0001@(Gripper) RC=1" if d < 17 else "FC=@Fault_0042@(Printer out) RC=42"
        blocks += [(A, at(f"01-{d:02d} 07:00:00"), at(f"01-{d:02d} 18:00:00"), True, "x", "Auto", 2 * d),
                   (A, at(f"01-{d:02d} 18:00:00"), at(f"01-{d:02d} 19:00:00"), False, reason, "Auto", 2 * d + 1)]
    site = make_site(
        lines=[dataclasses.replace(LINE_A, excluded_days=("2024-01-15",))],
        status_blocks=[*blocks, (A, at("01-18 08:00:00"), at("01-18 09:00:00"), True, "x", "Auto", 99)],
        ppm=[(A, at("01-18 09:00:00"), 10.0)], output_stats=[(A, 1, at("01-18 09:00:00"), 1, 1)],
    )
    try:
        rows = QUERIES["oee10_shift_document"](site).collect()
    finally:
        site.close()
    got = {r.shift_key.removeprefix("line_a|2024-01-"): (r.n_segments, r.n_hours, r.n_outliers) for r in rows}
    n = len(LINE_A.segments)
    assert len(rows) == len(got) == 34
    assert got["17|day"] == (n, 12, 1)  # the printer was never a cause before
    assert got["16|day"] == (n, 12, 0) and got["16|night"] == (n, 0, 0)
    assert sum(r.day_excluded for r in rows) == 2
    assert got["15|day"] == (n, 12, 0)


def test_snapshots_count_shifts_and_detail_rows(make_site, tmp_path):
    lanes = lambda *numbers: [{"lane": i, "rejects": i, "rate_pct": 0.1, "ooc": False} for i in numbers]
    shift = lambda o, skipped: {"ord": o, "label": f"s{o}", "skipped": skipped}
    panels = {
        "nozzle_spc": {"shift_table": [{"label": "s1", "per_lane": lanes(1, 2, 3)}, {"label": "s3", "per_lane": lanes(1, 2, 3)}]},
        "camera_spc": {"labels": ["s1", "s3"]}, "vision_spc": {"shift_table": [{"label": "s3", "per_lane": lanes(5)}]},
    }
    docs = [
        {"line_id": "line_a", "snapshot_key": "20240130_1745", "shifts": [shift(1, False), shift(2, True), shift(3, False)], "weekly_spc": panels},
        {"line_id": "line_b", "snapshot_key": "20240130_2315", "shifts": [shift(1, False)]},
    ]
    (tmp_path / "docs.json").write_text("\n".join(map(json.dumps, docs)))
    site = make_site()
    try:
        schema = documents.spc_snapshot(site).schema
        site.stage("snapshots.read_back", lambda: site.spark.read.schema(schema).json(str(tmp_path / "docs.json")))
        rows = QUERIES["spc20_spc_only"](site).collect()
    finally:
        site.close()
    got = sorted((r.line_id, r.label, r.skipped, r.n_shifts, r.n_rows) for r in rows)
    assert got == [("line_a", "s1", False, 2, 7), ("line_a", "s2", True, 2, 7), ("line_a", "s3", False, 2, 7), ("line_b", "s1", False, 1, 0)]

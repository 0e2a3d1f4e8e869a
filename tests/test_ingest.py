"""High-water marks, preview, streams, documents and snapshots."""

from __future__ import annotations

import tempfile

from conftest import SCHEMAS, at
from pyspark.sql import functions as F

from shiftlens.operators import ingest
from shiftlens.plans import documents
from shiftlens.sources import historian
from shiftlens.streaming import ingest as stream


def ppm(spark, *rows):
    return spark.createDataFrame([(line, at(t), v) for line, t, v in rows], SCHEMAS["ppm"])


def test_marks_are_strict_and_a_rerun_adds_nothing(spark):
    source = ppm(spark, ("a", "01-01 01:00:00", 1.0), ("a", "01-01 02:00:00", 2.0), ("a", "01-01 03:00:00", 3.0), ("b", "01-01 02:00:00", 9.0))
    target = ppm(spark, ("a", "01-01 01:00:00", 1.0))
    new = ingest.pending(source, target, "t_stamp", "2024-01-01 03:00:00")
    assert [(r.line_id, r.output_ppm) for r in new.collect()] == [("a", 2.0)]
    assert ingest.pending(source, target.union(new), "t_stamp", "2024-01-01 03:00:00").count() == 0
    marked = ingest.pending(source, target, "t_stamp", "2024-01-01 03:00:00", empty_mark="1900-01-01 00:00:00")
    assert sorted((r.line_id, r.output_ppm) for r in marked.collect()) == [("a", 2.0), ("b", 9.0)]


def test_append_to_a_partitioned_target(spark):
    source = ppm(spark, ("a", "01-01 01:00:00", 1.0), ("a", "01-01 02:00:00", 2.0), ("b", "01-01 02:00:00", 9.0))
    path = tempfile.mkdtemp(prefix="shiftlens-test-") + "/t"
    source.filter("output_ppm = 1.0 or output_ppm = 9.0").write.partitionBy("line_id").parquet(path)
    for _ in range(2):
        target = spark.read.schema(source.schema).parquet(path)
        ingest.append(source, path, target, "t_stamp", "2024-01-01 05:00:00")
    assert spark.read.parquet(path).count() == 3


def test_boundary_row_of_an_hour_is_kept(spark):
    rows = ppm(spark, ("a", "01-01 01:00:00", 1.0), ("a", "01-01 01:59:59.9", 2.0), ("a", "01-01 02:00:00", 3.0))
    got = ingest.hourly_batches(rows, "t_stamp").groupBy("batch_hour").count().collect()
    assert sorted((r.batch_hour.hour, r["count"]) for r in got) == [(1, 2), (2, 1)]


def test_preview_shows_empty_tables_and_scans_each_once(spark, tmp_path):
    rows = [("a", "01-01 01:00:00", 1.0), ("b", "01-01 01:00:00", 1.0), ("c", "01-01 01:00:00", 1.0), ("c", "01-01 02:00:00", 1.0)]
    ppm(spark, *rows).write.parquet(str(tmp_path / "ppm"))
    plan = {line: (("core", "ppm", "t_stamp"), ("core", "other", "t_stamp")) for line in "abcd"}
    log = spark.createDataFrame([("0", "a", "core", "ppm", at("01-01 01:00:00"), 1), ("0", "c", "core", "ppm", at("01-01 01:00:00"), 1), ("0", "b", "core", "ppm", None, 0)], "run string, " + ingest.ENTRY)
    read = lambda table: spark.read.parquet(str(tmp_path / table))
    shown = ingest.preview_plan(spark, plan, read, log, "2024-02-01 00:00:00", ["ppm"])
    got = {r.line_id: (r.rows_to_insert, r.status) for r in shown.filter("table_name = 'ppm'").collect()}
    assert got == {"a": (0, "up-to-date"), "b": (0, "EMPTY"), "c": (1, "ready"), "d": (0, "EMPTY")}
    assert [r.rows_to_insert for r in shown.filter("table_name = 'total' AND line_id = 'c'").collect()] == [1]
    one = ingest.preview_plan(spark, {"a": (("core", "ppm", "t_stamp"),)}, read, log, "2024-02-01 00:00:00", ["ppm"]).filter("table_name = 'ppm'")
    plan_text = one._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("FileScan parquet") == 1 and "LessThan(t_stamp" in plan_text and "EqualTo(line_id,a)" in plan_text


def test_a_run_that_dies_leaves_no_trace(spark, tmp_path):
    import pytest

    root, plan = str(tmp_path / "t"), {"a": (("core", "one", "t_stamp"), ("core", "two", "t_stamp")), "b": (("core", "one", "t_stamp"),)}
    data = {"one": ppm(spark, ("a", "01-01 01:00:00", 1.0), ("b", "01-01 02:00:00", 2.0), ("c", "01-01 02:00:00", 2.0)), "two": ppm(spark, ("a", "01-01 03:00:00", 3.0))}
    empty = {"one": "1900-01-01 00:00:00", "two": "1900-01-01 00:00:00"}

    def broken(table):
        if table == "two":
            raise ConnectionError(table)
        return data[table]

    with pytest.raises(ConnectionError):
        ingest.run_plan(spark, plan, broken, root, "2024-02-01 00:00:00", "1", empty_marks=empty)
    assert ingest.run_log(spark, root).isEmpty() and ingest.copied(spark, root, "one", data["one"]).isEmpty()
    added = ingest.run_plan(spark, plan, data.get, root, "2024-02-01 00:00:00", "2", empty_marks=empty)
    assert {(r.line_id, r.table_name): r.added for r in added.collect()} == {("a", "one"): 1, ("b", "one"): 1, ("a", "two"): 1, ("a", "total"): 2, ("b", "total"): 1}
    assert sorted(r.output_ppm for r in ingest.copied(spark, root, "one", data["one"]).collect()) == [1.0, 2.0]
    assert ingest.table_marks(ingest.run_log(spark, root)) == {"one": {"a": at("01-01 01:00:00"), "b": at("01-01 02:00:00")}, "two": {"a": at("01-01 03:00:00")}}
    again = ingest.run_plan(spark, plan, data.get, root, "2024-02-01 00:00:00", "3", empty_marks=empty)
    assert {r.added for r in again.collect()} == {0}
    with pytest.raises(ValueError, match="committed"):
        ingest.run_plan(spark, plan, data.get, root, "2024-02-01 00:00:00", "3", empty_marks=empty)


def test_stream_delivers_once_and_keeps_late_rows(spark):
    root = tempfile.mkdtemp(prefix="shiftlens-test-")
    first = ppm(spark, ("a", "01-05 01:00:00", 1.0), ("a", "01-05 02:00:00", 2.0))
    first.coalesce(1).write.parquet(f"{root}/src")

    def run():
        q = stream.start_append(spark, f"{root}/src", first.schema, f"{root}/out", f"{root}/state")
        q.awaitTermination()
        return sorted(r.output_ppm for r in stream.ingested(spark, f"{root}/out", first.schema).collect())

    assert run() == [1.0, 2.0] and run() == [1.0, 2.0]
    ppm(spark, ("a", "01-01 01:00:00", 3.0)).coalesce(1).write.mode("append").parquet(f"{root}/src")
    assert run() == [1.0, 2.0, 3.0]


def test_named_documents(spark):
    import json
    import os

    root = tempfile.mkdtemp(prefix="shiftlens-test-")
    os.makedirs(f"{root}/line_a")
    rows = [{"shift_date": "2024-01-01", "shift_type": "day", "oee": 1.5}, {"shift_date": "2023-12-31", "shift_type": "night", "oee": 9.0}]
    for name in ("shift-2024-01-01-day.json", "other.json"):
        with open(f"{root}/line_a/{name}", "w") as f:
            json.dump({"shifts": rows}, f, indent=2)
    docs = documents.read_named_documents(spark, root, "shifts array<struct<shift_date:string,shift_type:string,oee:double>>")
    got = documents.subject_shifts(docs).collect()
    assert [(r.line_id, r.shift_date, r.shift_type, r.oee) for r in got] == [("line_a", "2024-01-01", "day", 1.5)]


def test_snapshot_keys_and_retention(spark):
    from shiftlens.functions.columns import to_us

    rows = spark.createDataFrame([(at(t),) for t in ("01-10 10:14:59", "01-10 10:15:00", "01-07 10:14:00", "01-07 10:30:00")], "t timestamp_ntz")
    keys = rows.select(documents.snapshot_key(to_us(F.col("t"))).alias("snapshot_key")).union(spark.createDataFrame([("tmp",)], "k string"))
    kept = documents.retained(keys, to_us(F.lit("2024-01-10 10:20:00").cast("timestamp_ntz")))
    assert sorted(r.snapshot_key for r in kept.collect()) == ["20240107_1030", "20240110_1000", "20240110_1015"]


def test_physical_names_and_filters_reach_the_scan(spark):
    from shiftlens.config import LINE_A

    root = tempfile.mkdtemp(prefix="shiftlens-test-")
    df = spark.createDataFrame([(at("01-01 01:00:00"), 5.0, 1), (at("01-03 01:00:00"), 6.0, 2)], "t_stamp timestamp_ntz, Output_PPM double, other int")
    df.write.parquet(f"{root}/line_a/ppm")
    table = historian.scan([LINE_A], "ppm", historian.parquet_reader(spark, root))
    part = historian.window_filter(table, "t_stamp", "2024-01-02 00:00:00", None)
    assert [(r.line_id, r.output_ppm) for r in part.collect()] == [("line_a", 6.0)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t_stamp), GreaterThanOrEqual(t_stamp" in plan
    assert "other" not in plan.split("ReadSchema")[1]


def test_a_site_can_read_recent_data_only(spark):
    from shiftlens.plans.registry import QUERIES
    from shiftlens.sources.site import Site

    whole = Site.from_events(spark, "/root/testdata/sf0.001")
    recent = whole.since("2024-01-15 00:00:00")
    scan = recent.table("ppm")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t_stamp), GreaterThanOrEqual(t_stamp" in scan
    a = QUERIES["oee6_week_rollup"](whole).filter("week = 0")
    b = QUERIES["oee6_week_rollup"](recent).filter("week = 0")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    whole.close()
    recent.close()

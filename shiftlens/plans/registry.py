"""One named query per operator, each over the whole tables of a site."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import INGEST_PLAN
from shiftlens.functions import causes
from shiftlens.functions import columns as C
from shiftlens.operators import (
    anomalies, attribution, calendar, downtime, ingest, intervals, measures, oee, schedule, spc,
)
from shiftlens.plans import documents, nested, star, week_documents
from shiftlens.sources import historian
from shiftlens.sources.site import Site, union_all
from shiftlens.streaming import ingest as stream

QUERIES: dict[str, Callable[[Site], DataFrame]] = {}
_TABLES = ("status_blocks", "fof_changes", "ppm", "output_stats", "machine_state",
           "hydration_counters", "foil_counters", "downtime_overlays")
# Split of the derived history used by the ingest queries: what is copied, and the new cutoff.
COPIED_UNTIL, CUTOFF = "2024-01-20 07:07:00", "2024-01-27 07:07:00"
HOURLY_START = "2024-01-22 00:00:00"
# Hours of running below which the stored schedule of a query calls a day non-production.
STRICT_HOURS = 14.0


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _r6(df: DataFrame) -> DataFrame:
    """Round doubles for comparison between engines (not part of any operator)."""
    return df.select(*[
        F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema
    ])


def _plain(df: DataFrame, *cols) -> DataFrame:
    return df.select(C.shift_key(F.col("line_id"), F.col("ord")).alias("shift_key"), *cols)


def _keyed(df: DataFrame, *cols) -> DataFrame:
    return _r6(_plain(df, *cols))


def _us(c: str):
    return C.to_us(F.col(c))


# -- scans, sinks, ingest -----------------------------------------------------


@query
def src1_line_scan(s: Site) -> DataFrame:
    s.prepare(_TABLES)
    return union_all([
        s.table(t).groupBy("line_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(t))
        for t in _TABLES
    ])


@query
def src2_column_aliases(s: Site) -> DataFrame:
    """Physical column names at the source, canonical ones after the scan."""
    def read(profile, logical):
        df = s.table(logical).filter(F.col("line_id") == profile.line_id)
        names = {n: profile.column(k) for n, k in historian.CANONICAL[logical]}
        return df.select(*[F.col(n).cast("string").alias(p) if n == "running" else F.col(n).alias(p) for n, p in names.items()])

    return historian.scan(s.lines, "status_blocks", read).select(
        "line_id", C.ts_text(_us("start_ts")).alias("start_ts"), "running", "faults", "stop_type", "start_id"
    )


@query
def src3_availability_window(s: Site) -> DataFrame:
    clipped = historian.available(s.table("hydration_counters"), s.lines, "hydration", "t_stamp")
    return clipped.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("n_rows"), C.ts_text(F.min(_us("t_stamp"))).alias("first_ts"),
        C.ts_text(F.max(_us("t_stamp"))).alias("last_ts"),
    )


def _documents(s: Site) -> DataFrame:
    def make() -> DataFrame:
        docs = documents.shift_documents(s)
        folder = f"{s._stage.root}/shift_documents"
        documents.write_documents(docs, folder)
        return documents.read_documents(s.spark, folder, docs.schema)

    return s.stage("documents.read_back", make)


def _published(s: Site) -> DataFrame:
    """Documents of production shifts; those of excluded days exist on request only."""
    return _documents(s).filter(~F.col("day_excluded"))


def _weeks(s: Site) -> DataFrame:
    def make() -> DataFrame:
        docs = week_documents.week_documents(s)
        folder = f"{s._stage.root}/week_documents"
        documents.write_documents(docs, folder, by=week_documents.KEY)
        return documents.read_documents(s.spark, folder, docs.schema)

    return s.stage("week_documents.read_back", make)


@query
def src4_document_scan(s: Site) -> DataFrame:
    return documents.subject_shifts(_published(s)).select(
        F.concat_ws("|", "line_id", "doc_date", "doc_type").alias("shift_key"), "label", "oee", "total_stops",
        "total_downtime_hours",
    )


def _snapshots(s: Site) -> DataFrame:
    def make() -> DataFrame:
        snap = documents.spc_snapshot(s)
        folder = f"{s._stage.root}/snapshots"
        documents.write_snapshot(snap, folder)
        # A folder whose name is no time must be ignored by the scan.
        stray = snap.withColumn("snapshot_key", F.concat("snapshot_key", F.lit("_tmp")))
        documents.write_snapshot(stray, folder)
        return documents.read_snapshots(s.spark, folder, snap.schema)

    return s.stage("snapshots.read_back", make)


@query
def src5_snapshot_scan(s: Site) -> DataFrame:
    return _snapshots(s).select("line_id", "snapshot_key", F.inline("shifts")).filter("NOT skipped").select(
        "line_id", "snapshot_key", "label", "is_latest"
    )


@query
def snk1_json_sink(s: Site) -> DataFrame:
    return _published(s).groupBy("line_id").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.size("shifts")).alias("shift_rows")
    )


@query
def snk2_csv_sink(s: Site) -> DataFrame:
    def make() -> DataFrame:
        table = star.shifts(s)
        folder = f"{s._stage.root}/csv"
        star.write_csv({"Shifts": table}, folder)
        return s.spark.read.schema(table.schema).option("header", True).option("escape", '"').csv(f"{folder}/Shifts")

    return s.stage("csv.read_back", make).select("ShiftKey", "Label", "OEE", "RunningHours", "TotalStops")


@query
def snk3_snapshot_retention(s: Site) -> DataFrame:
    """Every speed sample taken as a run: runs per 15-minute snapshot, kept for three days."""
    runs = s.table("ppm").select("line_id", _us("t_stamp").alias("us"))
    now = runs.groupBy("line_id").agg(F.max("us").alias("now_us"))
    keys = runs.groupBy("line_id", documents.snapshot_key(F.col("us")).alias("snapshot_key")).agg(
        F.count(F.lit(1)).alias("runs")
    )
    kept = documents.retained(keys.join(F.broadcast(now), "line_id"), F.col("now_us"))
    return kept.select("line_id", "snapshot_key", "runs")


@query
def snk3_sink_retention(s: Site) -> DataFrame:
    """Snapshots of six days are written; the sink of the newest run leaves those of three."""

    def make() -> DataFrame:
        folder = f"{s._stage.root}/retained_snapshots"
        snap = documents.spc_snapshot(s)
        reached = s.stage("snapshots.reached", lambda: calendar.latest_shift(s).select("line_id", "reached_us"))
        days = reached.withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(5))))
        key = documents.snapshot_key(F.col("reached_us") - F.col("back") * C.DAY)
        older = snap.drop("snapshot_key").join(days.select("line_id", key.alias("snapshot_key")), "line_id")
        documents.write_documents(older.select(snap.columns), folder, by=("line_id", "snapshot_key"))
        documents.write_snapshot(snap, folder, now_us=reached.agg(F.max("reached_us")).first()[0])
        return documents.read_snapshots(s.spark, folder, snap.schema).select("line_id", "snapshot_key", F.size(F.filter("shifts", lambda x: ~x["skipped"])).alias("n_shifts"))

    return s.stage("snapshots.retained", make)


def _copied(s: Site, table: str, ts: str) -> DataFrame:
    return historian.window_filter(s.table(table), ts, None, COPIED_UNTIL)


@query
def ing1_incremental_append(s: Site) -> DataFrame:
    source = s.table("ppm")
    rows = ingest.pending(source, _copied(s, "ppm", "t_stamp"), "t_stamp", CUTOFF)
    return rows.select("line_id", C.ts_text(_us("t_stamp")).alias("t_stamp"), "output_ppm")


#: The planned tables that the site has.
_PLANNED = tuple(t for t in ingest.plan_tables(INGEST_PLAN) if t in _TABLES)


def _adopted(s: Site, root: str) -> None:
    """The planned tables as copied up to a day before the cutoff, taken over as run 0."""
    ingest.adopt(s.spark, INGEST_PLAN, lambda table, ts: _copied(s, table, ts), root, "0", _PLANNED)


@query
def ing1_plan_run(s: Site) -> DataFrame:
    """All planned tables that the site has are brought up to the cutoff; a second run adds nothing."""

    def make() -> DataFrame:
        root = f"{s._stage.root}/ingested"
        _adopted(s, root)
        runs = [ingest.run_plan(s.spark, INGEST_PLAN, s.table, root, CUTOFF, str(i), _PLANNED).withColumn("run", F.lit(i)) for i in (1, 2)]
        return union_all(runs)

    return s.stage("ingest.plan_run", make)


@query
def ing1_broken_run(s: Site) -> DataFrame:
    """Run 1 dies after two tables and run 2 starts again: rows in the target, distinct rows, and what the log says."""

    def make() -> DataFrame:
        root, left = f"{s._stage.root}/broken", []
        _adopted(s, root)

        def source(table: str) -> DataFrame:
            left.append(table)
            if len(left) == 3:
                raise ConnectionError(table)
            return s.table(table)

        try:
            ingest.run_plan(s.spark, INGEST_PLAN, source, root, CUTOFF, "1", _PLANNED)
        except ConnectionError:
            pass
        ingest.run_plan(s.spark, INGEST_PLAN, s.table, root, CUTOFF, "2", _PLANNED)
        log = ingest.run_log(s.spark, root).groupBy("table_name", "line_id").agg(
            F.sum("added").alias("logged"), F.max("mark").alias("mark"), F.concat_ws(",", F.array_sort(F.collect_set("run"))).alias("runs")
        )
        counts = []
        for table in _PLANNED:
            rows = ingest.copied(s.spark, root, table, s.table(table))
            counts.append(rows.groupBy("line_id").agg(
                F.count(F.lit(1)).alias("target_rows"), F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns])).alias("distinct_rows")
            ).withColumn("table_name", F.lit(table)))
        return union_all(counts).join(log, ["table_name", "line_id"])

    return s.stage("ingest.broken_run", make).withColumn("mark", C.ts_text(_us("mark")))


@query
def ing2_hourly_files(s: Site) -> DataFrame:
    """Rows from a start override on, written per hour and read back; writing them again changes nothing."""

    def make() -> DataFrame:
        source, folder = s.table("output_stats"), f"{s._stage.root}/hourly"
        rows = ingest.pending(source, _copied(s, "output_stats", "t_stamp"), "t_stamp", CUTOFF)
        for _ in range(2):
            ingest.write_hourly(rows, folder, "t_stamp", start=HOURLY_START)
        return s.spark.read.parquet(folder)

    return s.stage("ingest.hourly", make).groupBy("line_id", F.col("batch_hour").cast("string").alias("batch_hour")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def ing2_hourly_batches(s: Site) -> DataFrame:
    rows = ingest.pending(s.table("output_stats"), _copied(s, "output_stats", "t_stamp"), "t_stamp", CUTOFF)
    return ingest.hourly_batches(rows, "t_stamp").groupBy(
        "line_id", C.ts_text(_us("batch_hour")).alias("batch_hour")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def ing3_sync_preview(s: Site) -> DataFrame:
    """What run 1 would copy by the plan and the log: here one line has never copied its machine states, and all reasons are copied."""

    def make() -> DataFrame:
        root = f"{s._stage.root}/previewed"

        def old(table: str, ts: str) -> DataFrame:
            if table == "fof_changes":
                return s.table(table)
            rows = _copied(s, table, ts)
            return rows.filter("line_id = 'line_b'") if table in ("machine_state", "output_stats") else rows

        ingest.adopt(s.spark, INGEST_PLAN, old, root, "0", _PLANNED)
        log = ingest.run_log(s.spark, root)
        return ingest.preview_plan(s.spark, INGEST_PLAN, s.table, log, CUTOFF, _PLANNED, {"machine_state": "1900-01-01 00:00:00"})

    return s.stage("ingest.preview", make).select(
        "line_id", "sub_system", "table_name", C.ts_text(_us("local_max")).alias("local_max"), "rows_to_insert", "status"
    )


@query
def ing4_freshness(s: Site) -> DataFrame:
    now = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return ingest.freshness(s, now).select(
        "line_id", "table_name", C.ts_text(_us("latest")).alias("latest"), "extra"
    )


@query
def ing5_incremental_recompute(s: Site) -> DataFrame:
    """Documents that each refresh writes: all, then none, then those whose stored result is older than the newest shift.

    Before the third refresh the documents of night shifts are written as their own shift's end left them.
    """

    def make() -> DataFrame:
        folder = f"{s._stage.root}/refreshed"
        done = calendar.latest_shift(s).agg(F.max(C.shift_end(F.col("latest_ord"), s.bounds))).first()[0]
        first = documents.refresh(s, folder, done + C.HOUR)
        second = documents.refresh(s, folder, done + 2 * C.HOUR)
        nights = documents.shift_documents(s).filter("NOT day_excluded AND shift_type = 'night'")
        documents.write_documents(nights, folder)
        third = documents.refresh(s, folder, done + 3 * C.HOUR)
        return union_all([x.withColumn("run", F.lit(i)) for i, x in ((1, first), (2, second), (3, third))])

    return _plain(s.stage("documents.refreshes", make), "run")


# -- shifts and calendar ------------------------------------------------------


@query
def shf1_assign_shift(s: Site) -> DataFrame:
    return s.table("ppm").select("line_id", C.shift_of(_us("t_stamp"), s.bounds).alias("ord")).groupBy("line_id", "ord").agg(
        F.count(F.lit(1)).alias("samples")
    ).select("line_id", C.shift_date_text(F.col("ord")).alias("shift_date"), C.shift_type(F.col("ord")).alias("shift_type"), "samples")


@query
def shf2_shift_window(s: Site) -> DataFrame:
    o = F.col("ord")
    return _keyed(calendar.spine(s), C.ts_text(C.shift_start(o, s.bounds)).alias("starts"), C.ts_text(C.shift_end(o, s.bounds)).alias("ends"))


@query
def shf3_previous_shifts(s: Site) -> DataFrame:
    return calendar.previous(s).drop("line_id")


@query
def shf4_spc_cutoff(s: Site) -> DataFrame:
    return calendar.spc_cutoff(s).select("shift_key", C.ts_text(_us("cutoff_ts")).alias("cutoff"))


@query
def shf5_near_transition(s: Site) -> DataFrame:
    minute = C.bucket_no(F.pmod(_us("t_stamp"), F.lit(C.DAY)), C.MINUTE)
    return s.table("ppm").select("line_id", C.near_transition(minute, s.bounds).alias("near")).groupBy("line_id").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("near").alias("near_samples")
    )


@query
def shf6_shift_labels(s: Site) -> DataFrame:
    o = F.col("ord")
    return _keyed(calendar.spine(s), C.shift_label(o).alias("label"), C.full_shift_label(o, s.bounds).alias("full_label"))


@query
def shf7_batch_end_label(s: Site) -> DataFrame:
    return s.table("output_stats").groupBy(
        "line_id", C.batch_end_label(_us("t_stamp"), 13).alias("batch_label")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def shf8_boundaries_between(s: Site) -> DataFrame:
    blocks = intervals.closed_blocks(s)
    found = C.boundaries_between(F.col("s_us"), F.col("e_us"), s.bounds)
    return blocks.withColumn("b", found).filter(F.size("b") > 0).select(
        "line_id", "start_id", F.concat_ws(", ", F.transform("b", C.ts_text)).alias("boundaries")
    )


@query
def shf9_latest_shift(s: Site) -> DataFrame:
    return calendar.latest_shift(s).select(
        "line_id", C.ts_text(F.col("reached_us")).alias("reached"), C.shift_key(F.col("line_id"), F.col("latest_ord")).alias("shift_key")
    )


@query
def shf10_iso_week(s: Site) -> DataFrame:
    return calendar.labelled_spine(s).select("shift_date", "iso_week", "week_label").distinct()


@query
def shf11_date_dimension(s: Site) -> DataFrame:
    return star.dim_date(s)


@query
def shf12_shift_spine(s: Site) -> DataFrame:
    return calendar.labelled_spine(s).drop("ord")


# -- filters ------------------------------------------------------------------


@query
def flt1_interval_overlap(s: Site) -> DataFrame:
    return _keyed(intervals.block_shifts(s).groupBy("line_id", "ord").agg(F.count(F.lit(1)).alias("blocks")), "blocks")


@query
def flt2_clip_to_window(s: Site) -> DataFrame:
    return _plain(intervals.block_shifts(s), "start_id", (F.col("dur_us") / C.MINUTE).alias("dur_min"))


@query
def flt3_half_open_window(s: Site) -> DataFrame:
    return historian.window_filter(s.table("ppm"), "t_stamp", "2024-01-10 07:00:00", "2024-01-17 07:00:00").groupBy("line_id").agg(
        F.count(F.lit(1)).alias("samples"), C.ts_text(F.min(_us("t_stamp"))).alias("first_ts"), C.ts_text(F.max(_us("t_stamp"))).alias("last_ts")
    )


@query
def flt4_excluded_days(s: Site) -> DataFrame:
    kept = schedule.without_days(s.table("ppm"), s.excluded, F.to_date("t_stamp"))
    return kept.groupBy("line_id", F.to_date("t_stamp").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("samples"))


@query
def flt5_excluded_set(s: Site) -> DataFrame:
    return schedule.excluded_days(s, schedule.schedule(s)).select("line_id", F.col("day").cast("string").alias("day"))


@query
def flt5_stored_schedule(s: Site) -> DataFrame:
    """A schedule that was stored as JSON and read back decides which shifts are skipped and how many a week has.

    It was made with stricter thresholds, so that some days count as non-production.
    """

    def make() -> DataFrame:
        strict = [replace(p, min_run_hours=STRICT_HOURS, min_parts=10**9) for p in s.lines]
        days = schedule.schedule(s._derived("strict", lines=strict))
        folder = f"{s._stage.root}/schedule"
        days.write.mode("overwrite").json(folder)
        scheduled = s.with_schedule(s.spark.read.schema(days.schema).json(folder))
        return calendar.spine(scheduled)

    kept = F.count_if(~F.col("skipped")).over(W.partitionBy("line_id", "week"))
    return _plain(s.stage("schedule.applied", make).withColumn("kept", kept), "skipped", F.col("kept").alias("production_shifts"))


@query
def flt6_stale_schedule(s: Site) -> DataFrame:
    days = schedule.schedule(s)
    span = days.groupBy("line_id").agg(F.min("day").cast("string").alias("range_from"), F.max("day").cast("string").alias("range_to"))
    stored = days.join(span, "line_id")
    used, _ = schedule.guarded_schedule(stored, None, None)
    other, warnings = schedule.guarded_schedule(stored, "2024-02-01", "2024-02-08")
    return union_all([
        used.groupBy("line_id").agg(F.count(F.lit(1)).alias("days")).select("line_id", F.lit("no window").alias("asked"), "days", F.lit("").alias("warning")),
        warnings.join(other.groupBy("line_id").agg(F.count(F.lit(1)).alias("days")), "line_id", "left").select(
            "line_id", F.lit("other window").alias("asked"), F.coalesce("days", F.lit(0)).alias("days"), "warning"
        ),
    ])


@query
def flt7_name_pattern(s: Site) -> DataFrame:
    return spc.lane_rows(s).groupBy("line_id", "panel", "name").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def flt8_running_flag(s: Site) -> DataFrame:
    return s.table("status_blocks").groupBy("line_id", "running").agg(F.count(F.lit(1)).alias("blocks"))


@query
def flt9_counter_glitches(s: Site) -> DataFrame:
    good, total = F.col("counter_good"), F.col("counter_total")
    ok = good.isNotNull() & total.isNotNull() & (good <= total)
    return s.table("output_stats").groupBy("line_id").agg(
        F.count_if(ok).alias("kept"), F.count_if(good.isNull() | total.isNull()).alias("null_rows"), F.count_if(good > total).alias("glitches")
    )


# -- joins --------------------------------------------------------------------


@query
def joi1_stop_reason(s: Site) -> DataFrame:
    return intervals.stopped_with_reason(s).select("line_id", "start_id", "alarm_text")


@query
def joi2_interval_by_shift(s: Site) -> DataFrame:
    sums = intervals.block_shifts(s).filter(~F.col("running")).groupBy("line_id", "ord").agg(
        F.count(F.lit(1)).alias("stops"), (F.sum("dur_us") / C.MINUTE).alias("minutes")
    )
    return _plain(sums, "stops", "minutes")


@query
def joi3_interval_by_hour(s: Site) -> DataFrame:
    sums = downtime.hour_pieces(s).groupBy("line_id", "hour", "running").agg(F.sum("piece_us").alias("us")).filter("us > 0")
    return sums.select(
        "line_id", C.ts_text(F.col("hour") * C.HOUR).alias("hour"), "running", (F.col("us") / C.MINUTE).alias("minutes")
    )


@query
def joi4_point_in_interval(s: Site) -> DataFrame:
    return oee.running_samples(s).select("line_id", F.col("us").alias("sample_us"), "ppm", F.col("iv_lo").alias("block_start_us"))


@query
def joi5_halted_stops(s: Site) -> DataFrame:
    return _keyed(intervals.halted_stops(s, intervals.shift_stops(s)), "start_id")


@query
def joi6_lanes_at_blocks(s: Site) -> DataFrame:
    needed = spc.resets(s).select("line_id", "panel", (F.col("block_id") - 1).alias("block_id"))
    return spc.block_lanes(s, needed)


@query
def joi7_lanes_at_first_reset(s: Site) -> DataFrame:
    first = spc.resets(s).groupBy("line_id", "panel").agg(F.min("block_id").alias("block_id"))
    return spc.block_lanes(s, first)


@query
def joi8_block_before_boundary(s: Site) -> DataFrame:
    return spc.boundary_blocks(s).select("line_id", "panel", C.ts_text(C.shift_start(F.col("bound_ord"), s.bounds)).alias("boundary"), "last_block")


@query
def joi9_peak_in_range(s: Site) -> DataFrame:
    return spc.peaks(s, spc.segments(s))


@query
def joi10_calendar_joins(s: Site) -> DataFrame:
    return schedule.schedule(s).select("line_id", F.col("day").cast("string").alias("day"), "run_hours", "parts_produced", "coverage_hours")


@query
def joi11_zero_filled_keys(s: Site) -> DataFrame:
    """Current and baseline shares of every key that either side has."""
    prof = anomalies.profiles(s)
    targets = calendar.production_shifts(s).select("line_id", "ord", "week")
    members = calendar.baseline_members(s, calendar.weeks(s), "week", "oldest_ord")
    n = members.groupBy("line_id", "week").agg(F.count(F.lit(1)).alias("n"))
    base = anomalies._sums(members.join(prof, ["line_id", "ord"]), "line_id", "week")
    current = prof.join(targets.select("line_id", "ord"), ["line_id", "ord"])
    cells = anomalies._against(current, base, n, targets, ["line_id", "ord"], ["line_id", "week"])
    return _keyed(cells, "segment", "cluster", "share4", "s1", "s2", F.col("n").alias("members"))


@query
def joi12_relations(s: Site) -> DataFrame:
    return star.relation_counts(s)


@query
def joi12_star_join(s: Site) -> DataFrame:
    return star.related(s, "SegmentDowntime").groupBy("Line", "IsoWeek", "Month", "SegmentLabel").agg(
        measures._exact("Hours", 100).alias("hours"), F.count_distinct("ShiftKey").alias("shifts")
    )


@query
def joi13_spc_with_limits(s: Site) -> DataFrame:
    return spc.weekly_detail(s).drop("ord", "shift_idx").withColumn("week", F.col("week").cast("int"))


# -- OEE ----------------------------------------------------------------------


@query
def oee1_availability(s: Site) -> DataFrame:
    return _plain(oee.availability(s), "availability", "running_hours", "stopped_hours")


@query
def oee2_ideal_speed(s: Site) -> DataFrame:
    return _r6(oee.ideal_speed(s, "week"))


@query
def oee2_published(s: Site) -> DataFrame:
    return _r6(oee.ideal_speed(s, "published"))


@query
def oee2_single_shift(s: Site) -> DataFrame:
    return _r6(oee.ideal_speed(s, "single"))


@query
def oee3_performance(s: Site) -> DataFrame:
    return _keyed(oee.shift_oee(s, "week"), "performance", "avg_ppm")


@query
def oee4_quality(s: Site) -> DataFrame:
    return _plain(oee.quality(s), "quality", "good_count", "total_count")


@query
def oee5_shift_oee(s: Site) -> DataFrame:
    return oee.shift_entries(s, "week").drop("line_id", "ord", "is_latest")


@query
def oee5_published(s: Site) -> DataFrame:
    return oee.shift_entries(s, "published").drop("line_id", "ord", "is_latest")


@query
def oee6_week_rollup(s: Site) -> DataFrame:
    return oee.week_rollup(s, oee.shift_entries(s, "week"))


@query
def oee7_prior_week(s: Site) -> DataFrame:
    return oee.prior_week_rollup(s)


@query
def oee8_iso_week_rollup(s: Site) -> DataFrame:
    return oee.iso_week_rollup(s, oee.shift_entries(s, "week"))


@query
def oee9_kpi_bands(s: Site) -> DataFrame:
    return oee.kpi_bands(oee.shift_entries(s, "published")).drop("line_id")


@query
def oee9_week_deltas(s: Site) -> DataFrame:
    return oee.week_deltas(oee.week_rollup(s, oee.shift_entries(s, "week")), oee.prior_week_rollup(s))


@query
def oee10_shift_document(s: Site) -> DataFrame:
    """Head of every shift document that was read back, excluded days among them, and the sizes of its breakdowns."""
    size = lambda c: F.greatest(F.coalesce(F.size(f"subject_detail.{c}"), F.lit(0)), F.lit(0))
    return _documents(s).select(
        F.concat_ws("|", "line_id", "shift_date", "shift_type").alias("shift_key"), F.col("latest_shift.label").alias("label"),
        F.col("latest_shift.start").alias("starts"), F.col("latest_shift.end").alias("ends"), "generated_at", "day_excluded", "p95_ideal_ppm",
        F.size("shifts").alias("n_shifts"), F.size(F.filter("shifts", lambda x: x["skipped"])).alias("n_skipped"),
        F.col("subject_detail.baseline_shifts").alias("baseline_shifts"), size("segment_downtime").alias("n_segments"),
        size("hourly_breakdown").alias("n_hours"), size("cluster_outliers").alias("n_outliers"),
    )


@query
def oee10_document_rows(s: Site) -> DataFrame:
    """The subject's row and the rows before it, newest first, of every document."""
    rows = _documents(s).select(F.concat_ws("|", "line_id", "shift_date", "shift_type").alias("shift_key"), F.posexplode("shifts").alias("position", "r"))
    return rows.select("shift_key", "position", F.col("r.label").alias("label"), F.col("r.skipped").alias("skipped"), *[F.col(f"r.{c}").alias(c) for c in documents.ENTRY])


@query
def oee10_excluded_subject(s: Site) -> DataFrame:
    """All nested figures of the documents whose own day is excluded, one row per figure."""
    t = documents.flatten(s, _documents(s).filter("day_excluded"))
    none, text = F.lit(None), lambda c: F.col(c).cast("string")
    row = lambda df, part, a, b, c, v: df.select("ShiftKey", F.lit(part).alias("part"), a.cast("string").alias("a"), b.cast("string").alias("b"), c.cast("string").alias("c"), v.cast("double").alias("value"))
    return union_all([
        row(t["Shifts"], "oee", none, none, none, F.col("OEE")), row(t["DowntimeCategories"], "category", text("Category"), none, text("Count"), F.col("Hours")),
        row(t["SegmentDowntime"], "segment", text("Segment"), none, text("Count"), F.col("Hours")), row(t["SegmentClusters"], "cluster", text("Segment"), text("Cluster"), text("Count"), F.col("Hours")),
        row(t["TopStops"], "stop", text("Segment"), text("Cluster"), text("Label"), F.col("Hours")), row(t["HourlyBreakdown"], "hour", text("HourLabel"), text("Segment"), none, F.col("Minutes")),
        row(t["HourlyClusters"], "hour_cluster", text("HourLabel"), text("Segment"), text("Cluster"), F.col("Minutes")),
        row(t["Anomalies"], "outlier", text("Segment"), text("Cluster"), text("Direction"), F.col("ZScore")),
    ])


@query
def oee10_panels(s: Site) -> DataFrame:
    """The variant of each SPC panel of each document: charted, or without data in the shift."""
    return documents.flat_panels(_documents(s)).select(
        F.col("ShiftKey").alias("shift_key"), "panel", "status", F.coalesce(F.size("lanes"), F.lit(0)).alias("n_lanes"), "baseline_subgroups",
        "baseline_subgroups_requested", "last_reset_timestamp", "gap_hours",
    ).withColumn("n_lanes", F.greatest("n_lanes", F.lit(0)))


@query
def oee10_panel_lanes(s: Site) -> DataFrame:
    rows = documents.flat_panels(_documents(s)).select(F.col("ShiftKey").alias("shift_key"), "panel", F.inline("lanes"))
    return rows.withColumnRenamed("lane", "lane_no")


@query
def oee10_panel_ewma(s: Site) -> DataFrame:
    rows = documents.flat_panels(_documents(s)).filter("ewma IS NOT NULL").withColumnRenamed("ShiftKey", "shift_key")
    return nested.flat_ewma(rows, ["shift_key", "panel"]).drop("batch_label")


@query
def oee11_week_document(s: Site) -> DataFrame:
    return week_documents.flat_summary(_weeks(s))


@query
def oee11_week_shifts(s: Site) -> DataFrame:
    return week_documents.flat_shifts(_weeks(s)).select("line_id", "week", "position", "label", "skipped", *week_documents.ENTRY, F.col("anomalies.baseline_shifts").alias("baseline_shifts"))


_SHIFT = ["line_id", "week", "position"]
for _name, _flat in (("categories", nested.flat_categories), ("segments", nested.flat_segments), ("clusters", nested.flat_clusters), ("top_stops", nested.flat_top_stops)):
    QUERIES[f"oee11_week_{_name}"] = lambda s, f=_flat: f(_weeks(s).select("line_id", "week", "body.*"), ["line_id", "week"])
for _name, _flat in (("categories", nested.flat_categories), ("segments", nested.flat_segments), ("clusters", nested.flat_clusters)):
    QUERIES[f"oee11_shift_{_name}"] = lambda s, f=_flat: f(week_documents.flat_shifts(_weeks(s)), _SHIFT)


@query
def oee11_week_outliers(s: Site) -> DataFrame:
    return nested.flat_outliers(_weeks(s).select("line_id", "week", "body.anomalies.*"), ["line_id", "week"])


@query
def oee11_shift_outliers(s: Site) -> DataFrame:
    return nested.flat_outliers(week_documents.flat_shifts(_weeks(s)).select(*_SHIFT, "anomalies.*"), _SHIFT)


@query
def oee11_spc_points(s: Site) -> DataFrame:
    return week_documents.flat_points(_weeks(s), ["line_id", "week"])


@query
def oee11_spc_ewma(s: Site) -> DataFrame:
    return week_documents.flat_ewma(_weeks(s), ["line_id", "week"])


@query
def oee11_spc_table(s: Site) -> DataFrame:
    return week_documents.flat_table(_weeks(s), ["line_id", "week"])


@query
def oee12_oee_trend(s: Site) -> DataFrame:
    return oee.oee_trend(oee.shift_entries(s, "week"))


# -- causes -------------------------------------------------------------------


def _parsed(s: Site) -> DataFrame:
    return intervals.decoded(s, intervals.stopped_with_reason(s))


@query
def cau1_parse_faults(s: Site) -> DataFrame:
    text = lambda a: F.concat_ws(";", a)
    return _parsed(s).select(
        "line_id", "start_id", text(F.transform("codes", lambda c: c.cast("string"))).alias("codes"),
        text(F.transform("entries", lambda e: F.concat(e["fault_id"], F.lit("="), e["description"]))).alias("entries"),
    )


@query
def cau2_code_variants(s: Site) -> DataFrame:
    codes = _parsed(s).select(F.explode("codes").alias("code")).distinct()
    return codes.select("code", F.concat_ws(",", causes.code_variants(F.col("code"))).alias("variants"))


@query
def cau3_code_description(s: Site) -> DataFrame:
    return _parsed(s).select("line_id", "start_id", "entries", F.posexplode("codes").alias("pos", "code")).select(
        "line_id", "start_id", "pos", "code", causes.code_description(F.col("code"), F.col("entries")).alias("description")
    )


@query
def cau4_display_label(s: Site) -> DataFrame:
    return _parsed(s).select("line_id", "start_id", "label")


@query
def cau5_code_dictionary(s: Site) -> DataFrame:
    return attribution.dictionary(s)


@query
def cau6_attribution(s: Site) -> DataFrame:
    return attribution.attributed(s).select("line_id", "start_id", "rc_code", "rc_label", "rc_codes_count", "attribution_method")


@query
def cau7_explode_codes(s: Site) -> DataFrame:
    rows = attribution.attributed(s).withColumn("minutes", (F.col("e_us") - F.col("s_us")) / C.MINUTE)
    full = rows.withColumn("primary_minutes", F.col("minutes"))
    out = attribution.explode_codes(full, attribution.dictionary(s), "minutes")
    primary = F.when(F.col("code").isNull() | (F.col("pos") == 0), F.col("primary_minutes")).otherwise(F.lit(0.0))
    return out.select("line_id", "start_id", "code", "rc_label", "minutes", primary.alias("primary_minutes"))


@query
def cau8_segment_of_label(s: Site) -> DataFrame:
    labels = _parsed(s).select("line_id", "label").distinct().withColumn("number", causes.alarm_number(F.col("label")))
    return labels.select("line_id", "label", causes.per_line(
        s.lines, F.col("line_id"), lambda p: causes.segment_of_label(F.col("label"), F.col("number"), p),
        lambda p: p.segments,
    ).alias("segment"))


@query
def cau9_segment_of_stop(s: Site) -> DataFrame:
    return _parsed(s).select("line_id", "start_id", "segment")


@query
def cau10_cause_cluster(s: Site) -> DataFrame:
    return _parsed(s).select("line_id", "segment", "label", "cluster").distinct()


@query
def cau11_decoded_stops(s: Site) -> DataFrame:
    return _parsed(s).select("line_id", "start_id", "segment", "cluster", "label")


# -- downtime -----------------------------------------------------------------


def _cats(s: Site) -> DataFrame:
    return downtime.categories(s, intervals.flagged_stops(s))


def _segs(s: Site) -> DataFrame:
    return downtime.segments(s, star._cells(s))


def _clus(s: Site) -> DataFrame:
    return downtime.clusters(s, star._cells(s))


@query
def dt1_categories(s: Site) -> DataFrame:
    return _plain(_cats(s), "category", "count", "hours")


@query
def dt2_segments(s: Site) -> DataFrame:
    return _keyed(_segs(s), "segment", "count", "hours", "halted_hours", "stopped_hours")


@query
def dt2_clusters(s: Site) -> DataFrame:
    return _keyed(_clus(s), "segment", "cluster", "count", "hours", "halted_hours", "stopped_hours")


@query
def dt3_stop_summary(s: Site) -> DataFrame:
    return _plain(downtime.stop_summary(s), "total_stops", "downtime_hours", "longest_min")


@query
def dt4_hourly(s: Site) -> DataFrame:
    return _plain(downtime.hourly(s), "hour_idx", "hour_label", "segment", "cluster", (F.col("us") / C.MINUTE).alias("minutes"))


@query
def dt5_top_stops(s: Site) -> DataFrame:
    return _keyed(downtime.top_stops(intervals.flagged_stops(s)), "segment", "cluster", "rank", "label", "count", "hours")


@query
def dt6_week_top_stops(s: Site) -> DataFrame:
    return downtime.week_top_stops(s, intervals.flagged_stops(s))


@query
def dt7_week_segments(s: Site) -> DataFrame:
    return downtime.week_segments(_segs(s))


@query
def dt7_week_clusters(s: Site) -> DataFrame:
    return downtime.week_clusters(_clus(s))


@query
def dt8_week_categories(s: Site) -> DataFrame:
    return downtime.week_categories(_cats(s))


@query
def dt9_cluster_reference(s: Site) -> DataFrame:
    top = downtime.top_stops(intervals.flagged_stops(s))
    return _plain(downtime.cluster_reference(s, _segs(s), _clus(s), top), "segment", "position", "cluster", "count", "hours", "segment_pct", "top_labels")


@query
def dt10_daily_breakdown(s: Site) -> DataFrame:
    return _keyed(downtime.daily_breakdown(s, _segs(s)), "downtime_hours", "running_hours")


@query
def dt11_shift_trend(s: Site) -> DataFrame:
    return downtime.shift_trend(s, _cats(s))


@query
def dt12_best_anchor(s: Site) -> DataFrame:
    return downtime.best_anchor(downtime.shift_trend(s, _cats(s)))


@query
def dt13_latest_flag(s: Site) -> DataFrame:
    return downtime.latest_flags(oee.shift_entries(s, "week")).drop("line_id")


@query
def dt14_last_four_shifts(s: Site) -> DataFrame:
    return downtime.last_four(s, _cats(s))


# -- anomalies ----------------------------------------------------------------


@query
def ano1_cluster_profile(s: Site) -> DataFrame:
    return _keyed(anomalies.profiles(s), "segment", "cluster", "share4")


def _outlier_columns():
    return ["segment", "cluster", "current_share", "baseline_mean", "z_score", "direction", "rank"]


@query
def ano2_shift_outliers(s: Site) -> DataFrame:
    return _keyed(anomalies.shift_outliers(s), *_outlier_columns())


@query
def ano3_fixed_baseline(s: Site) -> DataFrame:
    members = calendar.baseline_members(s, calendar.weeks(s), "week", "oldest_ord")
    return members.select("line_id", "week", C.shift_key(F.col("line_id"), F.col("ord")).alias("shift_key"))


@query
def ano4_rolling_outliers(s: Site) -> DataFrame:
    return _keyed(anomalies.rolling_outliers(s), *_outlier_columns(), "baseline_members")


@query
def ano5_week_profile(s: Site) -> DataFrame:
    return anomalies.week_profiles(s)


@query
def ano6_prior_week_profiles(s: Site) -> DataFrame:
    return anomalies.prior_week_profiles(s)


@query
def ano6_week_outliers(s: Site) -> DataFrame:
    return anomalies.week_outliers(s)


@query
def ano7_headlines(s: Site) -> DataFrame:
    return anomalies.anomaly_rows(s).select("shift_key", "rank", "headline", "detail", "seg_color")


@query
def ano8_top_outlier(s: Site) -> DataFrame:
    return _keyed(anomalies.top_outlier(s), "label", "segment", "cluster", "direction", "z_score", "others")


@query
def ano9_newest_anomalous(s: Site) -> DataFrame:
    return anomalies.newest_anomalous(s)


@query
def ano10_key_findings(s: Site) -> DataFrame:
    entries = oee.shift_entries(s, "week")
    return anomalies.key_findings(
        s, entries, oee.week_rollup(s, entries), oee.prior_week_rollup(s), star.week_lanes(s)
    )


@query
def ano11_masked_spikes(s: Site) -> DataFrame:
    return anomalies.masked_spikes(s)


@query
def ano12_first_outliers(s: Site) -> DataFrame:
    return anomalies.first_outliers(s)


# -- SPC ----------------------------------------------------------------------


@query
def spc1_counter_resets(s: Site) -> DataFrame:
    return spc.resets(s).select("line_id", "panel", "block_id", F.col("us").alias("reset_us"), "prev_block")


@query
def spc1_three_days(s: Site) -> DataFrame:
    """With a lookback of three days instead of the default."""
    return spc1_counter_resets(s.with_lookback(3))


@query
def spc1_all_history(s: Site) -> DataFrame:
    return spc1_counter_resets(s.with_lookback(0))


@query
def spc2_representative_lane(s: Site) -> DataFrame:
    return spc.representatives(s)


@query
def spc3_lane_vector(s: Site) -> DataFrame:
    single = s.panels_dim.filter(~F.col("dual")).select("line_id", "panel")
    blocks = spc.representative_rows(s).select("line_id", "panel", "block_id").join(single, ["line_id", "panel"])
    return spc.block_lanes(s, blocks)


@query
def spc4_dual_station_lanes(s: Site) -> DataFrame:
    dual = s.panels_dim.filter("dual").select("line_id", "panel")
    blocks = spc.representative_rows(s).select("line_id", "panel", "block_id").join(dual, ["line_id", "panel"])
    return spc.block_lanes(s, blocks)


@query
def spc5_subgroups(s: Site) -> DataFrame:
    return _r6(spc.subgroups(s).select(
        "line_id", "panel", "no", C.ts_text(F.col("stamp_us")).alias("stamp"), "lane", "lane_no", "n_inspected", "rejects"
    ))


@query
def spc6_epoch_start(s: Site) -> DataFrame:
    return spc.segments(s).filter(~F.col("straddle")).select(
        "line_id", "panel", "block_id", C.ts_text(F.col("lo")).alias("epoch_start"), C.ts_text(F.col("hi")).alias("reset")
    )


@query
def spc7_straddling_batches(s: Site) -> DataFrame:
    return spc.segments(s).filter("straddle").select(
        "line_id", "panel", "block_id", "seg", C.ts_text(F.col("lo")).alias("starts"), C.ts_text(F.col("hi")).alias("ends"),
        "closed", "lo_block", "hi_block", C.ts_text(F.col("stamp_us")).alias("stamp"),
    )


@query
def spc8_panels(s: Site) -> DataFrame:
    return spc.subgroups(s).groupBy("line_id", "panel").agg(
        F.max("total_subgroups").alias("subgroups"), F.count_distinct("lane").alias("lanes"), F.sum("rejects").alias("rejects")
    )


@query
def spc9_lanes(s: Site) -> DataFrame:
    return spc.active_lanes(s, spc.subgroups(s))


@query
def spc10_shift_baseline(s: Site) -> DataFrame:
    return _r6(spc.pre_window_baseline(s, spc.subgroups(s)).select(
        "line_id", "panel", "week", "lane", C.ts_text(F.col("pos")).alias("first_stamp"), "n", "d"
    ))


@query
def spc11_laney_parameters(s: Site) -> DataFrame:
    return _r6(spc.laney_params(spc.pre_window_baseline(s, spc.subgroups(s)), ["line_id", "panel", "week", "lane"]))


@query
def spc12_laney_current(s: Site) -> DataFrame:
    return _keyed(spc.shift_panels(s), "panel", "lane_no", "n", "d", "rate", "ucl", "lcl", "ooc")


@query
def spc13_laney_series(s: Site) -> DataFrame:
    return _keyed(spc.weekly_series(s), "panel", "lane_no", "rate", "ucl", "lcl", "ooc", "p_bar", "any_out_of_control")


@query
def spc14_shift_axis(s: Site) -> DataFrame:
    return _keyed(spc.weekly_series(s), "panel", "lane_no", "n", "d")


@query
def spc15_ewma(s: Site) -> DataFrame:
    return _r6(spc.weekly_ewma(s).select(
        "line_id", "panel", "week", "lane_no", "batch_idx", C.ts_text(F.col("stamp_us")).alias("stamp"), "rate", "ewma", "ucl", "lcl"
    ))


@query
def spc16_shift_panel(s: Site) -> DataFrame:
    return spc.shift_status(s).drop("line_id", "ord", "age")


@query
def spc16_shift_ewma(s: Site) -> DataFrame:
    return _keyed(spc.shift_ewma(s), "panel", "lane_no", "batch_idx", "ewma", "ucl", "lcl")


@query
def spc16_own_cutoff(s: Site) -> DataFrame:
    return _keyed(spc.own_cutoff_panels(s), "panel", "lane_no", "n", "d", "p_bar", "sigma_z", "ucl", "ooc")


@query
def spc17_raw_subgroup_panel(s: Site) -> DataFrame:
    return _keyed(spc.raw_subgroup_panels(s), "panel", "lane_no", "n", "d", "p_bar", "sigma_z", "ucl", "ooc")


def _last_batches(s: Site) -> DataFrame:
    """Cutoffs: the end of every shift, and two days past the newest data."""
    def make() -> DataFrame:
        ends = calendar.spine(s).select("line_id", C.shift_end(F.col("ord"), s.bounds).alias("cutoff_us"))
        late = calendar.latest_shift(s).select("line_id", (F.col("reached_us") + 2 * C.DAY).alias("cutoff_us"))
        return spc.last_batches(s, ends.unionByName(late))

    return s.stage("spc.last_batches", make)


def _cut():
    return C.ts_text(F.col("cutoff_us")).alias("cutoff")


@query
def spc17_last_batch(s: Site) -> DataFrame:
    return _last_batches(s).select("line_id", "panel", _cut(), C.ts_text(F.col("last_us")).alias("last_reset"), "gap_hours", "status")


@query
def spc17_last_batch_panel(s: Site) -> DataFrame:
    return _r6(spc.last_batch_panels(s, _last_batches(s)).select(
        "line_id", "panel", _cut(), "lane_no", "n", "d", "rate", "ucl", "lcl", "ooc", "p_bar", "sigma_z", "baseline_n"
    ))


@query
def spc17_last_batch_ewma(s: Site) -> DataFrame:
    return _r6(spc.last_batch_ewma(s, _last_batches(s)).select("line_id", "panel", _cut(), "lane_no", "batch_idx", "ewma", "ucl", "lcl"))


@query
def spc18_weekly_panel(s: Site) -> DataFrame:
    return spc.weekly_series(s).groupBy("line_id", "panel", "week").agg(
        F.first("shift_subgroups").alias("shift_subgroups"), F.count_distinct("ord").alias("total_shifts"),
        F.count_distinct("lane").alias("lanes"), F.count_if("ooc").alias("ooc_points"),
    )


@query
def spc19_chart_lines(s: Site) -> DataFrame:
    return _r6(spc.chart_lines(s))


@query
def spc19_ewma_breaches(s: Site) -> DataFrame:
    return spc.ewma_in_view(s).filter("breach").select("line_id", "panel", "week", "lane_no", "batch_idx", "batch_label", "ewma", "ucl")


@query
def spc20_spc_only(s: Site) -> DataFrame:
    """The shift list of the SPC-only result, excluded shifts marked; beside it the result's production shifts and rows of its detail tables."""
    sizes = (F.size(F.filter("shifts", lambda x: ~x["skipped"])).alias("n_shifts"), week_documents.table_size().alias("n_rows"))
    rows = _snapshots(s).select("line_id", "snapshot_key", "analysis_id", "generated_at", *sizes, F.inline("shifts"))
    return rows.drop("ord")


@query
def spc20_points(s: Site) -> DataFrame:
    return week_documents.flat_points(_snapshots(s), ["line_id", "snapshot_key"])


@query
def spc20_ewma(s: Site) -> DataFrame:
    return week_documents.flat_ewma(_snapshots(s), ["line_id", "snapshot_key"])


@query
def spc21_attached_panels(s: Site) -> DataFrame:
    have = spc.shift_panels(s).select("line_id", "ord", "panel").distinct()
    return _keyed(oee.shift_entries(s, "week").join(have, ["line_id", "ord"], "left").groupBy("line_id", "ord").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("panel"))).alias("panels")
    ), "panels")


@query
def spc22_flagged_lanes(s: Site) -> DataFrame:
    return _keyed(spc.flagged_lanes(spc.shift_panels(s)), "panel", "flagged", "avg_p_bar", "baseline_subgroups")


@query
def spc22_reset_age(s: Site) -> DataFrame:
    return spc.shift_status(s).select("panel", "shift_key", "gap_hours", "age")


# -- schedule -----------------------------------------------------------------


@query
def sch1_daily_run_hours(s: Site) -> DataFrame:
    return schedule.daily_run_hours(s).withColumn("day", F.col("day").cast("string"))


@query
def sch2_daily_output(s: Site) -> DataFrame:
    return schedule.daily_output(s).withColumn("day", F.col("day").cast("string"))


@query
def sch3_day_classes(s: Site) -> DataFrame:
    return schedule.schedule(s).select("line_id", F.col("day").cast("string").alias("day"), "classification", "effective_hours")


@query
def sch4_schedule_summary(s: Site) -> DataFrame:
    return schedule.summary(schedule.schedule(s))


# -- star tables --------------------------------------------------------------

_EXP1 = ("Shifts", "DowntimeCategories", "SegmentDowntime", "SegmentClusters", "TopStops", "HourlyBreakdown", "HourlyClusters", "Anomalies")
_EXP2 = ("WeeklySummary", "WeeklyAnomalies", "SPC", "EWMA", "KeyFindings", "ShiftTrend")


def _snake(name: str) -> str:
    return name.lower() if name.isupper() else "".join("_" + c.lower() if c.isupper() else c for c in name).lstrip("_")


for _group, _names in (("exp1", _EXP1), ("exp2", _EXP2), ("exp4", ("Lines",))):
    for _name in _names:
        QUERIES[f"{_group}_{_snake(_name)}"] = star.TABLES[_name]


for _name in _EXP1:
    QUERIES[f"exp1_flattened_{_snake(_name)}"] = lambda s, n=_name: documents.flatten(s, _published(s))[n]


@query
def exp3_snapshots(s: Site) -> DataFrame:
    return documents.snapshot_tables(s, _snapshots(s))["Snapshots"]


@query
def exp3_snapshot_shifts(s: Site) -> DataFrame:
    return documents.snapshot_tables(s, _snapshots(s))["Shifts"]


@query
def exp3_snapshot_spc(s: Site) -> DataFrame:
    return documents.snapshot_tables(s, _snapshots(s))["SPC"]


@query
def exp5_slice(s: Site) -> DataFrame:
    tables = star.build(s, ["Shifts"], ["line_b"])
    return tables["Shifts"].select("ShiftKey", "LineId", "OEE", "IsLatest")


# -- measures -----------------------------------------------------------------


def _measure(s: Site, name: str, by: list[str], chosen: list[str] | None = None) -> DataFrame:
    return _r6(measures.evaluate(star.TABLES[name](s), name, by, chosen))


_CONTEXTS: dict[str, tuple[str, list[str], list[str] | None]] = {
    "mea1_ratio_measures": ("Shifts", ["LineId", "IsoWeek"], ["availability_pct", "quality_pct"]),
    "mea2_weighted_performance": ("Shifts", ["LineId", "IsoWeek"], ["performance_pct"]),
    "mea3_oee": ("Shifts", ["LineId", "ShiftType"], ["oee_pct"]),
    "mea4_shift_sums": ("Shifts", ["LineId", "ShiftDate"], ["total_downtime_h", "total_stops", "good_count", "total_count", "longest_stop_min"]),
    "mea5_shift_count": ("Shifts", ["LineId", "IsoWeek"], ["shift_count"]),
    "mea6_categories": ("DowntimeCategories", ["LineId", "CategoryLabel"], None),
    "mea6_segments": ("SegmentDowntime", ["LineId", "SegmentLabel"], None),
    "mea6_clusters": ("SegmentClusters", ["LineId", "Segment", "Cluster"], None),
    "mea6_hourly": ("HourlyBreakdown", ["LineId", "HourLabel", "SegmentLabel"], None),
    "mea6_hourly_clusters": ("HourlyClusters", ["LineId", "HourLabel", "Segment", "Cluster"], None),
    "mea6_trend": ("ShiftTrend", ["AnchorShiftKey", "TrendRank"], None),
    "mea6_top_stops": ("TopStops", ["LineId", "Label"], None),
    "mea7_anomalies": ("Anomalies", ["LineId", "Segment"], None),
    "mea7_weekly_anomalies": ("WeeklyAnomalies", ["LineId", "Segment"], None),
    "mea8_spc": ("SPC", ["LineId", "Panel", "Lane"], None),
    "mea8_ewma": ("EWMA", ["LineId", "Panel", "Lane"], None),
    "mea9_weekly": ("WeeklySummary", ["LineId"], None),
}
for _name, (_table, _by, _chosen) in _CONTEXTS.items():
    QUERIES[_name] = lambda s, t=_table, b=_by, c=_chosen: _measure(s, t, b, c)


@query
def mea10_last_refreshed(s: Site) -> DataFrame:
    return measures.evaluate(star.lines(s), "Lines", ["LineId"])


@query
def mea11_lane_matrix(s: Site) -> DataFrame:
    lanes = next(p.n_lanes for line in s.lines for p in line.panels if p.short == "Vision")
    return _r6(measures.lane_matrix(star.spc_table(s), "Vision", range(1, lanes + 1)))


@query
def mea12_segment_regroup(s: Site) -> DataFrame:
    """Hours > 0 per segment and cluster for display, with the largest cluster of each segment."""
    rows = star.segment_clusters(s).filter("Hours > 0").groupBy("LineId", "Segment", "Cluster").agg(
        measures._exact("Hours", 100).alias("hours")
    )
    order = F.broadcast(s.segments_dim.select(F.col("line_id").alias("LineId"), F.col("segment").alias("Segment"), "seg_order"))
    w = W.partitionBy("LineId", "Segment")
    return rows.join(order, ["LineId", "Segment"]).select(
        "LineId", "Segment", "seg_order", "Cluster", "hours",
        F.row_number().over(w.orderBy(F.desc("hours"), "Cluster")).alias("position"), F.max("hours").over(w).alias("max_hours"),
    )


# -- streaming ----------------------------------------------------------------


@query
def s1_stream_append(s: Site) -> DataFrame:
    """All speed samples arrive as a stream; a second run of the same stream adds nothing."""
    source = s.table("ppm")  # a staged table: its files are the stream's source
    root = s._stage.root

    def make() -> DataFrame:
        for _ in range(2):
            q = stream.start_append(s.spark, f"{root}/source.ppm", source.schema, f"{root}/streamed", f"{root}/stream_state")
            q.awaitTermination()
        return stream.ingested(s.spark, f"{root}/streamed", source.schema)

    return s.stage("stream.read_back", make).groupBy("line_id", F.to_date("t_stamp").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("samples")
    )

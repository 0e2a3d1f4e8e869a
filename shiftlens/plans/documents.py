"""Nested shift and week documents, their JSON sinks and scans, and SPC snapshots."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.config import SNAPSHOT_MINUTES, SNAPSHOT_RETENTION_DAYS, SPC_BASELINE_BUCKETS
from shiftlens.functions.columns import (
    MINUTE, floor_to, full_shift_label, round_even, shift_date_text, shift_end, shift_key,
    shift_label, shift_start, shift_type, to_us, ts_text,
)
from shiftlens.operators import anomalies, calendar, downtime, ingest, intervals, oee, spc
from shiftlens.plans import nested, star, week_documents
from shiftlens.sources.site import Site
from shiftlens.sources.staging import checked_broadcast

KEY = ["line_id", "ord"]
CONTEXT = 4  # earlier shifts in a shift document


def panel_variants(site: Site, subjects: DataFrame) -> DataFrame:
    """spc_panels: {panel: variant} of each subject that has one.

    A panel with subgroups in the shift has lanes and their EWMA; one without has the status
    ``no_shift_data``, its last reset and the hours since; one too young for a baseline is left out.
    """
    group = [*KEY, "panel"]
    rows = spc.panels_of(site, subjects)
    pct = lambda c: round_even(F.col(c) * 100, 2)
    lane = F.struct(
        F.col("lane_no").alias("lane"), F.col("d").alias("rejects"), F.rint("n").cast("long").alias("inspected"), pct("rate").alias("rate_pct"),
        pct("p_bar").alias("p_bar_pct"), pct("ucl").alias("ucl_pct"), pct("lcl").alias("lcl_pct"), F.col("ooc").alias("out_of_control"),
    )
    charted = rows.groupBy(*group).agg(
        F.sort_array(F.collect_list(lane)).alias("lanes"), F.first("baseline_n").alias("baseline_subgroups"),
        F.max(ts_text(F.col("last_us"))).alias("last_reset_timestamp"),
    ).join(nested.ewma(spc.shift_ewma(site, rows), group), group, "left")
    idle = spc.shift_status(site, subjects).select(
        *group, "status", F.lit(0).cast("long").alias("baseline_subgroups"), F.col("last_reset").alias("last_reset_timestamp"), "gap_hours"
    )
    both = charted.unionByName(idle, allowMissingColumns=True).withColumn("baseline_subgroups_requested", F.lit(SPC_BASELINE_BUCKETS))
    fields = ("status", "lanes", "baseline_subgroups", "baseline_subgroups_requested", "last_reset_timestamp", "gap_hours", "ewma")
    return both.groupBy(*KEY).agg(nested.keyed("panel", F.struct(*fields)).alias("spc_panels"))


def shift_details(site: Site) -> DataFrame:
    """One row per shift of the spine with all nested breakdowns: an excluded shift is computed as a subject too."""
    subjects = calendar.spine(site)
    stops = intervals.flagged_stops(site)
    cells = star._cells(site)
    every = downtime.hourly(site).join(subjects.select(*KEY), KEY)
    per_cluster = every.filter(F.col("cluster").isNotNull()).groupBy(*KEY, "hour_idx", "hour_label", "segment", "cluster").agg(
        round_even(F.sum("us") / F.lit(MINUTE), 1).alias("minutes")
    )
    out = anomalies.outliers_of(site, subjects)
    parts = (
        nested.categories(downtime.rounded_categories(downtime.categories(site, stops, subjects)), KEY),
        nested.segments(downtime.segments(site, cells, subjects), downtime.clusters(site, cells, subjects), KEY),
        nested.top_stops(downtime.top_stops(stops), KEY),
        nested.hours(downtime.hourly_segments(every), per_cluster, KEY),
        nested.outliers(out, KEY),
        panel_variants(site, subjects),
    )
    frame = oee.subject_entries(site).join(anomalies.baseline_sizes(site).withColumnRenamed("n", "baseline_shifts"), ["line_id", "week"], "left")
    for part in parts:
        frame = frame.join(part, KEY, "left")
    return frame


ENTRY = ("oee", "availability", "performance", "quality", "running_hours", "total_stops", "total_downtime_hours",
         "longest_stop_min", "good_count", "total_count")


def shift_documents(site: Site) -> DataFrame:
    """Each shift with up to four earlier shifts; excluded ones are skipped rows, but never the subject itself."""
    details = site.stage("documents.shift_details", lambda: shift_details(site))
    o = F.col("ord")
    names = [shift_date_text(o).alias("shift_date"), shift_type(o).alias("shift_type"), shift_label(o).alias("label")]
    known = calendar.spine(site).select(*KEY, "skipped").join(details.select(*KEY, *ENTRY, "downtime_categories"), KEY, "left")
    figures = [F.col(c) for c in (*ENTRY, "downtime_categories")]
    own = known.select(*KEY, F.struct(*names, F.lit(False).alias("skipped"), *figures).alias("own"))
    shown = [F.when(~F.col("skipped"), c).alias(n) for c, n in zip(figures, (*ENTRY, "downtime_categories"), strict=True)]
    rows = known.select(*KEY, F.struct(*names, "skipped", *shown).alias("row"))
    earlier = F.sequence(F.col("ord") + 1, F.col("ord") + CONTEXT)
    context = rows.select("line_id", F.explode(earlier).alias("subject"), "ord", "row").groupBy("line_id", F.col("subject").alias("ord")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("ord").alias("o"), "row")), lambda a, b: (b["o"] - a["o"]).cast("int")),
            lambda x: x["row"],
        ).alias("before")
    )
    detail = F.struct(
        "segment_downtime", "top_stops_by_cluster", "hourly_breakdown", "cluster_outliers",
        F.coalesce("baseline_shifts", F.lit(0)).alias("baseline_shifts"), "spc_panels",
    )
    ideal = oee.ideal_speed(site, "published")
    return (
        details.drop("shift_date", "shift_type").join(own, KEY).join(context, KEY, "left").join(ideal, ["line_id", "week"], "left")
        .join(calendar.spine(site).select(*KEY, "skipped"), KEY)
        .select(
            F.lit("shift-dashboard").alias("analysis_id"), "line_id", *names[:2],
            ts_text(shift_end(o, site.bounds)).alias("generated_at"), F.col("skipped").alias("day_excluded"),
            F.struct(
                full_shift_label(o, site.bounds).alias("label"), *names[:2],
                ts_text(shift_start(o, site.bounds)).alias("start"), ts_text(shift_end(o, site.bounds)).alias("end"),
            ).alias("latest_shift"),
            round_even(F.col("ideal_ppm"), 1).alias("p95_ideal_ppm"),
            F.concat(F.array("own"), F.coalesce("before", F.array())).alias("shifts"), detail.alias("subject_detail"),
        )
    )


def write_documents(docs: DataFrame, folder: str, by=("line_id", "shift_date", "shift_type")) -> None:
    """Nested JSON, one folder per key; a re-run replaces only the folders it computed."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(folder)


def generated(site: Site, folder: str) -> DataFrame:
    """line_id, ord, generated_at (microseconds) of every stored document; only that field is parsed."""
    spark = site.spark
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "line_id string, ord long, generated_at long")
    rows = spark.read.schema("generated_at string, line_id string, shift_date string, shift_type string").json(folder)
    day = F.unix_date(F.to_date("shift_date"))
    ordinal = (day * 2 + F.when(F.col("shift_type") == "night", 1).otherwise(0)).cast("long")
    return rows.select("line_id", ordinal.alias("ord"), to_us(F.col("generated_at").cast("timestamp_ntz")).alias("generated_at"))


def refresh(site: Site, folder: str, now_us: int) -> DataFrame:
    """Write the documents of production shifts that are missing, or older than the end of the line's latest complete shift.

    Returns (line_id, ord) of what was written.  Other documents keep their files.
    """
    targets = calendar.production_shifts(site)
    true_end = shift_end(F.col("latest_ord"), site.bounds)
    stored = generated(site, folder).join(targets.select("line_id", true_end.alias("true_end")).distinct(), "line_id")
    late = ingest.to_recompute(targets, stored, F.col("true_end")).select("line_id", "ord")
    late = site.stage(f"documents.late.{now_us}", lambda: late)  # the files that it reads are replaced below
    o = F.col("ord")
    names = late.select("line_id", shift_date_text(o).alias("shift_date"), shift_type(o).alias("shift_type"))
    fresh = shift_documents(site).join(checked_broadcast(names), ["line_id", "shift_date", "shift_type"], "left_semi")
    write_documents(fresh.withColumn("generated_at", ts_text(F.lit(now_us))), folder)
    return late


def read_documents(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Scan shift documents; the folder names carry line, date and type."""
    return spark.read.schema(schema).json(folder)


def subject_shifts(docs: DataFrame) -> DataFrame:
    """The row of each document whose date and type equal the document's name."""
    rows = docs.select("line_id", F.col("shift_date").cast("string").alias("doc_date"),
                       F.col("shift_type").alias("doc_type"), F.inline("shifts"))
    return rows.filter((F.col("shift_date") == F.col("doc_date")) & (F.col("shift_type") == F.col("doc_type")))


def subjects(docs: DataFrame) -> DataFrame:
    """line_id, ShiftKey and the subject's row and details of each document."""
    key = F.concat_ws("|", "line_id", F.col("shift_date").cast("string"), "shift_type").alias("ShiftKey")
    return docs.select("line_id", key, F.col("shifts")[0].alias("own"), "subject_detail.*")


def flatten(site: Site, docs: DataFrame) -> dict[str, DataFrame]:
    """The eight detail tables from documents that were read back: maps and arrays to rows."""
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label"))
    rows, keys = subjects(docs), ["line_id", "ShiftKey"]
    own = rows.select(*keys, "own.*")
    figures = [F.col(c).alias(t) for c, t in zip(nested.FIGURES, ("Count", "Hours", "HaltedHours", "StoppedHours"), strict=True)]
    segment, cluster = F.col("segment").alias("Segment"), F.col("cluster").alias("Cluster")
    shift_columns = {
        "ShiftDate": "shift_date", "ShiftType": "shift_type", "Label": "label", "OEE": "oee", "Availability": "availability", "Performance": "performance",
        "Quality": "quality", "RunningHours": "running_hours", "TotalStops": "total_stops", "TotalDowntimeHours": "total_downtime_hours",
        "LongestStopMin": "longest_stop_min", "GoodCount": "good_count", "TotalCount": "total_count",
    }
    return {
        "Shifts": own.select("ShiftKey", F.col("line_id").alias("LineId"), *[F.col(c).cast("string").alias(t) if t == "ShiftDate" else F.col(c).alias(t) for t, c in shift_columns.items()]),
        "DowntimeCategories": nested.flat_categories(own, keys).select(
            "ShiftKey", F.col("category").alias("Category"), F.col("count").alias("Count"), F.col("hours").alias("Hours")),
        "SegmentDowntime": nested.flat_segments(rows, keys).select("ShiftKey", segment, *figures),
        "SegmentClusters": nested.flat_clusters(rows, keys, names).select("ShiftKey", segment, cluster, *figures),
        "TopStops": nested.flat_top_stops(rows, keys).select(
            "ShiftKey", segment, cluster, F.col("label").alias("Label"), F.col("count").alias("Count"), F.col("hours").alias("Hours")),
        "HourlyBreakdown": nested.flat_hours(rows, keys).join(names, ["line_id", "segment"], "left").select(
            "ShiftKey", F.col("hour_label").alias("HourLabel"), segment, F.coalesce("segment_label", F.lit("Running")).alias("SegmentLabel"), F.col("minutes").alias("Minutes")),
        "HourlyClusters": nested.flat_hour_clusters(rows, keys, names).select(
            "ShiftKey", F.col("hour_label").alias("HourLabel"), F.col("hour_idx").alias("HourIdx"), segment, cluster, F.col("minutes").alias("Minutes")),
        "Anomalies": nested.flat_outliers(rows, keys).select(
            "ShiftKey", F.col("rank").alias("Rank"), segment, cluster, F.col("current_share").alias("CurrentShare"),
            F.col("baseline_mean").alias("BaselineMean"), F.col("z_score").alias("ZScore"), F.col("direction").alias("Direction")),
    }


def flat_panels(docs: DataFrame) -> DataFrame:
    """ShiftKey, panel and the variant of each panel of each document."""
    rows = subjects(docs).select("ShiftKey", F.explode("spc_panels").alias("panel", "v"))
    return rows.select("ShiftKey", "panel", "v.*")


def read_named_documents(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Scan documents stored as ``<line>/shift-<date>-<type>.json`` (one pretty-printed file each)."""
    name = r"([^/]+)/shift-(\d{4}-\d{2}-\d{2})-(day|night)\.json$"
    docs = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    path = F.col("_metadata.file_path")
    return (
        docs.select("shifts", *[F.regexp_extract(path, name, i).alias(c) for i, c in ((1, "line_id"), (2, "shift_date"), (3, "shift_type"))])
        .filter(F.col("shift_date") != "")
    )


# -- SPC snapshots ----------------------------------------------------------


def snapshot_key(us: Column) -> Column:
    """Time of the run, down to 15 minutes: runs in the same window replace each other."""
    return F.date_format(F.timestamp_micros(floor_to(us, SNAPSHOT_MINUTES * MINUTE)), "yyyyMMdd_HHmm")


def retained(keys: DataFrame, now_us: Column) -> DataFrame:
    """Drop snapshots older than three days; names that are no time are kept out."""
    at = F.try_to_timestamp(F.col("snapshot_key"), F.lit("yyyyMMdd_HHmm"))
    limit = now_us - F.lit(SNAPSHOT_RETENTION_DAYS * 24 * 60 * MINUTE)
    return keys.withColumn("snapshot_us", F.unix_micros(at)).filter(F.col("snapshot_us") >= limit)


def spc_snapshot(site: Site) -> DataFrame:
    """SPC-only result of the latest week: the shift list (excluded ones marked) and whole panels.

    Nothing here reaches a stop, a speed or a quality figure.
    """
    latest = calendar.latest_shift(site).select(
        "line_id", snapshot_key(F.col("reached_us")).alias("snapshot_key"), ts_text(F.col("reached_us")).alias("generated_at")
    )
    shifts = calendar.labelled_spine(site).filter("week = 0").groupBy("line_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "ord", "shift_date", "shift_type", "label", "line_shift_label", "iso_week", "week_label", "is_latest", "skipped"
        ))).alias("shifts")
    )
    panels = week_documents.panels(site).filter("week = 0").drop("week")
    head = latest.withColumn("analysis_id", F.lit("weekly-dashboard-spc"))
    return head.join(shifts, "line_id").join(panels, "line_id", "left")


def write_snapshot(snapshot: DataFrame, folder: str, now_us: int | None = None) -> None:
    """Write a run's snapshot; with the time of the run, snapshots past the retention are deleted."""
    write_documents(snapshot, folder, by=("line_id", "snapshot_key"))
    if now_us is not None:
        expire_snapshots(snapshot.sparkSession, folder, now_us)


def expire_snapshots(spark: SparkSession, folder: str, now_us: int) -> None:
    """Delete the folders of snapshots older than three days before ``now_us``.

    Folders are listed, not read: one name per line and snapshot, which retention keeps few.  Names
    that are no time stay, as they are not this sink's.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = path(f"{folder}/line_id=*/snapshot_key=*")
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = now_us - SNAPSHOT_RETENTION_DAYS * 24 * 60 * MINUTE
    for status in files.globStatus(found) or ():
        name = status.getPath().getName().removeprefix("snapshot_key=")
        try:
            at = datetime.strptime(name, "%Y%m%d_%H%M").replace(tzinfo=timezone.utc)
        except ValueError:
            continue
        if at.timestamp() * 1_000_000 < limit:
            files.delete(status.getPath(), True)


def read_snapshots(spark: SparkSession, folder: str, schema) -> DataFrame:
    docs = spark.read.schema(schema).json(folder)
    at = F.try_to_timestamp(F.col("snapshot_key").cast("string"), F.lit("yyyyMMdd_HHmm"))
    return docs.withColumn("snapshot_time", at).filter(F.col("snapshot_time").isNotNull())


def snapshot_tables(site: Site, docs: DataFrame) -> dict[str, DataFrame]:
    """Snapshots, Shifts and SPC of all retained snapshots, stacked by SnapshotKey."""
    names = F.broadcast(site.lines_dim.withColumnRenamed("line", "Line"))
    docs = docs.join(names, "line_id")
    newest = docs.agg(F.max("snapshot_key")).first()[0]  # one value
    snapshots = docs.select("snapshot_key", "snapshot_time").distinct().select(
        F.col("snapshot_key").alias("SnapshotKey"),
        F.date_format("snapshot_time", "yyyy-MM-dd HH:mm:ss").alias("SnapshotTime"),
        F.date_format("snapshot_time", "MMM d, h:mm a").alias("SnapshotLabel"),
        (F.col("snapshot_key") == F.lit(newest)).cast("int").alias("IsLatestSnapshot"),
    )
    shift_rows = docs.select("snapshot_key", "line_id", "Line", F.inline("shifts")).filter("NOT skipped")
    shifts = shift_rows.select(
        F.concat("snapshot_key", F.lit("|"), shift_key(F.col("line_id"), F.col("ord"))).alias("ShiftKey"),
        F.col("snapshot_key").alias("SnapshotKey"), F.col("line_id").alias("LineId"), "Line",
        F.col("shift_date").alias("ShiftDate"), F.col("shift_type").alias("ShiftType"), F.col("label").alias("Label"),
        F.col("line_shift_label").alias("LineShiftLabel"), F.col("iso_week").alias("IsoWeek"),
        F.col("week_label").alias("WeekLabel"), F.col("is_latest").cast("int").alias("IsLatest"),
    )
    latest = shift_rows.filter("is_latest").select("snapshot_key", "line_id", F.col("label").alias("latest_label"))
    panel_names = F.broadcast(site.panels_dim.select("line_id", "panel", "panel_short"))
    rows = week_documents.flat_table(docs, ["snapshot_key", "line_id", "Line"])
    spc_rows = rows.join(panel_names, ["line_id", "panel"]).join(latest, ["snapshot_key", "line_id"], "left")
    spc_table = spc_rows.select(
        F.col("snapshot_key").alias("SnapshotKey"), F.col("line_id").alias("LineId"), "Line",
        F.col("panel_short").alias("Panel"), F.col("label").alias("ShiftLabel"),
        F.concat("line_id", F.lit("|"), "label").alias("LineShiftLabel"), F.col("lane_no").alias("Lane"),
        F.col("rejects").alias("Rejects"), F.col("rate_pct").alias("RatePct"), F.col("ucl_pct").alias("UclPct"),
        F.col("ooc").alias("OOC"), F.col("n_inspected").alias("NInspected"), F.col("shift_idx").alias("ShiftIdx"),
        F.col("p_bar_pct").alias("PBar"),
        F.coalesce(F.col("label") == F.col("latest_label"), F.lit(False)).cast("int").alias("IsLatest"),
    )
    return {"Snapshots": snapshots, "Shifts": shifts, "SPC": spc_table}

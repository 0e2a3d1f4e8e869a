"""The star schema: 16 flat tables with their published column names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import IN_CONTROL_COLOR, OOC_COLOR, RUNNING_COLOR
from shiftlens.functions.columns import (
    iso_week, round_even, shift_key, shift_label, to_ts, week_label,
)
from shiftlens.operators import anomalies, calendar, downtime, intervals, oee, spc
from shiftlens.sources.site import Site, union_all


def _shift(df: DataFrame, line: str = "line_id") -> DataFrame:
    return df.withColumn("ShiftKey", shift_key(F.col(line), F.col("ord"))).withColumn("LineId", F.col(line))


def _line_names(site: Site, df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(site.lines_dim.withColumnRenamed("line", "Line")), "line_id")


def shifts(site: Site) -> DataFrame:
    length = (site.bounds[1] - site.bounds[0]) % 24
    day = F.to_date("shift_date")
    return _line_names(site, oee.shift_entries(site, "published")).select(
        F.col("shift_key").alias("ShiftKey"), F.col("line_id").alias("LineId"), "Line",
        F.col("shift_date").alias("ShiftDate"), F.col("shift_type").alias("ShiftType"),
        F.col("label").alias("Label"), F.concat("line_id", F.lit("|"), "label").alias("LineShiftLabel"),
        iso_week(day).alias("IsoWeek"), week_label(day).alias("WeekLabel"),
        F.col("oee").alias("OEE"), F.col("availability").alias("Availability"),
        F.col("performance").alias("Performance"), F.col("quality").alias("Quality"),
        F.col("running_hours").alias("RunningHours"), F.lit(length).alias("ScheduledHours"),
        F.col("total_stops").alias("TotalStops"),
        F.col("total_downtime_hours").alias("TotalDowntimeHours"),
        F.col("longest_stop_min").alias("LongestStopMin"), F.col("good_count").alias("GoodCount"),
        F.col("total_count").alias("TotalCount"),
        (F.col("shift_key") == F.max("shift_key").over(W.partitionBy("line_id"))).cast("int").alias("IsLatest"),
    )


def downtime_categories(site: Site) -> DataFrame:
    cats = downtime.rounded_categories(downtime.categories(site, intervals.flagged_stops(site)))
    return _shift(cats).join(F.broadcast(site.categories_dim), "category").select(
        "ShiftKey", "LineId", F.col("category").alias("Category"), F.col("category_label").alias("CategoryLabel"),
        F.col("count").alias("Count"), F.col("hours").alias("Hours"),
    )


def _cells(site: Site) -> DataFrame:
    return site.stage(
        "star.cells", lambda: downtime.segment_clusters(intervals.flagged_stops(site))
    )


def segment_downtime(site: Site) -> DataFrame:
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label", "segment_color"))
    return _shift(downtime.segments(site, _cells(site)).join(names, ["line_id", "segment"])).select(
        "ShiftKey", "LineId", F.col("segment").alias("Segment"), F.col("segment_label").alias("SegmentLabel"),
        F.col("count").alias("Count"), F.col("hours").alias("Hours"), F.col("halted_hours").alias("HaltedHours"),
        F.col("stopped_hours").alias("StoppedHours"), F.col("segment_color").alias("SegmentColor"),
    )


def segment_clusters(site: Site) -> DataFrame:
    """Clusters of each segment; a segment with hours but no cluster is one pseudo-cluster."""
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label"))
    clus = downtime.clusters(site, _cells(site))
    have = clus.select("line_id", "ord", "segment").distinct()
    pseudo = (
        downtime.segments(site, _cells(site)).filter("hours > 0")
        .join(have, ["line_id", "ord", "segment"], "left_anti").join(names, ["line_id", "segment"])
        .withColumn("cluster", F.col("segment_label"))
    )
    cols = ["line_id", "ord", "segment", "cluster", "count", "hours", "halted_hours", "stopped_hours"]
    return _shift(clus.select(*cols).unionByName(pseudo.select(*cols))).select(
        "ShiftKey", "LineId", F.col("segment").alias("Segment"), F.col("cluster").alias("Cluster"),
        F.col("count").alias("Count"), F.col("hours").alias("Hours"), F.col("halted_hours").alias("HaltedHours"),
        F.col("stopped_hours").alias("StoppedHours"),
    )


def top_stops(site: Site) -> DataFrame:
    shown = calendar.production_shifts(site).select("line_id", "ord")
    top = downtime.top_stops(intervals.flagged_stops(site)).join(shown, ["line_id", "ord"], "left_semi")
    return _shift(top).select(
        "ShiftKey", "LineId", F.col("segment").alias("Segment"), F.col("cluster").alias("Cluster"),
        F.col("label").alias("Label"), F.col("count").alias("Count"), F.col("hours").alias("Hours"),
    )


def _hours(site: Site) -> DataFrame:
    def make() -> DataFrame:
        return downtime.hourly(site).join(
            calendar.production_shifts(site).select("line_id", "ord"), ["line_id", "ord"]
        )

    return site.stage("star.hours", make)


def hourly_breakdown(site: Site) -> DataFrame:
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label", "segment_color"))
    return _shift(downtime.hourly_segments(_hours(site)).join(names, ["line_id", "segment"], "left")).select(
        "ShiftKey", "LineId", F.col("hour_label").alias("HourLabel"), F.col("segment").alias("Segment"),
        F.coalesce("segment_label", F.lit("Running")).alias("SegmentLabel"), F.col("minutes").alias("Minutes"),
        F.coalesce("segment_color", F.lit(RUNNING_COLOR)).alias("SegmentColor"),
    )


def hourly_clusters(site: Site) -> DataFrame:
    return _shift(downtime.hourly_clusters(site, _hours(site))).select(
        "ShiftKey", "LineId", F.col("hour_label").alias("HourLabel"), F.col("hour_idx").alias("HourIdx"),
        F.col("segment").alias("Segment"), F.col("cluster").alias("Cluster"), F.col("minutes").alias("Minutes"),
    )


def shift_trend(site: Site) -> DataFrame:
    cats = downtime.categories(site, intervals.flagged_stops(site))
    return _line_names(site, downtime.shift_trend(site, cats)).select(
        F.col("anchor_shift_key").alias("AnchorShiftKey"), F.col("line_id").alias("LineId"), "Line",
        F.col("trend_rank").alias("TrendRank"), F.col("trend_shift_key").alias("TrendShiftKey"),
        F.col("trend_shift_label").alias("TrendShiftLabel"), F.col("trend_shift_date").alias("TrendShiftDate"),
        F.col("category").alias("Category"), F.col("category_label").alias("CategoryLabel"),
        F.col("hours").alias("Hours"), F.col("category_color").alias("CategoryColor"),
    )


def anomaly_table(site: Site) -> DataFrame:
    return anomalies.anomaly_rows(site).select(
        F.col("shift_key").alias("ShiftKey"), F.col("line_id").alias("LineId"),
        F.col("shift_label").alias("ShiftLabel"), F.col("segment").alias("Segment"),
        F.col("cluster").alias("Cluster"), F.col("current_share").alias("CurrentShare"),
        F.col("baseline_mean").alias("BaselineMean"), F.col("z_score").alias("ZScore"),
        F.col("direction").alias("Direction"), F.col("headline").alias("Headline"),
        F.col("detail").alias("Detail"), F.concat("headline", F.lit("\n"), "detail").alias("HeadlineML"),
        F.col("seg_color").alias("SegColor"), F.col("rank").alias("Rank"),
    )


def weekly_summary(site: Site, week: int | None = None) -> DataFrame:
    rolled = oee.week_rollup(site, oee.shift_entries(site, "week"))
    both = _line_names(site, rolled.join(oee.prior_week_rollup(site), ["line_id", "week"]))
    return _only(both, week).select(
        F.col("line_id").alias("LineId"), "Line", F.col("week").cast("int").alias("Week"), F.col("week_from").alias("WeekFrom"),
        F.col("week_to").alias("WeekTo"), F.col("oee").alias("OEE"), F.col("availability").alias("Availability"),
        F.col("performance").alias("Performance"), F.col("quality").alias("Quality"),
        F.col("good_count").alias("GoodCount"), F.col("total_count").alias("TotalCount"),
        F.col("total_stops").alias("TotalStops"), F.col("total_downtime_hours").alias("TotalDowntimeHours"),
        F.col("longest_stop_min").alias("LongestStopMin"), F.col("production_shifts").alias("ProductionShifts"),
        F.col("prior_oee").alias("PriorOEE"), F.col("prior_availability").alias("PriorAvailability"),
        F.col("prior_performance").alias("PriorPerformance"), F.col("prior_quality").alias("PriorQuality"),
    )


def _only(df: DataFrame, week: int | None) -> DataFrame:
    """Rows of one week, or of all; 0 is the week of the latest complete shift."""
    return df if week is None else df.filter(F.col("week") == week)


def weekly_anomalies(site: Site, week: int | None = None) -> DataFrame:
    return _line_names(site, _only(anomalies.week_anomaly_rows(site), week)).select(
        F.col("line_id").alias("LineId"), "Line", F.col("week").cast("int").alias("Week"), F.col("segment").alias("Segment"),
        F.col("cluster").alias("Cluster"), F.col("current_share").alias("CurrentShare"),
        F.col("baseline_mean").alias("BaselineMean"), F.col("z_score").alias("ZScore"),
        F.col("direction").alias("Direction"), F.col("ratio").alias("Ratio"),
        F.col("headline").alias("Headline"), F.col("detail").alias("Detail"),
        F.concat("headline", F.lit("\n"), "detail").alias("HeadlineML"),
        F.col("seg_color").alias("SegColor"), F.col("rank").alias("Rank"),
    )


def spc_table(site: Site, week: int | None = None) -> DataFrame:
    names = F.broadcast(site.panels_dim.select("line_id", "panel", "panel_short"))
    rows = _only(spc.weekly_detail(site), week).join(names, ["line_id", "panel"])
    label = shift_label(F.col("ord"))
    return _line_names(site, rows).select(
        F.col("line_id").alias("LineId"), "Line", F.col("week").cast("int").alias("Week"), F.col("panel_short").alias("Panel"),
        shift_key(F.col("line_id"), F.col("ord")).alias("ShiftKey"), label.alias("ShiftLabel"), F.concat("line_id", F.lit("|"), label).alias("LineShiftLabel"),
        F.col("lane_no").alias("Lane"), F.col("rejects").alias("Rejects"), F.col("rate_pct").alias("RatePct"),
        F.col("ucl_pct").alias("UclPct"), F.col("ooc").alias("OOC"), F.col("n_inspected").alias("NInspected"),
        F.when(F.col("ooc") == 1, OOC_COLOR).otherwise(IN_CONTROL_COLOR).alias("OOCColor"),
        F.col("shift_idx").alias("ShiftIdx"), F.col("p_bar_pct").alias("PBar"),
    )


def ewma_table(site: Site, week: int | None = None) -> DataFrame:
    names = F.broadcast(site.panels_dim.select("line_id", "panel", "panel_short"))
    rows = _only(spc.weekly_ewma(site), week).join(names, ["line_id", "panel"])
    lane = F.dense_rank().over(W.partitionBy("line_id", "panel", "week").orderBy("lane_no"))
    return _line_names(site, rows).select(
        F.col("line_id").alias("LineId"), "Line", F.col("week").cast("int").alias("Week"), F.col("panel_short").alias("Panel"),
        F.col("batch_idx").alias("BatchIdx"), lane.alias("Lane"),
        round_even(round_even(F.col("rate"), 2), 3).alias("Rate"), round_even(F.col("ewma"), 3).alias("Ewma"),
        F.col("ucl").alias("Ucl"), F.col("lcl").alias("Lcl"),
    )


def week_lanes(site: Site) -> DataFrame:
    return spc.weekly_series(site).select(
        "line_id", "week", "panel", "lane_no", "any_out_of_control"
    ).distinct().join(F.broadcast(site.panels_dim.select("line_id", "panel", "panel_order", "panel_short")), ["line_id", "panel"])


def key_findings(site: Site, week: int | None = None) -> DataFrame:
    entries = oee.shift_entries(site, "week")
    rows = anomalies.key_findings(
        site, entries, oee.week_rollup(site, entries), oee.prior_week_rollup(site), week_lanes(site)
    )
    return _line_names(site, _only(rows, week)).select(
        F.col("line_id").alias("LineId"), "Line", F.col("week").cast("int").alias("Week"), F.col("rank").alias("Rank"),
        F.col("text").alias("Text")
    )


def lines(site: Site) -> DataFrame:
    """Lines with the time up to which their data was complete."""
    return _line_names(site, calendar.latest_shift(site)).select(
        F.col("line_id").alias("LineId"), "Line",
        F.date_format(to_ts(F.col("reached_us")), "yyyy-MM-dd HH:mm:ss").alias("GeneratedAt"),
    )


def dim_date(site: Site) -> DataFrame:
    d = F.to_date("shift_date")
    return oee.shift_entries(site, "published").select("shift_date").distinct().select(
        F.col("shift_date").alias("Date"), F.year(d).alias("Year"), F.month(d).alias("MonthNum"),
        F.date_format(d, "MMM").alias("Month"), F.dayofmonth(d).alias("Day"),
        F.date_format(d, "E").alias("Weekday"), iso_week(d).alias("IsoWeek"),
    )


TABLES: dict[str, Callable[[Site], DataFrame]] = {
    "Shifts": shifts, "DowntimeCategories": downtime_categories, "SegmentDowntime": segment_downtime,
    "SegmentClusters": segment_clusters, "TopStops": top_stops, "HourlyBreakdown": hourly_breakdown,
    "HourlyClusters": hourly_clusters, "ShiftTrend": shift_trend, "Anomalies": anomaly_table,
    "WeeklySummary": weekly_summary, "WeeklyAnomalies": weekly_anomalies, "SPC": spc_table,
    "EWMA": ewma_table, "KeyFindings": key_findings, "Lines": lines, "DimDate": dim_date,
}

# from table, column -> to table, column, active
RELATIONSHIPS = (
    ("Shifts", "LineId", "Lines", "LineId", True),
    ("WeeklySummary", "LineId", "Lines", "LineId", True),
    ("Shifts", "ShiftDate", "DimDate", "Date", True),
    ("SegmentDowntime", "ShiftKey", "Shifts", "ShiftKey", True),
    ("SegmentClusters", "ShiftKey", "Shifts", "ShiftKey", True),
    ("DowntimeCategories", "ShiftKey", "Shifts", "ShiftKey", True),
    ("TopStops", "ShiftKey", "Shifts", "ShiftKey", True),
    ("HourlyBreakdown", "ShiftKey", "Shifts", "ShiftKey", True),
    ("HourlyClusters", "ShiftKey", "Shifts", "ShiftKey", True),
    ("Anomalies", "ShiftKey", "Shifts", "ShiftKey", True),
    ("WeeklyAnomalies", "LineId", "Lines", "LineId", True),
    ("KeyFindings", "LineId", "Lines", "LineId", True),
    ("EWMA", "LineId", "Lines", "LineId", True),
    ("SPC", "ShiftKey", "Shifts", "ShiftKey", True),
    ("ShiftTrend", "AnchorShiftKey", "Shifts", "ShiftKey", True),
    ("SPC", "LineId", "Lines", "LineId", False),
)


def build(site: Site, tables: Sequence[str] | None = None, lines_only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The requested tables (all by default) for the requested lines, as lazy frames."""
    chosen = site.only(lines_only) if lines_only else site
    return {name: TABLES[name](chosen) for name in (tables or TABLES)}


def related(site: Site, name: str) -> DataFrame:
    """A fact or detail table joined along its active relationships up to the dimensions.

    Every right side is a dimension whose key is unique: labels of shifts come again after a year, so
    SPC is related by the shift's key.
    """
    frame = TABLES[name](site)
    for source, col, target, target_col, active in RELATIONSHIPS:
        if source == name and active:
            right = related(site, target)
            clash = [c for c in right.columns if c in frame.columns and c != target_col]
            right = right.drop(*clash)
            if target_col != col:
                right = right.withColumnRenamed(target_col, col)
            frame = frame.join(right, col, "left")
    return frame


def relation_counts(site: Site) -> DataFrame:
    """For each relationship: rows of its table, rows after the join (equal, if the key is unique), rows with a partner."""
    def table(name: str) -> DataFrame:
        return site.stage(f"star.table.{name}", lambda: TABLES[name](site))

    counts = []
    for source, col, target, target_col, active in RELATIONSHIPS:
        left = table(source).select(F.col(col).alias("key"))
        right = table(target).select(F.col(target_col).alias("key"), F.lit(True).alias("found"))
        name, none = F.lit(f"{source}.{col} > {target}.{target_col}"), F.lit(0).cast("long")
        flag = F.lit(active).alias("active")
        rows = left.agg(F.count(F.lit(1)).alias("table_rows"), none.alias("joined_rows"), none.alias("with_partner"))
        joined = left.join(right, "key", "left").agg(
            none.alias("table_rows"), F.count(F.lit(1)).alias("joined_rows"), F.count("found").alias("with_partner")
        )
        counts += [x.select(name.alias("relation"), flag, "*") for x in (rows, joined)]
    return union_all(counts).groupBy("relation", "active").agg(*[F.sum(c).alias(c) for c in ("table_rows", "joined_rows", "with_partner")])


def write_csv(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")

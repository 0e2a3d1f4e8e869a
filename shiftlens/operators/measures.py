"""Aggregate measures over the star tables, evaluated in a group-by context.

A measure is a Column aggregate, so any set of them is one pass over the table; filters on the
context go into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENT, MILLI = 100, 1000


def _exact(col: str, scale: int) -> Column:
    """Sum of a published (rounded) column in whole units: independent of the order of rows."""
    return F.sum(F.rint(F.col(col) * scale)) / scale


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)  # blank instead of a division by zero


def _availability() -> Column:
    return _ratio(_exact("RunningHours", CENT), F.sum("ScheduledHours")) * 100


def _quality() -> Column:
    return _ratio(F.sum("GoodCount"), F.sum("TotalCount")) * 100


def _performance() -> Column:
    weight = F.rint(F.col("RunningHours") * CENT)
    return _ratio(F.sum(F.rint(F.col("Performance") * 10) * weight), F.sum(weight)) / 10


def _change(current: str, prior: str) -> Column:
    return F.avg(current) - F.avg(prior)


def measure_definitions() -> Mapping[str, Mapping[str, Column]]:
    """Star table -> measure name -> aggregate."""
    return {
        "Shifts": {
            "availability_pct": _availability(),
            "quality_pct": _quality(),
            "performance_pct": _performance(),
            "oee_pct": _availability() * _performance() * _quality() / 10000,
            "total_downtime_h": _exact("TotalDowntimeHours", CENT),
            "total_stops": F.sum("TotalStops"),
            "shift_count": F.count_distinct("ShiftKey"),
            "good_count": F.sum("GoodCount"),
            "total_count": F.sum("TotalCount"),
            "longest_stop_min": F.max("LongestStopMin"),
        },
        "DowntimeCategories": {"category_downtime_h": _exact("Hours", CENT)},
        "SegmentDowntime": {"segment_downtime_h": _exact("Hours", CENT)},
        "SegmentClusters": {
            "cluster_downtime_h": _exact("Hours", CENT),
            "cluster_halted_h": _exact("HaltedHours", CENT),
            "cluster_stopped_h": _exact("StoppedHours", CENT),
        },
        "HourlyBreakdown": {"total_minutes": _exact("Minutes", 10)},
        "HourlyClusters": {"hourly_cluster_minutes": _exact("Minutes", 10)},
        "ShiftTrend": {"trend_hours": _exact("Hours", CENT)},
        "TopStops": {"stop_hours": _exact("Hours", CENT), "stop_count": F.sum("Count")},
        "Anomalies": {
            "anomaly_count": F.count(F.lit(1)),
            "max_z_score": F.max("ZScore"),
            "current_share_pct": F.max("CurrentShare"),
            "baseline_share_pct": F.max("BaselineMean"),
        },
        "WeeklyAnomalies": {
            "wk_current_pct": F.max("CurrentShare"),
            "wk_baseline_pct": F.max("BaselineMean"),
            "wk_z": F.max("ZScore"),
            "wk_ratio": F.max("Ratio"),
        },
        "SPC": {
            "reject_rate_pct": _exact("RatePct", MILLI),
            "max_reject_rate_pct": F.max("RatePct"),
            "ucl_pct": F.max("UclPct"),
            "total_rejects": F.sum("Rejects"),
            "out_of_control": F.max("OOC"),
        },
        "EWMA": {
            "ewma_value": F.avg("Ewma"),
            "ewma_rate_pct": F.avg("Rate"),
            "ewma_ucl": F.max("Ucl"),
            "ewma_lcl": F.min("Lcl"),
        },
        "WeeklySummary": {
            "weekly_oee_pct": F.avg("OEE"),
            "weekly_availability_pct": F.avg("Availability"),
            "weekly_performance_pct": F.avg("Performance"),
            "weekly_quality_pct": F.avg("Quality"),
            "oee_dpp": _change("OEE", "PriorOEE"),
            "availability_dpp": _change("Availability", "PriorAvailability"),
            "performance_dpp": _change("Performance", "PriorPerformance"),
            "quality_dpp": _change("Quality", "PriorQuality"),
            "wk_total_stops": F.sum("TotalStops"),
            "wk_downtime_h": _exact("TotalDowntimeHours", CENT),
            "wk_longest_stop_min": F.max("LongestStopMin"),
        },
        "Lines": {
            "last_refreshed": F.concat(F.lit("Last refreshed "), F.max("GeneratedAt")),
        },
    }


def evaluate(
    table: DataFrame, name: str, by: Sequence[str], measures: Sequence[str] | None = None
) -> DataFrame:
    """Measures of a star table in the context of the ``by`` columns."""
    defined = measure_definitions()[name]
    chosen = measures or list(defined)
    return table.groupBy(*by).agg(*[defined[m].alias(m) for m in chosen])


def lane_matrix(spc: DataFrame, panel: str, lanes: Sequence[int]) -> DataFrame:
    """Shift label by lane: sums of rejects and rates of one panel.  Lanes are given, not collected."""
    return (
        spc.filter(F.col("Panel") == panel).groupBy("LineId", "ShiftLabel")
        .pivot("Lane", list(lanes))
        .agg(F.sum("Rejects").alias("rejects"), _exact("RatePct", MILLI).alias("rate_pct"))
    )

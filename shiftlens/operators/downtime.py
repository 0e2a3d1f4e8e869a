"""Downtime: categories, segments and clusters, hours of the shift, top stops, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import MANUAL, TOP_STOPS, TREND_SHIFTS
from shiftlens.functions import causes
from shiftlens.functions.columns import (
    HOUR, MINUTE, round_even, shift_date_text, shift_key, shift_label, shift_start,
)
from shiftlens.operators import calendar, intervals
from shiftlens.sources.site import Site
from shiftlens.sources.staging import staged

KEY = ["line_id", "ord"]


def stop_summary(site: Site, stops: DataFrame | None = None) -> DataFrame:
    """Number, hours and longest minutes of the clipped stops of each shift."""
    if stops is None:
        stops = intervals.block_shifts(site).filter(~F.col("running"))
    return stops.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("total_stops"),
        (F.sum("dur_us") / F.lit(HOUR)).alias("downtime_hours"),
        (F.max("dur_us") / F.lit(MINUTE)).alias("longest_min"),
    )


def _targets(site: Site, shifts: DataFrame | None) -> DataFrame:
    """(line_id, ord, week) of the given shifts, or of all production shifts."""
    return (calendar.production_shifts(site) if shifts is None else shifts).select("line_id", "ord", "week")


def categories(site: Site, stops: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """Dense (shift, category): count and hours.  A manual halted stop counts in both of those."""
    limit = causes.per_line(
        site.lines, F.col("line_id"), lambda p: F.lit(int(p.micro_stop_min * MINUTE)).cast("long"),
        lambda p: p.micro_stop_min,
    )
    manual = F.coalesce(F.lower("stop_type") == MANUAL, F.lit(False))
    other = ~manual & ~F.col("halted")
    tests = {
        "micro_stops": (F.col("dur_us") < limit) & other,
        "halted": F.col("halted"),
        "auto_long": (F.col("dur_us") >= limit) & other,
        "manual": manual,
    }
    wide = stops.groupBy(*KEY).agg(
        *[F.count_if(t).alias(f"n_{k}") for k, t in tests.items()],
        *[F.coalesce(F.sum(F.when(t, F.col("dur_us"))), F.lit(0)).alias(f"u_{k}") for k, t in tests.items()],
    )
    cells = F.array(*[
        F.struct(
            F.lit(k).alias("category"), F.coalesce(f"n_{k}", F.lit(0)).alias("count"),
            (F.coalesce(f"u_{k}", F.lit(0)) / F.lit(HOUR)).alias("hours"),
        )
        for k in tests
    ])
    return _targets(site, shifts).join(wide, KEY, "left").select("line_id", "ord", "week", F.inline(cells))


def segment_clusters(stops: DataFrame) -> DataFrame:
    """(shift, segment, cluster) sums in microseconds; the base of every downtime breakdown."""
    return stops.groupBy(*KEY, "segment", "cluster").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("dur_us").alias("us"),
        F.sum(F.when(F.col("halted"), F.col("dur_us")).otherwise(0)).alias("halted_us"),
    )


def segments(site: Site, cells: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """Dense (shift, segment) downtime with zeros, rounded to 2 decimals."""
    sums = cells.groupBy(*KEY, "segment").agg(
        F.sum("count").alias("count"), F.sum("us").alias("us"), F.sum("halted_us").alias("halted_us")
    )
    grid = _targets(site, shifts).join(
        F.broadcast(site.segments_dim.select("line_id", "segment", "seg_order")), "line_id"
    )
    return _hours(grid.join(sums, [*KEY, "segment"], "left"), "line_id", "ord", "week", "segment", "seg_order")


def clusters(site: Site, cells: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """(shift, segment, cluster) downtime of the stops that have a cluster."""
    return _hours(
        _targets(site, shifts).join(cells.filter(F.col("cluster").isNotNull()), KEY),
        "line_id", "ord", "week", "segment", "cluster",
    )


def _hours(df: DataFrame, *keys: str) -> DataFrame:
    us, halted = F.coalesce("us", F.lit(0)), F.coalesce("halted_us", F.lit(0))
    return df.select(
        *keys, F.coalesce("count", F.lit(0)).alias("count"),
        round_even(us / F.lit(HOUR), 2).alias("hours"),
        round_even(halted / F.lit(HOUR), 2).alias("halted_hours"),
        round_even((us - halted) / F.lit(HOUR), 2).alias("stopped_hours"),
    )


def hour_pieces(site: Site) -> DataFrame:
    """Every closed block, clipped to its shift, cut at the full hours it touches."""
    running = intervals.block_shifts(site).filter(F.col("running")).select(
        *KEY, "c0", "c1", F.lit(True).alias("running"),
        F.lit(None).cast("string").alias("segment"), F.lit(None).cast("string").alias("cluster"),
    )
    stopped = intervals.flagged_stops(site).select(
        *KEY, "c0", "c1", F.lit(False).alias("running"), "segment", "cluster"
    )
    hour = F.explode(F.sequence(
        F.floor(F.col("c0") / F.lit(HOUR)), F.floor(F.col("c1") / F.lit(HOUR))
    ))
    return (
        running.unionByName(stopped).withColumn("hour", hour)
        .withColumn("lo", F.greatest("c0", F.col("hour") * HOUR))
        .withColumn("hi", F.least("c1", (F.col("hour") + 1) * HOUR))
        .withColumn("piece_us", F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(0))
    )


@staged
def hour_sums(site: Site) -> DataFrame:
    return (
        hour_pieces(site)
        .withColumn("segment", F.when(F.col("running"), F.lit("running")).otherwise(F.col("segment")))
        .groupBy(*KEY, "hour", "segment", "cluster")
        .agg(F.sum("piece_us").alias("us"))
    )


def hourly(site: Site) -> DataFrame:
    """(shift, hour, segment, cluster) minutes; segment 'running' for running time.

    All hours of a shift that has any block appear for 'running'; other cells only when > 0.
    """
    sums = hour_sums(site)
    length = (site.bounds[1] - site.bounds[0]) % 24
    first = F.floor(shift_start(F.col("ord"), site.bounds) / F.lit(HOUR))
    grid = sums.select(*KEY).distinct().select(
        *KEY, F.explode(F.sequence(first, first + (length - 1))).alias("hour"),
        F.lit("running").alias("segment"), F.lit(None).cast("string").alias("cluster"),
        F.lit(0).cast("long").alias("us"),
    )
    return (
        sums.filter((F.col("us") > 0)).unionByName(grid)
        .groupBy(*KEY, "hour", "segment", "cluster").agg(F.sum("us").alias("us"))
        .select(
            *KEY, (F.col("hour") - first).cast("int").alias("hour_idx"),
            F.format_string("%02d:00", F.pmod(F.col("hour"), F.lit(24))).alias("hour_label"),
            "segment", "cluster", "us",
        )
    )


def hourly_segments(hours: DataFrame) -> DataFrame:
    return (
        hours.groupBy(*KEY, "hour_idx", "hour_label", "segment").agg(F.sum("us").alias("us"))
        .select(*KEY, "hour_idx", "hour_label", "segment", round_even(F.col("us") / F.lit(MINUTE), 1).alias("minutes"))
    )


def hourly_clusters(site: Site, hours: DataFrame) -> DataFrame:
    """Cluster minutes per hour; a segment without clusters is one pseudo-cluster by its label.

    A segment whose minutes round to zero in the hour has no rows.
    """
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label"))
    whole = F.sum("us").over(W.partitionBy(*KEY, "hour_idx", "segment"))
    stopped = hours.filter(F.col("segment") != "running").withColumn("whole_us", whole)
    return (
        stopped.filter(round_even(F.col("whole_us") / F.lit(MINUTE), 1) > 0)
        .join(names, ["line_id", "segment"])
        .withColumn("cluster", F.coalesce("cluster", "segment_label"))
        .groupBy(*KEY, "hour_idx", "hour_label", "segment", "cluster").agg(F.sum("us").alias("us"))
        .select(
            *KEY, "hour_idx", "hour_label", "segment", "cluster",
            round_even(F.col("us") / F.lit(MINUTE), 1).alias("minutes"),
        )
    )


def label_sums(stops: DataFrame) -> DataFrame:
    """Stops with a cluster counted per (shift, segment, cluster, label).

    Label hours are kept in ten-thousandths: each stop is rounded before it is added.
    """
    hours4 = F.rint(round_even(F.col("dur_us") / F.lit(HOUR), 4) * 10_000).cast("long")
    return stops.filter(F.col("cluster").isNotNull()).groupBy(*KEY, "segment", "cluster", "label").agg(
        F.count(F.lit(1)).alias("count"), F.sum(hours4).alias("hours4")
    )


def _first_labels(labels: DataFrame, period: list[str], n: int) -> DataFrame:
    """The n labels with most hours per (period, segment, cluster); ties by label."""
    w = W.partitionBy(*period, "segment", "cluster").orderBy(F.desc("hours4"), "label")
    return (
        labels.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
        .select(*period, "segment", "cluster", "rank", "label", "count",
                round_even(F.col("hours4") / F.lit(10_000.0), 2).alias("hours"))
    )


def top_stops(stops: DataFrame, n: int = TOP_STOPS) -> DataFrame:
    """Top labels of each shift.  Labels are counted first; Spark limits the groups before the shuffle."""
    return _first_labels(label_sums(stops), KEY, n)


def week_top_stops(site: Site, stops: DataFrame, n: int = TOP_STOPS) -> DataFrame:
    """Top labels over all production shifts of a week, from the counts per shift."""
    shifts = calendar.production_shifts(site).select("line_id", "ord", "week")
    period = ["line_id", "week"]
    labels = label_sums(stops).join(shifts, KEY).groupBy(*period, "segment", "cluster", "label").agg(
        F.sum("count").alias("count"), F.sum("hours4").alias("hours4")
    )
    return _first_labels(labels, period, n)


def _hundredths(col: str):
    return F.sum(F.rint(F.col(col) * 100)) / 100


def week_segments(segs: DataFrame) -> DataFrame:
    """Week totals of the rounded shift values."""
    return segs.groupBy("line_id", "week", "segment").agg(
        F.sum("count").alias("count"),
        *[_hundredths(c).alias(c) for c in ("hours", "halted_hours", "stopped_hours")],
    )


def week_clusters(cells: DataFrame) -> DataFrame:
    return cells.groupBy("line_id", "week", "segment", "cluster").agg(
        F.sum("count").alias("count"),
        *[_hundredths(c).alias(c) for c in ("hours", "halted_hours", "stopped_hours")],
    )


def rounded_categories(cats: DataFrame) -> DataFrame:
    return cats.withColumn("hours", round_even(F.col("hours"), 2))


def week_categories(cats: DataFrame) -> DataFrame:
    return rounded_categories(cats).groupBy("line_id", "week", "category").agg(
        F.sum("count").alias("count"), _hundredths("hours").alias("hours")
    )


def cluster_reference(site: Site, segs: DataFrame, cells: DataFrame, top: DataFrame) -> DataFrame:
    """Defined clusters of a segment by hours (absent = 0), 'Other' last, with their top labels."""
    period = KEY
    grid = segs.select(*period, "segment", F.col("hours").alias("seg_hours")).join(
        F.broadcast(site.clusters_dim), ["line_id", "segment"]
    )
    got = cells.select(*period, "segment", "cluster", "count", "hours")
    defined = grid.join(got, [*period, "segment", "cluster"], "left")
    other = got.filter(F.col("cluster") == "Other").join(
        segs.select(*period, "segment", F.col("hours").alias("seg_hours")), [*period, "segment"]
    ).withColumn("cluster_order", F.lit(9999))
    labels = top.groupBy(*period, "segment", "cluster").agg(
        F.concat_ws("; ", F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "label"))), lambda s: s["label"]
        )).alias("top_labels")
    )
    hours = F.coalesce("hours", F.lit(0.0))
    w = W.partitionBy(*period, "segment").orderBy(
        (F.col("cluster") == "Other").cast("int"), F.desc(hours), "cluster_order"
    )
    return (
        defined.unionByName(other)
        .withColumn("position", F.row_number().over(w))
        .join(labels, [*period, "segment", "cluster"], "left")
        .select(
            *period, "segment", "position", "cluster", F.coalesce("count", F.lit(0)).alias("count"),
            hours.alias("hours"),
            F.coalesce(
                F.when(F.col("seg_hours") > 0, F.try_divide(hours, F.col("seg_hours")) * 100), F.lit(0.0)
            ).alias("segment_pct"),
            F.coalesce("top_labels", F.lit("")).alias("top_labels"),
        )
    )


def daily_breakdown(site: Site, segs: DataFrame) -> DataFrame:
    """Running hours left after the segment hours, never below zero."""
    length = (site.bounds[1] - site.bounds[0]) % 24
    return segs.groupBy(*KEY, "week").agg(_hundredths("hours").alias("downtime_hours")).withColumn(
        "running_hours", F.greatest(F.lit(0.0), F.lit(float(length)) - F.col("downtime_hours"))
    )


def shift_trend(site: Site, cats: DataFrame) -> DataFrame:
    """Each anchor shift with itself and up to three previous shifts present on the line."""
    rounded = rounded_categories(cats)
    w = W.partitionBy("line_id").orderBy("ord")
    seq = cats.select("line_id", "ord").distinct().withColumn("no", F.row_number().over(w))
    window = seq.select(
        "line_id", F.col("ord").alias("anchor"), "no",
        F.explode(F.sequence(F.lit(0), F.lit(TREND_SHIFTS - 1))).alias("trend_rank"),
    ).withColumn("no", F.col("no") - F.col("trend_rank"))
    joined = window.join(seq, ["line_id", "no"]).join(rounded, KEY)
    line, o = F.col("line_id"), F.col("ord")
    return joined.join(F.broadcast(site.categories_dim), "category").select(
        shift_key(line, F.col("anchor")).alias("anchor_shift_key"), "line_id", "trend_rank",
        shift_key(line, o).alias("trend_shift_key"), shift_label(o).alias("trend_shift_label"),
        shift_date_text(o).alias("trend_shift_date"), "category", "category_label", "hours",
        "category_color",
    )


def best_anchor(trend: DataFrame) -> DataFrame:
    """Per line the anchor with most distinct ranks, ties by the latest current date."""
    ranked = trend.groupBy("line_id", "anchor_shift_key").agg(
        F.count_distinct("trend_rank").alias("ranks"),
        F.max(F.when(F.col("trend_rank") == 0, F.col("trend_shift_date"))).alias("current_date"),
    )
    w = W.partitionBy("line_id").orderBy(F.desc("ranks"), F.desc("current_date"), F.desc("anchor_shift_key"))
    return ranked.withColumn("no", F.row_number().over(w)).filter("no = 1").drop("no")


def latest_flags(entries: DataFrame) -> DataFrame:
    """1 on the last shift of each line, in order of date then type (day before night)."""
    newest = entries.groupBy("line_id").agg(F.max("shift_key").alias("newest"))
    return entries.join(newest, "line_id").select(
        "line_id", "shift_key", (F.col("shift_key") == F.col("newest")).cast("int").alias("is_latest")
    )


def last_four(site: Site, cats: DataFrame) -> DataFrame:
    """The four newest shifts, oldest first; skipped ones go after the four are taken."""
    newest = calendar.spine(site).filter(F.col("ord") > F.col("latest_ord") - TREND_SHIFTS)
    kept = newest.filter(~F.col("skipped")).select("line_id", "ord", "latest_ord")
    rows = kept.join(rounded_categories(cats).drop("week"), KEY)
    total = W.partitionBy("line_id", "ord")
    sums = rows.withColumn("shift_hours", F.sum(F.rint(F.col("hours") * 100)).over(total) / 100)
    return sums.select(
        "line_id", shift_label(F.col("ord")).alias("label"),
        (F.col("ord") - F.col("latest_ord") + TREND_SHIFTS).cast("int").alias("position"),
        "category", "hours", "shift_hours",
        F.max("shift_hours").over(W.partitionBy("line_id")).alias("max_hours"),
    )

"""Share-of-downtime profiles and z-score outliers against earlier shifts or weeks.

Shares are kept as whole ten-thousandths, so means and deviations come from exact integer sums and
keys absent from a baseline member count as zero without being materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import (
    ANOMALY_MIN_SHARE, ANOMALY_PRIOR_WEEKS, ANOMALY_STD_FLOOR, ANOMALY_Z,
)
from shiftlens.functions.columns import (
    round_even, shift_date_text, shift_key, shift_label, shift_type, text1,
)
from shiftlens.operators import calendar, downtime, intervals
from shiftlens.sources.site import Site
from shiftlens.sources.staging import staged

UNIT = 10_000  # shares are rounded to 4 decimals
CELL = ["segment", "cluster"]


def _share(part: Column, whole: Column) -> Column:
    return F.rint(round_even(part / whole, 4) * UNIT).cast("long")


@staged
def profiles(site: Site) -> DataFrame:
    """Share of stop time per (shift, segment, cluster); no cluster falls back to the segment."""
    sums = (
        downtime.segment_clusters(intervals.flagged_stops(site))
        .withColumn("cluster", F.coalesce("cluster", "segment"))
        .groupBy("line_id", "ord", *CELL).agg(F.sum("us").alias("us"))
    )
    total = F.sum("us").over(W.partitionBy("line_id", "ord"))
    return sums.withColumn("total", total).filter(F.col("total") > 0).select(
        "line_id", "ord", *CELL, _share(F.col("us"), F.col("total")).alias("share4")
    )


def outliers(cells: DataFrame, period: list[str]) -> DataFrame:
    """Flag and rank: ``cells`` has share4 (current), s1 and s2 (baseline sums), n (members)."""
    n = F.col("n").cast("double")
    mean = F.col("s1") / (n * UNIT)
    spread = F.when(
        F.col("n") > 1,
        F.sqrt(F.try_divide(F.col("n") * F.col("s2") - F.col("s1") * F.col("s1"), n * (n - 1))) / UNIT,
    ).otherwise(F.lit(ANOMALY_STD_FLOOR))
    scored = (
        cells.filter(F.col("n") > 0)
        .withColumn("share", F.col("share4") / F.lit(float(UNIT)))
        .withColumn("mean", mean)
        .withColumn("std", F.greatest(spread, F.lit(ANOMALY_STD_FLOOR)))
        .withColumn("z", (F.col("share") - F.col("mean")) / F.col("std"))
        .filter(F.abs("z") >= ANOMALY_Z)
        .filter((F.col("share") > ANOMALY_MIN_SHARE) | (F.col("mean") > ANOMALY_MIN_SHARE))
        .withColumn("z_score", round_even(F.col("z"), 1))
    )
    w = W.partitionBy(*period).orderBy(F.desc(F.abs("z_score")), F.concat_ws(":", *CELL))
    return scored.select(
        *period, *CELL,
        round_even(F.col("share") * 100, 1).alias("current_share"),
        round_even(F.col("mean") * 100, 1).alias("baseline_mean"),
        "z_score", F.when(F.col("z") > 0, "above").otherwise("below").alias("direction"),
        (F.row_number().over(w) - 1).alias("rank"),
        F.col("n").cast("long").alias("baseline_members"),
    )


def _against(
    current: DataFrame, base: DataFrame, members: DataFrame, targets: DataFrame,
    period: list[str], group: list[str],
) -> DataFrame:
    """Join current shares with baseline sums; a key of either side is kept."""
    expected = targets.join(base, group)
    cells = expected.join(current, [*period, *CELL], "full").select(
        *period, *CELL, F.coalesce("share4", F.lit(0)).alias("share4"),
        F.coalesce("s1", F.lit(0)).alias("s1"), F.coalesce("s2", F.lit(0)).alias("s2"),
    )
    return cells.join(targets.select(*{*period, *group}), period).join(members, group)


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys, *CELL).agg(
        F.sum("share4").alias("s1"), F.sum(F.col("share4") * F.col("share4")).alias("s2")
    )


@staged
def shift_outliers(site: Site) -> DataFrame:
    """Each production shift against the 13 shifts before its week's oldest shift."""
    return outliers_of(site, calendar.production_shifts(site))


def baseline_sizes(site: Site) -> DataFrame:
    """line_id, week, n: the baseline shifts of each week."""
    members = calendar.baseline_members(site, calendar.weeks(site), "week", "oldest_ord")
    return members.groupBy("line_id", "week").agg(F.count(F.lit(1)).alias("n"))


def prior_weeks(site: Site) -> DataFrame:
    """line_id, week, n: the up to four weeks before each week that have stops."""
    have = prior_week_profiles(site).select("line_id", "week").distinct()
    return have.withColumn("week", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(ANOMALY_PRIOR_WEEKS)), lambda i: F.col("week") - i
    ))).filter("week >= 0").groupBy("line_id", "week").agg(F.count(F.lit(1)).alias("n"))


def outliers_of(site: Site, shifts: DataFrame) -> DataFrame:
    prof = profiles(site)
    targets = shifts.select("line_id", "ord", "week")
    members = calendar.baseline_members(site, calendar.weeks(site), "week", "oldest_ord")
    n = baseline_sizes(site)
    base = _sums(members.join(prof, ["line_id", "ord"]), "line_id", "week")
    current = prof.join(targets.select("line_id", "ord"), ["line_id", "ord"])
    cells = _against(current, base, n, targets, ["line_id", "ord"], ["line_id", "week"])
    return outliers(cells, ["line_id", "week", "ord"])


def rolling_outliers(site: Site) -> DataFrame:
    """Each production shift against the 13 shifts right before it."""
    prof = profiles(site)
    targets = calendar.production_shifts(site).select("line_id", "ord", F.col("ord").alias("target"))
    members = calendar.baseline_members(site, targets.select("line_id", "target"), "target", "target")
    n = members.groupBy("line_id", "target").agg(F.count(F.lit(1)).alias("n"))
    base = _sums(members.join(prof, ["line_id", "ord"]), "line_id", "target")
    current = prof.join(targets.select("line_id", "ord"), ["line_id", "ord"])
    cells = _against(current, base, n, targets, ["line_id", "ord"], ["line_id", "target"])
    return outliers(cells, ["line_id", "ord"])


def week_profiles(site: Site) -> DataFrame:
    """Week shares from week hours; what a segment has beyond its clusters is segment:segment."""
    cells = downtime.segment_clusters(intervals.flagged_stops(site))
    segs = downtime.week_segments(downtime.segments(site, cells))
    clus = downtime.week_clusters(downtime.clusters(site, cells))
    as_int = lambda c: F.rint(F.col(c) * 100).cast("long")
    c = clus.select("line_id", "week", *CELL, as_int("hours").alias("h")).filter("h > 0")
    in_clusters = clus.groupBy("line_id", "week", "segment").agg(F.sum(as_int("hours")).alias("in_h"))
    rest = segs.join(in_clusters, ["line_id", "week", "segment"], "left").select(
        "line_id", "week", "segment", F.col("segment").alias("cluster"),
        (as_int("hours") - F.coalesce("in_h", F.lit(0))).alias("h"),
    ).filter("h > 0")
    both = c.unionByName(rest).groupBy("line_id", "week", *CELL).agg(F.sum("h").alias("h"))
    total = F.sum("h").over(W.partitionBy("line_id", "week"))
    return both.select("line_id", "week", *CELL, _share(F.col("h"), total).alias("share4"))


def prior_week_profiles(site: Site) -> DataFrame:
    """Week shares in which every production shift weighs the same."""
    shifts = calendar.production_shifts(site).select("line_id", "ord", "week")
    sums = profiles(site).join(shifts, ["line_id", "ord"]).groupBy("line_id", "week", *CELL).agg(
        F.sum("share4").alias("h")
    )
    total = F.sum("h").over(W.partitionBy("line_id", "week"))
    return sums.withColumn("total", total).filter("total > 0").select(
        "line_id", "week", *CELL, _share(F.col("h"), F.col("total")).alias("share4")
    )


@staged
def week_outliers(site: Site) -> DataFrame:
    """Each week against up to four weeks before it that have stops."""
    prior = prior_week_profiles(site).withColumn(
        "week", F.explode(F.transform(
            F.sequence(F.lit(1), F.lit(ANOMALY_PRIOR_WEEKS)), lambda i: F.col("week") - i
        ))
    ).filter("week >= 0")
    targets = calendar.weeks(site).select("line_id", "week")
    key = ["line_id", "week"]
    cells = _against(week_profiles(site), _sums(prior, *key), prior_weeks(site), targets, key, key)
    return outliers(cells, key)


def ratio() -> Column:
    """Current over baseline share; 0 when there is no baseline."""
    return F.when(
        F.col("baseline_mean") > 0, F.try_divide(F.col("current_share"), F.col("baseline_mean"))
    ).otherwise(F.lit(0.0))


def times(r: Column) -> Column:
    return F.rint(r).cast("long").cast("string")


def with_headline(site: Site, df: DataFrame, period: str) -> DataFrame:
    """Headline and detail text of an outlier.  The wording is fixed: it must equal the published text."""
    names = F.broadcast(site.segments_dim.select("line_id", "segment", "segment_label", "segment_color"))
    r = ratio()
    tail = F.concat(F.col("cluster"), F.lit(" stops than usual ("), F.col("segment_label"), F.lit(")"))
    head = F.when(
        F.col("direction") == "above",
        F.concat(F.when(r >= 2, F.concat(times(r), F.lit("× "))).otherwise(F.lit("")), F.lit("more "), tail),
    ).otherwise(F.concat(F.lit("Fewer "), tail))
    detail = F.concat(
        text1(F.col("current_share")), F.lit(f"% of this {period}'s downtime, normally "),
        text1(F.col("baseline_mean")), F.lit("%"),
    )
    return df.join(names, ["line_id", "segment"]).withColumn("headline", head).withColumn("detail", detail)


def top_outlier(site: Site) -> DataFrame:
    """Per shift: highest z among 'above', else highest |z|; and how many others there are."""
    above = F.col("direction") == "above"
    w = W.partitionBy("line_id", "ord")
    order = w.orderBy(
        F.desc(above), F.desc(F.when(above, F.col("z_score")).otherwise(F.abs("z_score"))), "rank"
    )
    return (
        shift_outliers(site)
        .withColumn("no", F.row_number().over(order))
        .withColumn("others", F.count(F.lit(1)).over(w) - 1)
        .filter("no = 1")
        .select("line_id", shift_label(F.col("ord")).alias("label"), "ord", *CELL, "direction",
                "z_score", "others")
    )


def newest_anomalous(site: Site, n: int = 14) -> DataFrame:
    """The newest n shifts with outliers per line: their first outlier and '+k more'."""
    rows = shift_outliers(site).withColumn("shift_key", shift_key(F.col("line_id"), F.col("ord")))
    by_key = W.partitionBy("line_id").orderBy(F.desc("shift_key"))
    within = W.partitionBy("line_id", "shift_key")
    counts = rows.groupBy("line_id", "shift_key").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "position", F.row_number().over(by_key)
    ).filter(F.col("position") <= n)
    first = rows.withColumn("no", F.row_number().over(within.orderBy("rank"))).filter("no = 1")
    return first.join(counts, ["line_id", "shift_key"]).select(
        "line_id", "shift_key", "position", *CELL, "z_score",
        F.when(F.col("n") > 1, F.concat(F.lit("+"), (F.col("n") - 1).cast("string"), F.lit(" more")))
        .otherwise(F.lit("")).alias("more"),
    )


def masked_spikes(site: Site) -> DataFrame:
    """Per week: shifts with their own outlier, and whether the week as a whole shows none."""
    per_week = shift_outliers(site).groupBy("line_id", "week").agg(
        F.count_distinct("ord").alias("anomalous_shifts")
    )
    has = week_outliers(site).select("line_id", "week").distinct().withColumn("has", F.lit(True))
    return (
        calendar.weeks(site).select("line_id", "week")
        .join(per_week, ["line_id", "week"], "left").join(has, ["line_id", "week"], "left")
        .select(
            "line_id", "week", F.coalesce("anomalous_shifts", F.lit(0)).alias("anomalous_shifts"),
            (F.col("has").isNull() & (F.coalesce("anomalous_shifts", F.lit(0)) > 0)).alias("masked"),
        )
    )


def first_outliers(site: Site, n: int = 5) -> DataFrame:
    """First n outliers of each week by rank, with the rounded ratio."""
    return week_outliers(site).filter(F.col("rank") < n).select(
        "line_id", "week", "rank", *CELL, "direction", round_even(ratio(), 1).alias("ratio")
    )


def anomaly_rows(site: Site) -> DataFrame:
    """Published shift outliers with their texts."""
    o = F.col("ord")
    return with_headline(site, shift_outliers(site), "shift").select(
        shift_key(F.col("line_id"), o).alias("shift_key"), "line_id",
        shift_label(o).alias("shift_label"), shift_date_text(o).alias("shift_date"),
        shift_type(o).alias("shift_type"), *CELL, "current_share", "baseline_mean", "z_score",
        "direction", "headline", "detail", F.col("segment_color").alias("seg_color"), "rank",
    )


def week_anomaly_rows(site: Site) -> DataFrame:
    """Published week outliers: ratio against at least 0.0001."""
    base = F.when(F.col("baseline_mean") > 0, F.col("baseline_mean")).otherwise(F.lit(0.0001))
    return with_headline(site, week_outliers(site), "week").select(
        "line_id", "week", *CELL, "current_share", "baseline_mean", "z_score", "direction",
        round_even(F.col("current_share") / base, 1).alias("ratio"), "headline", "detail",
        F.col("segment_color").alias("seg_color"), "rank",
    )


def key_findings(site: Site, entries: DataFrame, week: DataFrame, prior: DataFrame, lanes: DataFrame) -> DataFrame:
    """Up to four ranked sentences per line and week.  The wording is fixed: it must equal the published text.

    ``lanes``: (line_id, week, panel_order, panel_short, lane_no, any_out_of_control).
    """
    r = ratio()
    seg = F.initcap(F.col("segment"))
    cur, base = text1(F.col("current_share")), text1(F.col("baseline_mean"))
    lead = F.concat(F.col("cluster"), F.lit(" stops in "), seg)
    above = F.col("direction") == "above"
    outlier = week_outliers(site).filter("rank = 0").select(
        "line_id", "week", F.lit(1).alias("item"),
        F.when(above & (r >= 2), F.concat(
            lead, F.lit(" accounted for "), cur, F.lit("% of downtime — "), times(r),
            F.lit("× the normal level ("), base, F.lit("%)"),
        )).when(above, F.concat(lead, F.lit(" ran above normal: "), cur, F.lit("% vs typical "), base, F.lit("%")))
        .otherwise(F.concat(lead, F.lit(" below normal: "), cur, F.lit("% vs typical "), base, F.lit("%")))
        .alias("text"),
    )
    delta = round_even(F.col("oee") - F.col("prior_oee"), 1)
    change = week.join(prior, ["line_id", "week"]).withColumn("delta", delta).filter(F.abs("delta") >= 1.0).select(
        "line_id", "week", F.lit(2).alias("item"),
        F.concat(
            F.lit("Weekly OEE "), F.when(F.col("delta") > 0, "improved").otherwise("declined"), F.lit(" by "),
            text1(F.abs("delta")), F.lit("pp vs prior week ("), F.substring("prior_from", 6, 5), F.lit(" – "),
            F.substring("prior_to", 6, 5), F.lit("): "), text1(F.col("oee")), F.lit("% vs "),
            text1(F.col("prior_oee")), F.lit("%"),
        ).alias("text"),
    )
    per_panel = lanes.filter("any_out_of_control").groupBy("line_id", "week", "panel_order", "panel_short").agg(
        F.concat_ws(", ", F.transform(
            F.array_sort(F.collect_set("lane_no")), lambda x: x.cast("string")
        )).alias("lanes")
    ).withColumn("part", F.concat(F.col("panel_short"), F.lit(" lanes "), F.col("lanes")))
    alert = per_panel.groupBy("line_id", "week").agg(
        F.sort_array(F.collect_list(F.struct("panel_order", "part"))).alias("parts")
    ).select(
        "line_id", "week", F.lit(3).alias("item"),
        F.concat(
            F.lit("Quality alert: "),
            F.concat_ws(" · ", F.transform(F.col("parts"), lambda p: p["part"])),
            F.lit(" exceeded Laney p′ control limits this week"),
        ).alias("text"),
    )
    worst = entries.groupBy("line_id", "week").agg(
        F.min_by(
            F.struct("label", "oee", "availability", "performance", "quality"),
            F.struct("oee", -F.col("ord")),
        ).alias("w")
    ).select(
        "line_id", "week", F.lit(4).alias("item"),
        F.concat(
            F.lit("Weakest shift: "), F.col("w.label"), F.lit(" at "), text1(F.col("w.oee")), F.lit("% OEE (A="),
            text1(F.col("w.availability")), F.lit("% · P="), text1(F.col("w.performance")), F.lit("% · Q="),
            text1(F.col("w.quality")), F.lit("%)"),
        ).alias("text"),
    )
    items = outlier.unionByName(change).unionByName(alert).unionByName(worst)
    w = W.partitionBy("line_id", "week").orderBy("item")
    return items.select("line_id", "week", (F.row_number().over(w) - 1).alias("rank"), "text")

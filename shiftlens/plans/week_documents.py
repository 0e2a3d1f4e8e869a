"""Week documents: figures, nested downtime, outliers, shifts and the points of every SPC lane."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.functions.columns import round_even, shift_date_text, shift_end, shift_label, shift_type, ts_text
from shiftlens.operators import anomalies, calendar, downtime, intervals, oee, spc
from shiftlens.plans import nested, star
from shiftlens.sources.site import Site

KEY = ["line_id", "week"]
FIGURES = ("oee", "availability", "performance", "quality")
TOTALS = ("good_count", "total_count", "total_stops", "total_downtime_hours", "longest_stop_min", "production_shifts", "excluded_shifts")
ENTRY = (*FIGURES, "running_hours", "total_stops", "total_downtime_hours", "longest_stop_min", "good_count", "total_count")


def panels(site: Site) -> DataFrame:
    """weekly_spc of each line and week: {panel: points of every lane, EWMA, table}.

    All lanes of a panel share the axis ``labels``, the week's production shifts; a shift without
    enough inspected parts is a gap, null in every lane.
    """
    period = [*KEY, "panel"]
    pct = lambda c: round_even(F.col(c) * 100, 3).alias(f"{c}_pct")
    series = spc.weekly_series(site)
    point = F.struct("ord", pct("rate"), pct("ucl"), pct("lcl"), F.col("ooc").alias("out_of_control"))
    lane = series.groupBy(*period, "lane_no").agg(
        F.sort_array(F.collect_list(point)).alias("p"), F.first(round_even(F.col("p_bar") * 100, 3)).alias("p_bar_pct"),
        F.first("any_out_of_control").alias("any_out_of_control"), F.first("shift_subgroups").alias("shift_subgroups"),
    )
    pick = lambda c: F.transform("p", lambda x: x[c]).alias(c)
    lane = lane.select(
        *period, "shift_subgroups", F.transform("p", lambda x: shift_label(x["ord"])).alias("labels"),
        F.struct("lane_no", "p_bar_pct", "any_out_of_control", F.struct(*[pick(c) for c in ("rate_pct", "ucl_pct", "lcl_pct", "out_of_control")]).alias("points")).alias("lane"),
    )
    lanes = lane.groupBy(*period).agg(
        F.first("shift_subgroups").alias("shift_subgroups"), F.first("labels").alias("labels"), F.sort_array(F.collect_list("lane")).alias("lanes")
    )
    cell = F.struct(F.col("lane_no").alias("lane"), "rejects", "rate_pct", (F.col("ooc") == 1).alias("ooc"))
    table = spc.weekly_detail(site).groupBy(*period, "ord").agg(F.first("n_inspected").alias("n_inspected"), F.sort_array(F.collect_list(cell)).alias("per_lane"))
    table = table.groupBy(*period).agg(F.sort_array(F.collect_list(F.struct("ord", "n_inspected", "per_lane"))).alias("t"))
    shown = F.transform("t", lambda x: F.struct(shift_label(x["ord"]).alias("label"), x["n_inspected"].alias("n_inspected"), x["per_lane"].alias("per_lane")))
    whole = lanes.join(nested.ewma(spc.weekly_ewma(site), period), period, "left").join(table.select(*period, shown.alias("shift_table")), period, "left")
    body = F.struct("shift_subgroups", F.size("labels").alias("total_shifts"), "labels", "lanes", "ewma", "shift_table")
    return whole.groupBy(*KEY).agg(nested.keyed("panel", body).alias("weekly_spc"))


def shifts(site: Site, cells: DataFrame, stops: DataFrame) -> DataFrame:
    """shifts of each line and week, newest first: figures, downtime and outliers; excluded ones are skipped rows."""
    period = ["line_id", "ord"]
    rows = calendar.spine(site).select(*period, "week", "skipped").join(oee.shift_entries(site, "week").select(*period, *ENTRY), period, "left")
    parts = (
        nested.categories(downtime.rounded_categories(downtime.categories(site, stops)), period),
        nested.segments(downtime.segments(site, cells), downtime.clusters(site, cells), period),
        nested.outliers(anomalies.shift_outliers(site), period),
    )
    for part in parts:
        rows = rows.join(part, period, "left")
    rows = rows.join(anomalies.baseline_sizes(site), KEY, "left")
    o, kept = F.col("ord"), ~F.col("skipped")
    found = F.struct("cluster_outliers", F.coalesce("n", F.lit(0)).alias("baseline_shifts"))
    row = F.struct(
        "ord", shift_date_text(o).alias("shift_date"), shift_type(o).alias("shift_type"), shift_label(o).alias("label"), "skipped",
        *ENTRY, "downtime_categories", "segment_downtime", F.when(kept, found).alias("anomalies"),
    )
    newest = F.array_sort(F.collect_list(row), lambda a, b: (b["ord"] - a["ord"]).cast("int"))
    return rows.groupBy(*KEY).agg(F.transform(newest, lambda x: x.dropFields("ord")).alias("shifts"))


def week_documents(site: Site) -> DataFrame:
    """One document per line and week."""
    stops, cells = intervals.flagged_stops(site), star._cells(site)
    segs, clus = downtime.segments(site, cells), downtime.clusters(site, cells)
    rolled = oee.week_rollup(site, oee.shift_entries(site, "week")).join(oee.prior_week_rollup(site), KEY)
    parts = (
        nested.categories(downtime.week_categories(downtime.categories(site, stops)), KEY),
        nested.segments(downtime.week_segments(segs), downtime.week_clusters(clus), KEY),
        nested.top_stops(downtime.week_top_stops(site, stops), KEY),
        nested.outliers(anomalies.week_outliers(site), KEY),
        anomalies.prior_weeks(site).withColumnRenamed("n", "baseline_weeks"),
        shifts(site, cells, stops), panels(site),
        calendar.weeks(site).select(*KEY, ts_text(shift_end(F.col("newest_ord"), site.bounds)).alias("generated_at")),
    )
    for part in parts:
        rolled = rolled.join(part, KEY, "left")
    prior = F.struct(*[F.col(f"prior_{c}").alias(c) for c in ("from", "to", *FIGURES)])
    found = F.struct("cluster_outliers", F.coalesce("baseline_weeks", F.lit(0)).alias("baseline_weeks"))
    body = F.struct(
        F.col("week_from").alias("from"), F.col("week_to").alias("to"), *FIGURES, *TOTALS,
        "downtime_categories", "segment_downtime", "top_stops_by_cluster", found.alias("anomalies"), prior.alias("prior_week"),
    )
    return rolled.select(F.lit("weekly-dashboard").alias("analysis_id"), *KEY, "generated_at", body.alias("body"), "shifts", "weekly_spc")


# -- the way back, from documents that were read --------------------------------------------


def flat_summary(docs: DataFrame) -> DataFrame:
    rows = docs.select(*KEY, "body.*")
    prior = [F.col(f"prior_week.{c}").alias(f"prior_{c}") for c in ("from", "to", *FIGURES)]
    return rows.select(
        *KEY, F.col("from").alias("week_from"), F.col("to").alias("week_to"), *FIGURES, *TOTALS, *prior, F.col("anomalies.baseline_weeks").alias("baseline_weeks")
    )


def flat_shifts(docs: DataFrame) -> DataFrame:
    """One row per shift of a document, skipped ones too, with its nested parts."""
    return docs.select(*KEY, F.posexplode("shifts").alias("position", "s")).select(*KEY, "position", "s.*")


def _panels(docs: DataFrame, keys: list[str]) -> DataFrame:
    return docs.select(*keys, F.explode("weekly_spc").alias("panel", "v")).select(*keys, "panel", "v.*")


def flat_points(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per lane and shift of the axis, gaps included."""
    rows = _panels(docs, keys).select(*keys, "panel", "labels", F.inline("lanes"))
    zipped = F.arrays_zip("labels", *[F.col(f"points.{c}").alias(c) for c in ("rate_pct", "ucl_pct", "lcl_pct", "out_of_control")])
    rows = rows.select(*keys, "panel", "lane_no", "p_bar_pct", "any_out_of_control", F.posexplode(zipped).alias("position", "p"))
    return rows.select(*keys, "panel", "lane_no", "p_bar_pct", "any_out_of_control", "position", F.col("p.labels").alias("label"), "p.rate_pct", "p.ucl_pct", "p.lcl_pct", "p.out_of_control")


def flat_ewma(docs: DataFrame, keys: list[str]) -> DataFrame:
    return nested.flat_ewma(_panels(docs, keys).filter("ewma IS NOT NULL"), [*keys, "panel"])


def table_size() -> Column:
    """Number of rows that ``flat_table`` makes of a document: its shifts with data times their lanes, over all panels."""
    whole = lambda v: F.greatest(F.coalesce(v, F.lit(0)), F.lit(0))
    shifts = lambda t: whole(F.aggregate(t, F.lit(0), lambda n, x: n + whole(F.size(x["per_lane"]))))
    return whole(F.aggregate(F.map_values("weekly_spc"), F.lit(0), lambda n, v: n + shifts(v["shift_table"])))


def flat_table(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The detail table: one row per shift with data and lane, the limit taken from the lane's points."""
    rows = _panels(docs, keys).select(*keys, "panel", "labels", "lanes", F.posexplode("shift_table").alias("shift_idx", "t"))
    rows = rows.select(*keys, "panel", "labels", "lanes", "shift_idx", "t.label", "t.n_inspected", F.posexplode("t.per_lane").alias("i", "c"))
    lane = F.get("lanes", F.col("i"))
    limit = F.get(lane["points"]["ucl_pct"], (F.array_position("labels", F.col("label")) - 1).cast("int"))
    return rows.select(
        *keys, "panel", "label", F.col("c.lane").alias("lane_no"), F.col("c.rejects").alias("rejects"), F.col("c.rate_pct").alias("rate_pct"), limit.alias("ucl_pct"),
        F.col("c.ooc").cast("int").alias("ooc"), "n_inspected", "shift_idx", lane["p_bar_pct"].alias("p_bar_pct"),
    )

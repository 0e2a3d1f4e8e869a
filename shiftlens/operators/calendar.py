"""Latest complete shift, the shift spine and its weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.config import ANOMALY_BASELINE_SHIFTS, SHIFTS_PER_WEEK
from shiftlens.functions.columns import (
    iso_week, shift_date, shift_date_text, shift_end, shift_key, shift_label, shift_of,
    shift_start, shift_type, to_ts, to_us, week_label,
)
from shiftlens.sources.site import Site, union_all
from shiftlens.sources.staging import staged


def latest_shift(site: Site) -> DataFrame:
    """Per line: the newest shift that every core table covers to its end."""
    newest = union_all([
        site.table(t).groupBy("line_id").agg(F.max(c).alias("ts"))
        for t, c in (("status_blocks", "end_ts"), ("ppm", "t_stamp"), ("output_stats", "t_stamp"))
    ])
    reached = newest.filter(F.col("ts").isNotNull()).groupBy("line_id").agg(
        F.min(to_us(F.col("ts"))).alias("reached_us")
    )
    current = shift_of(F.col("reached_us"), site.bounds)
    return reached.withColumn(
        "latest_ord",
        F.when(F.col("reached_us") < shift_end(current, site.bounds), current - 1).otherwise(current),
    )


def week_of(ordinal: Column, latest: Column) -> Column:
    """0 = the 14 shifts that end with the latest one, 1 = the 14 before, ..."""
    return F.floor((latest - ordinal) / F.lit(SHIFTS_PER_WEEK)).cast("int")


@staged
def spine(site: Site) -> DataFrame:
    """Every shift of every line up to the latest complete one, with week and skip flag."""
    first = site.table("status_blocks").groupBy("line_id").agg(
        shift_of(F.min(to_us(F.col("start_ts"))), site.bounds).alias("first_ord")
    )
    shifts = (
        latest_shift(site).join(first, "line_id")
        .filter(F.col("first_ord") <= F.col("latest_ord"))
        .select("line_id", "latest_ord", F.explode(F.sequence("first_ord", "latest_ord")).alias("ord"))
        .withColumn("week", week_of(F.col("ord"), F.col("latest_ord")))
        .withColumn("day", shift_date(F.col("ord")))
    )
    skip = site.excluded.withColumn("skip", F.lit(True))
    return shifts.join(skip, ["line_id", "day"], "left").select(
        "line_id", "ord", "week", "latest_ord", F.coalesce("skip", F.lit(False)).alias("skipped")
    )


def production_shifts(site: Site) -> DataFrame:
    return spine(site).filter(~F.col("skipped")).drop("skipped")


def labelled_spine(site: Site) -> DataFrame:
    o = F.col("ord")
    return spine(site).select(
        "line_id", "ord", "week", "skipped",
        shift_date_text(o).alias("shift_date"), shift_type(o).alias("shift_type"),
        shift_label(o).alias("label"),
        F.concat(F.col("line_id"), F.lit("|"), shift_label(o)).alias("line_shift_label"),
        iso_week(shift_date(o)).alias("iso_week"), week_label(shift_date(o)).alias("week_label"),
        (o == F.col("latest_ord")).alias("is_latest"),
    )


def weeks(site: Site) -> DataFrame:
    """One row per line and week of the spine with its window of ordinals."""
    return weeks_of(spine(site))


def weeks_of(shifts: DataFrame) -> DataFrame:
    newest = F.col("latest_ord") - F.col("week") * SHIFTS_PER_WEEK
    return (
        shifts.select("line_id", "week", "latest_ord").distinct()
        .withColumn("newest_ord", newest)
        .withColumn("oldest_ord", newest - (SHIFTS_PER_WEEK - 1))
    )


def previous(site: Site, n: int = 4) -> DataFrame:
    """The n shifts before each shift of the spine, newest first (rank 1..n)."""
    return spine(site).select(
        "line_id", "ord", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank")
    ).select(
        "line_id", shift_key(F.col("line_id"), F.col("ord")).alias("shift_key"), "rank",
        shift_date_text(F.col("ord") - F.col("rank")).alias("prev_date"),
        shift_type(F.col("ord") - F.col("rank")).alias("prev_type"),
    )


def spc_cutoff(site: Site) -> DataFrame:
    """Start of the oldest of the 14 shifts that end with each shift of the spine."""
    oldest = F.col("ord") - (SHIFTS_PER_WEEK - 1)
    return spine(site).select(
        "line_id", shift_key(F.col("line_id"), F.col("ord")).alias("shift_key"),
        to_ts(shift_start(oldest, site.bounds)).alias("cutoff_ts"),
    )


def baseline_members(site: Site, anchors: DataFrame, key: str, before: str) -> DataFrame:
    """(line, key, ord) of the 13 non-excluded shifts before ``before``; excluded are not replaced."""
    members = anchors.select(
        "line_id", key,
        F.explode(F.sequence(
            F.col(before) - ANOMALY_BASELINE_SHIFTS, F.col(before) - 1
        )).alias("ord"),
    ).withColumn("day", shift_date(F.col("ord")))
    return members.join(site.excluded, ["line_id", "day"], "left_anti").drop("day")

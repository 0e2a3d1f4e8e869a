"""Production schedule: daily run hours and output, day classes, excluded days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.functions import causes
from shiftlens.functions.columns import HOUR, SECOND, bucket_no, date_of, round_even, to_us
from shiftlens.operators import intervals
from shiftlens.sources.site import Site
from shiftlens.sources.staging import staged


def daily_run_hours(site: Site) -> DataFrame:
    """Running hours by start date of closed blocks; both ends count in whole seconds."""
    blocks = intervals.closed_blocks(site)
    seconds = bucket_no(F.col("e_us"), SECOND) - bucket_no(F.col("s_us"), SECOND)
    return blocks.groupBy("line_id", date_of(F.col("s_us")).alias("day")).agg(
        (F.sum(F.when(F.col("running"), seconds).otherwise(0)) / F.lit(3600.0)).alias("run_hours")
    )


def daily_output(site: Site) -> DataFrame:
    """Largest minus smallest counter of the day (resets are not looked at), first/last sample."""
    us = to_us(F.col("t_stamp"))
    return site.table("output_stats").groupBy("line_id", date_of(us).alias("day")).agg(
        (F.max("counter_total") - F.min("counter_total")).alias("parts_produced"),
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count(F.lit(1)).alias("n_samples"),
        ((F.max(us) - F.min(us)) / F.lit(HOUR)).alias("coverage_hours"),
    )


def day_spine(site: Site) -> DataFrame:
    """Every calendar day of each line from the first block start to the last sample."""
    run = site.table("status_blocks").groupBy("line_id").agg(
        F.min(to_us(F.col("start_ts"))).alias("lo"), F.max(to_us(F.col("start_ts"))).alias("hi")
    )
    return run.select(
        "line_id",
        F.explode(F.sequence(date_of(F.col("lo")), date_of(F.col("hi")))).alias("day"),
    )


@staged
def schedule(site: Site) -> DataFrame:
    """Day spine with run hours, output and class; zero where there is no data."""
    zero = F.lit(0.0)

    def limit(attr: str):
        return causes.per_line(
            site.lines, F.col("line_id"), lambda p: F.lit(float(getattr(p, attr))), lambda p: getattr(p, attr)
        )

    days = (
        day_spine(site)
        .join(daily_run_hours(site), ["line_id", "day"], "left")
        .join(daily_output(site), ["line_id", "day"], "left")
        .select(
            "line_id", "day", F.coalesce("run_hours", zero).alias("run_hours"),
            F.coalesce("parts_produced", F.lit(0)).alias("parts_produced"),
            F.coalesce("coverage_hours", zero).alias("coverage_hours"),
        )
    )
    classed = days.withColumn(
        "classification",
        F.when(
            (F.col("run_hours") < limit("min_run_hours")) & (F.col("parts_produced") < limit("min_parts")),
            F.lit("non_production"),
        ).when(F.col("coverage_hours") < limit("full_day_hours"), F.lit("partial")).otherwise(F.lit("full")),
    )
    return classed.withColumn(
        "effective_hours",
        F.when(F.col("classification") == "non_production", zero)
        .when(F.col("classification") == "partial", round_even(F.col("coverage_hours"), 2))
        .otherwise(F.lit(24.0)),
    )


def summary(days: DataFrame) -> DataFrame:
    """Counts per class, calendar/effective/excluded hours and share excluded."""
    sums = days.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("total_days"),
        *[F.count_if(F.col("classification") == c).alias(f"{c}_days") for c in ("full", "partial", "non_production")],
        (F.sum(F.rint(F.col("effective_hours") * 100)) / 100).alias("effective_hours"),
    )
    calendar_hours = F.col("total_days") * 24.0
    return sums.select(
        "*", calendar_hours.alias("calendar_hours"),
        round_even(calendar_hours - F.col("effective_hours"), 2).alias("excluded_hours"),
        round_even((1 - F.col("effective_hours") / calendar_hours) * 100, 1).alias("exclusion_pct"),
    )


def excluded_days(site: Site, days: DataFrame) -> DataFrame:
    """Declared days and detected non-production days together."""
    found = days.filter(F.col("classification") == "non_production").select("line_id", "day")
    return site.excluded.select("line_id", "day").union(found).distinct()


def without_days(df: DataFrame, excluded: DataFrame, day) -> DataFrame:
    """Drop the rows whose calendar date is excluded.

    The list has at most one row per line and calendar day, so it is broadcast.
    """
    return df.withColumn("day", day).join(F.broadcast(excluded), ["line_id", "day"], "left_anti").drop("day")


def guarded_schedule(stored: DataFrame, start: str | None, end: str | None) -> tuple[DataFrame, DataFrame]:
    """A stored schedule counts only when its range is the requested window.

    Returns (days to use, warnings).  ``stored`` carries range_from and range_to; without a window
    it is used as is.
    """
    if start is None or end is None:
        return stored, stored.limit(0).select("line_id", F.lit("").alias("warning"))
    same = (F.col("range_from") == start) & (F.col("range_to") == end)
    warning = stored.filter(~same).select("line_id", "range_from", "range_to").distinct().select(
        "line_id",
        F.concat(
            F.lit("schedule range "), F.col("range_from"), F.lit(".."), F.col("range_to"),
            F.lit(f" does not match the window {start}..{end}; schedule ignored"),
        ).alias("warning"),
    )
    return stored.filter(same), warning

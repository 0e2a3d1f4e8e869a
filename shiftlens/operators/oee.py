"""Availability, performance, quality and OEE per shift, and their week roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import ANOMALY_BASELINE_SHIFTS, DEFAULT_IDEAL_PPM
from shiftlens.functions.columns import (
    HOUR, iso_week, round_even, shift_date, shift_date_text, shift_key, shift_label,
    shift_of, shift_type, to_us,
)
from shiftlens.functions.ordered import (
    CHUNK, assign_chunks, exact_percentile, latest_start_asof,
)
from shiftlens.operators import calendar, intervals
from shiftlens.sources.site import Site
from shiftlens.sources.staging import checked_broadcast, staged

KEY = ["line_id", "ord"]


def shift_us(site: Site) -> int:
    day, night = site.bounds
    return ((night - day) % 24) * HOUR


def availability(site: Site) -> DataFrame:
    """Running share of the fixed shift length, running and stopped hours."""
    sums = intervals.block_shifts(site).groupBy(*KEY).agg(
        F.sum(F.when(F.col("running"), F.col("dur_us")).otherwise(0)).alias("run_us"),
        F.sum(F.when(F.col("running"), 0).otherwise(F.col("dur_us"))).alias("stop_us"),
    )
    return sums.select(
        *KEY,
        (F.col("run_us") / F.lit(shift_us(site)) * 100).alias("availability"),
        (F.col("run_us") / F.lit(HOUR)).alias("running_hours"),
        (F.col("stop_us") / F.lit(HOUR)).alias("stopped_hours"),
    )


def speed_samples(site: Site) -> DataFrame:
    """Positive speed samples with their shift."""
    return (
        site.table("ppm").filter(F.col("output_ppm") > 0)
        .select("line_id", to_us(F.col("t_stamp")).alias("us"), F.col("output_ppm").cast("double").alias("ppm"))
        .withColumn("ord", shift_of(F.col("us"), site.bounds))
    )


def speed_window(site: Site, span: str) -> DataFrame:
    """(line_id, week, latest_ord, lo, hi): the shifts whose samples give an ideal speed.

    ``week``: the non-excluded shifts of the week.  ``published``: those and the 13 shifts before the
    oldest of them, as for every published shift.  ``single``: the latest shift and the 13 before it,
    excluded or not, as for a run of that shift alone.  Excluded days inside a window count.
    """
    weeks = calendar.production_shifts(site).groupBy("line_id", "week").agg(
        F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.first("latest_ord").alias("latest_ord")
    )
    if span == "week":
        return weeks
    if span == "single":
        lines = weeks.groupBy("line_id").agg(F.first("latest_ord").alias("latest_ord"))
        first = F.col("latest_ord") - ANOMALY_BASELINE_SHIFTS
        return lines.select("line_id", F.lit(0).alias("week"), "latest_ord", first.alias("lo"), F.col("latest_ord").alias("hi"))
    if span != "published":
        raise ValueError(f"span is 'week', 'published' or 'single', not {span!r}")
    before = weeks.select("line_id", "week", F.explode(F.sequence(F.col("lo") - ANOMALY_BASELINE_SHIFTS, F.col("lo") - 1)).alias("ord"))
    kept = before.withColumn("day", shift_date(F.col("ord"))).join(site.excluded, ["line_id", "day"], "left_anti")
    first = kept.groupBy("line_id", "week").agg(F.min("ord").alias("first"))
    return weeks.join(first, ["line_id", "week"], "left").withColumn("lo", F.coalesce("first", "lo")).drop("first")


@staged
def ideal_speed(site: Site, span: str) -> DataFrame:
    """Exact 95th percentile of the positive samples of each window (see ``speed_window``)."""
    window = site.stage(f"oee.speed_window.{span}", lambda: speed_window(site, span))
    # One row per line, and one per line and week: counted before they are broadcast.
    latest = checked_broadcast(window.groupBy("line_id").agg(F.first("latest_ord").alias("latest_ord")))
    own = calendar.week_of(F.col("ord"), F.col("latest_ord"))
    # a sample lies in the window of its own week and, published, in that of the next week
    weeks = {"week": F.array(own), "published": F.array(own, own - 1), "single": F.array(F.lit(0))}[span]
    samples = (
        speed_samples(site).join(latest, "line_id").withColumn("week", F.explode(weeks))
        .join(checked_broadcast(window.drop("latest_ord")), ["line_id", "week"])
        .filter(F.col("ord").between(F.col("lo"), F.col("hi")))
    )
    found = exact_percentile(samples, ["line_id", "week"], "ppm", 0.95, lambda name, make: site.stage(f"oee.ideal_speed.{span}.{name}", make))
    # exact_percentile has a row for every window with samples
    return window.select("line_id", "week").join(found, ["line_id", "week"], "left").select(
        "line_id", "week", F.coalesce("percentile", F.lit(DEFAULT_IDEAL_PPM)).alias("ideal_ppm")
    )


def running_samples(site: Site) -> DataFrame:
    """Speed samples inside a running interval: latest start not after them, closed end."""
    running = intervals.block_shifts(site).filter(F.col("running")).select(*KEY, "c0", "c1")
    matched = latest_start_asof(
        speed_samples(site).select("line_id", "us", "ord", "ppm"),
        running.withColumnRenamed("ord", "iv_ord"), ["line_id"], "us", "c0", "c1", site.chunking,
        carried=["iv_ord"], payload=["ord", "ppm"],
    )
    return matched.filter((F.col("us") <= F.col("iv_hi")) & (F.col("ord") == F.col("iv_ord")))


def average_speed(site: Site) -> DataFrame:
    return running_samples(site).groupBy(*KEY).agg(
        F.avg("ppm").alias("avg_ppm"), F.count(F.lit(1)).alias("samples")
    )


def quality(site: Site) -> DataFrame:
    """Good over total from cumulative counters; the step across a reset adds nothing."""
    rows = (
        site.table("output_stats")
        .filter(F.col("counter_total").isNotNull() & F.col("counter_good").isNotNull())
        .filter(F.col("counter_good") <= F.col("counter_total"))
        .select(
            "line_id", "row_id", to_us(F.col("t_stamp")).alias("us"),
            F.col("counter_total").cast("long").alias("total"),
            F.col("counter_good").cast("long").alias("good"),
        )
        .withColumn("ord", shift_of(F.col("us"), site.bounds))
    )
    chunked = assign_chunks(rows, ["line_id"], "us", site.chunking)
    # Steps inside a chunk, then the step from each chunk to the next one of the same shift.
    order = F.struct("us", "row_id")
    w = W.partitionBy("line_id", CHUNK).orderBy("us", "row_id")
    steps = chunked.withColumn("p_total", F.lag("total").over(w)).withColumn("p_good", F.lag("good").over(w))
    grew = F.col("total") >= F.col("p_total")
    chunks = steps.groupBy("line_id", CHUNK, "ord").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.when(grew, F.col("total") - F.col("p_total"))), F.lit(0)).alias("d_total"),
        F.coalesce(F.sum(F.when(grew, F.col("good") - F.col("p_good"))), F.lit(0)).alias("d_good"),
        F.min_by(F.struct("total", "good"), order).alias("first"),
        F.max_by(F.struct("total", "good"), order).alias("last"),
    )
    series = W.partitionBy(*KEY).orderBy(CHUNK)
    linked = chunks.withColumn("before", F.lag("last").over(series))
    grew = F.col("first.total") >= F.col("before.total")
    sums = linked.groupBy(*KEY).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("d_total") + F.when(grew, F.col("first.total") - F.col("before.total")).otherwise(0)).alias("total"),
        F.sum(F.col("d_good") + F.when(grew, F.col("first.good") - F.col("before.good")).otherwise(0)).alias("good"),
    )
    usable = (F.col("n") >= 2) & (F.col("total") > 0)
    return sums.select(
        *KEY,
        F.when(usable, F.try_divide(F.col("good"), F.col("total")) * 100).otherwise(F.lit(100.0)).alias("quality"),
        F.when(usable, F.col("good")).otherwise(F.lit(0)).cast("long").alias("good_count"),
        F.when(usable, F.col("total")).otherwise(F.lit(0)).cast("long").alias("total_count"),
    )


@staged
def shift_parts(site: Site) -> DataFrame:
    """Unrounded A, average speed, Q of every production shift; defaults where there is no data."""
    return parts_of(site, calendar.production_shifts(site))


def parts_of(site: Site, shifts: DataFrame) -> DataFrame:
    return (
        shifts
        .join(availability(site), KEY, "left")
        .join(average_speed(site), KEY, "left")
        .join(quality(site), KEY, "left")
        .select(
            "line_id", "ord", "week", "latest_ord",
            F.coalesce("availability", F.lit(0.0)).alias("availability"),
            F.coalesce("running_hours", F.lit(0.0)).alias("running_hours"),
            F.coalesce("stopped_hours", F.lit(0.0)).alias("stopped_hours"),
            F.coalesce("avg_ppm", F.lit(0.0)).alias("avg_ppm"),
            F.coalesce("quality", F.lit(100.0)).alias("quality"),
            F.coalesce("good_count", F.lit(0)).alias("good_count"),
            F.coalesce("total_count", F.lit(0)).alias("total_count"),
        )
    )


def _performance(avg: str, ideal: str):
    return F.when(F.col(ideal) > 0, F.col(avg) / F.col(ideal) * 100).otherwise(F.lit(0.0))


@staged
def shift_oee(site: Site, span: str) -> DataFrame:
    """Unrounded A, P, Q and OEE per production shift against the ideal speed of a span."""
    return measured(site, shift_parts(site), span)


def measured(site: Site, parts: DataFrame, span: str) -> DataFrame:
    parts = parts.join(ideal_speed(site, span), ["line_id", "week"], "left")
    return parts.withColumn("performance", _performance("avg_ppm", "ideal_ppm")).withColumn(
        "oee", F.col("availability") / 100 * F.col("performance") / 100 * F.col("quality") / 100 * 100
    )


@staged
def shift_entries(site: Site, span: str) -> DataFrame:
    """Shift rows: rounded parts, stop summary, labels.  Skipped shifts are not here.

    Published rows have the span "published", the rows of a week report the span "week".
    """
    return entries_of(site, shift_oee(site, span))


@staged
def subject_entries(site: Site) -> DataFrame:
    """Published rows of every shift of the spine: the subject of a document is never skipped."""
    return entries_of(site, measured(site, parts_of(site, calendar.spine(site)), "published"))


def entries_of(site: Site, figures: DataFrame) -> DataFrame:
    from shiftlens.operators import downtime

    summary = downtime.stop_summary(site)
    o = F.col("ord")
    return figures.join(summary, KEY, "left").select(
        "line_id", "ord", "week",
        shift_key(F.col("line_id"), o).alias("shift_key"),
        shift_date_text(o).alias("shift_date"), shift_type(o).alias("shift_type"),
        shift_label(o).alias("label"),
        round_even(F.col("oee"), 1).alias("oee"),
        round_even(F.col("availability"), 1).alias("availability"),
        round_even(F.col("performance"), 1).alias("performance"),
        round_even(F.col("quality"), 1).alias("quality"),
        round_even(F.col("running_hours"), 2).alias("running_hours"),
        F.coalesce("total_stops", F.lit(0)).alias("total_stops"),
        F.coalesce(round_even(F.col("downtime_hours"), 2), F.lit(0.0)).alias("total_downtime_hours"),
        F.coalesce(round_even(F.col("longest_min"), 1), F.lit(0.0)).alias("longest_stop_min"),
        "good_count", "total_count",
        (o == F.col("latest_ord")).alias("is_latest"),
    )


def week_rollup(site: Site, entries: DataFrame) -> DataFrame:
    """Week figures from the rounded shift rows: hours-weighted speed, ratio-of-counts quality."""
    hours = F.col("running_hours")
    scheduled = shift_us(site) // HOUR
    window = calendar.weeks(site)
    all_shifts = calendar.spine(site).groupBy("line_id", "week").agg(
        F.count_if("skipped").alias("excluded_shifts")
    )
    sums = entries.groupBy("line_id", "week").agg(
        F.count(F.lit(1)).alias("production_shifts"),
        F.sum(F.rint(hours * 100)).alias("run_c"),
        F.sum(F.rint(hours * 100) * F.rint(F.col("performance") * 10)).alias("weighted"),
        F.sum("good_count").alias("good_count"), F.sum("total_count").alias("total_count"),
        F.sum("total_stops").alias("total_stops"),
        (F.sum(F.rint(F.col("total_downtime_hours") * 100)) / 100).alias("total_downtime_hours"),
        F.max("longest_stop_min").alias("longest_stop_min"),
    )
    a = F.col("run_c") / 100 / (F.col("production_shifts") * scheduled) * 100
    p = F.when(F.col("run_c") > 0, F.try_divide(F.col("weighted"), F.col("run_c")) / 10).otherwise(0.0)
    q = F.when(
        F.col("total_count") > 0, F.try_divide(F.col("good_count"), F.col("total_count")) * 100
    ).otherwise(0.0)
    return (
        all_shifts.join(sums, ["line_id", "week"], "left")
        .join(window, ["line_id", "week"])
        .withColumn("availability", F.coalesce(a, F.lit(0.0)))
        .withColumn("performance", F.coalesce(p, F.lit(0.0)))
        .withColumn("quality", F.coalesce(q, F.lit(0.0)))
        .withColumn(
            "oee", F.col("availability") / 100 * F.col("performance") / 100 * F.col("quality") / 100 * 100
        )
        .select(
            "line_id", "week", shift_date_text(F.col("oldest_ord")).alias("week_from"),
            shift_date_text(F.col("newest_ord")).alias("week_to"),
            *[round_even(F.col(c), 1).alias(c) for c in ("oee", "availability", "performance", "quality")],
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("good_count", "total_count", "total_stops", "production_shifts")],
            "excluded_shifts",
            *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("total_downtime_hours", "longest_stop_min")],
        )
    )


def prior_week_rollup(site: Site) -> DataFrame:
    """For each week, its 14 preceding shifts rolled up from unrounded parts with its own ideal."""
    parts = shift_parts(site).withColumn("week", F.col("week") - 1).filter(F.col("week") >= 0)
    ideal = ideal_speed(site, "week")
    scheduled = shift_us(site) // HOUR
    sums = parts.join(ideal, ["line_id", "week"]).withColumn(
        "performance", _performance("avg_ppm", "ideal_ppm")
    ).groupBy("line_id", "week").agg(
        F.count(F.lit(1)).alias("production_shifts"), F.sum("running_hours").alias("hours"),
        F.sum(F.col("performance") * F.col("running_hours")).alias("weighted"),
        F.sum("good_count").alias("good_count"), F.sum("total_count").alias("total_count"),
    )
    a = F.col("hours") / (F.col("production_shifts") * scheduled) * 100
    p = F.when(F.col("hours") > 0, F.try_divide(F.col("weighted"), F.col("hours"))).otherwise(0.0)
    q = F.when(
        F.col("total_count") > 0, F.try_divide(F.col("good_count"), F.col("total_count")) * 100
    ).otherwise(0.0)
    zero = F.lit(0.0)
    return (
        calendar.weeks(site).join(sums, ["line_id", "week"], "left")
        .withColumn("prior_availability", F.coalesce(a, zero))
        .withColumn("prior_performance", F.coalesce(p, zero))
        .withColumn("prior_quality", F.coalesce(q, zero))
        .withColumn(
            "prior_oee",
            F.col("prior_availability") / 100 * F.col("prior_performance") / 100
            * F.col("prior_quality") / 100 * 100,
        )
        .select(
            "line_id", "week",
            shift_date_text(F.col("oldest_ord") - 14).alias("prior_from"),
            shift_date_text(F.col("oldest_ord") - 1).alias("prior_to"),
            *[round_even(F.col(f"prior_{c}"), 1).alias(f"prior_{c}")
              for c in ("oee", "availability", "performance", "quality")],
            F.coalesce("good_count", F.lit(0)).alias("prior_good"),
            F.coalesce("total_count", F.lit(0)).alias("prior_total"),
        )
    )


def iso_week_rollup(site: Site, entries: DataFrame) -> DataFrame:
    """Shift rows grouped by ISO week: first and last date, shifts in order."""
    return (
        entries.withColumn("iso_week", iso_week(F.to_date("shift_date")))
        .groupBy("line_id", "iso_week")
        .agg(
            F.min("shift_date").alias("week_start"), F.max("shift_date").alias("week_end"),
            F.count(F.lit(1)).alias("n_shifts"),
            F.concat_ws(", ", F.transform(
                F.sort_array(F.collect_list(F.struct("ord", "label"))), lambda s: s["label"]
            )).alias("shifts"),
        )
    )


def kpi_bands(entries: DataFrame) -> DataFrame:
    """Band of each KPI and its change against the previous production shift (dead band 0.05)."""
    w = W.partitionBy("line_id").orderBy("ord")
    names = ("oee", "availability", "performance", "quality")
    frame = entries.withColumn("prev_label", F.lag("label").over(w))
    for n in names:
        frame = frame.withColumn(f"prev_{n}", F.lag(n).over(w))
    long = frame.select(
        "line_id", "shift_key", "prev_label",
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("kpi"), F.col(n).alias("value"), F.col(f"prev_{n}").alias("prev"))
            for n in names
        ])),
    )
    delta = F.col("value") - F.col("prev")
    return long.select(
        "line_id", "shift_key", "kpi", "value", "prev_label",
        F.when(F.col("value") >= 80, "good").when(F.col("value") >= 60, "fair").otherwise("poor").alias("band"),
        round_even(delta, 1).alias("delta_pp"),
        F.when(F.col("prev").isNull(), F.lit(None)).when(F.abs(delta) < 0.05, "flat")
        .when(delta > 0, "up").otherwise("down").alias("trend"),
    )


def week_deltas(week: DataFrame, prior: DataFrame) -> DataFrame:
    joined = week.join(prior, ["line_id", "week"])
    return joined.select(
        "line_id", "week",
        *[round_even(F.col(c) - F.col(f"prior_{c}"), 1).alias(f"{c}_dpp")
          for c in ("oee", "availability", "performance", "quality")],
    )


def oee_trend(entries: DataFrame) -> DataFrame:
    """Production shifts of each week, oldest first."""
    w = W.partitionBy("line_id", "week").orderBy("ord")
    return entries.select(
        "line_id", "week", F.row_number().over(w).alias("position"), "label", "shift_type",
        "oee", "availability", "performance", "quality",
    )



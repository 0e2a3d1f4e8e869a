"""SPC from counters that reset: subgroups, Laney p-prime and EWMA, for all panels in one plan.

The counter tables are large; resets and subgroups are few (the site's lookback bounds them), so
only reset detection, lane lookup and the peak lookup touch large data, each with an equi key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftlens.config import (
    EWMA_L, EWMA_LAMBDA, EWMA_STD_FLOOR, EWMA_WINDOW, LAST_BATCH_GAP_HOURS, MIDDAY_HOUR, SPC_BASELINE_BUCKETS,
    SPC_D2, SPC_MIN_INSPECTED, SPC_SIGMA_FLOOR,
)
from shiftlens.functions.columns import (
    DAY, HOUR, SECOND, batch_end_label, boundaries_between, bucket_no, date_of, floor_to, round_even,
    shift_end, shift_key, shift_label, shift_of, shift_start, to_ts, to_us, ts_text,
)
from shiftlens.functions.ordered import with_previous
from shiftlens.operators import calendar, schedule
from shiftlens.sources.site import Site, union_all
from shiftlens.sources.staging import checked_broadcast, staged

PANEL = ["line_id", "panel"]
SUBGROUP = ["line_id", "panel", "block_id", "seg"]
LANE_SCHEMA = (
    "line_id string, panel string, counter_table string, dual boolean, row_id long, block_id long, us long, "
    "name string, cnt long, lane string"
)
_BLOCK_CHUNK = 4096


def lane_rows(site: Site, since_us: int | None = None) -> DataFrame:
    """Counter rows that belong to a panel, one scan per counter table for all its panels.

    ``since_us`` is a literal bound on the raw time column, so that old row groups are not read.
    """
    by_table: dict[str, dict] = {}
    for profile in site.lines:
        for panel in profile.panels:
            if profile.has_table(panel.table):
                by_table.setdefault(panel.table, {}).setdefault(panel, []).append(profile.line_id)
    parts = []
    for table, members in sorted(by_table.items()):
        tests = []
        for panel, line_ids in members.items():
            named = F.lit(False)
            for pattern in panel.patterns:
                named = named | F.col("name").like(pattern)
            tests.append((panel, F.col("line_id").isin(*line_ids) & named))
        tags = F.array(*[
            F.when(test, F.struct(F.lit(p.key).alias("panel"), F.lit(p.dual).alias("dual")))
            for p, test in tests
        ])
        rows = site.table(table)
        if since_us is not None:
            rows = rows.filter(F.col("t_stamp") >= to_ts(F.lit(since_us)))
        parts.append(
            rows.withColumn("tag", F.explode(F.filter(tags, lambda t: t.isNotNull())))
            .select(
                "line_id", F.col("tag.panel").alias("panel"), F.lit(table).alias("counter_table"),
                F.col("tag.dual").alias("dual"), "row_id", "block_id",
                to_us(F.col("t_stamp")).alias("us"), "name", F.col("cnt").cast("long").alias("cnt"),
                F.when(F.col("tag.dual"), F.concat(F.lit("lane"), F.substring_index("name", "_", -1)))
                .otherwise(F.col("name")).alias("lane"),
            )
        )
    if not parts:
        return site.spark.createDataFrame([], LANE_SCHEMA)
    return union_all(parts)


def representatives(site: Site) -> DataFrame:
    """The lane whose resets stand for the panel: declared, else the lowest row id (only then the counters are read)."""
    declared = site.panels_dim.filter("representative is not null").select(*PANEL, F.col("representative").alias("name"))
    unknown = site.panels_dim.filter("representative is null").select(*PANEL)
    if all(x.representative for p in site.lines for x in p.panels):
        return declared
    first = lane_rows(site).join(F.broadcast(unknown), PANEL, "left_semi").groupBy(*PANEL)
    return declared.unionByName(first.agg(F.min_by("name", "row_id").alias("name")))


def lookback_floor(site: Site) -> DataFrame:
    """Per line and counter table: newest time minus the site's lookback, in whole seconds; all with a lookback of 0."""
    days = site.spc_lookback_days
    tables = sorted({x.table for p in site.lines for x in p.panels if p.has_table(x.table)})
    if not tables:
        return site.spark.createDataFrame([], "line_id string, floor_us long, counter_table string")
    at = to_us(F.col("t_stamp"))
    floor = floor_to(F.max(at) - F.lit(days * DAY) if days else F.min(at), SECOND)
    return union_all([
        site.table(t).groupBy("line_id").agg(floor.alias("floor_us")).withColumn("counter_table", F.lit(t))
        for t in tables
    ])


@staged
def representative_rows(site: Site) -> DataFrame:
    """Rows of the representative lane inside the lookback."""
    floors = lookback_floor(site)
    oldest = floors.agg(F.min("floor_us")).first()[0]  # one value, to prune the scan
    return (
        lane_rows(site, oldest).join(F.broadcast(representatives(site)), [*PANEL, "name"])
        .join(F.broadcast(floors), ["line_id", "counter_table"])
        .filter(F.col("us") >= F.col("floor_us"))
        .select(*PANEL, "block_id", "row_id", "us", "cnt")
        .withColumn("ord", shift_of(F.col("us"), site.bounds))
    )


@staged
def resets(site: Site) -> DataFrame:
    """Blocks where the representative counter fell, with the reset before; too few = no panel."""
    rows = representative_rows(site).withColumn("block_chunk", floor_to(F.col("block_id"), _BLOCK_CHUNK))
    stepped = with_previous(
        rows, PANEL, ["block_id", "row_id"], {"cnt": "prev_cnt"}, chunk="block_chunk"
    )
    fell = stepped.filter(F.col("cnt") < F.col("prev_cnt")).select(*PANEL, "block_id", "us")
    w = W.partitionBy(*PANEL)
    before = w.orderBy("block_id")
    return (
        fell.withColumn("n_resets", F.count(F.lit(1)).over(w))
        .withColumn("prev_block", F.lag("block_id").over(before))
        .withColumn("prev_us", F.lag("us").over(before))
        .join(F.broadcast(site.panels_dim.select(*PANEL, "min_resets")), PANEL)
        .filter(F.col("n_resets") >= F.col("min_resets"))
        .drop("min_resets", "n_resets")
    )


def boundary_blocks(site: Site) -> DataFrame:
    """(panel, shift) -> last block that began strictly before the start of that shift.

    Boundaries are shift edges, so the as-of lookup is a running maximum over shift summaries.
    """
    per_shift = representative_rows(site).groupBy(*PANEL, "ord").agg(F.max("block_id").alias("block"))
    w = W.partitionBy(*PANEL).orderBy("ord")
    run = per_shift.withColumn(
        "last_block", F.max("block").over(w.rowsBetween(W.unboundedPreceding, 0))
    ).withColumn("until", F.coalesce(F.lead("ord").over(w), F.col("ord") + 1))
    return run.select(
        *PANEL, "last_block", F.explode(F.sequence(F.col("ord") + 1, F.col("until"))).alias("bound_ord")
    )


@staged
def segments(site: Site) -> DataFrame:
    """Time segments to be counted: one per batch, or one per shift part of a straddling batch."""
    b = site.bounds
    us, prev = F.col("us"), F.col("prev_us")
    reset_s, prev_s = floor_to(us, SECOND), floor_to(prev, SECOND)
    empty = F.array().cast("array<bigint>")
    kept = schedule.without_days(resets(site), site.excluded, date_of(us))
    marked = kept.withColumn(
        "bounds", F.when(prev.isNull(), empty).otherwise(boundaries_between(prev, us, b))
    ).withColumn("straddle", F.size("bounds") > 0)
    last_bound = shift_start(shift_of(us - 1, b), b)
    simple = F.array(
        F.when(prev.isNull(), reset_s).otherwise(F.greatest(prev_s, last_bound)), reset_s
    )
    marks = F.when(F.col("straddle"), F.concat(F.array(prev_s), F.col("bounds"), F.array(reset_s))).otherwise(simple)
    pieces = marked.withColumn("marks", marks).withColumn("n", F.size("marks")).select(
        *PANEL, "block_id", "prev_block", "straddle", "marks", "n",
        F.explode(F.sequence(F.lit(0), F.col("n") - 2)).alias("seg"),
    ).select(
        *PANEL, "block_id", "prev_block", "straddle", "seg",
        F.element_at("marks", F.col("seg") + 1).alias("lo"),
        F.element_at("marks", F.col("seg") + 2).alias("hi"),
        (F.col("seg") == F.col("n") - 2).alias("closed"),
    )
    at = boundary_blocks(site)
    lo_block = at.select(*PANEL, F.col("bound_ord").alias("lo_ord"), F.col("last_block").alias("lo_bound"))
    hi_block = at.select(*PANEL, F.col("bound_ord").alias("hi_ord"), F.col("last_block").alias("hi_bound"))
    return (
        pieces.withColumn("lo_ord", shift_of(F.col("lo"), b)).withColumn("hi_ord", shift_of(F.col("hi"), b))
        .join(lo_block, [*PANEL, "lo_ord"], "left").join(hi_block, [*PANEL, "hi_ord"], "left")
        .select(
            *SUBGROUP, "straddle", "closed", "lo", "hi",
            F.when(F.col("straddle"), F.when(F.col("seg") == 0, F.col("prev_block")).otherwise(F.col("lo_bound")))
            .alias("lo_block"),
            F.when(F.col("closed"), F.col("block_id") - 1).otherwise(F.col("hi_bound")).alias("hi_block"),
            F.when(F.col("closed"), F.col("hi")).otherwise(F.col("hi") - SECOND).alias("stamp_us"),
        )
    )


def block_lanes(site: Site, needed: DataFrame) -> DataFrame:
    """Lane counts at the needed blocks; a block with missing lanes or NULLs is left out.

    Single station: exactly n rows and no NULL.  Two stations: non-NULL counts are summed per lane
    and every lane must have one.
    """
    span = needed.agg(F.min("block_id"), F.max("block_id")).first()  # two values, to prune the scan
    rows = lane_rows(site).filter(F.col("block_id").between(F.lit(span[0]).cast("long"), F.lit(span[1]).cast("long"))).join(
        checked_broadcast(needed.select(*PANEL, "block_id").distinct()), [*PANEL, "block_id"], "left_semi"
    )
    lanes = rows.groupBy(*PANEL, "dual", "block_id", "lane").agg(
        F.sum("cnt").alias("value"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("cnt").isNull()).alias("n_null"),
    )
    w = W.partitionBy(*PANEL, "block_id")
    full = (
        lanes.withColumn("rows", F.sum("n_rows").over(w)).withColumn("nulls", F.sum("n_null").over(w))
        .withColumn("lanes", F.count("value").over(w))
        .join(F.broadcast(site.panels_dim.select(*PANEL, "n_lanes")), PANEL)
    )
    single = (F.col("rows") == F.col("n_lanes")) & (F.col("nulls") == 0)
    double = (F.col("rows") >= F.col("n_lanes")) & (F.col("lanes") >= F.col("n_lanes"))
    return full.filter(F.when(F.col("dual"), double).otherwise(single)).filter(
        F.col("value").isNotNull()
    ).select(*PANEL, "block_id", "lane", "value")


def second_peaks(site: Site, span: tuple[int, int]) -> DataFrame:
    """level, slot, peak, at_start: the largest positive output counter of every second, minute and hour with samples.

    ``at_start`` counts samples exactly on the start of a second.  Samples are shuffled once, whatever the
    number of panels; minutes and hours come from the seconds.
    """
    us, total = to_us(F.col("t_stamp")), F.col("counter_total").cast("long")
    samples = site.table("output_stats").filter(F.col("counter_total") > 0).filter(
        F.col("t_stamp").between(to_ts(F.lit(span[0]).cast("long")), to_ts(F.lit(span[1]).cast("long")))
    )
    exact = F.max(F.when(F.pmod(us, F.lit(SECOND)) == 0, total))
    seconds = samples.groupBy("line_id", bucket_no(us, SECOND).alias("second")).agg(F.max(total).alias("peak"), exact.alias("at_start"))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.floor(F.col("second") / F.lit(n)).cast("long").alias("slot")) for i, n in enumerate((1, 60, 3600))])
    rows = seconds.select("line_id", "peak", "at_start", F.inline(levels))
    return rows.groupBy("line_id", "level", "slot").agg(F.max("peak").alias("peak"), F.max(F.when(F.col("level") == 0, F.col("at_start"))).alias("at_start"))


def covering(lo: Column, hi: Column) -> Column:
    """Slots (level, slot) of whole hours, minutes and seconds that make up [lo, hi), both whole seconds."""

    def slots(level: int, first: Column, end: Column) -> Column:
        some = F.transform(F.sequence(first, F.greatest(first, end - 1)), lambda x: F.struct(F.lit(level).alias("level"), x.cast("long").alias("slot")))
        return F.when(first < end, some).otherwise(F.array().cast("array<struct<level:int,slot:bigint>>"))

    up, down = lambda x: F.ceil(x / F.lit(60)).cast("long"), lambda x: F.floor(x / F.lit(60)).cast("long")
    minute, minute_end = up(lo), down(hi)
    hour, hour_end = up(minute), down(minute_end)
    a = F.least(minute * 60, hi)
    b = F.greatest(minute_end * 60, a)
    c = F.least(hour * 60, minute_end)
    d = F.greatest(hour_end * 60, c)
    return F.concat(slots(0, lo, a), slots(0, b, hi), slots(1, minute, c), slots(1, d, minute_end), slots(2, hour, hour_end))


def peaks(site: Site, segs: DataFrame) -> DataFrame:
    """Largest positive output counter inside each segment; the last segment has a closed end.

    Segments begin and end on whole seconds, so each is a few whole hours, minutes and seconds, which are
    looked up by equality; the sample on a closed end is that second's ``at_start``.
    """
    span = segs.agg(F.min("lo"), F.max("hi")).first()  # two values, to prune the scan
    table = site.stage("spc.second_peaks", lambda: second_peaks(site, span))
    lo, hi = bucket_no(F.col("lo"), SECOND), bucket_no(F.col("hi"), SECOND)
    inside = segs.filter(F.col("hi") > F.col("lo")).select(*SUBGROUP, F.inline(covering(lo, hi)), F.lit(False).alias("on_end"))
    ends = segs.filter("closed").select(*SUBGROUP, F.lit(0).alias("level"), hi.alias("slot"), F.lit(True).alias("on_end"))
    value = F.when(F.col("on_end"), F.col("at_start")).otherwise(F.col("peak"))
    found = inside.unionByName(ends).join(table, ["line_id", "level", "slot"]).groupBy(*SUBGROUP).agg(F.max(value).alias("peak"))
    return found.filter("peak IS NOT NULL")


@staged
def subgroups(site: Site) -> DataFrame:
    """Long subgroups: (line, panel, subgroup, lane) with inspected parts and rejects."""
    segs = segments(site)
    dims = F.broadcast(site.panels_dim.select(*PANEL, "divisor", "min_subgroups", "lane_mode"))
    found = (
        segs.join(peaks(site, segs), SUBGROUP).join(dims, PANEL)
        .filter(F.col("peak") >= F.col("divisor") * SPC_MIN_INSPECTED)
    )
    counted = site.stage("spc.counted_segments", lambda: found)
    needed = union_all([
        counted.select(*PANEL, F.col(c).alias("block_id")).filter(F.col("block_id").isNotNull())
        for c in ("lo_block", "hi_block")
    ])
    # A few blocks per reset: written first, so that its size decides the join with the counters.
    needed = site.stage("spc.needed_blocks", lambda: needed.distinct())
    lanes = site.stage("spc.block_lanes", lambda: block_lanes(site, needed))
    end = lanes.select(*PANEL, F.col("block_id").alias("hi_block"), "lane", F.col("value").alias("end_value"))
    start = lanes.select(*PANEL, F.col("block_id").alias("lo_block"), "lane", F.col("value").alias("start_value"))
    valid = lanes.select(*PANEL, F.col("block_id").alias("lo_block")).distinct().withColumn("lo_valid", F.lit(True))
    joined = (
        counted.join(end, [*PANEL, "hi_block"])
        .join(start, [*PANEL, "lo_block", "lane"], "left")
        .join(valid, [*PANEL, "lo_block"], "left")
        .filter(~F.col("straddle") | F.col("lo_valid"))
    )
    value = F.when(
        F.col("straddle"), F.greatest(F.lit(0), F.col("end_value") - F.coalesce("start_value", F.lit(0)))
    ).otherwise(F.col("end_value"))
    order = W.partitionBy(*PANEL).orderBy("stamp_us", "block_id", "seg")
    names = W.partitionBy(*PANEL).orderBy("lane")
    suffix = F.regexp_extract("lane", r"(\d+)$", 1).try_cast("int")
    return (
        joined.select(
            *SUBGROUP, "stamp_us", "peak", "divisor", "lane", value.alias("rejects"), "lane_mode",
            "min_subgroups", shift_of(F.col("stamp_us"), site.bounds).alias("ord"),
        )
        .withColumn("no", F.dense_rank().over(order))
        .withColumn("total_subgroups", F.max("no").over(W.partitionBy(*PANEL)))
        .filter(F.col("total_subgroups") >= F.col("min_subgroups"))
        .withColumn(
            "lane_no",
            F.when(F.col("lane_mode") == "discovered_sorted", F.dense_rank().over(names)).otherwise(suffix),
        )
        .withColumn("n_inspected", F.col("peak") / F.col("divisor"))
        .drop("lane_mode", "min_subgroups")
    )


def active_lanes(site: Site, subs: DataFrame, drop_last: bool = False) -> DataFrame:
    """Lanes of each panel; where the panel asks for it, only lanes that fired in scope."""
    scope = subs.filter(F.col("no") < F.col("total_subgroups")) if drop_last else subs
    fired = scope.groupBy(*PANEL, "lane", "lane_no").agg(F.max("rejects").alias("most"))
    return fired.join(F.broadcast(site.panels_dim.select(*PANEL, "active_only")), PANEL).filter(
        ~F.col("active_only") | (F.col("most") > 0)
    ).select(*PANEL, "lane", "lane_no")


def shift_buckets(site: Site, subs: DataFrame, for_baseline: bool = False) -> DataFrame:
    """Subgroups summed per shift and lane; fewer than 100 inspected is no bucket.

    A baseline also leaves out subgroups stamped on an excluded calendar date.
    """
    if for_baseline:
        subs = schedule.without_days(subs, site.excluded, date_of(F.col("stamp_us")))
    return subs.groupBy(*PANEL, "ord", "lane", "lane_no").agg(
        (F.sum("peak") / F.first("divisor")).alias("n"), F.sum("rejects").alias("d"),
        F.min("stamp_us").alias("first_us"),
    ).filter(F.col("n") >= SPC_MIN_INSPECTED)


def baseline_before(
    site: Site, subs: DataFrame, anchors: DataFrame, key: str, before: str, size: int = SPC_BASELINE_BUCKETS
) -> DataFrame:
    """Last ``size`` buckets before a shift ordinal of each anchor (line, key, before).

    Buckets of a lane are numbered; an anchor's last number comes from a running maximum over buckets and
    anchors, and its buckets from an equi-join on blocks of ``size`` numbers, two at most.
    """
    lane = [*PANEL, "lane"]
    buckets = shift_buckets(site, subs, for_baseline=True).withColumn("no", F.row_number().over(W.partitionBy(*lane).orderBy("first_us")))
    buckets = site.stage("spc.numbered_buckets", lambda: buckets)
    times = anchors.select("line_id", F.col(key).alias("_key"), F.col(before).alias("t"))
    lanes = F.broadcast(buckets.select(*lane).distinct())  # bounded by the configured panels
    asked = times.join(lanes, "line_id").select(
        *lane, "t", F.lit(0).alias("side"), "_key", F.lit(None).cast("int").alias("no")
    )
    points = buckets.select(*lane, F.col("ord").alias("t"), F.lit(1).alias("side"), F.lit(None).cast(asked.schema["_key"].dataType).alias("_key"), "no")
    upto = W.partitionBy(*lane).orderBy("t", "side").rowsBetween(W.unboundedPreceding, 0)
    last = points.unionByName(asked).withColumn("last", F.max("no").over(upto)).filter("side = 0 AND last IS NOT NULL")
    block = lambda c: F.floor((c - 1) / F.lit(size)).cast("int")
    first = F.greatest(F.lit(1), F.col("last") - (size - 1))
    wanted = last.select(*lane, F.col("_key").alias(key), "last", F.explode(F.array_distinct(F.array(block(first), block(F.col("last"))))).alias("block"))
    rows = wanted.join(buckets.drop("ord").withColumn("block", block(F.col("no"))), [*lane, "block"])
    return rows.filter((F.col("no") <= F.col("last")) & (F.col("no") > F.col("last") - size)).select(
        *PANEL, key, "lane", "lane_no", F.col("first_us").alias("pos"), "n", "d"
    )


def pre_window_baseline(site: Site, subs: DataFrame) -> DataFrame:
    """Buckets before each week's window, shared by all shifts of the week."""
    weeks = calendar.weeks(site).select("line_id", "week", "oldest_ord")
    return baseline_before(site, subs, weeks, "week", "oldest_ord")


def laney_params(baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Mean rate and sigma_z per key from (n, d) in the order of ``pos``."""
    w = W.partitionBy(*keys)
    p = F.col("p_bar")
    se = F.sqrt(p * (1 - p) / F.col("n"))
    z = F.when((F.col("n") > 0) & (p > 0) & (se > 0), (F.col("d") / F.col("n") - p) / se).otherwise(F.lit(0.0))
    scored = (
        baseline.withColumn("p_bar", F.coalesce(F.try_divide(F.sum("d").over(w), F.sum("n").over(w)), F.lit(0.0)))
        .withColumn("z", z)
        .withColumn("step", F.abs(F.col("z") - F.lag("z").over(w.orderBy("pos"))))
    )
    return scored.groupBy(*keys).agg(
        F.first("p_bar").alias("p_bar"),
        F.greatest(F.coalesce(F.avg("step"), F.lit(1.0)) / SPC_D2, F.lit(SPC_SIGMA_FLOOR)).alias("sigma_z"),
        F.count(F.lit(1)).alias("baseline_n"),
    )


def with_limits(df: DataFrame) -> DataFrame:
    """Rate, limits and the out-of-control flag (only above the upper limit) of n, d, p_bar, sigma_z."""
    p = F.col("p_bar")
    se = F.when((p > 0) & (F.col("n") > 0), F.sqrt(F.try_divide(p * (1 - p), F.col("n")))).otherwise(F.lit(0.0))
    return (
        df.withColumn("se", se)
        .withColumn("rate", F.try_divide(F.col("d"), F.col("n")))
        .withColumn("ucl", F.when(F.col("n") > 0, p + 3 * F.col("sigma_z") * F.col("se")))
        .withColumn("lcl", F.when(F.col("n") > 0, F.greatest(F.lit(0.0), p - 3 * F.col("sigma_z") * F.col("se"))))
        .withColumn("ooc", F.coalesce(F.col("rate") > F.col("ucl"), F.lit(False)))
        .drop("se")
    )


@staged
def weekly_series(site: Site) -> DataFrame:
    """Laney p-prime per week, lane and production shift; gaps are rows without values.

    At least three shifts with data; baseline before the window, else the window itself.
    """
    subs = subgroups(site)
    lanes = active_lanes(site, subs)
    inside = shift_buckets(site, subs).select(*PANEL, "ord", "lane", "n", "d", "first_us")
    axis = calendar.production_shifts(site).select("line_id", "week", "ord").join(
        site.panels_dim.select(*PANEL), "line_id"
    ).join(lanes, PANEL)
    grid = axis.join(inside, [*PANEL, "ord", "lane"], "left")
    period = [*PANEL, "week"]
    valid = grid.filter(F.col("n").isNotNull())
    enough = valid.groupBy(*period).agg(F.count_distinct("ord").alias("shift_subgroups")).filter("shift_subgroups >= 3")
    before = pre_window_baseline(site, subs).join(lanes.select(*PANEL, "lane"), [*PANEL, "lane"], "left_semi")
    usable = before.groupBy(*period).agg(F.count_distinct("pos").alias("k")).filter("k >= 2").drop("k")
    outside = before.join(usable, period, "left_semi")
    fallback = valid.select(*period, "lane", "lane_no", F.col("first_us").alias("pos"), "n", "d").join(
        usable, period, "left_anti"
    )
    params = laney_params(outside.unionByName(fallback), [*period, "lane"])
    total = W.partitionBy(*period, "lane")
    return with_limits(
        grid.join(enough, period).join(params, [*period, "lane"])
        .withColumn("n", F.coalesce("n", F.lit(0.0)))
    ).select(
        *period, "lane", "lane_no", "ord", "n", "d", "rate", "ucl", "lcl", "ooc", "p_bar", "sigma_z",
        "baseline_n", "shift_subgroups",
        F.max("ooc").over(total).alias("any_out_of_control"),
    )


def numbers_at(subs: DataFrame, anchors: DataFrame, at: str, out: str, inclusive: bool = True) -> DataFrame:
    """Number of the last subgroup at (or before) an instant of each anchor, by a running maximum."""
    points = subs.select(*PANEL, F.col("stamp_us").alias("t"), "no").distinct().withColumn("side", F.lit(0))
    keys = [c for c in anchors.columns if c not in PANEL]
    side = F.lit(1 if inclusive else -1)
    asked = anchors.withColumn("t", F.col(at)).withColumn("side", side).withColumn(
        "no", F.lit(None).cast("int")
    )
    for k in keys:
        points = points.withColumn(k, F.lit(None).cast(anchors.schema[k].dataType))
    w = W.partitionBy(*PANEL).orderBy("t", "side").rowsBetween(W.unboundedPreceding, 0)
    return (
        points.unionByName(asked).withColumn(out, F.max("no").over(w))
        .filter(F.col("side") != 0).select(*PANEL, *keys, out)
    )


def _window_rows(subs: DataFrame, anchors: DataFrame, last: str, size: int, keys: list[str]) -> DataFrame:
    """Subgroups numbered last-size+1 .. last for each anchor (equi join on the number)."""
    wanted = anchors.filter(F.col(last).isNotNull()).select(
        *PANEL, *keys, F.explode(F.sequence(F.greatest(F.lit(1), F.col(last) - (size - 1)), F.col(last))).alias("no")
    )
    return wanted.join(subs.drop(*keys), [*PANEL, "no"])


def ewma_series(site: Site, subs: DataFrame, lanes: DataFrame, anchors: DataFrame, keys: list[str], baseline: bool = True) -> DataFrame:
    """EWMA of the last 30 subgroups of each anchor (end_us), limits from before base_us.

    The state is rounded to three decimals at every step; the fold runs over at most 30 values.
    """
    group = [*PANEL, *keys, "lane", "lane_no"]
    subs = subs.join(F.broadcast(lanes), [*PANEL, "lane", "lane_no"], "left_semi")
    placed = numbers_at(subs, anchors, "end_us", "last_no")
    shown = _window_rows(subs, placed, "last_no", EWMA_WINDOW, keys)
    rate = F.col("rejects") / F.col("n_inspected") * 100
    shown = shown.withColumn("rate", rate)
    limits_of = shown
    if baseline:
        placed_base = numbers_at(subs, anchors, "base_us", "base_no", inclusive=False)
        base = _window_rows(subs, placed_base, "base_no", EWMA_WINDOW, keys).withColumn("rate", rate)
        enough = placed_base.filter(F.col("base_no") >= 3).select(*PANEL, *keys)
        limits_of = base.join(enough, [*PANEL, *keys], "left_semi").unionByName(
            shown.join(enough, [*PANEL, *keys], "left_anti")
        )
    factor = (EWMA_LAMBDA / (2 - EWMA_LAMBDA)) ** 0.5
    spread = F.greatest(F.coalesce(F.stddev_samp("rate"), F.lit(EWMA_STD_FLOOR)), F.lit(EWMA_STD_FLOOR))
    limits = limits_of.groupBy(*group).agg(F.avg("rate").alias("mean"), spread.alias("std")).select(
        *group,
        round_even(F.col("mean") + EWMA_L * F.col("std") * factor, 2).alias("ucl"),
        round_even(F.greatest(F.lit(0.0), F.col("mean") - EWMA_L * F.col("std") * factor), 2).alias("lcl"),
    )
    series = shown.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("no", "stamp_us", "rate"))).alias("points")
    ).filter(F.size("points") >= 3)
    first = F.element_at("points", 1)["rate"]
    folded = F.aggregate(
        F.slice("points", 2, EWMA_WINDOW),
        F.array(first),
        lambda acc, x: F.concat(acc, F.array(round_even(
            EWMA_LAMBDA * x["rate"] + (1 - EWMA_LAMBDA) * F.element_at(acc, -1), 3
        ))),
    )
    return (
        series.withColumn("ewma", folded)
        .select(*group, F.posexplode(F.arrays_zip("points", "ewma")).alias("batch_idx", "p"))
        .select(
            *group, "batch_idx", F.col("p.points.stamp_us").alias("stamp_us"),
            F.col("p.points.rate").alias("rate"), F.col("p.ewma").alias("ewma"),
        )
        .join(limits, group)
        .withColumn("breach", F.col("ewma") > F.col("ucl"))
        .withColumn("batch_label", batch_end_label(F.col("stamp_us"), MIDDAY_HOUR))
    )


def week_anchors(site: Site) -> DataFrame:
    b = site.bounds
    return calendar.weeks(site).join(site.panels_dim.select(*PANEL), "line_id").select(
        *PANEL, "week", shift_end(F.col("newest_ord"), b).alias("end_us"),
        shift_start(F.col("oldest_ord"), b).alias("base_us"),
    )


@staged
def weekly_ewma(site: Site) -> DataFrame:
    subs = subgroups(site)
    shown = weekly_series(site).select(*PANEL, "week").distinct()
    rows = ewma_series(site, subs, active_lanes(site, subs), week_anchors(site), ["week"])
    return rows.join(shown, [*PANEL, "week"], "left_semi")


def weekly_detail(site: Site) -> DataFrame:
    """Detail table: shift x lane with rejects, rate, limit, flag and mean rate; gaps left out."""
    series = weekly_series(site).filter(F.col("n") > 0)
    position = W.partitionBy(*PANEL, "week").orderBy("ord")
    ordinal = series.select(*PANEL, "week", "ord").distinct().withColumn("shift_idx", F.row_number().over(position) - 1)
    rate2 = round_even(F.col("rate") * 100, 2)
    return series.join(ordinal, [*PANEL, "week", "ord"]).select(
        *PANEL, "week", "ord", "lane_no", F.col("d").alias("rejects"), rate2.alias("rate_pct"),
        round_even(F.col("ucl") * 100, 3).alias("ucl_pct"), F.col("ooc").cast("int").alias("ooc"),
        F.rint("n").cast("long").alias("n_inspected"), "shift_idx",
        round_even(F.col("p_bar") * 100, 3).alias("p_bar_pct"),
    )


def in_shift(site: Site, subs: DataFrame) -> DataFrame:
    """Subgroups of each shift; one stamped exactly on a boundary also closes the shift before."""
    edge = subs.filter(F.col("stamp_us") == shift_start(F.col("ord"), site.bounds)).withColumn("ord", F.col("ord") - 1)
    return subs.unionByName(edge)


def current_observations(site: Site, subs: DataFrame) -> DataFrame:
    """All subgroups of a shift summed into one observation per active lane."""
    lanes = active_lanes(site, subs, drop_last=True)
    return in_shift(site, subs).join(lanes, [*PANEL, "lane", "lane_no"], "left_semi").groupBy(
        *PANEL, "ord", "lane", "lane_no"
    ).agg(
        (F.sum("peak") / F.first("divisor")).alias("n"), F.sum("rejects").alias("d"),
        F.max("stamp_us").alias("last_us"),
    )


@staged
def shift_panels(site: Site) -> DataFrame:
    """Laney p-prime of each production shift and lane: in-shift sum against the pre-window buckets."""
    return panels_of(site, calendar.production_shifts(site))


def panels_of(site: Site, shifts: DataFrame) -> DataFrame:
    subs = subgroups(site)
    current = current_observations(site, subs).join(shifts.select("line_id", "ord", "week"), ["line_id", "ord"])
    params = laney_params(pre_window_baseline(site, subs), [*PANEL, "week", "lane"]).filter("baseline_n >= 2")
    return with_limits(current.join(params, [*PANEL, "week", "lane"]))


def own_cutoff_panels(site: Site) -> DataFrame:
    """The same with the buckets before the shift itself, as a single-shift run uses them."""
    subs = subgroups(site)
    shifts = calendar.production_shifts(site).select("line_id", "ord")
    base = baseline_before(site, subs, shifts, "ord", "ord")
    params = laney_params(base, [*PANEL, "ord", "lane"]).filter("baseline_n >= 2")
    return with_limits(current_observations(site, subs).join(params, [*PANEL, "ord", "lane"]))


def shift_status(site: Site, shifts: DataFrame | None = None) -> DataFrame:
    """Panels of shifts (all production shifts) without a subgroup: last reset before the shift's end and its age."""
    subs, b = subgroups(site), site.bounds
    shifts = calendar.production_shifts(site) if shifts is None else shifts
    shifts = shifts.join(site.panels_dim.select(*PANEL), "line_id").select(
        *PANEL, "ord", shift_end(F.col("ord"), b).alias("end_us")
    )
    busy = in_shift(site, subs).select(*PANEL, "ord").distinct()
    stamps = subs.groupBy(*PANEL, "no").agg(F.first("stamp_us").alias("last_us"))
    idle = numbers_at(subs, shifts.join(busy, [*PANEL, "ord"], "left_anti"), "end_us", "no")
    gap = (F.col("end_us") - F.col("last_us")) / F.lit(HOUR)
    days, hours = F.floor(F.col("gap_hours") / 24), F.floor(F.pmod(F.col("gap_hours"), F.lit(24.0)))
    return (
        idle.join(stamps, [*PANEL, "no"])
        .withColumn("gap_hours", round_even(gap, 1))
        .select(
            *PANEL, "ord", shift_key(F.col("line_id"), F.col("ord")).alias("shift_key"), F.lit("no_shift_data").alias("status"),
            ts_text(F.col("last_us")).alias("last_reset"), "gap_hours",
            F.concat(F.when(days > 0, F.concat(days.cast("string"), F.lit("d "))).otherwise(F.lit("")),
                     hours.cast("string"), F.lit("h")).alias("age"),
        )
    )


def shift_ewma(site: Site, panels: DataFrame | None = None) -> DataFrame:
    """EWMA per shift that has a panel (of ``panels``, or of all): last 30 subgroups up to the shift's end."""
    b, subs = site.bounds, subgroups(site)
    weeks = calendar.weeks(site).select("line_id", "week", "oldest_ord")
    anchors = (shift_panels(site) if panels is None else panels).select(*PANEL, "week", "ord").distinct().join(weeks, ["line_id", "week"]).select(
        *PANEL, "ord", shift_end(F.col("ord"), b).alias("end_us"), shift_start(F.col("oldest_ord"), b).alias("base_us")
    )
    return ewma_series(site, subs, active_lanes(site, subs, drop_last=True), anchors, ["ord"])


def raw_subgroup_panels(site: Site, size: int = SPC_BASELINE_BUCKETS) -> DataFrame:
    """The older rule: baseline of the last raw subgroups before the shift, ten in all needed."""
    subs, b = subgroups(site), site.bounds
    shifts = calendar.production_shifts(site).join(site.panels_dim.select(*PANEL), "line_id").select(
        *PANEL, "ord", shift_start(F.col("ord"), b).alias("start_us"), shift_end(F.col("ord"), b).alias("end_us")
    )
    placed = numbers_at(subs, shifts, "end_us", "seen").filter("seen >= 10")
    placed = numbers_at(subs, placed, "start_us", "before_no", inclusive=False).filter("before_no >= 2")
    base = _window_rows(subs, placed, "before_no", size, ["ord"])
    params = laney_params(
        base.select(*PANEL, "ord", "lane", F.col("no").alias("pos"), F.col("n_inspected").alias("n"), F.col("rejects").alias("d")),
        [*PANEL, "ord", "lane"],
    )
    return with_limits(current_observations(site, subs).join(params, [*PANEL, "ord", "lane"]))


def last_batches(site: Site, cutoffs: DataFrame) -> DataFrame:
    """Per panel and cutoff (line_id, cutoff_us): the last subgroup up to it, if there are ten; the gap in hours and its status.

    A gap of more than 12 hours has the status ``no_shift_data``; its panel has no lanes.
    """
    subs = subgroups(site)
    anchors = cutoffs.join(site.panels_dim.select(*PANEL), "line_id").withColumn("at_us", F.col("cutoff_us"))
    placed = numbers_at(subs, anchors.select(*PANEL, "cutoff_us", "at_us"), "at_us", "last_no").filter("last_no >= 10").drop("at_us")
    stamps = subs.groupBy(*PANEL, F.col("no").alias("last_no")).agg(F.first("stamp_us").alias("last_us"))
    hours = (F.col("cutoff_us") - F.col("last_us")) / F.lit(HOUR)
    return placed.join(stamps, [*PANEL, "last_no"]).select(
        *PANEL, "cutoff_us", "last_no", "last_us", round_even(hours, 1).alias("gap_hours"), F.when(hours > LAST_BATCH_GAP_HOURS, "no_shift_data").alias("status"),
    )


def last_batch_panels(site: Site, batches: DataFrame, size: int = SPC_BASELINE_BUCKETS) -> DataFrame:
    """Laney p-prime of the last subgroup alone, against the ``size`` subgroups before it (``batches``: rows of ``last_batches``)."""
    subs, keys = subgroups(site), ["cutoff_us"]
    lanes = active_lanes(site, subs, drop_last=True)
    charted = batches.filter("status IS NULL").select(*PANEL, "cutoff_us", "last_no", (F.col("last_no") - 1).alias("before_no"))
    base = _window_rows(subs, charted.drop("last_no"), "before_no", size, keys)
    params = laney_params(
        base.select(*PANEL, *keys, "lane", F.col("no").alias("pos"), F.col("n_inspected").alias("n"), F.col("rejects").alias("d")), [*PANEL, *keys, "lane"]
    )
    current = charted.select(*PANEL, *keys, F.col("last_no").alias("no")).join(subs, [*PANEL, "no"]).join(lanes, [*PANEL, "lane", "lane_no"], "left_semi")
    current = current.select(*PANEL, *keys, "lane", "lane_no", F.col("n_inspected").alias("n"), F.col("rejects").alias("d"), F.col("stamp_us").alias("last_us"))
    return with_limits(current.join(params, [*PANEL, *keys, "lane"]))


def last_batch_ewma(site: Site, batches: DataFrame) -> DataFrame:
    """EWMA of the last 30 subgroups up to each cutoff, its limits from the same ones."""
    subs = subgroups(site)
    anchors = batches.filter("status IS NULL").select(*PANEL, "cutoff_us", F.col("cutoff_us").alias("end_us"))
    return ewma_series(site, subs, active_lanes(site, subs, drop_last=True), anchors, ["cutoff_us"], baseline=False)


def flagged_lanes(panels: DataFrame) -> DataFrame:
    """Per shift panel: lanes out of control as a list, mean of the published mean rates."""
    return panels.groupBy(*PANEL, "ord").agg(
        F.concat_ws(", ", F.transform(
            F.array_sort(F.collect_list(F.when(F.col("ooc"), F.col("lane_no")))), lambda x: x.cast("string")
        )).alias("flagged"),
        F.avg(round_even(F.col("p_bar") * 100, 2)).alias("avg_p_bar"),
        F.first("baseline_n").alias("baseline_subgroups"),
    )


def chart_lines(site: Site) -> DataFrame:
    """Per lane the mean upper limit over its points; per panel the mean of the mean rates."""
    series = weekly_series(site)
    per_lane = series.groupBy(*PANEL, "week", "lane_no").agg(
        F.avg(round_even(F.col("ucl") * 100, 3)).alias("mean_ucl_pct"),
        F.first(round_even(F.col("p_bar") * 100, 3)).alias("p_bar_pct"),
    )
    return per_lane.withColumn("panel_p_bar", F.avg("p_bar_pct").over(W.partitionBy(*PANEL, "week")))


def ewma_in_view(site: Site) -> DataFrame:
    """EWMA points whose batch label is one of the week's production shifts."""
    shown = calendar.production_shifts(site).select("line_id", "week", shift_label(F.col("ord")).alias("batch_label"))
    return weekly_ewma(site).join(shown, ["line_id", "week", "batch_label"], "left_semi")

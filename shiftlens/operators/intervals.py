"""Status blocks and stops at the grain (line, shift)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.functions import causes
from shiftlens.functions.columns import shift_end, shift_of, shift_start, to_us
from shiftlens.functions.ordered import intervals_hit
from shiftlens.sources.site import Site
from shiftlens.sources.staging import staged

STOP_ID = ["s_us", "start_id"]
_SALT = 512


def closed_blocks(site: Site) -> DataFrame:
    """Closed status blocks with microsecond bounds; an open block (no end) is left out."""
    return (
        site.table("status_blocks")
        .filter(F.col("end_ts").isNotNull())
        .withColumn("s_us", to_us(F.col("start_ts")))
        .withColumn("e_us", to_us(F.col("end_ts")))
    )


def split_by_shift(df: DataFrame, bounds: tuple[int, int]) -> DataFrame:
    """One row per shift an interval overlaps, clipped to it (c0, c1, dur_us).

    start < window end and end > window start: a zero-length block inside a shift stays, one
    exactly on a boundary matches neither side.
    """
    ordinal = F.explode(
        F.sequence(shift_of(F.col("s_us"), bounds), shift_of(F.col("e_us"), bounds))
    )
    start, end = shift_start(F.col("ord"), bounds), shift_end(F.col("ord"), bounds)
    return (
        df.filter(F.col("e_us") >= F.col("s_us"))
        .withColumn("ord", ordinal)
        .filter((F.col("s_us") < end) & (F.col("e_us") > start))
        .withColumn("c0", F.greatest(F.col("s_us"), start))
        .withColumn("c1", F.least(F.col("e_us"), end))
        .withColumn("dur_us", F.col("c1") - F.col("c0"))
    )


def block_shifts(site: Site) -> DataFrame:
    return split_by_shift(closed_blocks(site), site.bounds)


def stopped_with_reason(site: Site) -> DataFrame:
    """Stopped blocks left-joined with the operator's reason.

    Blocks without a reason id would all hash to one task; they are spread over salted keys that
    match nothing.
    """
    stops = closed_blocks(site).filter(~F.col("running"))
    salt = F.when(
        F.col("start_id").isNull(), F.pmod(F.xxhash64("s_us"), F.lit(_SALT)).cast("int") + 1
    ).otherwise(F.lit(0))
    reasons = site.table("fof_changes").select(
        "line_id", F.col("ndx").alias("start_id"), F.lit(0).alias("salt"),
        F.nullif(F.col("alarm_text"), F.lit("")).alias("alarm_text"),
    )
    return stops.withColumn("salt", salt).join(reasons, ["line_id", "start_id", "salt"], "left").drop("salt")


def decoded(site: Site, stops: DataFrame) -> DataFrame:
    """Add label, segment and cluster to stop rows (narrow: no shuffle).

    Each step is a column of its own: a value used by many branches is computed once per row and
    the generated code stays small enough to be compiled.
    """
    label, codes, entries = F.col("label"), F.col("codes"), F.col("entries")

    def by_rules(make):
        return causes.per_line(site.lines, F.col("line_id"), make, lambda p: p.segments)

    steps = {
        "codes": causes.reason_codes(F.col("faults")),
        "entries": causes.fault_entries(F.col("faults")),
        "described": causes.code_description(F.get(codes, F.lit(0)), entries),
        "label": causes.display_label(codes, entries, F.col("alarm_text"), F.col("described")),
        "number": causes.alarm_number(label),
        "texts": F.when(F.size(codes) > 1, F.transform(
            F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))),
            lambda c: causes.code_description(c, entries),
        )),
        "primary": by_rules(lambda p: causes.segment_of_label(label, F.col("number"), p)),
        "secondary": F.when(
            F.col("texts").isNotNull(), by_rules(lambda p: causes.segment_of_texts(F.col("texts"), p))
        ),
        "segment": causes.segment_of_stop(F.col("primary"), F.col("secondary"), F.col("stop_type")),
        "cluster": by_rules(lambda p: causes.cluster_of(label, F.col("segment"), p)),
    }
    for name, step in steps.items():
        stops = stops.withColumn(name, step)
    return stops.drop("described", "number", "texts", "primary", "secondary")


def shift_stops(site: Site) -> DataFrame:
    """Decoded stops, one row per stop and shift, clipped to the shift."""
    stops = decoded(site, stopped_with_reason(site)).select(
        "line_id", "start_id", "s_us", "e_us", "stop_type", "label", "segment", "cluster"
    )
    return split_by_shift(stops, site.bounds)


def halted_samples(site: Site) -> DataFrame:
    states = causes.per_line(
        site.lines, F.col("line_id"), lambda p: F.col("state_text").isin(*p.halted_states),
        lambda p: p.halted_states,
    )
    return site.table("machine_state").filter(states).select("line_id", to_us(F.col("t_stamp")).alias("us"))


def halted_stops(site: Site, stops: DataFrame) -> DataFrame:
    """(line, ord, stop) of the stops with a halted sample in [start, end) of the clipped stop."""
    ident = ["ord", *STOP_ID]
    spans = stops.select("line_id", *ident, "c0", "c1")
    return intervals_hit(
        spans, halted_samples(site), ident, ["line_id"], "us", "c0", "c1", site.chunking
    )


@staged
def flagged_stops(site: Site) -> DataFrame:
    """Decoded stops per shift with the halted flag; every breakdown of downtime reads this."""
    stops = shift_stops(site)
    spans = block_shifts(site).filter(~F.col("running"))  # the flag needs neither reason nor decoding
    # a stop is its line, shift, start and reason id, which may be missing
    halted = halted_stops(site, spans).select(*[F.col(c).alias(f"_{c}") for c in ("line_id", "ord", *STOP_ID)])
    same = F.lit(True)
    for c in ("line_id", "ord", "s_us"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    joined = stops.join(halted, same & F.col("start_id").eqNullSafe(F.col("_start_id")), "left")
    return joined.withColumn("halted", F.col("_s_us").isNotNull()).drop(*halted.columns)

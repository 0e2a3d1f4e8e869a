"""Attribution of stops to reason codes: dictionary, columns, one row per code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.config import NO_ALARM, UNATTRIBUTED
from shiftlens.functions import causes
from shiftlens.operators import intervals
from shiftlens.sources.site import Site
from shiftlens.sources.staging import checked_broadcast, staged


def code_dictionary(parsed: DataFrame) -> DataFrame:
    """First description seen for any code, in order of time, per line."""
    rows = parsed.select("line_id", "s_us", "start_id", "entries", F.posexplode("codes").alias("pos", "code"))
    described = rows.withColumn("description", causes.code_description(F.col("code"), F.col("entries"))).filter(
        F.col("description").isNotNull()
    )
    return described.groupBy("line_id", "code").agg(
        F.min_by("description", F.struct("s_us", "start_id", "pos")).alias("description")
    )


@staged
def dictionary(site: Site) -> DataFrame:
    return code_dictionary(intervals.decoded(site, intervals.stopped_with_reason(site)))


def attributed(site: Site) -> DataFrame:
    """Attribution columns of every stop; the dictionary has one row per line and code."""
    parsed = intervals.decoded(site, intervals.stopped_with_reason(site))
    lookup = dictionary(site).select("line_id", F.col("code").alias("rc_code"), F.col("description").alias("known"))
    joined = parsed.withColumn("rc_code", F.get("codes", F.lit(0))).join(
        checked_broadcast(lookup), ["line_id", "rc_code"], "left"
    )
    codes, entries = F.col("codes"), F.col("entries")
    described = F.coalesce(causes.code_description(F.col("rc_code"), entries), F.col("known"))
    joined = joined.withColumn("described", described)
    label = causes.display_label(codes, entries, F.col("alarm_text"), F.col("described"))
    method = (
        F.when(F.size("codes") > 0, "RC").when(F.size("entries") > 0, "FC-fallback")
        .when(F.col("alarm_text").isNotNull() & ~F.col("alarm_text").isin("", NO_ALARM), "FOF-fallback")
        .otherwise(UNATTRIBUTED)
    )
    return joined.withColumn("rc_label", label).withColumn("attribution_method", method).withColumn(
        "rc_codes_count", F.size("codes")
    )


def explode_codes(rows: DataFrame, lookup: DataFrame, weight: str, strategy: str = "equal") -> DataFrame:
    """One row per (stop, code); the weight is split equally or goes to the primary code."""
    n = F.size("codes")
    long = rows.select("*", F.posexplode_outer("codes").alias("pos", "code"))
    share = F.col(weight) / n if strategy == "equal" else F.when(F.col("pos") == 0, F.col(weight)).otherwise(F.lit(0.0))
    out = long.withColumn(weight, F.when(F.col("code").isNull(), F.col(weight)).otherwise(share))
    return out.join(checked_broadcast(lookup), ["line_id", "code"], "left").withColumn(
        "rc_label", F.when(F.col("code").isNull(), F.col("rc_label")).otherwise(
            F.coalesce("description", F.concat(F.lit("RC="), F.col("code").cast("string")))
        ),
    ).drop("description")

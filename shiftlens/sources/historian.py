"""Line-aware scans of historian tables: physical names in, canonical columns out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlens.config import LineProfile
from shiftlens.functions.columns import as_flag

# logical table -> canonical columns: (canonical name, logical column key or profile attribute)
CANONICAL: dict[str, tuple[tuple[str, str], ...]] = {
    "status_blocks": (
        ("start_ts", "start_ts"), ("end_ts", "end_ts"), ("running", "running_status"),
        ("faults", "faults"), ("stop_type", "stop_type"), ("start_id", "start_id"),
    ),
    "fof_changes": (("ndx", "@reason_key"), ("alarm_text", "alarm_text"), ("t_stamp", "t_stamp")),
    "ppm": (("t_stamp", "t_stamp"), ("output_ppm", "output_ppm")),
    "output_stats": (
        ("row_id", "row_id"), ("t_stamp", "t_stamp"), ("counter_total", "counter_total"),
        ("counter_good", "counter_good"),
    ),
    "machine_state": (("t_stamp", "t_stamp"), ("state_text", "@state_column")),
    "hydration_counters": (
        ("row_id", "row_id"), ("block_id", "block_id"), ("t_stamp", "t_stamp"),
        ("name", "counter_name"), ("cnt", "counter_value"),
    ),
    "downtime_overlays": (("start_ts", "start_ts"),),
}
CANONICAL["foil_counters"] = CANONICAL["hydration_counters"]


def canonical(df: DataFrame, profile: LineProfile, logical: str) -> DataFrame:
    """Project physical columns to canonical names (pruned at the scan) and tag the line."""
    cols = [F.lit(profile.line_id).alias("line_id")]
    for name, key in CANONICAL[logical]:
        physical = getattr(profile, key[1:]) if key.startswith("@") else profile.column(key)
        col = F.col(physical)
        cols.append((as_flag(col) if name == "running" else col).alias(name))
    return df.select(*cols)


def scan(
    lines: Sequence[LineProfile], logical: str, read: Callable[[LineProfile, str], DataFrame]
) -> DataFrame:
    """Union of one logical table over the lines that have it."""
    parts = [canonical(read(p, logical), p, logical) for p in lines if p.has_table(logical)]
    if not parts:
        raise KeyError(f"table {logical!r} is not configured for any line")
    return reduce(lambda a, b: a.unionByName(b), parts)


def parquet_reader(spark: SparkSession, root: str) -> Callable[[LineProfile, str], DataFrame]:
    """Physical tables stored as parquet folders ``root/<line>/<table>``."""
    return lambda p, logical: spark.read.parquet(f"{root}/{p.line_id}/{p.physical_table(logical)}")


def jdbc_reader(
    spark: SparkSession, url: str, options: dict[str, str], partition: dict[str, dict[str, str]]
) -> Callable[[LineProfile, str], DataFrame]:
    """Physical tables behind JDBC; ``partition[logical]`` gives partitionColumn, bounds, number."""

    def read(p: LineProfile, logical: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).options(**options)
        reader = reader.option("dbtable", p.physical_table(logical))
        return reader.options(**partition.get(logical, {})).load()

    return read


def available(df: DataFrame, lines: Sequence[LineProfile], subsystem: str, ts: str) -> DataFrame:
    """Clip a scan to the period in which a sub-system has valid data, per line.

    The windows are plain literals, so the filter reaches the scan.
    """
    keep = F.lit(False)
    for p in lines:
        window = p.availability.get(subsystem, {})
        mine = F.col("line_id") == p.line_id
        if "from" in window:
            mine = mine & (F.col(ts) >= F.lit(window["from"]).cast("timestamp_ntz"))
        if "to" in window:
            mine = mine & (F.col(ts) < F.lit(window["to"]).cast("timestamp_ntz"))
        keep = keep | mine
    return df.filter(keep)


def window_filter(df: DataFrame, ts: str, start: str | None, end: str | None) -> DataFrame:
    """Half-open time window [start, end) on the raw column, so that parquet prunes row groups."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end).cast("timestamp_ntz"))
    return df

"""Historian tables derived from a generic ``events`` table.

Two production lines (by parity of the user), with status blocks, speed samples, counters that
reset every eight hours, machine states and reject counters per lane.  Everything is computed from
the whole event table by Spark; the series-order parts use chunked scans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlens.config import LineProfile
from shiftlens.functions.columns import HOUR, as_flag, bucket_no, to_ts, to_us
from shiftlens.functions.ordered import Chunking, assign_chunks, with_previous, with_running_sums

EPOCH = 8 * HOUR
PARTS_FACTOR = 25

PHRASES = (
    "Gripper no part", "Catheter rejected at funnel", "Hot printer foil fault",
    "Frame b waiting downstream", "Web torn at splice", "Air valve on web", "Unknown condition",
)
ALARMS = (
    "", "No Alarm Text", "2150 Pouch misfeed", "4 Closing area open", "Temperature too high",
    "150 Limit switch", "Fork blocked", "Dosing nozzle",
)


def _pick(values: Sequence[str], index) -> F.Column:
    chain = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        chain = chain.when(index == i, F.lit(v))
    return chain


def _events(events: DataFrame, lines: Sequence[LineProfile]) -> DataFrame:
    even, odd = lines[0].line_id, lines[1].line_id
    return events.select(
        F.when(F.col("user_id") % 2 == 0, F.lit(even)).otherwise(F.lit(odd)).alias("line_id"),
        "event_id", "ts", to_us(F.col("ts")).alias("us"), "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _faults():
    k = F.col("k")
    k1 = (k + 1).cast("string")
    phrase = _pick(PHRASES, k % 7)
    return (
        F.when(k % 4 == 0, F.lit("x"))
        .when(k % 4 == 1, F.concat(F.lit("RC="), k1))
        .when(k % 8 == 6, F.concat(
            F.lit("RC="), k.cast("string"), F.lit(" RC="), k1, F.lit(" FC=@Alarm_PLC1_"), k1,
            F.lit("@("), phrase, F.lit(")"),
        ))
        .when(k % 4 == 2, F.concat(
            F.lit("FC=@Fault_"), F.lpad(k.cast("string"), 4, "0"), F.lit("@("), phrase,
            F.lit(") RC="), k.cast("string"),
        ))
        .when(k % 16 == 7, F.concat(F.lit("FC=@Warning_"), k.cast("string"), F.lit("@")))
        .otherwise(F.concat(
            F.lit("FC=@Alarm_PLC1_"), k.cast("string"), F.lit("@("), phrase, F.lit(")")
        ))
    )


def _status_blocks(ev: DataFrame, c: Chunking) -> DataFrame:
    run = ~F.col("event_type").isin("error", "signup")
    flag = F.when(run, _pick(("true", "1", "True"), F.col("k") % 3)).otherwise(
        _pick(("False", "0", "false"), F.col("k") % 3)
    )
    base = ev.select("line_id", "event_id", "ts", "us", "event_type", "k")
    chunked = assign_chunks(base, ["line_id"], "us", c)
    linked = with_previous(chunked, ["line_id"], ["us", "event_id"], {"us": "next_us"}, forward=True)
    return linked.select(
        "line_id",
        F.col("ts").cast("timestamp_ntz").alias("start_ts"),
        to_ts(F.col("next_us")).alias("end_ts"),
        as_flag(flag).alias("running"),
        _faults().alias("faults"),
        F.when(F.col("event_type") == "signup", F.lit("Manual")).otherwise(F.lit("Auto")).alias("stop_type"),
        F.col("event_id").alias("start_id"),
    )


def _fof_changes(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type").isin("error", "signup") & (F.col("event_id") % 2 == 0)).select(
        "line_id", F.col("event_id").alias("ndx"), _pick(ALARMS, F.col("k") % 8).alias("alarm_text"),
        F.col("ts").cast("timestamp_ntz").alias("t_stamp"),
    )


def _ppm(ev: DataFrame) -> DataFrame:
    return ev.select(
        "line_id",
        (F.col("ts").cast("timestamp_ntz") + F.expr("interval 37 seconds")).alias("t_stamp"),
        F.col("value").alias("output_ppm"),
    )


def _output_stats(ev: DataFrame, c: Chunking) -> DataFrame:
    parts = (F.floor("value") * PARTS_FACTOR).cast("long")
    base = ev.filter(F.col("event_type") == "purchase").select(
        "line_id", "event_id", "us", "k", parts.alias("parts"), bucket_no(F.col("us"), EPOCH).alias("epoch")
    )
    chunked = assign_chunks(base, ["line_id"], "us", c)
    summed = with_running_sums(
        chunked, ["line_id"], ["us", "event_id"],
        {"total": F.col("parts"), "bad": F.when(F.col("k") < 10, F.col("parts")).otherwise(F.lit(0))},
        scope="epoch",
    )
    good = (
        F.when(F.col("k") == 99, F.col("total") + 5)
        .when(F.col("k") == 77, F.lit(None))
        .otherwise(F.col("total") - F.col("bad"))
    )
    return summed.select(
        "line_id", F.col("event_id").alias("row_id"), to_ts(F.col("us")).alias("t_stamp"),
        F.col("total").alias("counter_total"), good.alias("counter_good"),
    )


def _machine_state(ev: DataFrame) -> DataFrame:
    halted = (F.col("event_type") == "error") & (F.col("k") < 50)
    ts = F.col("ts").cast("timestamp_ntz")
    return ev.select(
        "line_id",
        F.when(halted, ts + F.expr("interval 5 seconds")).otherwise(ts).alias("t_stamp"),
        F.when(halted, F.lit("Halted")).otherwise(F.lit("Execute")).alias("state_text"),
    )


# station, number of lanes, digit used by lane i for its count, row number of the first lane
_STATIONS = {
    "hydration_counters": (
        ("Stn080_Foam dosing_1_12_", 10, 0), ("Stn012_Camera align cap rear_1_7_", 10, 1),
        ("Stn031_Camera align cap front_1_9_", 10, 2),
    ),
    "foil_counters": (("Foil St_041 Vision system printing_", 5, 3),),
}


def _station_counters(ev: DataFrame, c: Chunking, logical: str) -> DataFrame:
    base = ev.filter(F.col("event_type") == "purchase").select(
        "line_id", "event_id", "us", "k", bucket_no(F.col("us"), EPOCH).alias("epoch")
    )
    chunked = assign_chunks(base, ["line_id"], "us", c)
    rejects = with_running_sums(
        chunked, ["line_id"], ["us", "event_id"],
        {f"r{d}": (F.col("k") % 5 == d).cast("long") for d in range(5)}, scope="epoch",
    )
    numbered = with_running_sums(
        rejects, ["line_id"], ["us", "event_id"], {"block_id": F.lit(1).cast("long")}
    )
    digits = F.array(*[F.col(f"r{d}") for d in range(5)])
    k, lanes, row = F.col("k"), [], 0
    for prefix, n, kind in _STATIONS[logical]:
        for i in range(1, n + 1):
            own = F.get(digits, F.lit((i + kind) % 5))
            if kind == 1:
                count = F.when((k == 50) & F.lit(i == 3), F.lit(None)).otherwise(own)
            elif kind == 2:
                count = own if i % 2 == 0 else F.lit(0).cast("long")
            elif kind == 3:
                both = F.get(digits, F.lit(i % 5)) + own
                count = F.when((k == 50) & F.lit(i == 3), F.lit(None)).otherwise(both)
            else:
                count = own
            lanes.append(F.struct(
                F.lit(row).cast("long").alias("row"), F.lit(f"{prefix}{i}").alias("name"),
                count.cast("long").alias("cnt"),
            ))
            row += 1
    return numbered.select(
        "line_id", "block_id", to_ts(F.col("us")).alias("t_stamp"),
        F.explode(F.array(*lanes)).alias("lane"),
    ).select(
        "line_id", (F.col("block_id") * 100 + F.col("lane.row")).alias("row_id"), "block_id",
        "t_stamp", F.col("lane.name").alias("name"), F.col("lane.cnt").alias("cnt"),
    )


def _downtime_overlays(ev: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp_ntz")
    return ev.filter(F.col("event_type") == "signup").select(
        "line_id",
        F.when(F.col("k") >= 90, ts + F.expr("interval 36500 days")).otherwise(ts).alias("start_ts"),
    )


def tables(
    events: DataFrame, lines: Sequence[LineProfile], c: Chunking
) -> Callable[[str], DataFrame]:
    ev = _events(events, lines)
    makers = {
        "status_blocks": lambda: _status_blocks(ev, c),
        "fof_changes": lambda: _fof_changes(ev),
        "ppm": lambda: _ppm(ev),
        "output_stats": lambda: _output_stats(ev, c),
        "machine_state": lambda: _machine_state(ev),
        "hydration_counters": lambda: _station_counters(ev, c, "hydration_counters"),
        "foil_counters": lambda: _station_counters(ev, c, "foil_counters"),
        "downtime_overlays": lambda: _downtime_overlays(ev),
    }

    def table(logical: str) -> DataFrame:
        if logical not in makers:
            raise KeyError(f"table {logical!r} cannot be derived from events")
        return makers[logical]()

    return table

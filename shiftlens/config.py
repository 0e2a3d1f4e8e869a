"""Declarative line profiles: tables, columns, thresholds, segments, clusters and SPC panels.

Nothing about a line is hard-coded in the operators; a new line is a new ``LineProfile``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  They must equal the published rules for right results.
# ---------------------------------------------------------------------------

# Logical -> physical column names of the historian tables.
DEFAULT_COLUMNS: Mapping[str, str] = {
    "start_ts": "Start_TS",
    "end_ts": "End_TS",
    "running_status": "RunningStatus",
    "faults": "Faults",
    "stop_type": "StopType",
    "start_id": "StartID",
    "alarm_text": "ActualAlarmText",
    "output_ppm": "Output_PPM",
    "counter_total": "Counter_Total",
    "counter_good": "Counter_Good",
    "t_stamp": "t_stamp",
}

MICRO_STOP_MIN = 2  # a stop shorter than this is a micro-stop (minutes)
DEFAULT_IDEAL_PPM = 100.0  # ideal speed when there is no sample
SHIFTS_PER_WEEK = 14
ANOMALY_BASELINE_SHIFTS = 13
ANOMALY_PRIOR_WEEKS = 4
ANOMALY_Z = 1.8
ANOMALY_MIN_SHARE = 0.05
ANOMALY_STD_FLOOR = 0.01
TREND_SHIFTS = 4
TOP_STOPS = 5

SPC_LOOKBACK_DAYS = 75
SPC_MIN_INSPECTED = 100
SPC_BASELINE_BUCKETS = 100
LAST_BATCH_GAP_HOURS = 12
SPC_D2 = 1.128  # moving-range constant for pairs
SPC_SIGMA_FLOOR = 0.01
EWMA_LAMBDA = 0.2
EWMA_L = 2.7
EWMA_WINDOW = 30
EWMA_STD_FLOOR = 0.01
MIDDAY_HOUR = 13  # a counter reset before this hour ends the night shift

SNAPSHOT_MINUTES = 15
SNAPSHOT_RETENTION_DAYS = 3

MIN_RUN_HOURS = 2.0
MIN_PARTS = 5000
FULL_DAY_HOURS = 22.0

NO_ALARM = "No Alarm Text"
UNATTRIBUTED = "Unattributed"
MANUAL = "manual"
NO_SEGMENT = "unattributed"

# category key, display label, colour; display order
CATEGORIES = (
    ("micro_stops", "Micro-stops (<2 min)", "#2d3436"),
    ("halted", "Halted (operator wait)", "#636e72"),
    ("auto_long", "Auto-stops (>2 min)", "#b2bec3"),
    ("manual", "Manual stops", "#dfe6e9"),
)
RUNNING_COLOR = "#c7c0e8"
DEFAULT_COLOR = "#b2bec3"
ANOMALY_DEFAULT_COLOR = "#636e72"
OOC_COLOR = "#e17055"
IN_CONTROL_COLOR = "#ffffff"


@dataclass(frozen=True)
class Segment:
    """A named part of a line: how labels are assigned to it and its cause clusters."""

    key: str
    label: str
    color: str
    code_range: tuple[int, int] | None = None
    keywords: str | None = None
    clusters: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Panel:
    """One SPC panel over a long-format counter table."""

    key: str
    short: str
    title: str
    table: str
    patterns: tuple[str, ...]  # one station pattern, or two stations that are summed per lane
    n_lanes: int
    divisor: int
    lane_mode: str  # name_template | discovered_sorted | synthetic
    name_template: str | None = None
    representative: str | None = None  # lane used for reset detection; None = lowest row_id
    min_resets: int = 10
    min_subgroups: int = 10
    active_only: bool = False

    @property
    def dual(self) -> bool:
        return len(self.patterns) > 1


@dataclass(frozen=True)
class LineProfile:
    line_id: str
    label: str
    segments: tuple[Segment, ...]
    tables: Mapping[str, str] = field(default_factory=dict)
    shared_tables: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=lambda: DEFAULT_COLUMNS)
    reason_key: str = "ndx"
    state_column: str = "state_text"
    halted_states: tuple[str, ...] = ("Halted",)
    excluded_days: tuple[str, ...] = ()
    availability: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    bounds: tuple[int, int] = (7, 19)
    micro_stop_min: float = MICRO_STOP_MIN
    min_run_hours: float = MIN_RUN_HOURS
    min_parts: int = MIN_PARTS
    full_day_hours: float = FULL_DAY_HOURS
    panels: tuple[Panel, ...] = ()

    def physical_table(self, logical: str) -> str:
        """Physical name of a logical table, qualified when it lives in a shared database."""
        if logical not in self.tables:
            raise KeyError(f"table {logical!r} is not configured for line {self.line_id}")
        name = self.tables[logical]
        shared = self.shared_tables.get(logical)
        return f"{shared}.{name}" if shared else name

    def has_table(self, logical: str) -> bool:
        return logical in self.tables

    def column(self, logical: str) -> str:
        """Physical column name; an undeclared key is its own name."""
        return self.columns.get(logical, logical)


# Segment and cluster rules in matching order, SPC panels and tables of the built-in
# lines.  Results must match the published ones.  Patterns are case-insensitive.
_MANUAL = Segment("manual", "Manual", "#636e72")
_OTHER = Segment("unattributed", "Other", "#b2bec3")

SEGMENTS_A = (
    Segment(
        "hydration", "Hydration", "#e76f51", (0, 2000),
        r"catheter|gripper|PMK|hydration|cover holder|\bfoam\b|\bdosing\b|nozzle|stn080|inject\s*pressure",
        (
            ("Gripper", r"gripper|funnel"),
            ("Catheter Reject", r"catheter|rejected"),
            ("Foam", r"\bfoam\b|\bdosing\b|nozzle|stn080|inject\s*pressure"),
            ("PMK / Media", r"\bPMK\b|empty.*mode"),
            ("Timing", r"takes longer|maximum allowed|\bMSM\b"),
            ("Cover", r"cover holder"),
            ("Cap", r"\bcap\b"),
            ("Limit Switch", r"limit switch"),
        ),
    ),
    Segment(
        "foil", "Foil", "#e9c46a", (2000, 3000),
        r"printer|labeler|pouch|edge\s*trim|sealing|foil",
        (
            ("Printer", r"printer"),
            ("Labeler", r"labeler"),
            ("Edge Trim", r"edge\s*trim|trim broken"),
            ("Scanner", r"laser scanner|scanner"),
            ("Positioning", r"position|product not in"),
            ("Sealing Lane", r"sealing\s*lane"),
            ("Detection Fault", r"detection\s*fault|reject\s*fault"),
        ),
    ),
    Segment(
        "schubert", "Schubert", "#2a9d8f", (3000, 9999),
        r"schubert|frame [a-z]|closing area",
        (
            ("Line Stop / Wait", r"waiting|line stop|downstream"),
            ("Frame", r"frame"),
            ("Closing", r"closing"),
        ),
    ),
    _MANUAL,
    _OTHER,
)

SEGMENTS_B = (
    Segment(
        "web", "Web / Reel", "#3B82F6", None,
        r"reel|web torn|splice|all rolls empty|vacuum splice",
        (
            ("End of Reel", r"end of reel|prewarning.*reel|all rolls empty"),
            ("Web Torn", r"web torn"),
            ("Splice", r"splice|splice module|last splice"),
        ),
    ),
    Segment(
        "sealing", "Sealing", "#F59E0B", None,
        r"sealing head|temperature|knife|hot printer|current limit",
        (
            ("Sealing Head", r"sealing head|current limit"),
            ("Temperature", r"temperature"),
            ("Knife", r"knife"),
            ("Printer", r"hot printer"),
        ),
    ),
    Segment(
        "handling", "Handling", "#8B5CF6", None,
        r"gripper|fork|pickup position|push.?out piston|parallel gripper|cylinder switch",
        (
            ("Gripper", r"gripper|pickup position|parallel gripper"),
            ("Fork", r"fork"),
            ("Piston", r"push.?out piston"),
            ("Cylinder", r"cylinder switch"),
        ),
    ),
    Segment(
        "pneumatic", "Pneumatic", "#10B981", None,
        r"valve|air valve|flow monitor|cooling",
        (
            ("Air Pressure", r"air valve"),
            ("Valve on Web", r"valve.*web|valve.*inserted|valve.*area"),
            ("Cooling", r"cooling|flow monitor"),
        ),
    ),
    _MANUAL,
    _OTHER,
)

PANELS_A = (
    Panel(
        "nozzle_spc", "Nozzle", "Nozzle Reject SPC", "hydration_counters",
        ("Stn080_Foam dosing_1_12_%",), 10, 10, "name_template", "Stn080_Foam dosing_1_12_{i}",
    ),
    Panel(
        "camera_spc", "Camera", "Camera Reject SPC (Cap Orientation)", "hydration_counters",
        ("Stn012_Camera align cap rear_1_7_%", "Stn031_Camera align cap front_1_9_%"), 10, 10,
        "synthetic", representative="Stn012_Camera align cap rear_1_7_2",
        min_resets=5, min_subgroups=5, active_only=True,
    ),
    Panel(
        "vision_spc", "Vision", "Vision System SPC (Stn 041 Print Inspection)", "foil_counters",
        ("%St_041 Vision system printing%",), 5, 5, "discovered_sorted",
    ),
)

# The tables that an ingest run copies per line, as (group, table, time column).  XML
# payload tables keep their payload as an opaque string and start from a fixed mark when empty.
INGEST_PLAN = {
    "line_a": (
        ("core", "status_blocks", "Start_TS"), ("core", "downtime_overlays", "Start_TS"),
        ("core", "fof_changes", "t_stamp"), ("core", "fof_changes_alt", "t_stamp"),
        ("core", "live_oee", "t_stamp"), ("core", "machine_state", "t_stamp"),
        ("core", "output_stats", "t_stamp"), ("core", "ppm", "t_stamp"),
        ("hydration", "alarm_stack", "t_stamp"), ("hydration", "buttons", "t_stamp"),
        ("hydration", "operator_stop_events", "t_stamp"), ("hydration", "resets", "t_stamp"),
        ("hydration", "station_reject_summary", "t_stamp"), ("hydration", "format", "t_stamp"),
        ("hydration", "hydration_counters", "t_stamp"), ("foil", "foil_counters", "t_stamp"),
        ("foam", "foam_current_product", "t_stamp"), ("foam", "foam_function_state", "t_stamp"),
        ("foam", "foam_machine_state", "t_stamp"), ("foam", "foam_message_text", "t_stamp"),
        ("foam", "foam_air_flow", "t_stamp"), ("foam", "foam_air_pressure", "t_stamp"),
        ("foam", "foam_nozzle_time", "t_stamp"), ("foam", "foam_solution_flow", "t_stamp"),
        ("schubert", "schubert_product", "t_stamp"), ("schubert", "schubert_alarms", "t_stamp"),
        ("schubert", "schubert_mode", "t_stamp"), ("schubert", "schubert_state", "t_stamp"),
    ),
    "line_b": (
        ("core", "status_blocks", "Start_TS"), ("core", "downtime_overlays", "Start_TS"),
        ("core", "fof_changes", "t_stamp"), ("core", "live_oee", "t_stamp"),
        ("core", "machine_state", "t_stamp"), ("core", "output_stats", "t_stamp"),
        ("core", "ppm", "t_stamp"), ("quality", "op_marked_defects", "t_stamp"),
        ("quality", "operator_actions", "t_stamp"), ("quality", "station_cycle", "t_stamp"),
        ("quality", "batch_report", "t_stamp"),
    ),
}
# High-water mark of an empty target, for the tables that have one.
EMPTY_MARKS = {
    "station_reject_summary": "1900-01-01 00:00:00",
    "station_cycle": "2000-01-01 00:00:00",
    "batch_report": "2000-01-01 00:00:00",
}

_CORE_TABLES = (
    "status_blocks", "downtime_overlays", "fof_changes", "live_oee", "machine_state",
    "output_stats", "ppm", "order_management", "stop_reasons", "stop_reasons_expanded",
)


def _copied(line: str, *others: str) -> dict[str, str]:
    """Tables of a line: the core ones, those that its ingest copies, and ``others``."""
    return {t: t for t in (*_CORE_TABLES, *(table for _, table, _ in INGEST_PLAN[line]), *others)}


_LOOKUPS = {"order_management": "master", "stop_reasons": "master", "stop_reasons_expanded": "master"}

# The two built-in profiles.  Their tables are named by logical key; a deployment passes its own
# mapping with dataclasses.replace(profile, tables={...}).
LINE_A = LineProfile(
    "line_a", "Line A", SEGMENTS_A,
    tables=_copied("line_a"),
    shared_tables=_LOOKUPS,
    halted_states=("Halted",),
    excluded_days=("2024-01-14", "2024-01-25"),
    availability={"hydration": {"from": "2024-01-05"}, "foam": {"from": "2024-01-17"}},
    panels=PANELS_A,
)
LINE_B = LineProfile(
    "line_b", "Line B", SEGMENTS_B,
    tables=_copied("line_b", "pouch_counters"),
    shared_tables=_LOOKUPS,
    halted_states=("Halted", "HaltConditionReached"),
    availability={"op_marked_defects": {"to": "2024-01-12"}},
)
DEFAULT_LINES = (LINE_A, LINE_B)

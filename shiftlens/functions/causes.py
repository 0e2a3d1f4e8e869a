"""Fault text -> reason codes, label, segment, cluster, as column expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftlens.config import MANUAL, NO_ALARM, NO_SEGMENT, UNATTRIBUTED, LineProfile

# Fixed patterns of the fault text.
FC_PATTERN = r"FC=@?((?:Fault|Alarm|Warning)_(?:PLC1_)?\d+)@?\s*(?:\(([^)]*)\))?"
RC_PATTERN = r"RC=(\d+)"
FC_PREFIXES = ("Fault", "Alarm", "Warning")


def reason_codes(faults: Column) -> Column:
    """All reason codes of a fault text, in order; empty for NULL, '' and 'x'."""
    found = F.regexp_extract_all(faults, F.lit(RC_PATTERN), 1)
    codes = F.filter(F.transform(found, lambda c: c.try_cast("bigint")), lambda c: c.isNotNull())
    return F.when(faults.isNull() | (faults == "x"), F.array().cast("array<bigint>")).otherwise(codes)


def fault_entries(faults: Column) -> Column:
    """All fault entries as array<struct<fault_id, description>>; no description is ''."""
    ids = F.regexp_extract_all(faults, F.lit(FC_PATTERN), 1)
    texts = F.regexp_extract_all(faults, F.lit(FC_PATTERN), 2)
    entries = F.arrays_zip(ids.alias("fault_id"), texts.alias("description"))
    empty = F.array().cast("array<struct<fault_id:string,description:string>>")
    return F.when(faults.isNull() | (faults == "x"), empty).otherwise(
        entries.cast("array<struct<fault_id:string,description:string>>")
    )


def code_variants(code: Column) -> Column:
    """Fault ids that can encode a reason code, in matching order."""
    text = code.cast("string")
    padded = F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)
    spelled = []
    for prefix in FC_PREFIXES:
        spelled += [
            F.concat(F.lit(f"{prefix}_"), padded),
            F.concat(F.lit(f"{prefix}_"), text),
            F.concat(F.lit(f"{prefix}_PLC1_"), text),
        ]
    return F.array(*spelled)


def code_description(code: Column, entries: Column) -> Column:
    """Description of a reason code: first variant, then first entry that has one."""
    described = F.filter(entries, lambda e: e["description"] != "")
    hits = F.flatten(
        F.transform(code_variants(code), lambda v: F.filter(described, lambda e: e["fault_id"] == v))
    )
    return F.when(F.size(entries) > 0, F.get(hits, F.lit(0))["description"])


def display_label(codes: Column, entries: Column, alarm: Column, described: Column) -> Column:
    """Code description, else 'RC=n', else first entry, else alarm text, else 'Unattributed'.

    ``described`` is the description of the first code (or a dictionary's).
    """
    code = F.get(codes, F.lit(0))
    first = F.get(entries, F.lit(0))
    return (
        F.when(F.size(codes) > 0, F.coalesce(described, F.concat(F.lit("RC="), code.cast("string"))))
        .when(
            F.size(entries) > 0,
            F.when(first["description"] != "", first["description"]).otherwise(first["fault_id"]),
        )
        .when(alarm.isNotNull() & ~alarm.isin("", NO_ALARM), alarm)
        .otherwise(F.lit(UNATTRIBUTED))
    )


def _matches(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?i){pattern}")


def alarm_number(label: Column) -> Column:
    """Leading number of a label; a single digit stands for its thousands."""
    number = F.regexp_extract(label, r"^(\d+)", 1).try_cast("bigint")
    return number * F.when(F.length(F.ltrim(number.cast("string"))) == 1, 1000).otherwise(1)


def segment_of_label(label: Column, number: Column, profile: LineProfile) -> Column:
    """Leading alarm number in a code range, else first keyword match, else unattributed.

    ``number`` is alarm_number(label) as a column of its own, so that it is computed once.
    """
    chain = F.when(label.isNull() | label.isin("", UNATTRIBUTED), F.lit(NO_SEGMENT))
    for seg in profile.segments:
        if seg.code_range:
            lo, hi = seg.code_range
            chain = chain.when((number >= lo) & (number < hi), F.lit(seg.key))
    for seg in profile.segments:
        if seg.keywords:
            chain = chain.when(_matches(label, seg.keywords), F.lit(seg.key))
    return chain.otherwise(F.lit(NO_SEGMENT))


def segment_of_texts(texts: Column, profile: LineProfile) -> Column:
    """Segment of the first text that has one (texts: descriptions of the secondary codes)."""
    found = F.transform(
        F.transform(texts, lambda t: F.struct(t.alias("text"), alarm_number(t).alias("number"))),
        lambda x: segment_of_label(x["text"], x["number"], profile),
    )
    return F.get(F.filter(found, lambda s: s != NO_SEGMENT), F.lit(0))


def segment_of_stop(primary: Column, secondary: Column, stop_type: Column) -> Column:
    """Manual wins; then the label's segment; then that of the secondary codes."""
    return (
        F.when(F.lower(stop_type) == MANUAL, F.lit(MANUAL))
        .when(primary != NO_SEGMENT, primary)
        .otherwise(F.coalesce(secondary, F.lit(NO_SEGMENT)))
    )


def cluster_of(label: Column, segment: Column, profile: LineProfile) -> Column:
    """First matching cluster pattern of the segment, else 'Other'; NULL outside real segments."""
    chain = F.when(segment.isin(MANUAL, NO_SEGMENT, "running"), F.lit(None).cast("string"))
    chain = chain.when(label.isin("", UNATTRIBUTED), F.lit("Other"))
    for seg in profile.segments:
        for name, pattern in seg.clusters:
            chain = chain.when((segment == seg.key) & _matches(label, pattern), F.lit(name))
    return chain.otherwise(F.lit("Other"))


def per_line(profiles: Sequence[LineProfile], line: Column, make: Callable, by: Callable) -> Column:
    """Evaluate ``make(profile)`` for the profile of each row's line.

    Lines with the same rule (``by(profile)``) share one branch, so many lines stay a short chain.
    """
    rules: dict = {}
    for p in profiles:
        rules.setdefault(by(p), []).append(p)
    chain = None
    for members in rules.values():
        mine, value = line.isin(*[p.line_id for p in members]), make(members[0])
        chain = F.when(mine, value) if chain is None else chain.when(mine, value)
    return chain

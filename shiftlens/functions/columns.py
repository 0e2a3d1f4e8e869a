"""Column helpers: half-even rounding, shift arithmetic, calendar labels.

Inside the operators a time is a LONG of microseconds since the epoch (naive local time read as
UTC), so durations are exact integers and no result depends on summation order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 3600 * SECOND
DAY = 24 * HOUR

_SPLITTER = 134217729.0  # 2**27 + 1, splits a double into two halves


def round_even(col: Column, digits: int = 0) -> Column:
    """Round a double to ``digits`` decimals, ties judged on its exact binary value, to even.

    Spark's round/bround work on the shortest decimal text (2.675 -> 2.68); published numbers are
    rounded on the binary value (2.675 is below the tie -> 2.67).  The product with 10**n is
    taken together with its rounding error, so the tie test is exact.
    """
    x = col.cast("double")
    scale = float(10**digits)
    product = x * F.lit(scale)
    big = x * F.lit(_SPLITTER)
    high = big - (big - x)
    error = (high * F.lit(scale) - product) + (x - high) * F.lit(scale)
    low = F.floor(product).cast("double")
    side = (product - low - F.lit(0.5)) + error
    nearest = (
        F.when(side > 0, low + 1.0).when(side < 0, low).otherwise(low + F.pmod(low, F.lit(2.0)))
    )
    return nearest / F.lit(scale)


def floor_to(us: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``us``."""
    return us - F.pmod(us, F.lit(width))


def bucket_no(us: Column, width: int) -> Column:
    return F.floor(us / F.lit(width)).cast("long")


def to_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def to_ts(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def ts_text(us: Column) -> Column:
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss")


def date_of(us: Column) -> Column:
    return F.date_from_unix_date(bucket_no(us, DAY).cast("int"))


def as_flag(col: Column) -> Column:
    """Running flag from 1/0, true/false or their text forms in any case."""
    return F.lower(col.cast("string")).isin("1", "true")


# -- shifts -----------------------------------------------------------------
# A shift is identified by its ordinal: 2 * (day number) for day, + 1 for night.


def shift_of(us: Column, bounds: tuple[int, int]) -> Column:
    """Ordinal of the shift that owns the instant (start inclusive, end exclusive)."""
    day_h, night_h = bounds
    shifted = us - F.lit(day_h * HOUR)
    night = F.pmod(shifted, F.lit(DAY)) >= F.lit((night_h - day_h) * HOUR)
    return 2 * bucket_no(shifted, DAY) + night.cast("long")


def shift_day(ordinal: Column) -> Column:
    return F.floor(ordinal / F.lit(2)).cast("long")


def is_night(ordinal: Column) -> Column:
    return F.pmod(ordinal, F.lit(2)) == 1


def shift_start(ordinal: Column, bounds: tuple[int, int]) -> Column:
    day_h, night_h = bounds
    hour = F.when(is_night(ordinal), F.lit(night_h)).otherwise(F.lit(day_h)).cast("long")
    return shift_day(ordinal) * F.lit(DAY) + hour * F.lit(HOUR)


def shift_end(ordinal: Column, bounds: tuple[int, int]) -> Column:
    return shift_start(ordinal + 1, bounds)


def shift_date(ordinal: Column) -> Column:
    return F.date_from_unix_date(shift_day(ordinal).cast("int"))


def shift_date_text(ordinal: Column) -> Column:
    return shift_date(ordinal).cast("string")


def shift_type(ordinal: Column) -> Column:
    return F.when(is_night(ordinal), F.lit("night")).otherwise(F.lit("day"))


def shift_label(ordinal: Column) -> Column:
    name = F.when(is_night(ordinal), F.lit("Night ")).otherwise(F.lit("Day "))
    return F.concat(name, F.date_format(shift_date(ordinal), "MM-dd"))


def full_shift_label(ordinal: Column, bounds: tuple[int, int]) -> Column:
    day_h, night_h = (f"{h:02d}:00" for h in bounds)
    return F.concat(
        F.when(is_night(ordinal), F.lit("Night")).otherwise(F.lit("Day")),
        F.lit(" Shift — "),
        shift_date_text(ordinal),
        F.when(is_night(ordinal), F.lit(f" ({night_h} – {day_h})")).otherwise(
            F.lit(f" ({day_h} – {night_h})")
        ),
    )


def shift_key(line: Column, ordinal: Column) -> Column:
    return F.concat(line, F.lit("|"), shift_date_text(ordinal), F.lit("|"), shift_type(ordinal))


def batch_end_label(us: Column, midday_hour: int) -> Column:
    """Label of the shift that a counter reset closes: before midday, the night before."""
    day = bucket_no(us, DAY)
    before = F.pmod(us, F.lit(DAY)) < F.lit(midday_hour * HOUR)
    owner = F.when(before, day - 1).otherwise(day).cast("int")
    name = F.when(before, F.lit("Night ")).otherwise(F.lit("Day "))
    return F.concat(name, F.date_format(F.date_from_unix_date(owner), "MM-dd"))


def near_transition(minute_of_day: Column, hours: Iterable[int], tolerance: int = 30) -> Column:
    """Within ``tolerance`` minutes of a boundary; distances do not wrap at midnight."""
    marks = F.array(*[F.lit(h * 60) for h in hours])
    return F.exists(marks, lambda m: F.abs(minute_of_day - m) <= tolerance)


def boundaries_between(t1: Column, t2: Column, bounds: tuple[int, int]) -> Column:
    """Array of shift boundaries strictly between two instants, in order."""
    first, last = shift_of(t1, bounds), shift_of(t2, bounds)
    starts = F.transform(
        F.when(last > first, F.sequence(first + 1, last)).otherwise(F.array().cast("array<bigint>")),
        lambda o: shift_start(o, bounds),
    )
    return F.filter(starts, lambda b: (b > t1) & (b < t2))


# -- calendar ---------------------------------------------------------------


def iso_week(date: Column) -> Column:
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), date).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(date).cast("string"), 2, "0"),
    )


def week_label(date: Column) -> Column:
    return F.concat(F.lit("Week of "), F.date_format(F.date_trunc("week", date), "MMM dd"))


def text1(col: Column) -> Column:
    """A double that was rounded to one decimal, as text with its decimal ('12.0')."""
    return F.format_string("%.1f", col)

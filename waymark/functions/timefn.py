"""Date and clock expressions (F1, F2, F5, F6, F8-F13), all built-in.

Clock arithmetic works on minutes since midnight, so an ``HH:mm:ss`` string
never needs a calendar date or a time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTES_PER_DAY = 24 * 60


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_of_iso(departure: str | Column) -> Column:
    """Last eight characters of an ISO date-time text: ``HH:mm:ss`` (F1)."""
    return F.substring(_col(departure), -8, 8)


def clock_of_ts(ts: str | Column) -> Column:
    """``HH:mm:ss`` of a timestamp (F1 for typed input)."""
    return F.date_format(_col(ts), "HH:mm:ss")


def clock_hour(clock: str | Column) -> Column:
    """Hour of an ``HH:mm:ss`` text; NULL if it is none (F2)."""
    return F.substring(_col(clock), 1, 2).try_cast("int")


def clock_minute(clock: str | Column) -> Column:
    """Minute of an ``HH:mm:ss`` text; NULL if it is none (F2)."""
    return F.substring(_col(clock), 4, 2).try_cast("int")


def _hh_mm_00(hours: Column, minutes: Column) -> Column:
    return F.when(hours.isNotNull() & minutes.isNotNull(), F.format_string("%02d:%02d:00", hours, minutes))


def departure_ts(date: str | Column, clock: str | Column) -> Column:
    """Timestamp of a date and an ``HH:mm:ss`` text; NULL unless both are there and valid."""
    text = F.concat(_col(date).cast("string"), F.lit(" "), _col(clock))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def arrival_clock(clock: str | Column, minutes: str | Column) -> Column:
    """Departure clock + duration, wrapped at midnight, seconds ``00``."""
    total = F.pmod(clock_hour(clock) * 60 + clock_minute(clock) + _col(minutes).cast("bigint"),
                   F.lit(MINUTES_PER_DAY))
    return _hh_mm_00((total / 60).cast("int"), (total % 60).cast("int"))


def arrival_clock_compat(clock: str | Column, minutes: str | Column) -> Column:
    """The original carry rule (quirk Q1), kept for compatibility.

    The minute remainder is added to the departure minute, then a carry hour is
    added when *that sum plus the remainder again* exceeds 60.
    """
    dur = _col(minutes).cast("bigint")
    rem = F.pmod(dur, F.lit(60))
    hours = clock_hour(clock) + (dur / 60).cast("bigint")  # truncates, like int()
    mins = clock_minute(clock) + rem
    carry = F.when(mins + rem > 60, F.lit(1)).otherwise(F.lit(0))
    return _hh_mm_00(F.pmod(hours + carry, F.lit(24)).cast("int"), F.pmod(mins, F.lit(60)).cast("int"))


def minutes_to_hours(minutes: str | Column) -> Column:
    """Duration in hours (F8)."""
    return _col(minutes) / F.lit(60.0)


def add_minutes(ts: str | Column, minutes: str | Column) -> Column:
    """Full arrival timestamp: departure timestamp + duration."""
    return F.timestamp_add("MINUTE", _col(minutes), _col(ts))


def as_date(d: str | _dt.date | Column) -> Column:
    """A date literal / column."""
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.date):
        d = d.isoformat()
    return F.to_date(F.lit(d))


def date_bounds(dtype: T.DataType, start: str | _dt.date | Column, days: int) -> tuple[Column, Column]:
    """Half-open ``[start, start + days)`` as literals of the column's type (foldable → pushed down)."""
    lo = as_date(start)
    hi = F.date_add(lo, days)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return lo.cast(dtype), hi.cast(dtype)
    return lo, hi


def day_sequence(start: str | _dt.date | Column, n_days: int, offset: int = 0) -> Column:
    """Array of ``n_days`` consecutive dates from ``start + offset``."""
    first = F.date_add(as_date(start), offset)
    return F.sequence(first, F.date_add(first, n_days - 1), F.expr("INTERVAL 1 DAY"))


def to_iso_date_text(d: str | Column) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def today() -> Column:
    """Today's date, for the edge of a scheduled run only (F11); operators take the date as a parameter."""
    return F.current_date()

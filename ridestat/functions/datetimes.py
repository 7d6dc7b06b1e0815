"""Trip datetime parsing, validity checks, duration and calendar columns.

All values are TIMESTAMP_NTZ, so nothing depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import (
    DAY_RE,
    HOUR_RE,
    MINUTE_RE,
    MONTH_RE,
    SECOND_RE,
    TIMESTAMP_MAX,
    TIMESTAMP_MIN,
    TWO_DIGIT_YEAR_PIVOT,
    WEEKDAY_NAMES,
    WEEKEND_DAYS,
    YEAR2_RE,
    YEAR4_RE,
)
from .text import try_cast, as_text, col_of, py_strip

_DAY, _MONTH = rf"(?:{DAY_RE})", rf"(?:{MONTH_RE})"
_TIME = rf"(?:{HOUR_RE}):(?:{MINUTE_RE}):(?:{SECOND_RE})"

# Whole-text matches (\z: no trailing newline allowed); a space in a strptime format accepts
# any run of whitespace. Once a text matches, its numbers are simply the runs of digits.
DATETIME4_RE = rf"^{_DAY}/{_MONTH}/{YEAR4_RE}\s+{_TIME}\z"
DATETIME_RE = rf"^{_DAY}/{_MONTH}/(?:{YEAR4_RE}|{YEAR2_RE})\s+{_TIME}\z"
DATE4_RE = rf"^{_DAY}/{_MONTH}/{YEAR4_RE}\z"
TIME_RE = rf"^{_TIME}\z"


def _in_range(ts: Column) -> Column:
    lo = F.lit(TIMESTAMP_MIN).cast("timestamp_ntz")
    hi = F.lit(TIMESTAMP_MAX).cast("timestamp_ntz")
    return F.when(ts.between(lo, hi), ts)


def _numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[0-9]+"), 0)


def _num(parts: Column, i: int) -> Column:
    return try_cast(F.get(parts, F.lit(i - 1)), "int")  # a text with fewer digit runs has a null part


def datetime_parts(text: str | Column, two_digit_years: bool = True) -> Column:
    """Digit runs [d, m, y, H, M, S] of a text that has the trip datetime format, else null."""
    t = col_of(text)
    return F.when(t.rlike(DATETIME_RE if two_digit_years else DATETIME4_RE), _numbers(t))


def timestamp_from_parts(parts: str | Column) -> Column:
    """Timestamp from :func:`datetime_parts`; a two-digit year pivots at 69 (69..99 -> 19xx)."""
    p = col_of(parts)
    y = _num(p, 3)
    year = F.when(F.length(F.get(p, F.lit(2))) == 4, y).when(y < TWO_DIGIT_YEAR_PIVOT, y + 2000).otherwise(y + 1900)
    # seconds are added, not set: 60 and 61 (accepted by the field pattern) roll forward
    minute = F.try_make_timestamp_ntz(year, _num(p, 2), _num(p, 1), _num(p, 4), _num(p, 5), F.lit(0))
    return _in_range(F.timestamp_add("SECOND", _num(p, 6), minute))


def with_parsed_datetime(df, text_col: str, out_col: str, two_digit_years: bool = True):
    """DataFrame step: ``out_col`` = parsed ``text_col``, with the digit array in its own
    projection so the regex runs once per row (the optimizer keeps a non-trivial column that
    is read several times in its own projection)."""
    tmp = f"__parts_{out_col}"
    return (
        df.withColumn(tmp, datetime_parts(text_col, two_digit_years))
        .withColumn(out_col, timestamp_from_parts(tmp))
        .drop(tmp)
    )


def datetime_text(date_col: str | Column, time_col: str | Column) -> Column:
    """``strip(date) + ' ' + strip(time)`` with missing values rendered as ``nan``."""
    return F.concat(as_text(py_strip(date_col)), F.lit(" "), as_text(py_strip(time_col)))


def parse_trip_datetime(
    date_col: str | Column, time_col: str | Column, two_digit_years: bool = True
) -> Column:
    """``dd/mm/YYYY HH:MM:SS``, then (only where that failed) ``dd/mm/yy HH:MM:SS``; else null.

    With ``two_digit_years=False`` this is the strict triage parse (four-digit years only).
    Seconds 60 and 61 roll into the next minute; impossible dates (31/02) are null.
    """
    # A text with a four-digit year never matches the two-digit form, so "four digits, else two
    # digits" is one pattern with both year forms.
    text = datetime_text(date_col, time_col)
    return timestamp_from_parts(datetime_parts(text, two_digit_years))


def valid_date_only(c: str | Column) -> Column:
    """True when the raw (unstripped) text is a ``dd/mm/YYYY`` date; null is invalid."""
    text = col_of(c)
    p = _numbers(text)
    ts = F.try_make_timestamp_ntz(_num(p, 3), _num(p, 2), _num(p, 1), F.lit(0), F.lit(0), F.lit(0))
    return F.coalesce(text.rlike(DATE4_RE) & _in_range(ts).isNotNull(), F.lit(False))


def valid_time_only(c: str | Column) -> Column:
    """True when the raw (unstripped) text is an ``HH:MM:SS`` time; null is invalid."""
    text = col_of(c)
    p = _numbers(text)
    ts = F.try_make_timestamp_ntz(F.lit(1900), F.lit(1), F.lit(1), _num(p, 1), _num(p, 2), F.lit(0))
    return F.coalesce(text.rlike(TIME_RE) & ts.isNotNull(), F.lit(False))


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes as double; null if either is null; may be negative."""
    micros = F.timestamp_diff("MICROSECOND", col_of(start), col_of(end))
    return micros.cast("double") / F.lit(60_000_000.0)


def weekday(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(ts))


def is_weekend(weekday_col: str | Column) -> Column:
    """Weekday 5 or 6; a null weekday is *not* a weekend (never null)."""
    return F.coalesce(col_of(weekday_col).isin(WEEKEND_DAYS), F.lit(False))


def weekday_name(weekday_col: str | Column) -> Column:
    c = col_of(weekday_col)
    out = None
    for i, name in enumerate(WEEKDAY_NAMES):
        out = (F.when(c == i, F.lit(name)) if out is None else out.when(c == i, F.lit(name)))
    return out


def truncate_to_second(ts: str | Column) -> Column:
    """Drop sub-second digits of a TIMESTAMP_NTZ without passing through a time zone."""
    t = col_of(ts)
    midnight = F.to_date(t).cast("timestamp_ntz")
    frac = F.timestamp_diff("MICROSECOND", midnight, t) % F.lit(1_000_000)
    return F.timestamp_add("MICROSECOND", -frac, t)


# ---- exact duration statistics -------------------------------------------------------------
# Trip datetimes have whole-second resolution, so every duration is an integer number of
# seconds. Aggregating those integers and dividing once gives the exact mean / median as the
# correctly rounded double: independent of summation order, partitioning and engine.


def duration_seconds(minutes: str | Column = "duration_minutes") -> Column:
    return F.round(col_of(minutes) * F.lit(60.0)).cast("bigint")


def avg_minutes(minutes: str | Column = "duration_minutes") -> Column:
    """Mean duration in minutes: sum of whole seconds / (count * 60)."""
    sec = duration_seconds(minutes)
    return F.sum(sec).cast("double") / (F.count(sec) * F.lit(60)).cast("double")


def median_minutes(minutes: str | Column = "duration_minutes") -> Column:
    """Exact (interpolated) median duration in minutes, taken over whole seconds."""
    return F.median(duration_seconds(minutes)) / F.lit(60.0)


def percentile_minutes(minutes: str | Column, p: float) -> Column:
    """Exact interpolated percentile in minutes, taken over whole seconds."""
    return F.percentile(duration_seconds(minutes), F.lit(p)) / F.lit(60.0)

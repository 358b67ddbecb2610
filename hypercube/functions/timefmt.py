"""Simulator time texts and schedule switch times.

The simulator prints hourly stamps as ``MM/DD  HH:MM:SS`` with hours 01..24,
no year, and arbitrary runs of blanks.  Hour 24 means midnight of the next
day.  All helpers are built-in expressions (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypercube.functions._cols import col

# Fixed values of the study (must equal the reference):
# base year of parsed simulator stamps, the heating-schedule anchors
# (early morning 10, evening stop 22), and the shading centre hour 14:00.
BASE_YEAR = 2001
EARLY_MORNING_HOUR = 10
EVENING_STOP_HOUR = 22
SHADING_CENTRE_HOUR = 14.0

_WHITESPACE = " \t\n\r\f\u000b"
# date, blanks, time: the parts of a stamp and what stands between them
STAMP_PATTERN = r"^\d+/\d+\s+\d+:\d+:\d+$"


def hour24_timestamp(raw, base_year: int = BASE_YEAR) -> Column:
    """Parse a simulator stamp to TIMESTAMP_NTZ; hour 24 rolls to the next day.

    One split on ``/``, ``:`` and blanks gives month, day, hour, minute,
    second.  NULL and blank text give NULL; any other text that is no date
    with a time of hours 0 to 24 raises an error.
    """
    text = F.btrim(col(raw), F.lit(_WHITESPACE))
    parts = F.split(text, r"[/:\s]+")

    def part(i: int) -> Column:
        return F.element_at(parts, i).try_cast("int")

    month, day, hour, minute, second = (part(i) for i in range(1, 6))
    # midnight of the date (NULL for an impossible date), plus the clock time
    # as a day-time interval, so hour 24 lands on the next day
    midnight = F.try_make_timestamp_ntz(F.lit(base_year), month, day, F.lit(0), F.lit(0), F.lit(0))
    valid = (F.coalesce(F.size(parts) == 5, F.lit(False)) & text.rlike(STAMP_PATTERN) & midnight.isNotNull()
             & hour.between(0, 24) & minute.between(0, 59) & second.between(0, 59))
    stamp = F.when(valid, midnight + F.make_dt_interval(F.lit(0), hour, minute, second))
    return (F.when(text.isNull() | (F.length(text) == 0), F.lit(None).cast("timestamp_ntz"))
            .when(~valid, F.raise_error(F.concat(F.lit("not a simulator stamp: "), text)).cast("timestamp_ntz"))
            .otherwise(stamp))


def hhmm(hour, minute=None) -> Column:
    """``%02d:%02d`` text; minute 0 when not given."""
    m = F.lit(0) if minute is None else col(minute)
    return F.format_string("%02d:%02d", col(hour).cast("int"), m.cast("int"))


def heating_switch_times(hours) -> Column:
    """Heating-hours selector -> struct of four switch times.

    h <= 4 : 08:00, 08:00, (22-h):00, 22:00
    h <= 8 : (10-(h-4)):00, 10:00, 18:00, 22:00
    else   : 06:00, 10:00, (22-(h-4)):00, 22:00
    """
    h = col(hours).cast("int")
    em, es = F.lit(EARLY_MORNING_HOUR), F.lit(EVENING_STOP_HOUR)
    fixed = lambda hh: hhmm(F.lit(hh))
    morning_start = (F.when(h <= 4, fixed(8)).when(h <= 8, hhmm(em - (h - 4)))
                     .otherwise(fixed(6)))
    morning_end = F.when(h <= 4, fixed(8)).otherwise(hhmm(em))
    evening_start = (F.when(h <= 4, hhmm(es - h)).when(h <= 8, fixed(18))
                     .otherwise(hhmm(es - (h - 4))))
    evening_end = hhmm(es)
    return F.struct(morning_start.alias("morning_start"), morning_end.alias("morning_end"),
                    evening_start.alias("evening_start"), evening_end.alias("evening_end"))


def shading_window_from_close(hours_open, hour_close) -> Column:
    """Shading open/close from a close hour: open = close - hours, both ``HH:00``."""
    close = col(hour_close).cast("int")
    opening = close - col(hours_open).cast("int")
    return F.struct(hhmm(opening).alias("open"), hhmm(close).alias("close"))


def shading_window_symmetric(hours_duration) -> Column:
    """Shading window centred on 14:00: 14 -/+ h/2, ``HH:MM`` truncated."""
    half = col(hours_duration).cast("double") / F.lit(2.0)

    def to_hm(decimal_hour: Column) -> Column:
        h = decimal_hour.cast("int")
        m = ((decimal_hour - h) * F.lit(60.0)).cast("int")
        return hhmm(h, m)

    centre = F.lit(SHADING_CENTRE_HOUR)
    return F.struct(to_hm(centre - half).alias("open"), to_hm(centre + half).alias("close"))

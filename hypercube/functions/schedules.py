"""Compact schedule builders (F13) and construction layer lists.

A compact schedule is an ordered list of fields, each either text
(``Through: 31 Mar``) or a number.  It is kept as
``ARRAY<STRUCT<field_text STRING, field_number DOUBLE>>`` so numbers stay
numbers and no engine-specific float-to-text formatting enters the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypercube.functions._cols import col, lit_or_col
from hypercube.functions.timefmt import (heating_switch_times, shading_window_from_close,
                                         shading_window_symmetric)

# Fixed values (must equal the reference): schedule names, type limits and the
# heating season boundaries (heating through 31 Mar and again after 30 Nov).
SHADING_SCHEDULE = "Master_Shading_S"
SHADING_SCHEDULE_IDF = "Master_Shading_Availability_S"
SETPOINT_SCHEDULE = "Master_Heating_Setpoint_S"
AVAILABILITY_SCHEDULE = "Master_Heating_Availability_S"
LIMITS_ON_OFF = "On/Off"
LIMITS_TEMPERATURE = "Temperature"
LIMITS_FRACTION = "Fraction"
THROUGH_MAR = "Through: 31 Mar"
THROUGH_NOV = "Through: 30 Nov"
THROUGH_DEC = "Through: 31 Dec"
ALL_DAYS = "For: AllDays"
UNTIL_MIDNIGHT = "Until: 24:00"
OFF_SEASON_SETPOINT = 12.0
SHADING_CONTROL_TYPE = "OnIfScheduleAllows"
MAX_LAYERS = 10


def _text(x) -> Column:
    return F.struct(lit_or_col(x).cast("string").alias("field_text"),
                    F.lit(None).cast("double").alias("field_number"))


def _num(x) -> Column:
    return F.struct(F.lit(None).cast("string").alias("field_text"),
                    lit_or_col(x).cast("double").alias("field_number"))


def _until(t: Column) -> Column:
    return _text(F.concat(F.lit("Until: "), t))


def shading_schedule(s_hours, s_close, shgc) -> Column:
    """Shading fraction: shgc until open, 0 while open, shgc after close."""
    w = shading_window_from_close(s_hours, s_close)
    return F.array(_text(THROUGH_DEC), _text(ALL_DAYS), _until(w["open"]), _num(col(shgc)),
                   _until(w["close"]), _num(0.0), _text(UNTIL_MIDNIGHT), _num(col(shgc)))


def shading_schedule_symmetric(s_hours) -> Column:
    """Availability variant centred on 14:00: 0 outside, 1 inside the window."""
    w = shading_window_symmetric(s_hours)
    return F.array(_text(THROUGH_DEC), _text(ALL_DAYS), _until(w["open"]), _num(0.0),
                   _until(w["close"]), _num(1.0), _text(UNTIL_MIDNIGHT), _num(0.0))


def _two_period_day(t: Column, low: Column, high: Column) -> list[Column]:
    return [_until(t["morning_start"]), _num(low), _until(t["morning_end"]), _num(high),
            _until(t["evening_start"]), _num(low), _until(t["evening_end"]), _num(high),
            _text(UNTIL_MIDNIGHT), _num(low)]


def _seasonal(hours, low: Column, high: Column) -> Column:
    t = heating_switch_times(hours)
    day = _two_period_day(t, low, high)
    return F.array(_text(THROUGH_MAR), _text(ALL_DAYS), *day,
                   _text(THROUGH_NOV), _text(ALL_DAYS), _text(UNTIL_MIDNIGHT), _num(low),
                   _text(THROUGH_DEC), _text(ALL_DAYS), *day)


def setpoint_schedule(hours, setpoint) -> Column:
    """Heating setpoint: setpoint in the two daily periods, 12.0 otherwise and off-season."""
    return _seasonal(hours, F.lit(OFF_SEASON_SETPOINT), col(setpoint).cast("double"))


def availability_schedule(hours) -> Column:
    """Heating availability: 1.0 in the two daily periods of the season, else 0.0."""
    return _seasonal(hours, F.lit(0.0), F.lit(1.0))


def layer_list(outside_layer, *inner_layers) -> Column:
    """Outside layer then layers 2..10, NULL and empty names removed."""
    arr = F.array(*[col(c).cast("string") for c in (outside_layer, *inner_layers)])
    return F.filter(arr, lambda x: x.isNotNull() & (x != ""))


def editable_layers(layers) -> Column:
    """All layers but the innermost one."""
    arr = col(layers)
    return F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0)))

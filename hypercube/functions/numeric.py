"""Numeric column expressions.

NumPy rounds ``round(x, n)`` by scaling, rounding half to even and scaling
back; ``round_even`` mirrors that exactly with ``rint`` so results agree with
the reference to the last bit (Spark's ``round`` is half-up, ``bround`` works
on the decimal text of the double; both differ on some inputs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypercube.functions._cols import col

# Fixed unit constants of the study.
JOULES_PER_KWH = 3_600_000.0
SECONDS_PER_HOUR = 3600.0


def round_even(x, n: int) -> Column:
    """``rint(x * 10**n) / 10**n``: NumPy-style half-even rounding to n places."""
    scale = float(10 ** n)
    return F.rint(col(x).cast("double") * F.lit(scale)) / F.lit(scale)


def ceil_div(a, b) -> Column:
    """Integer ceiling division ``(a + b - 1) / b`` for positive integers."""
    return F.ceil(col(a).cast("double") / col(b).cast("double")).cast("int")


def joules_to_kwh(x) -> Column:
    return col(x).cast("double") / F.lit(JOULES_PER_KWH)


def ach_to_flow(ach, volume) -> Column:
    """Air changes per hour over a zone volume -> volumetric flow in m3/s."""
    return (col(ach).cast("double") * col(volume).cast("double")) / F.lit(SECONDS_PER_HOUR)


def is_missing(x) -> Column:
    """NULL or NaN: the cells a NumPy float matrix holds as NaN."""
    c = col(x)
    return c.isNull() | F.isnan(c)

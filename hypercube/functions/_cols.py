from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    """Accept a column name or a Column."""
    return F.col(x) if isinstance(x, str) else x


def lit_or_col(x) -> Column:
    """Accept a Column, a column name given as Column, or a Python literal."""
    return x if isinstance(x, Column) else F.lit(x)

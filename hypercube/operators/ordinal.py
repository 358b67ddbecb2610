"""Row numbers within a group that stay distributed when a group is huge.

A plain ``row_number().over(Window.partitionBy(key))`` sends a whole group to
one task.  ``sliced_row_number`` numbers rows inside (group, slice) windows,
where the caller supplies a slice column that is monotone with the order
(a day of the time axis, a hash prefix), then adds the count of rows in the
earlier slices of the same group.  A window partition is one slice of one
group; the offsets come from a per-(group, slice) count table whose size is
groups x slices, never rows, and that joins back on (group, slice), the key
the windowed rows are already partitioned and sorted by.  The join merges:
Spark estimates rows that were exploded by the size before, and would
broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hypercube.functions._cols import col


def sliced_row_number(df: DataFrame, keys: list[str], slice_col: str,
                      order: list[Column | str], out: str, start: int = 1) -> DataFrame:
    """Add ``out`` = position of each row inside ``keys`` ordered by
    ``(slice_col, *order)``, counting from ``start``.

    ``slice_col`` must be non-NULL and non-decreasing along the order, so
    rows of an earlier slice always sort before rows of a later one.
    """
    order_cols = [col(c) for c in order]
    local = df.withColumn(
        "_local_rn", F.row_number().over(Window.partitionBy(*keys, slice_col).orderBy(*order_cols)))
    before = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (df.groupBy(*keys, slice_col).agg(F.count(F.lit(1)).alias("_slice_rows"))
               .withColumn("_offset", F.coalesce(F.sum("_slice_rows").over(before), F.lit(0)))
               .drop("_slice_rows"))
    return (local.join(offsets.hint("merge"), on=[*keys, slice_col], how="inner")
            .withColumn(out, (F.col("_offset") + F.col("_local_rn") + F.lit(start - 1)).cast("int"))
            .drop("_offset", "_local_rn"))

"""Exact medians without gathering a group in one task.

``percentile``/``median`` aggregate every distinct value of a group into one
buffer that a single task merges; for a study-wide median that is every run.
``exact_median`` instead narrows, per group, the value range that holds the
two middle ranks:

1. per group: count n, min, max; targets k1 = (n-1) div 2, k2 = n div 2.
2. each round: values inside a target's current range are counted per
   (group, target, bucket) over ``buckets`` equal-width buckets, with the
   bucket's exact min and max (hash aggregation, partial per task); a
   window over the bucket counts of one target (at most ``buckets`` rows)
   finds the bucket holding rank k, whose [min, max] and count become the
   new range.
3. rounds go on until every range holds one distinct value.  The smallest and
   the largest value of a range never share a bucket, so each round shrinks
   every open range.

A double has 64 bits and a round splits 13 of them, so rounds are few; each
is one scan of the value column, and the driver only reads a one-row
convergence flag per round.  The median is (x[k1] + x[k2]) / 2, as NumPy
and pandas compute it.  The ranges, two rows a group, are broadcast, so groups
are few; for many groups of bounded size ``bounded_median`` ranks the values of
a group in one window instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 8192


def exact_median(df: DataFrame, group_cols: list[str], value_col: str, out: str = "median",
                 buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Per group (or globally when ``group_cols`` is empty) the exact median of
    ``value_col`` (NULL and NaN ignored).  Groups without values are absent."""
    g = list(group_cols)
    gk = g if g else []
    vals = (df.select(*g, F.col(value_col).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    if not g:
        vals = vals.withColumn("_g", F.lit(0))
        gk = ["_g"]
    stats = vals.groupBy(*gk).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"),
                                  F.max("_v").alias("_hi"))
    state = (stats.select(*gk, F.explode(F.array(
        F.struct(F.lit(1).alias("t"), ((F.col("_n") - 1) / 2).cast("long").alias("k")),
        F.struct(F.lit(2).alias("t"), (F.col("_n") / 2).cast("long").alias("k")))).alias("_t"),
        "_lo", "_hi")
        .select(*gk, "_t.t", "_t.k", "_lo", "_hi"))
    keys = gk + ["t"]
    lo, hi, v = F.col("_lo"), F.col("_hi"), F.col("_v")
    state = _materialize(state)
    while True:
        open_ = state.where(lo < hi)
        if open_.isEmpty():
            break
        # halves keep the width of the widest range finite
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
        b = F.when(v == hi, buckets - 1).otherwise(
            F.least(F.floor(F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(0.0)) * buckets).cast("int"), F.lit(buckets - 2)))
        # the few ranges go to the values: Spark estimates unpivoted values by the size before
        cand = (vals.join(F.broadcast(open_), on=gk, how="inner")
                .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                .withColumn("_b", b))
        counts = cand.groupBy(*keys, "k", "_b").agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        found = (counts.withColumn("_cum", F.coalesce(F.sum("_c").over(before), F.lit(0)))
                 .where((F.col("_cum") <= F.col("k")) & (F.col("k") < F.col("_cum") + F.col("_c")))
                 .select(*keys, (F.col("k") - F.col("_cum")).alias("k"), F.col("_blo").alias("_lo"),
                         F.col("_bhi").alias("_hi")))
        done = state.join(open_.select(*keys), on=keys, how="left_anti")
        state = _materialize(done.unionByName(found))
    picked = state.select(*keys, F.col("_lo").alias("_x"))
    med = picked.groupBy(*gk).agg(
        ((F.max(F.when(F.col("t") == 1, F.col("_x"))) + F.max(F.when(F.col("t") == 2, F.col("_x"))))
         / F.lit(2.0)).alias(out))
    return med if g else med.drop("_g")


def bounded_median(df: DataFrame, group_cols: list[str], value_col: str, out: str = "median") -> DataFrame:
    """Per group the exact median of ``value_col`` (NULL and NaN ignored), for
    groups of a bounded size (the runs of one batch): one window per group."""
    vals = (df.select(*group_cols, F.col(value_col).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    w = Window.partitionBy(*group_cols)
    ranked = vals.select("*", F.row_number().over(w.orderBy("_v")).alias("_r"), F.count(F.lit(1)).over(w).alias("_n"))
    middle = (F.col("_r") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_r") == F.floor(F.col("_n") / 2) + 1)
    return ranked.where(middle).groupBy(*group_cols).agg(((F.min("_v") + F.max("_v")) / F.lit(2.0)).alias(out))


def _materialize(df: DataFrame) -> DataFrame:
    """Cut the loop's growing lineage: the state table (two rows per group) is
    written as a reliable checkpoint to the shared checkpoint folder."""
    from hypercube.session import cut_lineage
    return cut_lineage(df)

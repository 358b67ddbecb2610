"""Timing marts (C13): per-batch timing (A8) and the study summary.

Medians are exact and interpolate between the two middle values, like
pandas.  A batch's come from a window over its runs, the study's from
``quantile.exact_median`` (range narrowing with partial aggregations), so the
study is never gathered in one task; every ``*_sec`` column is handled in the same pass by unpivoting
the timing columns into (column, value) groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercube.functions.numeric import round_even
from hypercube.operators.quantile import bounded_median, exact_median
from hypercube.operators.runs import batch_of

# Fixed values (must equal the reference): batch-level cost columns summed
# into the study summary when present.
BATCH_COST_COLUMNS = ("input_load_sec", "baseline_idf_load_sec", "baseline_model_load_sec",
                      "summary_write_sec", "hourly_concat_sec", "hourly_write_sec",
                      "batch_total_sec")
TIME_SUFFIX = "_sec"
# The other columns of a batch's own timing row.
BATCH_TEXT_COLUMNS = ("input_format", "tmpdir")


def batch_column_type(name: str) -> str:
    """Type of a column of the batch timing table."""
    return ("double" if name.endswith(TIME_SUFFIX) else "string" if name in BATCH_TEXT_COLUMNS
            else "boolean" if name == "batch_matches_design" else "int")


def time_columns(df: DataFrame, sort: bool = False) -> list[str]:
    cols = [c for c in df.columns if c.endswith(TIME_SUFFIX)]
    return sorted(cols) if sort else cols


def _means(cols: list[str]) -> list:
    return [round_even(F.avg(c), 6).alias(f"mean_{c}") for c in cols]


def _medians(detail: DataFrame, group_cols: list[str], cols: list[str]) -> DataFrame:
    """Exact median of every column in ``cols`` per group, one wide row per group."""
    long = detail.unpivot(group_cols, cols, "_col", "_val") if group_cols else \
        detail.select(F.lit(0).alias("_one"), *cols).unpivot(["_one"], cols, "_col", "_val")
    keys = group_cols or ["_one"]
    # a batch holds a batch size of runs at most, the study any number
    median = bounded_median if group_cols else exact_median
    med = median(long, keys + ["_col"], "_val", out="_m")
    wide = med.groupBy(*keys).pivot("_col", cols).agg(F.first("_m"))
    return wide.select(*group_cols, *[round_even(F.col(c), 6).alias(f"median_{c}") for c in cols])


def _interleave(cols: list[str]) -> list[str]:
    out = []
    for c in cols:
        out += [f"median_{c}", f"mean_{c}"]
    return out


def batch_timing(detail: DataFrame, batch_size: int, n_runs) -> DataFrame:
    """A8 + P10: per batch, its design slice, finished runs, and median/mean of
    every ``*_sec`` column (names sorted, as the worker writes them).

    ``n_runs`` is the design size (an int or a scalar-subquery Column).
    """
    n = n_runs if not isinstance(n_runs, int) else F.lit(n_runs)
    b = F.col("batch_id")
    cols = time_columns(detail, sort=True)
    base = detail.groupBy("batch_id").agg(
        F.min("input_format").alias("input_format"),
        F.count(F.lit(1)).cast("int").alias("n_sims"),
        F.min("sim_id").alias("first_sim"), F.max("sim_id").alias("last_sim"), *_means(cols))
    if cols:
        base = base.join(_medians(detail, ["batch_id"], cols), on="batch_id", how="left")
    return (base.select("batch_id", "input_format", "n_sims", "first_sim", "last_sim", *_interleave(cols))
        .withColumn("start_sim", ((b - 1) * F.lit(batch_size) + 1).cast("int"))
        .withColumn("end_sim", F.least(b * F.lit(batch_size), n).cast("int"))
        .withColumn("batch_matches_design",
                    (batch_of("first_sim", batch_size) == b) & (batch_of("last_sim", batch_size) == b)))


def study_timing(detail: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """A6 + A7: one row: batches, runs, median/mean of each ``*_sec`` column,
    and totals of the batch-level cost columns the batch table has."""
    cols = time_columns(detail)
    row = detail.agg(F.count_distinct("batch_id").cast("int").alias("n_batches"),
                     F.count(F.lit(1)).cast("int").alias("n_sims"), *_means(cols))
    if cols:
        med = _medians(detail, [], cols)
        row = row.select("n_batches", "n_sims", *[
            med.select(c).scalar().alias(c) if c.startswith("median_") else F.col(c)
            for c in _interleave(cols)])
    if batches is None:
        return row
    present = [c for c in BATCH_COST_COLUMNS if c in batches.columns]
    if not present:
        return row
    totals = batches.agg(*[round_even(F.sum(c), 6).alias(f"total_{c}") for c in present])
    return row.select("*", *[totals.select(f"total_{c}").scalar().alias(f"total_{c}")
                             for c in present])

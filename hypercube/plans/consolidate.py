"""Consolidation of worker batch outputs (C14: S2, U1, S10, O1, S15, Q4, C13).

Workers write, per batch or for several batches in one file, a summary CSV, an
hourly Parquet file, a timing CSV with a row per run and one with a row for the
batch (its medians and the costs of the batch itself).  Each kind lives below
folders of its own, ``batch=<b>`` folders among them; CSV files of different
headers may lie together and are read by column name.

``consolidate`` writes below ``out``:
- ``study_results`` (summary rows ordered by sim_id);
- ``hourly`` (one compacted table clustered by sim_id; files with other zone
  columns are merged by name, missing cells NULL);
- ``worker_timings`` (timing rows ordered by sim_id);
- ``worker_batch_timings`` (the batches' own rows, or worked out from the runs'
  where there are none) and ``worker_timing_summary`` with ``total_*`` columns
  of the batch costs.

It refuses to overwrite existing outputs, stops when there are no summary
rows, and skips hourly or timing outputs that do not exist, with a warning,
as the reference does.
"""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.operators import timing as timing_ops
from hypercube.plans.dashboard import write_sparse, write_table
from hypercube.session import path_exists
from hypercube.sources.csv import read_csv_union

BATCH_FOLDER = "batch"


def consolidate(spark: SparkSession, *, summary_roots: list[str], hourly_roots: list[str],
                timing_roots: list[str], types: dict[str, str], out: str,
                batch_size: int, n_runs, batch_timing_roots: list[str] = ()) -> dict[str, str]:
    paths = {k: os.path.join(out, k) for k in (
        "study_results", "hourly", "worker_timings", "worker_batch_timings", "worker_timing_summary")}
    for k in ("study_results", "hourly"):
        if path_exists(spark, paths[k]):
            raise FileExistsError(f"{paths[k]} already exists; delete it to rebuild")
    summary = read_csv_union(spark, [p for p in summary_roots if path_exists(spark, p)], types)
    if summary.isEmpty():
        raise ValueError("no summary rows found in the batch outputs")
    write_table(summary.orderBy("sim_id"), paths["study_results"])

    hourly_present = [p for p in hourly_roots if path_exists(spark, p)]
    if hourly_present:
        hourly = (spark.read.option("mergeSchema", True).parquet(*hourly_present).drop(BATCH_FOLDER))
        write_sparse(hourly, paths["hourly"], sort_cols=("sim_id", "datetime"))
    else:
        warnings.warn("no hourly outputs; hourly consolidation skipped")
        paths.pop("hourly")

    timing_present = [p for p in timing_roots if path_exists(spark, p)]
    if timing_present:
        detail = read_csv_union(spark, timing_present, types)
        write_table(detail.orderBy("sim_id"), paths["worker_timings"])
        detail = spark.read.parquet(paths["worker_timings"])
        own = [p for p in batch_timing_roots if path_exists(spark, p)]
        batches = (read_csv_union(spark, own, {}) if own else timing_ops.batch_timing(detail, batch_size, n_runs))
        if own:
            batches = batches.select(*[F.col(c).cast(timing_ops.batch_column_type(c)).alias(c) for c in batches.columns])
        write_table(batches.orderBy("batch_id"), paths["worker_batch_timings"])
        batches = spark.read.parquet(paths["worker_batch_timings"])
        write_table(timing_ops.study_timing(detail, batches), paths["worker_timing_summary"])
    else:
        warnings.warn("no timing outputs; timing consolidation skipped")
        for k in ("worker_timings", "worker_batch_timings", "worker_timing_summary"):
            paths.pop(k)
    return paths


def land_batches(df: DataFrame, root: str, fmt: str, batch_size: int, n_files: int) -> str:
    """Write rows as worker files in one job: ``n_files`` at most, each batch
    whole in one of them, so files follow the rows and not the batches."""
    from hypercube.operators.runs import batch_of
    batch = F.col("batch_id") if "sim_id" not in df.columns else batch_of("sim_id", batch_size)
    w = df.repartition(n_files, batch).write
    if fmt == "csv":
        (w.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(root))
    else:
        w.parquet(root)
    return root


def rebuild_dashboard(spark: SparkSession, consolidated: dict[str, str], *, design: DataFrame,
                      zone_mapping: DataFrame, out: str, batch_size: int,
                      mode: str = "errorifexists") -> dict[str, str]:
    """S16 ``dashboard_only`` mode: rebuild the bundle from consolidated tables
    only (no batch files), e.g. after the batch folder has been cleaned up."""
    from hypercube.plans.dashboard import DASHBOARD_ONLY, export_bundle

    def table(key: str) -> DataFrame | None:
        return spark.read.parquet(consolidated[key]) if key in consolidated else None

    return export_bundle(out, design=design, zone_mapping=zone_mapping, hourly_wide=table("hourly"),
                         summary=table("study_results"), timing=table("worker_timings"),
                         batch_size=batch_size, batches=table("worker_batch_timings"),
                         export_mode=DASHBOARD_ONLY, mode=mode)

"""Streaming state carried across micro-batches equals the batch result."""

from __future__ import annotations

import shutil
import time

import pytest
from pyspark.sql import functions as F

from hypercube.operators import hourly
from hypercube.session import work_dir
from hypercube.streaming import incremental as inc

WIDE = "sim_id int, datetime string, zone_a float, zone_b float"


def test_run_split_over_two_micro_batches(spark):
    first = [(1, " 01/01  01:00:00", 1.0, 0.0), (1, " 01/01  02:00:00", 5.0, 0.0), (2, " 01/01  01:00:00", 0.0, 0.0)]
    second = [(1, " 01/01  03:00:00", 2.0, 3.0), (1, " 01/01  04:00:00", 0.0, 0.0), (2, " 01/01  02:00:00", 2.0, None)]
    root = work_dir(spark, "stream-test")
    spark.createDataFrame(first, WIDE).coalesce(1).write.parquet(f"{root}/in")
    time.sleep(1.1)  # the file source takes files in modification order
    spark.createDataFrame(second, WIDE).coalesce(1).write.mode("append").parquet(f"{root}/in")
    got = {r.sim_id: r for r in inc.stream_run_stats(spark, f"{root}/in").collect()}
    catalog = spark.createDataFrame([(0, "zone_a"), (1, "zone_b")], "zone_id int, zone_label string")
    batch = {r.sim_id: r for r in hourly.hourly_marts(spark.createDataFrame(first + second, WIDE),
                                                      catalog)["run_stats"].collect()}
    for sim in (1, 2):
        for f in ("annual_total_heating_j", "nonzero_hour_count", "nonzero_zone_observation_count",
                  "peak_hour_total_heating_j", "peak_hour_index"):
            assert getattr(got[sim], f) == getattr(batch[sim], f), (sim, f)
    # run 1: the 5.0 peak of the first chunk is tied by 2+3 later and must stay (strict >)
    assert got[1].peak_hour_index == 1
    sparse = inc.stream_sparse_append(spark, f"{root}/in", catalog)
    assert sorted((r.sim_id, r.hour_index, r.zone_id) for r in sparse.collect()) == [
        (1, 0, 0), (1, 1, 0), (1, 2, 0), (1, 2, 1), (2, 1, 0), (2, 1, 1)]


def test_late_row_stops_the_stream(spark):
    root = work_dir(spark, "late-test")
    spark.createDataFrame([(1, " 01/01  05:00:00", 1.0, 0.0)], WIDE).coalesce(1).write.parquet(f"{root}/in")
    time.sleep(1.1)
    spark.createDataFrame([(1, " 01/01  04:00:00", 1.0, 0.0)], WIDE).coalesce(1).write.mode("append").parquet(f"{root}/in")
    with pytest.raises(Exception, match="late row of run 1"):
        inc.stream_run_stats(spark, f"{root}/in")


def _land(spark, root, rows):
    spark.createDataFrame(rows, WIDE).coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_an_epoch_writes_the_runs_it_changes(spark):
    root = work_dir(spark, "delta-test")
    _land(spark, root, [(i, " 01/01  01:00:00", float(i), None) for i in range(1, 201)])
    first = inc.stream_run_stats(spark, f"{root}/in", root=f"{root}/job")
    assert first.count() == 200
    _land(spark, root, [(7, " 01/01  02:00:00", 50.0, 1.0), (9, " 01/01  02:00:00", None, float("nan"))])
    second = {r.sim_id: r for r in inc.stream_run_stats(spark, f"{root}/in", root=f"{root}/job").collect()}
    epochs = {r.epoch: r["count"] for r in inc.read_epochs(spark, f"{root}/job", inc.CHANGED).groupBy("epoch").count().collect()}
    assert len(second) == 200 and sorted(epochs.values()) == [2, 200]
    assert (second[7].annual_total_heating_j, second[7].peak_hour_index, second[7].nonzero_zone_observation_count) == (51.0, 1, 4)
    assert (second[9].annual_total_heating_j, second[9].nonzero_zone_observation_count) == (0.0, 4)


def test_lost_state_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    _land(spark, root, [(1, " 01/01  01:00:00", 1.0, 0.0)])
    inc.stream_run_stats(spark, f"{root}/in", root=f"{root}/job").collect()
    # the same stream, all but its state
    shutil.copytree(f"{root}/job", f"{root}/bare", ignore=shutil.ignore_patterns("state"))
    _land(spark, root, [(1, " 01/01  02:00:00", 1.0, 0.0)])
    with pytest.raises(Exception, match="(?i)state"):
        inc.stream_run_stats(spark, f"{root}/in", root=f"{root}/bare")
    assert inc.stream_run_stats(spark, f"{root}/in", root=f"{root}/job").first().annual_total_heating_j == 2.0


def test_null_and_nan_cells_survive_the_stream(spark):
    root = work_dir(spark, "cells-test")
    rows = [(1, " 01/01  01:00:00", None, float("nan")), (1, " 01/01  02:00:00", 0.0, 2.5)]
    _land(spark, root, rows)
    catalog = spark.createDataFrame([(0, "zone_a"), (1, "zone_b")], "zone_id int, zone_label string")
    got = inc.stream_sparse_append(spark, f"{root}/in", catalog)
    want = hourly.hourly_marts(spark.createDataFrame(rows, WIDE), catalog)["hourly_sparse"]
    text = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert text(got) == text(want) and len(text(got)) == 3


def test_a_summary_that_lands_twice_counts_once(spark):
    root = work_dir(spark, "twice-test")
    design = spark.range(1, 11).selectExpr("CAST(id AS INT) AS sim_id")
    runs = design.where("sim_id <= 7")
    for part in (runs.where("sim_id < 5"), runs.where("sim_id >= 3"), runs.where("sim_id < 5")):
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    got = inc.stream_progress(spark, f"{root}/in", design, 5, root=f"{root}/job")
    want = inc.progress_report(inc.progress_counts(runs, 5), design, 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [(1, 5, 5, 100.0), (2, 2, 5, 40.0)]
    runs.coalesce(1).write.mode("append").parquet(f"{root}/in")
    again = inc.stream_progress(spark, f"{root}/in", design, 5, root=f"{root}/job")
    assert sorted(map(tuple, again.collect())) == [(1, 5, 5, 100.0), (2, 2, 5, 40.0)]


def test_progress_takes_several_files_an_epoch(spark):
    root = work_dir(spark, "progress-files")
    spark.range(1, 61).select(F.col("id").cast("int").alias("sim_id")).repartition(6).write.parquet(f"{root}/in")
    design = spark.range(1, 61).select(F.col("id").cast("int").alias("sim_id"))
    got = inc.stream_progress(spark, f"{root}/in", design, 20, files_per_trigger=3, root=f"{root}/job")
    assert sorted((r.batch_id, r.n_done, r.pct_done) for r in got.collect()) == [(b, 20, 100.0) for b in (1, 2, 3)]
    assert inc.read_epochs(spark, f"{root}/job", inc.PROGRESS).select("epoch").distinct().count() == 2

"""Structured Streaming versions of progress and hourly consolidation.

Worker outputs land as files in a folder; a file-source stream picks them up
as they arrive (``maxFilesPerTrigger`` files per micro-batch).  Sinks use
``foreachBatch`` and write each micro-batch below ``epoch=<id>``: a replayed
epoch (after a failure) overwrites its own folder, so the sink is idempotent,
and no result passes through the driver.

What a stream remembers lies in Spark's state store (RocksDB), keyed and
versioned with the checkpoint, so an epoch reads and writes the keys of its
own rows only, and a stream whose state is lost does not start but fails:

* progress (T1): the runs seen.  A summary that lands twice counts once; the
  runs that an epoch is the first to see are counted per batch, and the
  epochs' counts add up.
* run stats (T2): per run the rows seen so far (the next hour index), the
  last stamp and the running statistics; an epoch's sink holds the runs it
  changed, and the newest row of each run is the result.
* sparse append (T3): per run the rows seen so far and the last stamp; rows
  leave with their hour index and become cells.

A run's rows must arrive in time order across micro-batches; a row that goes
back in time stops the stream with an error.  The rows that one epoch brings
of one run are put in order in one task: three numbers a row for T2, the cells
that stay for T3, and as many as ``files_per_trigger`` files hold of a run.

Given a ``root`` folder, a stream goes on from where the last call with the
same folder ended; without one it starts anew in a scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hypercube.functions.numeric import round_even
from hypercube.functions.timefmt import hour24_timestamp
from hypercube.operators import hourly
from hypercube.operators.runs import batch_of
from hypercube.session import path_exists, work_dir


def land_files(df: DataFrame, path: str, n_files: int, key) -> str:
    """Write ``df`` as about ``n_files`` Parquet files split by ``key``
    (how worker outputs would arrive), returning the folder."""
    df.repartition(n_files, key).write.parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet file-source stream with the folder's schema."""
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_until_drained(stream: DataFrame, root: str, write, output_mode: str = "append") -> None:
    """Process everything available now, each micro-batch by ``write(batch)``
    into its own folder below ``root/sink``, with state in RocksDB, then stop."""
    spark = stream.sparkSession
    own = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", f"{root}/checkpoint")
             .foreachBatch(lambda batch, epoch_id: write(batch).write.mode("overwrite")
                           .parquet(f"{root}/sink/epoch={epoch_id}"))
             .trigger(availableNow=True).start())
    finally:
        spark.conf.unset(PROVIDER) if own is None else spark.conf.set(PROVIDER, own)
    q.awaitTermination()


def read_epochs(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of every epoch with its number; none if nothing has landed yet."""
    with_epoch = f"{schema}, epoch long"
    if not path_exists(spark, f"{root}/sink"):
        return spark.createDataFrame([], with_epoch)
    return spark.read.schema(with_epoch).parquet(f"{root}/sink")


# --- T1 ----------------------------------------------------------------------


PROGRESS = "batch_id int, n_done long"


def first_summaries(summary_stream: DataFrame) -> DataFrame:
    """Streaming deduplication: each run once, whichever file brings it first."""
    return summary_stream.select("sim_id").dropDuplicates(["sim_id"])


def progress_counts(runs: DataFrame, batch_size: int) -> DataFrame:
    """Finished runs per batch of one epoch's new runs."""
    return (runs.withColumn("batch_id", batch_of("sim_id", batch_size).cast("int"))
            .groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_done")))


def progress_report(done: DataFrame, design: DataFrame, batch_size: int) -> DataFrame:
    """Every design batch with finished runs, total and percent (capped at 100)."""
    totals = (design.withColumn("batch_id", batch_of("sim_id", batch_size))
              .groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_total")))
    d = F.coalesce(F.col("n_done"), F.lit(0))
    return (totals.join(done, on="batch_id", how="left")
            .select("batch_id", d.alias("n_done"), "n_total",
                    round_even(F.least(d, F.col("n_total")) * F.lit(100.0) / F.col("n_total"), 2)
                    .alias("pct_done")))


def stream_progress(spark: SparkSession, summary_dir: str, design: DataFrame, batch_size: int,
                    files_per_trigger: int = 1, root: str | None = None) -> DataFrame:
    root = root or work_dir(spark, "progress-stream")
    run_until_drained(first_summaries(file_stream(spark, summary_dir, files_per_trigger)), root,
                      lambda runs: progress_counts(runs, batch_size))
    done = read_epochs(spark, root, PROGRESS).groupBy("batch_id").agg(F.sum("n_done").alias("n_done"))
    return progress_report(done, design, batch_size)


# --- T2 / T3 -------------------------------------------------------------------

SEEN = "seen long, last_stamp timestamp_ntz"
STATS = "annual double, nz_hours long, nz_cells long, peak double, peak_hour long"
CHANGED = f"sim_id int, {STATS}"
INDEXED = "sim_id int, hour_index int, cells array<int>, cell_values array<float>"
FACT = "sim_id int, hour_index int, zone_id int, value float"


class _Runs(StatefulProcessor):
    """Puts the rows that an epoch brings of a run behind those seen before."""

    schema = SEEN

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._run = handle.getValueState("run", self.schema)

    def close(self) -> None:
        pass

    def in_order(self, sim_id: int, frames: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, tuple | None, tuple]:
        """The epoch's rows in time order with ``hour_index``, the state before
        and the part of the state after that both streams share."""
        rows = pd.concat(list(frames), ignore_index=True)
        rows = rows.sort_values(["timestamp", "datetime"], kind="stable", na_position="first", ignore_index=True)
        before = self._run.get() if self._run.exists() else None
        seen, last = before[:2] if before else (0, None)
        newest = rows["timestamp"].max()
        if last is not None and (rows["timestamp"] < pd.Timestamp(last)).any():
            raise ValueError(f"late row of run {sim_id}")
        rows["hour_index"] = np.arange(seen, seen + len(rows))
        return rows, before, (seen + len(rows), last if pd.isna(newest) else newest.to_pydatetime())


class RunTotals(_Runs):
    """Running statistics of each run.  On equal peaks the earlier hour stays."""

    schema = f"{SEEN}, {STATS}"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows, before, seen = self.in_order(key[0], rows)
        annual, hours, cells, peak, peak_hour = before[2:] if before else (0.0, 0, 0, None, None)
        totals = rows["row_total"].to_numpy(dtype="float64", na_value=np.nan)
        if not np.isnan(totals).all():
            top = int(np.nanargmax(totals))
            if peak is None or totals[top] > peak:
                peak, peak_hour = float(totals[top]), int(rows["hour_index"][top])
        after = (annual + float(np.nansum(totals)), hours + int((rows["nonzero_cells"] > 0).sum()),
                 cells + int(rows["nonzero_cells"].sum()), peak, peak_hour)
        self._run.update(seen + after)
        yield pd.DataFrame([(key[0], *after)], columns=["sim_id", "annual", "nz_hours", "nz_cells", "peak", "peak_hour"])


class RunHours(_Runs):
    """The rows as they are, with their hour index."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows, _, seen = self.in_order(key[0], rows)
        self._run.update(seen)
        yield rows[["sim_id", "hour_index", "cells", "cell_values"]]


def _per_run(rows: DataFrame, processor: StatefulProcessor, schema: str, output_mode: str) -> DataFrame:
    return rows.groupBy("sim_id").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=output_mode, timeMode="None")


def _stamped(wide: DataFrame) -> DataFrame:
    return wide.withColumn("sim_id", F.col("sim_id").cast("int")).withColumn("timestamp", hour24_timestamp("datetime"))


def stream_run_stats(spark: SparkSession, hourly_dir: str, files_per_trigger: int = 1,
                     root: str | None = None) -> DataFrame:
    """Run stats over hourly worker files; the newest row of each run is its result."""
    root = root or work_dir(spark, "stats-stream")
    rows = hourly.with_row_aggregates(_stamped(file_stream(spark, hourly_dir, files_per_trigger))).select(
        "sim_id", "timestamp", "datetime", "row_total", "nonzero_cells")
    run_until_drained(_per_run(rows, RunTotals(), CHANGED, "update"), root, lambda changed: changed, "update")
    found = read_epochs(spark, root, CHANGED)
    newest = found.groupBy("sim_id").agg(F.max_by(F.struct(*[c for c in found.columns if c not in ("sim_id", "epoch")]),
                                                  "epoch").alias("run")).select("sim_id", "run.*")
    above = F.coalesce(F.col("peak") > 0, F.lit(False))
    return newest.select(
        "sim_id", round_even("annual", 6).alias("annual_total_heating_j"),
        F.col("nz_hours").cast("int").alias("nonzero_hour_count"),
        F.col("nz_cells").cast("int").alias("nonzero_zone_observation_count"),
        F.when(above, F.col("peak")).otherwise(0.0).alias("peak_hour_total_heating_j"),
        F.when(above, F.col("peak_hour")).otherwise(0).cast("int").alias("peak_hour_index"))


def stream_sparse_append(spark: SparkSession, hourly_dir: str, zone_catalog: DataFrame,
                         files_per_trigger: int = 1, root: str | None = None) -> DataFrame:
    """The cells that stay, with their hour index, appended per micro-batch."""
    root = root or work_dir(spark, "sparse-stream")
    wide = _stamped(file_stream(spark, hourly_dir, files_per_trigger))
    zones = hourly.zone_columns(wide)
    rows = wide.select("sim_id", "timestamp", "datetime", *hourly.kept_cells(zones))
    indexed = _per_run(rows, RunHours(), INDEXED, "append")
    run_until_drained(indexed, root, lambda batch: hourly.cells_to_fact(batch, zone_catalog, zones))
    return read_epochs(spark, root, FACT).drop("epoch")

"""Study tables assembled from the fixture views of one data directory.

This module only wires inputs to the library's operators; every computed
column comes from ``hypercube.operators``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.functions.geometry import rectangle
from hypercube.operators import hourly, runs, timing, zones
from hypercube.sources.fixtures import Fixtures

BATCH_SIZE = 20
# rows of a landed worker file, about; a study lands in two files at least
LANDED_ROWS = 100_000
# simulator stamp text of fixture hour h (same expression as the hourly fixture)
STAMP_FROM_H = ("concat(' 01/', lpad(CAST(CAST(floor(h / 24) AS INT) + 1 AS STRING), 2, '0'), '  ', "
                "lpad(CAST(h % 24 + 1 AS STRING), 2, '0'), ':00:00')")


class Study:
    """Lazily built study tables for ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.fx = Fixtures(spark, sf_dir)

    # inputs -------------------------------------------------------------
    @cached_property
    def design(self) -> DataFrame:
        return self.fx.fx_design

    @cached_property
    def summary(self) -> DataFrame:
        return self.fx.fx_summary

    @cached_property
    def timing(self) -> DataFrame:
        return self.fx.fx_timing

    @cached_property
    def hourly_wide(self) -> DataFrame:
        """``sim_id, datetime, zone_*`` as workers write it."""
        return self.fx.fx_hourly_wide.drop("h")

    @cached_property
    def hourly_wide_all(self) -> DataFrame:
        return self.fx.fx_hourly_wide_all.drop("h")

    @cached_property
    def model_floors(self) -> DataFrame:
        f = self.fx.fx_floor
        return f.select("surface_id", "zone_name", "surface_type",
                        rectangle("w", "d", "z").alias("vertices"))

    # derived ------------------------------------------------------------
    @cached_property
    def zone_mapping(self) -> DataFrame:
        return zones.classify_zones(self.fx.fx_zone)

    @cached_property
    def zone_catalog(self) -> DataFrame:
        return zones.zone_catalog(self.zone_mapping)

    @cached_property
    def model_zone_mapping(self) -> DataFrame:
        mz = self.fx.fx_model_zone
        thermostats = mz.where(F.col("has_thermostat")).select("zone_name")
        return zones.zone_mapping(mz, self.model_floors, thermostats)

    @cached_property
    def runs(self) -> DataFrame:
        return runs.runs_mart(self.design, self.summary, self.timing)

    @cached_property
    def marts(self) -> dict:
        """The hourly marts; the zone catalog is read from its published table, so its bytes are known."""
        return hourly.hourly_marts(self.hourly_wide, self.published("zone_catalog"), check_labels=False)

    @cached_property
    def many_zones_wide(self) -> DataFrame:
        """Wide hourly rows of a model with 1,024 zone columns, as a worker's Parquet file."""
        zones_ = range(1024)

        def cells(path):
            by_zone = F.map_from_entries(F.collect_list(F.struct("zone", "value")))
            (self.fx.fx_many_zones_long.groupBy("sim_id", "h").agg(by_zone.alias("m"))
             .select("sim_id", F.expr(STAMP_FROM_H).alias("datetime"), F.transform(
                 F.array(*[F.lit(z) for z in zones_]), lambda z: F.coalesce(F.col("m")[z], F.lit(0.0).cast("float"))).alias("cells"))
             .write.parquet(path))

        def wide(path):
            rows = self.spark.read.parquet(self.fx.artifact("many-zones-cells", cells))
            rows.select("sim_id", "datetime", *[F.col("cells")[z].alias(f"zone_{z}") for z in zones_]).write.parquet(path)
        return self.spark.read.parquet(self.fx.artifact("many-zones-wide", wide))

    # published tables (written once per process) ---------------------------
    def consolidated(self) -> dict[str, str]:
        """The consolidated study tables, made from the landed batch files."""
        from hypercube.plans.consolidate import consolidate
        from hypercube.sources.csv import type_map
        names = ("study_results", "hourly", "worker_timings", "worker_batch_timings", "worker_timing_summary")

        def write(path):
            files = self.batch_files()
            consolidate(self.spark, summary_roots=files["summary"], hourly_roots=files["hourly"],
                        timing_roots=files["timing"], batch_timing_roots=files["batch_timing"],
                        types={**type_map(self.summary), **type_map(self.timing)}, out=path, batch_size=BATCH_SIZE,
                        n_runs=self.design.agg(F.count(F.lit(1))).scalar())
        root = self.fx.artifact("consolidated", write)
        return {n: f"{root}/{n}" for n in names}

    def published(self, name: str) -> DataFrame:
        """A table of the study bundle, rebuilt from the consolidated tables alone."""
        from hypercube.plans.dashboard import bundle_paths
        if name == "zone_catalog":
            root = self.fx.artifact("zone-catalog", lambda path: self.zone_catalog.write.parquet(f"{path}/zone_catalog"))
            return self.spark.read.parquet(f"{root}/{name}")
        return self.spark.read.parquet(bundle_paths(self.spark, self.bundle_root())[name])

    def bundle_root(self) -> str:
        """The folder that the study's bundle is published in."""
        from hypercube.plans.consolidate import rebuild_dashboard
        return self.fx.artifact("bundle", lambda path: rebuild_dashboard(
            self.spark, self.consolidated(), design=self.design, zone_mapping=self.zone_mapping, out=path,
            batch_size=BATCH_SIZE))

    # landed input folders (written once per process) ---------------------
    @cached_property
    def landed_files(self) -> int:
        """Worker files that the hourly rows land in: as many as their number asks for."""
        return max(2, -(-self.hourly_wide.count() // LANDED_ROWS))

    def files_per_trigger(self) -> int:
        """Half of the landed files, so that a run of the stream has two micro-batches at least."""
        return -(-self.landed_files // 2)

    def landed_hourly(self) -> str:
        """Hourly worker files (``sim_id, datetime, zone_*``), each run whole in
        one file, as batches land (stream input)."""
        from hypercube.streaming.incremental import land_files
        n = self.landed_files
        return self.fx.artifact("landed-hourly", lambda path: land_files(
            self.hourly_wide, path, n, F.col("sim_id") % n))

    def landed_summary(self) -> str:
        """Summary rows landing batch by batch (progress stream input)."""
        from hypercube.streaming.incremental import land_files
        n = self.landed_files
        return self.fx.artifact("landed-summary", lambda path: land_files(
            self.summary, path, n, F.ceil(F.col("sim_id") / BATCH_SIZE) % n))

    def raw_run_files(self) -> str:
        """One simulator-style CSV folder per run (``Run_<id>``: Date/Time + one
        column per output variable), the input of the raw-output scan."""
        from hypercube.sources.raw_output import write_run_files

        def write(path):
            raw = self.fx.fx_raw_output
            heads = sorted(r.header for r in raw.select("header").distinct().collect())
            per_run = (raw.withColumn("Date/Time", F.expr(STAMP_FROM_H)).groupBy("sim_id", "Date/Time")
                       .pivot("header", heads).agg(F.sum("joules")).na.fill(0.0))
            odd = F.col("sim_id") % 2 == 1
            write_run_files(per_run.where(~odd), f"{path}/a")
            write_run_files(per_run.where(odd).select("sim_id", "Date/Time", *reversed(heads)), f"{path}/b")
        return self.fx.artifact("raw-run-files", write)

    def batch_files(self) -> dict[str, list[str]]:
        """Worker outputs, as workers of two versions would leave them:
        summaries with two different CSV headers, hourly Parquet, and timing
        CSVs per run and per batch.  A worker's file holds whole batches, and
        files of each kind are as many as the hourly rows ask for."""
        from hypercube.plans.consolidate import land_batches

        def write(root):
            s, n = self.summary, self.landed_files
            odd = (F.ceil(F.col("sim_id") / BATCH_SIZE) % 2) == 1
            land_batches(s.where(~odd), f"{root}/summary", "csv", BATCH_SIZE, n)
            land_batches(s.where(odd).select(*reversed(s.columns)), f"{root}/summary_v2", "csv", BATCH_SIZE, n)
            land_batches(self.hourly_wide, f"{root}/hourly", "parquet", BATCH_SIZE, n)
            land_batches(self.timing, f"{root}/timing_detail", "csv", BATCH_SIZE, n)
            n_runs = self.design.agg(F.count(F.lit(1))).scalar()
            own = timing.batch_timing(self.timing, BATCH_SIZE, n_runs).join(self.fx.fx_batch_cost, on="batch_id")
            land_batches(own, f"{root}/timing_summary", "csv", BATCH_SIZE, n)
        root = self.fx.artifact("batch-files", write)
        return {"summary": [f"{root}/summary", f"{root}/summary_v2"], "hourly": [f"{root}/hourly"],
                "timing": [f"{root}/timing_detail"], "batch_timing": [f"{root}/timing_summary"]}

    def prepare_inputs(self) -> None:
        """Materialise every fixture and landed folder (one-off input cost)."""
        from hypercube.sources.fixtures import FIXTURE_SQL
        for name in FIXTURE_SQL:
            self.fx[name]
        self.landed_hourly()
        self.landed_summary()
        self.raw_run_files()
        self.batch_files()
        self.published("zone_catalog")
        self.published("runs")

    def run_dashboard(self) -> DataFrame:
        """The run dashboard over the published tables."""
        from hypercube.plans.dashboard import run_dashboard
        return run_dashboard(self.published("runs"), self.published("run_stats"))

    def hourly_dashboard(self) -> DataFrame:
        """The hourly dashboard over the published tables."""
        from hypercube.plans.dashboard import hourly_dashboard
        return hourly_dashboard(self.published("hourly_sparse"), self.published("calendar"), self.published("zone_catalog"))

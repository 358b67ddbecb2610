"""The published study bundle: tables, views and manifest.

``export_bundle`` writes every table as zstd Parquet into a version folder of
its own below one root, names that version in ``published`` when all of its
tables are there, and registers the two dashboard views.  Readers take the
tables of the version named last (``bundle_paths``), so they see a bundle whole
or not at all, whatever becomes of an export on its way; a version that was
replaced stays for those who still read it.  The sparse fact is range-partitioned on
``(sim_id, hour_index)`` and sorted within partitions by (sim_id, hour_index,
zone_id), so a point lookup on one run prunes row groups; it is never sorted
globally.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.operators import hourly as hourly_ops
from hypercube.operators import runs as runs_ops
from hypercube.operators import timing as timing_ops
from hypercube.session import path_exists, work_dir

# Fixed values (must equal the reference): bundle schema version and modes.
SCHEMA_VERSION = 1
FULL_CONSOLIDATION = "full_consolidation"
DASHBOARD_ONLY = "dashboard_only"

BUNDLE_TABLES = ("runs", "zone_catalog", "parameter_catalog", "batch_stats", "study_stats",
                 "calendar", "run_stats", "hourly_sparse", "manifest")
PUBLISHED = "published"

RUN_STATS_COLUMNS = ("annual_total_heating_j", "nonzero_hour_count",
                     "nonzero_zone_observation_count", "peak_hour_total_heating_j",
                     "peak_hour_index", "peak_datetime", "peak_timestamp")


def run_dashboard(runs: DataFrame, run_stats: DataFrame) -> DataFrame:
    """Every run with its hourly statistics (LEFT JOIN USING sim_id).

    Both sides are per-run tables; the join shuffles on ``sim_id``.
    """
    stats = run_stats.select("sim_id", *RUN_STATS_COLUMNS)
    return runs.join(stats.hint("merge"), on="sim_id", how="left")


def hourly_dashboard(sparse: DataFrame, calendar: DataFrame, zone_catalog: DataFrame) -> DataFrame:
    """C15 / J4 + J5: sparse fact with calendar stamps and zone attributes.

    Calendar and zone catalog are dimensions: read from their published
    tables their bytes are known, and Spark broadcasts them below its own
    threshold.  Hours beyond the calendar drop out (inner join), as in the
    reference.
    """
    cal = calendar.select("hour_index", "datetime", "timestamp")
    zc = zone_catalog.select("zone_id", "zone_name", "cluster", "area_sqm")
    return (sparse.join(cal, on="hour_index", how="inner").join(zc, on="zone_id", how="inner")
            .select("sim_id", "hour_index", "datetime", "timestamp", "zone_id", "zone_name",
                    "cluster", "area_sqm", "value"))


def manifest(spark: SparkSession, *, runs: DataFrame, zone_catalog: DataFrame,
             calendar: DataFrame, zero_fraction: DataFrame,
             has_timing: bool, export_mode: str = FULL_CONSOLIDATION,
             study_folder: str = "", source_hourly_path: str = "",
             with_timestamp: bool = True) -> DataFrame:
    """One row of counts and flags; each count is a scalar subquery."""
    cols = [
        F.lit(SCHEMA_VERSION).cast("int").alias("schema_version"),
        F.lit(export_mode).alias("export_mode"),
        F.lit(study_folder).alias("study_folder"),
        runs.agg(F.count(F.lit(1)).cast("int")).scalar().alias("n_runs"),
        zone_catalog.agg(F.count(F.lit(1)).cast("int")).scalar().alias("n_heated_zones"),
        calendar.agg(F.count(F.lit(1)).cast("int")).scalar().alias("n_calendar_hours"),
        # the sparse fact has a row for each non-zero cell
        zero_fraction.select("nonzero_cells").scalar().alias("n_sparse_rows"),
        zero_fraction.select("hourly_zero_fraction").scalar().alias("hourly_zero_fraction"),
        F.lit(bool(has_timing)).alias("has_timing_data"),
        F.lit(source_hourly_path).alias("source_hourly_path"),
    ]
    if with_timestamp:
        cols.insert(1, F.current_timestamp().alias("created_at_utc"))
    return spark.range(1).select(*cols)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Zstd Parquet; ``errorifexists`` refuses to overwrite."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_sparse(df: DataFrame, path: str, mode: str = "errorifexists",
                 sort_cols: tuple[str, ...] = ("sim_id", "hour_index", "zone_id")) -> None:
    """Range-partition on the first two sort columns, sort within
    partitions, zstd Parquet.

    Row groups are sorted and files hold ranges, so a filter on one run prunes
    both; no global sort.  A run may span files.  Ranges are as many as the
    session's shuffle partitions, and adaptive execution joins small ones, so
    files follow the data's size.
    """
    (df.repartitionByRange(*sort_cols[:2])
     .sortWithinPartitions(*sort_cols)
     .write.mode(mode).option("compression", "zstd").parquet(path))


def _published(spark: SparkSession, root: str) -> tuple[str, str] | None:
    """Number and version folder of the newest bundle below ``root``, if there is one.

    A file of ``published`` holds a version's name in one line; a file that
    its writer has not finished holds no row yet."""
    if not path_exists(spark, f"{root}/{PUBLISHED}"):
        return None
    named = spark.read.text(f"{root}/{PUBLISHED}").select(F.col("_metadata.file_name").alias("number"), "value")
    newest = named.agg(F.max(F.struct("number", "value")).alias("newest")).first()["newest"]
    return newest and (newest["number"], newest["value"])


def bundle_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> path of the bundle published last below ``root``."""
    newest = _published(spark, root)
    if newest is None:
        raise FileNotFoundError(f"no bundle is published below {root}")
    return {name: f"{root}/{newest[1]}/{name}" for name in BUNDLE_TABLES}


def _publish(spark: SparkSession, root: str, version: str, after: str | None) -> None:
    """Name ``version`` as the newest, if none was named since ``after``: the
    file system creates the next number's file for one writer only."""
    number = f"{int(after or 0) + 1:012d}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{PUBLISHED}/{number}")
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, False)
    out.write(bytearray(f"{version}\n", "utf-8"))
    out.close()


def export_bundle(root: str, *, design: DataFrame, zone_mapping: DataFrame, hourly_wide: DataFrame | None,
                  summary: DataFrame | None, timing: DataFrame | None, batch_size: int,
                  batches: DataFrame | None = None, export_mode: str = FULL_CONSOLIDATION, mode: str = "errorifexists",
                  study_folder: str = "") -> dict[str, str]:
    """Build and write the nine tables, publish them together, register the two views.

    Returns table name -> path.  ``errorifexists`` refuses if a bundle is
    published below ``root``; ``overwrite`` replaces it.  Of two exports at the
    same time the one that ends first is published, the other is an error.  Missing inputs give empty tables with the
    default columns (S7); no summary rows at all is an error (Q4).
    """
    from hypercube.operators.zones import zone_catalog as build_catalog

    spark = design.sparkSession
    if summary is not None and summary.isEmpty():
        raise ValueError("no summary rows: nothing to consolidate")
    before = _published(spark, root)
    if before is not None and mode != "overwrite":
        raise FileExistsError(f"a bundle is published below {root}; overwrite it to rebuild")
    catalog = build_catalog(zone_mapping)
    runs = runs_ops.runs_mart(design, summary, timing)
    params = runs_ops.column_catalog(runs)
    version = f"version-{uuid.uuid4().hex}"
    paths = {name: f"{root}/{version}/{name}" for name in BUNDLE_TABLES}
    write_table(runs.orderBy("sim_id"), paths["runs"])
    write_table(catalog, paths["zone_catalog"])
    write_table(params, paths["parameter_catalog"])
    if timing is not None:
        write_table(timing_ops.batch_timing(timing, batch_size, design.agg(F.count(F.lit(1))).scalar())
                    if batches is None else batches, paths["batch_stats"])
        write_table(timing_ops.study_timing(timing, batches), paths["study_stats"])
    else:
        write_table(spark.createDataFrame([], "batch_id int"), paths["batch_stats"])
        write_table(spark.createDataFrame([], "n_batches int, n_sims int"), paths["study_stats"])

    if hourly_wide is not None:
        catalog = spark.read.parquet(paths["zone_catalog"])
        # the indexed wide rows are written once to shared storage; every mart reads them from there
        indexed = work_dir(spark, "hourly-indexed")
        write_sparse(hourly_ops.hourly_marts(hourly_wide, catalog)["indexed"], indexed, sort_cols=("sim_id", "hour_index"))
        marts = hourly_ops.marts_from_indexed(spark.read.parquet(indexed), catalog)
        cal, stats, sparse, zf = (marts["calendar"], marts["run_stats"], marts["hourly_sparse"],
                                  marts["zero_fraction"])
    else:
        cal = spark.createDataFrame([], "hour_index int, datetime string, timestamp timestamp_ntz")
        stats = spark.createDataFrame([], "sim_id int, annual_total_heating_j double, "
                                      "nonzero_hour_count int, nonzero_zone_observation_count int, "
                                      "peak_hour_total_heating_j double, peak_hour_index int, "
                                      "peak_datetime string, peak_timestamp timestamp_ntz")
        sparse = spark.createDataFrame([], "sim_id int, hour_index int, zone_id int, value float")
        zf = spark.createDataFrame([(0, 0, 0.0)], "total_cells long, nonzero_cells long, "
                                   "hourly_zero_fraction double")
    write_table(cal.orderBy("hour_index"), paths["calendar"])
    write_table(stats, paths["run_stats"])
    write_sparse(sparse, paths["hourly_sparse"])

    # published tables are re-read, so the manifest counts what was written
    t = {k: spark.read.parquet(p) for k, p in paths.items() if k != "manifest"}
    man = manifest(spark, runs=t["runs"], zone_catalog=t["zone_catalog"], calendar=t["calendar"],
                   zero_fraction=zf, has_timing=timing is not None,
                   export_mode=export_mode, study_folder=study_folder,
                   source_hourly_path=paths["hourly_sparse"] if hourly_wide is not None else "")
    write_table(man, paths["manifest"])
    _publish(spark, root, version, before and before[0])
    register_views(spark, root)
    return paths


def register_views(spark: SparkSession, root: str) -> None:
    """Register the newest bundle's tables and the two dashboard views."""
    t = {}
    for name, path in bundle_paths(spark, root).items():
        t[name] = spark.read.parquet(path)
        t[name].createOrReplaceTempView(name)
    run_dashboard(t["runs"], t["run_stats"]).createOrReplaceTempView("run_dashboard")
    hourly_dashboard(t["hourly_sparse"], t["calendar"], t["zone_catalog"]).createOrReplaceTempView(
        "hourly_dashboard")

"""Registered queries: simulator results, CSV/Parquet round trips, JSON model."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hypercube.operators import results
from hypercube.plans import dashboard
from hypercube.plans import oracle_sql as o
from hypercube.plans.queries import register
from hypercube.plans.consolidate import rebuild_dashboard
from hypercube.plans.study import BATCH_SIZE, STAMP_FROM_H, Study
from hypercube.session import work_dir
from hypercube.sources import csv as csv_src
from hypercube.sources import raw_output
from hypercube.sources.model_json import explode_model

RAW = ("fx_raw_output",)

HEADER_ZONE = "trim(split_part(header, ' IDEAL LOADS AIR', 1))"

CTE_ZONE_MAP = """
zm AS (SELECT zone_name, is_heated, z_level, area_sqm,
  CASE WHEN NOT is_heated THEN 'EXCLUDED'
       WHEN z_level = (SELECT min(z_level) FROM fx_zone WHERE is_heated) THEN 'GROUND'
       WHEN z_level = (SELECT max(z_level) FROM fx_zone WHERE is_heated) THEN 'TOP'
       ELSE 'MIDDLE' END AS cluster FROM fx_zone)"""


def _cte_intensity(match: str) -> str:
    return f"""
ze AS (SELECT r.sim_id, z.zone_name, z.cluster, z.area_sqm, sum(r.joules) AS joules
  FROM fx_raw_output r JOIN zm z ON {match}
  WHERE z.is_heated AND contains(r.header, 'Heating Energy') GROUP BY 1, 2, 3, 4),
zi AS (SELECT ze.sim_id, ze.zone_name, ze.cluster,
  {o.re_sql('((ze.joules / 3600000.0E0) / d.cop) / ze.area_sqm', 2)} AS kwh_sqm
  FROM ze JOIN fx_design d ON ze.sim_id = d.sim_id)"""


EXACT = f"trim(split_part(r.header, ' IDEAL LOADS AIR', 1)) = upper(z.zone_name)"
SUBSTR = "contains(r.header, upper(z.zone_name))"


@register("parse_hourly_headers", o.q(RAW, select=f"""
SELECT sim_id, h, 'zone_' || {HEADER_ZONE} AS zone_label, CAST(sum(joules) AS FLOAT) AS value
FROM fx_raw_output WHERE contains(header, 'Heating Energy') GROUP BY 1, 2, 3"""))
def q_parse_hourly_headers(spark, sf_dir):
    """Heating columns by header text (P5), zone from header (F6),
    columns per zone summed, renamed and narrowed (P6, P8)."""
    return results.parse_hourly(Study(spark, sf_dir).fx.fx_raw_output)


@register("zone_intensity", o.q(RAW + ("fx_zone", "fx_design"), CTE_ZONE_MAP, _cte_intensity(EXACT),
                                select="SELECT * FROM zi"))
def q_zone_intensity(spark, sf_dir):
    """A1 + J17 + J19 + F8: kWh/m2 per run and heated zone (exact header match)."""
    st = Study(spark, sf_dir)
    energy = results.zone_energy_exact(st.fx.fx_raw_output, st.zone_mapping, fold_case=True)
    return results.zone_intensity(energy, st.design)


@register("substring_zone_match", o.q(RAW + ("fx_zone", "fx_design"), CTE_ZONE_MAP, _cte_intensity(SUBSTR),
                                      select="SELECT * FROM zi"))
def q_substring_zone_match(spark, sf_dir):
    """The legacy zone match (zone name anywhere in the header)."""
    st = Study(spark, sf_dir)
    energy = results.zone_energy_substring(st.fx.fx_raw_output, st.zone_mapping, fold_case=True)
    return results.zone_intensity(energy, st.design)


_DESIGN_SEL = ", ".join(f"d.{c}" for c in ("sim_id",) + o.DESIGN_COLS)


@register("run_summary", o.q(RAW + ("fx_zone", "fx_design"), CTE_ZONE_MAP, _cte_intensity(EXACT), f"""
kp AS (SELECT sim_id, avg(kwh_sqm) FILTER (WHERE cluster = 'GROUND') AS g,
  avg(kwh_sqm) FILTER (WHERE cluster = 'MIDDLE') AS m, avg(kwh_sqm) FILTER (WHERE cluster = 'TOP') AS t
  FROM zi GROUP BY sim_id)""", select=f"""
SELECT {_DESIGN_SEL},
  CASE WHEN kp.sim_id IS NOT NULL THEN {o.re_sql('coalesce(kp.g, 0.0E0)', 2)} END AS kwh_sqm_ground,
  CASE WHEN kp.sim_id IS NOT NULL THEN {o.re_sql('coalesce(kp.m, 0.0E0)', 2)} END AS kwh_sqm_middle,
  CASE WHEN kp.sim_id IS NOT NULL THEN {o.re_sql('coalesce(kp.t, 0.0E0)', 2)} END AS kwh_sqm_top
FROM (SELECT DISTINCT sim_id FROM fx_raw_output) r JOIN fx_design d ON r.sim_id = d.sim_id
LEFT JOIN kp ON d.sim_id = kp.sim_id"""))
def q_run_summary(spark, sf_dir):
    """C9 + A2 + P18 + P19: the per-run KPI row the workers write."""
    st = Study(spark, sf_dir)
    raw = st.fx.fx_raw_output
    energy = results.zone_energy_exact(raw, st.zone_mapping, fold_case=True)
    return results.run_summary(results.zone_intensity(energy, st.design), st.design, raw)


_STAMP_SQL = STAMP_FROM_H
_RAW_ZONES = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")


@register("raw_output_scan", o.q(RAW, f"""
rw AS (SELECT sim_id, {_STAMP_SQL} AS datetime, {HEADER_ZONE} AS zk, joules FROM fx_raw_output)""", select=f"""
SELECT sim_id, datetime, {", ".join(f"CAST(coalesce(sum(joules) FILTER (WHERE zk = '{z}'), 0.0E0) AS FLOAT) AS zone_{z}" for z in _RAW_ZONES)}
FROM rw GROUP BY sim_id, datetime"""))
def q_raw_output_scan(spark, sf_dir):
    """S5 + C8 + P18: simulator-style CSV files, one folder per run, read a
    portion at a time by header (run id from the file path; half the runs' files
    have their columns in another order), heating columns projected to the wide
    hourly table."""
    st = Study(spark, sf_dir)
    out = None
    for part in raw_output.scan_raw_output(spark, st.raw_run_files(), results.hourly_projection):
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@register("union_by_name_batches", o.q(("fx_timing",), select="""
SELECT batch_id, sim_id, input_format, energyplus_sec,
  CASE WHEN batch_id % 3 = 2 THEN NULL ELSE model_load_sec END AS model_load_sec,
  sim_total_sec, energyplus_returncode FROM fx_timing ORDER BY sim_id"""))
def q_union_by_name_batches(spark, sf_dir):
    """S1 + S2 + U1 + O1 + S8: timing rows written as CSV by three worker
    versions (reordered header, a column left out) into one folder, read back
    by header, unioned by name, ordered by sim_id."""
    st = Study(spark, sf_dir)
    t = st.timing
    root = work_dir(spark, "timing-csv")
    cols = t.columns
    variants = {0: cols, 1: list(reversed(cols)), 2: [c for c in cols if c != "model_load_sec"]}
    for g, vc in variants.items():
        csv_src.write_csv(t.where(F.col("batch_id") % 3 == g).select(*vc), os.path.join(root, f"group_{g}"))
    return csv_src.read_csv_union(spark, root, csv_src.type_map(t)).select(*cols).orderBy("sim_id")


@register("header_catalog", o.q(RAW, select=f"""
SELECT {HEADER_ZONE} AS zone_key, count(DISTINCT header) AS n_heating_columns, CAST(list_sort(list(DISTINCT header)) AS VARCHAR) AS headers
FROM fx_raw_output WHERE contains(header, 'Heating Energy') GROUP BY 1"""))
def q_header_catalog(spark, sf_dir):
    """The heating columns of each zone (the list as text)."""
    found = results.header_catalog(Study(spark, sf_dir).fx.fx_raw_output)
    # a list's text quotes items as the comparing engine does
    return found.withColumn("headers", F.concat(F.lit("['"), F.array_join("headers", "', '"), F.lit("']")))


# --- consolidated tables (C14), one query per table ---------------------------


def _consolidated(name: str, oracle: str, doc: str) -> None:
    def query(spark, sf_dir):
        return spark.read.parquet(Study(spark, sf_dir).consolidated()[name])
    query.__doc__ = doc
    register(f"consolidated_{name}", oracle)(query)


_SEC = ("energyplus_sec", "model_load_sec", "sim_total_sec")
_COSTS = ("input_load_sec", "hourly_write_sec", "batch_total_sec")
_MEDIANS = ", ".join(f"{o.re_sql(f'median({c})', 6)} AS median_{c}, {o.re_sql(f'avg({c})', 6)} AS mean_{c}" for c in _SEC)
_BATCH_ROWS = f"""
bt AS (SELECT batch_id, min(input_format) AS input_format, CAST(count(*) AS INTEGER) AS n_sims, min(sim_id) AS first_sim, max(sim_id) AS last_sim,
  {_MEDIANS}, CAST((batch_id - 1) * {BATCH_SIZE} + 1 AS INTEGER) AS start_sim,
  CAST(least(batch_id * {BATCH_SIZE}, (SELECT count(*) FROM fx_design)) AS INTEGER) AS end_sim,
  CAST(ceil(min(sim_id) / {BATCH_SIZE}.0E0) AS INTEGER) = batch_id AND CAST(ceil(max(sim_id) / {BATCH_SIZE}.0E0) AS INTEGER) = batch_id AS batch_matches_design
  FROM fx_timing GROUP BY batch_id),
bs AS (SELECT bt.*, {', '.join('c.' + c for c in _COSTS)} FROM bt JOIN fx_batch_cost c ON bt.batch_id = c.batch_id)"""
_STUDY_ROW = f"""
SELECT CAST(count(DISTINCT batch_id) AS INTEGER) AS n_batches, CAST(count(*) AS INTEGER) AS n_sims, {_MEDIANS},
  {", ".join(f"(SELECT {o.re_sql(f'sum({c})', 6)} FROM bs) AS total_{c}" for c in _COSTS)} FROM fx_timing"""
_TIMING_FX = ("fx_timing", "fx_design", "fx_batch_cost")

_consolidated("study_results", o.q(("fx_summary",), select="""
SELECT sim_id, kwh_sqm_ground, kwh_sqm_middle, kwh_sqm_top FROM fx_summary"""),
              "C14 + S2: the batches' summary CSVs of two header layouts as one table.")
_consolidated("hourly", o.q(o.HOURLY_FX, select=f"SELECT sim_id, datetime, {', '.join(o.ZONES)} FROM fx_hourly_wide"),
              "C14 + U1: the batches' hourly files as one table clustered by run.")
_consolidated("worker_timings", o.q(("fx_timing",), select="SELECT * FROM fx_timing"),
              "C13: the batches' timing rows as one table.")
_consolidated("worker_batch_timings", o.q(_TIMING_FX, _BATCH_ROWS, select="SELECT * FROM bs"),
              "A7 + A8: the batches' own timing rows, medians and costs, as their workers wrote them.")
_consolidated("worker_timing_summary", o.q(_TIMING_FX, _BATCH_ROWS, select=_STUDY_ROW),
              "A6 + A7 + C13: the study's timing row with the totals of the batch costs.")


# --- published tables (S8-S16), one query per table ---------------------------


def _published(name: str, oracle: str, doc: str, drop: tuple[str, ...] = ()) -> None:
    def query(spark, sf_dir):
        return Study(spark, sf_dir).published(name).drop(*drop)
    query.__doc__ = doc
    register(f"published_{name}", oracle)(query)


_published("runs", o.q(o.RUN_FX, o.CTE_RUNS, select="SELECT * FROM runs"),
           "S16: the published runs table, made from the consolidated tables alone.")
_published("batch_stats", o.q(_TIMING_FX, _BATCH_ROWS, select="SELECT * FROM bs"), "S16: the published batch timing table.")
_published("study_stats", o.q(_TIMING_FX, _BATCH_ROWS, select=_STUDY_ROW), "S16: the published study timing row.")
_published("calendar", o.q(o.HOURLY_FX, o.cte_hourly(), select="SELECT hour_index, datetime, timestamp FROM cal"),
           "S16: the published calendar.")
_published("run_stats", o.q(o.HOURLY_FX, o.cte_hourly(), select="SELECT * FROM rsc"), "S16: the published run statistics.")
_published("manifest", o.q(o.HOURLY_FX + o.ZONE_FX + o.RUN_FX, o.CTE_ZONES, o.CTE_RUNS, o.cte_hourly(), o.cte_sparse(), select=f"""
SELECT CAST(1 AS INTEGER) AS schema_version, 'dashboard_only' AS export_mode, '' AS study_folder,
  CAST((SELECT count(*) FROM runs) AS INTEGER) AS n_runs, CAST((SELECT count(*) FROM zc) AS INTEGER) AS n_heated_zones,
  CAST((SELECT count(*) FROM cal) AS INTEGER) AS n_calendar_hours, (SELECT count(*) FROM sp) AS n_sparse_rows,
  (SELECT {o.re_sql(f'1.0E0 - sum(nonzero_cells) / (count(*) * {len(o.ZONES)}.0E0)', 6)} FROM hi) AS hourly_zero_fraction,
  true AS has_timing_data"""), "C16: the published manifest (without creation stamp and path).", drop=("created_at_utc", "source_hourly_path"))


@register("published_views", o.q(o.HOURLY_FX + o.ZONE_FX + o.RUN_FX, o.CTE_ZONES, o.CTE_RUNS, o.cte_hourly(), o.cte_sparse(), select="""
SELECT r.sim_id, r.run_status, s.annual_total_heating_j, x.n_cells, x.value_sum
FROM runs r LEFT JOIN rsc s ON r.sim_id = s.sim_id LEFT JOIN (
  SELECT sp.sim_id, count(*) AS n_cells, round_even(sum(CAST(sp.value AS DOUBLE)), 3) AS value_sum
  FROM sp JOIN cal c ON sp.hour_index = c.hour_index JOIN zc ON sp.zone_id = zc.zone_id GROUP BY 1) x ON r.sim_id = x.sim_id"""))
def q_published_views(spark, sf_dir):
    """Both dashboard views of the bundle, registered and read by name."""
    st = Study(spark, sf_dir)
    dashboard.register_views(spark, st.bundle_root())
    cells = spark.table("hourly_dashboard").groupBy("sim_id").agg(
        F.count(F.lit(1)).alias("n_cells"), (F.rint(F.sum(F.col("value").cast("double")) * 1000) / 1000).alias("value_sum"))
    return (spark.table("run_dashboard").select("sim_id", "run_status", "annual_total_heating_j")
            .join(cells, on="sim_id", how="left"))


@register("scan_pruned_point", o.q(o.HOURLY_FX, select="""
SELECT sim_id, datetime, zone_click FROM fx_hourly_wide WHERE sim_id = 42"""))
def q_scan_pruned_point(spark, sf_dir):
    """S3 + S4 + P12 + P4 (+ S10): the hourly table compacted to zstd Parquet
    clustered by sim_id, then one run's column subset read back; the filter
    and the column list reach the Parquet scan."""
    st = Study(spark, sf_dir)
    path = work_dir(spark, "hourly-compacted")
    dashboard.write_sparse(st.hourly_wide, path, sort_cols=("sim_id", "datetime"))
    return (spark.read.parquet(path).where(F.col("sim_id") == 42)
            .select("sim_id", "datetime", "zone_click"))


@register("compaction_roundtrip", o.q(o.HOURLY_FX + o.ZONE_FX, o.CTE_ZONES, o.cte_hourly(), o.cte_sparse(),
                                      select="SELECT * FROM sp"))
def q_compaction_roundtrip(spark, sf_dir):
    """C14 + S9-S16: the published sparse fact, zstd Parquet clustered by run and hour, read back."""
    return Study(spark, sf_dir).published("hourly_sparse")


@register("dashboard_rebuild", o.q(o.RUN_FX + o.HOURLY_FX, o.CTE_RUNS, o.cte_hourly(), select="""
SELECT r.*, s.annual_total_heating_j, s.nonzero_hour_count, s.nonzero_zone_observation_count,
  s.peak_hour_total_heating_j, s.peak_hour_index, s.peak_datetime, s.peak_timestamp
FROM runs r LEFT JOIN rsc s ON r.sim_id = s.sim_id"""))
def q_dashboard_rebuild(spark, sf_dir):
    """S16 + S11: a bundle written, overwritten in ``dashboard_only`` mode from
    the consolidated tables alone, and its run dashboard read back."""
    st = Study(spark, sf_dir)
    out = work_dir(spark, "bundle-rebuilt")
    args = dict(design=st.design, zone_mapping=st.zone_mapping, batch_size=BATCH_SIZE, mode="overwrite")
    dashboard.export_bundle(out, **args, hourly_wide=None, summary=st.summary, timing=None)
    paths = rebuild_dashboard(spark, st.consolidated(), out=out, **args)
    return dashboard.run_dashboard(spark.read.parquet(paths["runs"]), spark.read.parquet(paths["run_stats"]))


@register("json_objects", o.q(("fx_json",), select="""
SELECT event_id, c.key AS object_class, n.key AS object_name, f.key AS field, CAST(f.value AS VARCHAR) AS value
FROM fx_json, json_each(doc) c, json_each(c.value) n, json_each(n.value) f"""))
def q_json_objects(spark, sf_dir):
    """S6 + F14: model documents parsed and exploded to one row per field."""
    st = Study(spark, sf_dir)
    return explode_model(st.fx.fx_json, "doc", ["event_id"])


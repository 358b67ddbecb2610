"""Registry of named queries: each reads the tables of one data directory,
runs the library's operators, and returns a DataFrame; most carry a DuckDB
statement (``oracle_sql``) that recomputes the same result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.functions.names import normalize_name_table
from hypercube.functions.timefmt import hour24_timestamp
from hypercube.operators import hourly, runs as runs_ops, timing, zones
from hypercube.plans import dashboard
from hypercube.plans import oracle_sql as o
from hypercube.plans.study import BATCH_SIZE, Study
from hypercube.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_modules()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracles() -> dict[str, str]:
    _load_modules()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_modules() -> None:
    # registering modules import this one; importing them fills REGISTRY
    from hypercube.plans import queries_model, queries_results, queries_stream  # noqa: F401


HOURLY = o.HOURLY_FX + o.ZONE_FX
ZL = ", ".join(o.ZONES)

# --- hourly marts ----------------------------------------------------------


@register("hour24_timestamp", o.q(o.HOURLY_FX, select=f"""
SELECT datetime, {o.ts_sql('datetime')} AS timestamp FROM (SELECT DISTINCT datetime FROM fx_hourly_wide) d"""))
def q_hour24_timestamp(spark, sf_dir):
    """F1 over every distinct simulator stamp of the hourly table."""
    st = Study(spark, sf_dir)
    return (st.hourly_wide.select("datetime").distinct()
            .select("datetime", hour24_timestamp("datetime").alias("timestamp")))


@register("hour_index", o.q(o.HOURLY_FX, o.cte_hourly(), select="""
SELECT sim_id, datetime, hour_index FROM hi"""))
def q_hour_index(spark, sf_dir):
    """Per-run hour ordinal in stamp order."""
    st = Study(spark, sf_dir)
    return hourly.with_hour_index(st.hourly_wide).select("sim_id", "datetime", "hour_index")


@register("calendar", o.q(o.HOURLY_FX, o.cte_hourly(), select="""
SELECT hour_index, datetime, timestamp FROM cal ORDER BY hour_index"""))
def q_calendar(spark, sf_dir):
    """W2 + F1 + O2: calendar of the reference run, ordered by hour."""
    st = Study(spark, sf_dir)
    return st.marts["calendar"].orderBy("hour_index")


@register("run_stats", o.q(o.HOURLY_FX, o.cte_hourly(), select="SELECT * FROM rsc"))
def q_run_stats(spark, sf_dir):
    """C10 stats part: A14 row totals, A3 sums, A4 earliest peak, J9 stamp lookup."""
    return Study(spark, sf_dir).marts["run_stats"]


@register("hourly_sparse", o.q(HOURLY, o.CTE_ZONES, o.cte_hourly(), o.cte_sparse(), select="""
SELECT * FROM sp"""))
def q_hourly_sparse(spark, sf_dir):
    """C10 fact part: unpivot (P17), keep non-zero/NULL/NaN (P3), zone ids."""
    return Study(spark, sf_dir).marts["hourly_sparse"]


@register("zero_fraction", o.q(o.HOURLY_FX, o.cte_hourly(), select=f"""
SELECT CAST(count(*) * {len(o.ZONES)} AS BIGINT) AS total_cells, CAST(coalesce(sum(nonzero_cells), 0) AS BIGINT) AS nonzero_cells,
  CASE WHEN count(*) > 0 THEN {o.re_sql(f'1.0E0 - sum(nonzero_cells) / (count(*) * {len(o.ZONES)}.0E0)', 6)} ELSE 0.0E0 END AS hourly_zero_fraction
FROM hi"""))
def q_zero_fraction(spark, sf_dir):
    """A5: cells, non-zero cells and the zero fraction of the wide table."""
    return Study(spark, sf_dir).marts["zero_fraction"]


@register("heating_season_rows", o.q(o.HOURLY_FX, select=f"""
SELECT sim_id, datetime, {ZL}, {o.row_total_sql()} AS row_total FROM fx_hourly_wide
WHERE {o.row_total_sql()} > 0"""))
def q_heating_season_rows(spark, sf_dir):
    """A14 + P11 + P5: wide rows whose zone total is positive."""
    st = Study(spark, sf_dir)
    wide = st.hourly_wide
    zs = hourly.zone_columns(wide)
    return (hourly.with_row_aggregates(wide, zs).where(F.col("row_total") > 0)
            .select("sim_id", "datetime", *zs, "row_total"))


_STAMP = "concat(' 01/', lpad(CAST(CAST(floor(h / 24) AS INT) + 1 AS VARCHAR), 2, '0'), '  ', lpad(CAST(h % 24 + 1 AS VARCHAR), 2, '0'), ':00:00')"


@register("many_zones_rows", o.q(("fx_many_zones_long",), select=f"""
SELECT sim_id, {_STAMP} AS datetime, sum(CAST(value AS DOUBLE)) AS row_total, CAST(count(*) FILTER (WHERE value <> 0) AS INTEGER) AS nonzero_cells
FROM fx_many_zones_long GROUP BY sim_id, h"""))
def q_many_zones_rows(spark, sf_dir):
    """A14 + P11 on a model of 1,024 zones: row totals and non-zero cells."""
    wide = Study(spark, sf_dir).many_zones_wide
    return hourly.with_row_aggregates(wide).select("sim_id", "datetime", "row_total", "nonzero_cells")


@register("many_zones_stats", o.q(("fx_many_zones_long",), """
mr AS (SELECT sim_id, h, sum(CAST(value AS DOUBLE)) AS t, count(*) FILTER (WHERE value <> 0) AS nz FROM fx_many_zones_long GROUP BY 1, 2),
mi AS (SELECT *, row_number() OVER (PARTITION BY sim_id ORDER BY h) - 1 AS hour_index FROM mr),
mp AS (SELECT sim_id, arg_max(hour_index, (t, -hour_index)) AS ph, max(t) AS pv, sum(t) AS a, count(*) FILTER (WHERE nz > 0) AS nh, sum(nz) AS nc FROM mi GROUP BY 1)""",
                                  select="""
SELECT sim_id, a AS annual_total_heating_j, CAST(nh AS INTEGER) AS nonzero_hour_count, CAST(nc AS INTEGER) AS nonzero_zone_observation_count,
  CASE WHEN pv > 0 THEN pv ELSE 0.0E0 END AS peak_hour_total_heating_j, CAST(CASE WHEN pv > 0 THEN ph ELSE 0 END AS INTEGER) AS peak_hour_index FROM mp"""))
def q_many_zones_stats(spark, sf_dir):
    """A3 + A4 + W1 on a model of 1,024 zones: run statistics."""
    wide = Study(spark, sf_dir).many_zones_wide
    return hourly.run_stats(hourly.with_hour_index(hourly.with_row_aggregates(wide)))


@register("many_zones_sparse", o.q(("fx_many_zones_long",), """
mh AS (SELECT DISTINCT sim_id, h FROM fx_many_zones_long),
mi AS (SELECT sim_id, h, row_number() OVER (PARTITION BY sim_id ORDER BY h) - 1 AS hour_index FROM mh)""", select="""
SELECT l.sim_id, CAST(mi.hour_index AS INTEGER) AS hour_index, l.zone AS zone_id, l.value
FROM fx_many_zones_long l JOIN mi ON l.sim_id = mi.sim_id AND l.h = mi.h WHERE l.value <> 0"""))
def q_many_zones_sparse(spark, sf_dir):
    """C10 + P17 + J10 on a model of 1,024 zones: the sparse fact."""
    wide = Study(spark, sf_dir).many_zones_wide
    catalog = spark.range(1024).select(F.col("id").cast("int").alias("zone_id"), F.concat(F.lit("zone_"), F.col("id").cast("string")).alias("zone_label"))
    return hourly.sparse_fact(hourly.with_hour_index(wide), catalog)


@register("hourly_join_params", o.q(o.HOURLY_FX + ("fx_design",), select=f"""
SELECT h.sim_id, h.datetime, {", ".join('h.' + z for z in o.ZONES)}, {", ".join('d.' + c for c in o.DESIGN_COLS)}
FROM fx_hourly_wide h JOIN fx_design d ON h.sim_id = d.sim_id"""))
def q_hourly_join_params(spark, sf_dir):
    """J8 + P4: hourly rows with their run's parameters (inner join on sim_id)."""
    st = Study(spark, sf_dir)
    wide = st.hourly_wide
    zs = hourly.zone_columns(wide)
    return (wide.join(st.design, on="sim_id", how="inner")
            .select("sim_id", "datetime", *zs, *o.DESIGN_COLS))


@register("unknown_zone_labels", o.q(("fx_zone",), o.CTE_ZONES, select="""
SELECT zone_label FROM (VALUES ('zone_click'), ('zone_purchase'), ('zone_signup'), ('zone_view'), ('zone_error')) v(zone_label)
WHERE zone_label NOT IN (SELECT zone_label FROM zc) ORDER BY zone_label"""))
def q_unknown_zone_labels(spark, sf_dir):
    """J7 + Q1 + U3: hourly zone columns the catalog lacks (the unheated zone)."""
    st = Study(spark, sf_dir)
    return hourly.unknown_zone_labels(st.hourly_wide_all, st.zone_catalog)


# --- zones -----------------------------------------------------------------


@register("zone_catalog", o.q(o.ZONE_FX, o.CTE_ZONES, select="SELECT * FROM zc"))
def q_zone_catalog(spark, sf_dir):
    """Heated zones with dense ids and labels."""
    return Study(spark, sf_dir).zone_catalog


@register("cluster_counts", o.q(o.ZONE_FX, o.CTE_ZONES, select="""
SELECT cluster, count(*) AS n_zones, count(DISTINCT zone_name) AS n_distinct_zones,
  count(*) FILTER (WHERE is_heated) AS n_heated FROM zm GROUP BY cluster"""))
def q_cluster_counts(spark, sf_dir):
    """A11 + P2 + A13: zones per cluster."""
    return zones.cluster_counts(Study(spark, sf_dir).zone_mapping)


# --- runs, dashboard, audits -----------------------------------------------


@register("runs_mart", o.q(o.RUN_FX, o.CTE_RUNS, select="SELECT * FROM runs"))
def q_runs_mart(spark, sf_dir):
    """C11: design + summary + timing, flags and run status."""
    return Study(spark, sf_dir).runs


@register("run_dashboard", o.q(o.RUN_FX + o.HOURLY_FX, o.CTE_RUNS, o.cte_hourly(), select="""
SELECT r.*, s.annual_total_heating_j, s.nonzero_hour_count, s.nonzero_zone_observation_count,
  s.peak_hour_total_heating_j, s.peak_hour_index, s.peak_datetime, s.peak_timestamp
FROM runs r LEFT JOIN rsc s ON r.sim_id = s.sim_id"""))
def q_run_dashboard(spark, sf_dir):
    """Flagship (J3 + C15): every run with KPIs, status and hourly statistics."""
    return Study(spark, sf_dir).run_dashboard()


@register("hourly_dashboard", o.q(HOURLY, o.CTE_ZONES, o.cte_hourly(), o.cte_sparse(), select="""
SELECT sp.sim_id, sp.hour_index, c.datetime, c.timestamp, zc.zone_id, zc.zone_name, zc.cluster, zc.area_sqm, sp.value
FROM sp JOIN cal c ON sp.hour_index = c.hour_index JOIN zc ON sp.zone_id = zc.zone_id"""))
def q_hourly_dashboard(spark, sf_dir):
    """J4 + J5: sparse fact with calendar and zone attributes."""
    return Study(spark, sf_dir).hourly_dashboard()


@register("limit_ordered", o.q(HOURLY, o.CTE_ZONES, o.cte_hourly(), o.cte_sparse(), select="""
SELECT sp.sim_id, sp.hour_index, c.datetime, c.timestamp, zc.zone_id, zc.zone_name, zc.cluster, zc.area_sqm, sp.value
FROM sp JOIN cal c ON sp.hour_index = c.hour_index JOIN zc ON sp.zone_id = zc.zone_id
WHERE sp.sim_id = 42 ORDER BY sp.hour_index, zc.zone_id LIMIT 20"""))
def q_limit_ordered(spark, sf_dir):
    """O5 + O4 + P12: the documented point lookup, first 20 cells of run 42
    in hour and zone order (a top-k report; the limit is the feature)."""
    return (Study(spark, sf_dir).hourly_dashboard().where(F.col("sim_id") == 42)
            .orderBy("hour_index", "zone_id").limit(20))


@register("run_dashboard_head", o.q(o.RUN_FX + o.HOURLY_FX, o.CTE_RUNS, o.cte_hourly(), select="""
SELECT r.*, s.annual_total_heating_j, s.nonzero_hour_count, s.nonzero_zone_observation_count,
  s.peak_hour_total_heating_j, s.peak_hour_index, s.peak_datetime, s.peak_timestamp
FROM runs r LEFT JOIN rsc s ON r.sim_id = s.sim_id ORDER BY r.sim_id LIMIT 5"""))
def q_run_dashboard_head(spark, sf_dir):
    """The documented first look at the dashboard, five runs (in run
    order, as the published runs table is stored; the limit is the feature)."""
    return Study(spark, sf_dir).run_dashboard().orderBy("sim_id").limit(5)


@register("ok_run_totals", o.q(o.RUN_FX + o.HOURLY_FX, o.CTE_RUNS, o.cte_hourly(), select="""
SELECT r.sim_id, s.annual_total_heating_j FROM runs r LEFT JOIN rsc s ON r.sim_id = s.sim_id
WHERE r.run_status = 'ok'"""))
def q_ok_run_totals(spark, sf_dir):
    """The documented annual totals of successful runs only."""
    return (Study(spark, sf_dir).run_dashboard().where(F.col("run_status") == "ok")
            .select("sim_id", "annual_total_heating_j"))


@register("manifest", o.q(HOURLY + o.RUN_FX, o.CTE_ZONES, o.CTE_RUNS, o.cte_hourly(), o.cte_sparse(), select=f"""
SELECT CAST(1 AS INTEGER) AS schema_version, 'full_consolidation' AS export_mode, '' AS study_folder,
  CAST((SELECT count(*) FROM runs) AS INTEGER) AS n_runs, CAST((SELECT count(*) FROM zc) AS INTEGER) AS n_heated_zones,
  CAST((SELECT count(*) FROM cal) AS INTEGER) AS n_calendar_hours, (SELECT count(*) FROM sp) AS n_sparse_rows,
  (SELECT {o.re_sql(f'1.0E0 - sum(nonzero_cells) / (count(*) * {len(o.ZONES)}.0E0)', 6)} FROM hi) AS hourly_zero_fraction,
  true AS has_timing_data, '' AS source_hourly_path"""))
def q_manifest(spark, sf_dir):
    """C16 + A12: bundle manifest (creation stamp left out for comparison).
    The number of sparse rows is the number of cells that stay."""
    st = Study(spark, sf_dir)
    m = st.marts
    return dashboard.manifest(spark, runs=st.runs, zone_catalog=st.published("zone_catalog"),
                              calendar=m["calendar"], zero_fraction=m["zero_fraction"], has_timing=True,
                              with_timestamp=False)


@register("column_catalog", o.q(o.RUN_FX, o.CTE_RUNS, """
cols(ordinal, column_name) AS (VALUES (0, 'sim_id'), (1, 'f_wall'), (2, 'f_roof'), (3, 'f_win'), (4, 'setpoint'),
  (5, 'hours'), (6, 'inf'), (7, 'vent'), (8, 'misc'), (9, 'shgc'), (10, 's_hours'), (11, 's_close'), (12, 'cop'),
  (13, 'kwh_sqm_ground'), (14, 'kwh_sqm_middle'), (15, 'kwh_sqm_top'), (16, 'batch_id'), (17, 'input_format'),
  (18, 'energyplus_sec'), (19, 'model_load_sec'), (20, 'sim_total_sec'), (21, 'energyplus_returncode'),
  (22, 'has_summary'), (23, 'has_timing'), (24, 'run_status')),
descr(column_name, description) AS (VALUES ('sim_id', 'Simulation identifier'),
  ('f_wall', 'Envelope aging factor for exterior walls'), ('f_roof', 'Envelope aging factor for roofs'),
  ('f_win', 'Envelope aging factor for windows'), ('setpoint', 'Heating setpoint in Celsius'),
  ('hours', 'Heating schedule hours selector'), ('inf', 'Infiltration rate in air changes per hour'),
  ('vent', 'Ventilation rate in air changes per hour'), ('misc', 'Miscellaneous internal gains in W/m2'),
  ('shgc', 'Solar heat gain coefficient'), ('s_hours', 'Shading schedule hours selector'),
  ('s_close', 'Shading close hour selector'), ('cop', 'Boiler coefficient of performance'),
  ('kwh_sqm_ground', 'Heating energy intensity for ground floor zones'),
  ('kwh_sqm_middle', 'Heating energy intensity for middle floor zones'),
  ('kwh_sqm_top', 'Heating energy intensity for top floor zones'),
  ('run_status', 'Run outcome derived from EnergyPlus return code and outputs'),
  ('has_summary', 'Whether aggregated simulation outputs were produced'),
  ('has_timing', 'Whether timing instrumentation data was produced')),
nv AS (UNPIVOT (SELECT count(COLUMNS(*)) FROM runs) ON COLUMNS(*) INTO NAME column_name VALUE n_values)""", select="""
SELECT CAST(c.ordinal AS INTEGER) AS ordinal, c.column_name,
  CASE WHEN c.column_name = 'sim_id' THEN 'identifier'
       WHEN c.column_name IN ('f_wall','f_roof','f_win','setpoint','hours','inf','vent','misc','shgc','s_hours','s_close','cop') THEN 'parameter'
       WHEN starts_with(c.column_name, 'kwh_sqm_') THEN 'summary_kpi'
       WHEN ends_with(c.column_name, '_sec') OR c.column_name IN ('batch_id','input_format','energyplus_returncode') THEN 'runtime'
       WHEN c.column_name IN ('run_status','has_summary','has_timing') THEN 'status'
       ELSE 'metric' END AS group_name,
  coalesce(d.description, '') AS description, nv.n_values
FROM cols c LEFT JOIN descr d ON c.column_name = d.column_name JOIN nv ON nv.column_name = c.column_name"""))
def q_column_catalog(spark, sf_dir):
    """C12 + P15: group, description and number of values of every runs column."""
    return runs_ops.column_catalog(Study(spark, sf_dir).runs)


@register("normalize_names", o.q(("fx_raw_output", "fx_clashing_name"), select=r"""
WITH names AS (
  SELECT DISTINCT 'orderpriority' AS source, o_orderpriority AS name FROM orders
  UNION SELECT DISTINCT 'orderstatus', o_orderstatus FROM orders
  UNION SELECT DISTINCT 'linestatus', l_linestatus FROM lineitem
  UNION SELECT DISTINCT 'returnflag', l_returnflag FROM lineitem
  UNION SELECT DISTINCT 'mktsegment', c_mktsegment FROM customer
  UNION SELECT DISTINCT 'header', header FROM fx_raw_output UNION SELECT source, name FROM fx_clashing_name),
n0 AS (SELECT source, name, lower(regexp_replace(regexp_replace(trim(name), '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g')) AS s FROM names),
n1 AS (SELECT source, name, CASE WHEN s = '' THEN 'col' WHEN regexp_matches(s, '^[0-9]') THEN 'col_' || s ELSE s END AS normalized FROM n0),
n2 AS (SELECT *, row_number() OVER (ORDER BY source, name) AS i FROM n1),
step AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS used, '' AS deduped
  UNION ALL
  SELECT n2.i, list_append(step.used, f.c), f.c FROM step JOIN n2 ON n2.i = step.i + 1,
    LATERAL (SELECT CASE WHEN NOT list_contains(step.used, n2.normalized) THEN n2.normalized
      ELSE n2.normalized || '_' || CAST(list_min(list_filter(range(2, len(step.used) + 3), lambda k: NOT list_contains(step.used, n2.normalized || '_' || CAST(k AS VARCHAR)))) AS VARCHAR) END AS c) f)
SELECT n2.source, n2.name, n2.normalized, step.deduped FROM n2 JOIN step ON n2.i = step.i"""))
def q_normalize_names(spark, sf_dir):
    """F5 + W7: normalise categorical values and simulator headers as
    identifiers; taken ones get the first free suffix in (source, name) order."""
    st = Study(spark, sf_dir)
    fx = st.fx
    t = lambda name: read_table(spark, sf_dir, name)
    parts = [
        t("orders").select(F.lit("orderpriority").alias("source"), F.col("o_orderpriority").alias("name")),
        t("orders").select(F.lit("orderstatus"), F.col("o_orderstatus")),
        t("lineitem").select(F.lit("linestatus"), F.col("l_linestatus")),
        t("lineitem").select(F.lit("returnflag"), F.col("l_returnflag")),
        t("customer").select(F.lit("mktsegment"), F.col("c_mktsegment")),
        fx.fx_raw_output.select(F.lit("header"), F.col("header")),
        fx.fx_clashing_name,
    ]
    names = parts[0]
    for p in parts[1:]:
        names = names.union(p)
    return normalize_name_table(names.distinct(), "name", ["source", "name"])


@register("batch_timing", o.q(("fx_timing", "fx_design"), select=f"""
SELECT batch_id, min(input_format) AS input_format, CAST(count(*) AS INTEGER) AS n_sims,
  min(sim_id) AS first_sim, max(sim_id) AS last_sim,
  {o.re_sql('median(energyplus_sec)', 6)} AS median_energyplus_sec, {o.re_sql('avg(energyplus_sec)', 6)} AS mean_energyplus_sec,
  {o.re_sql('median(model_load_sec)', 6)} AS median_model_load_sec, {o.re_sql('avg(model_load_sec)', 6)} AS mean_model_load_sec,
  {o.re_sql('median(sim_total_sec)', 6)} AS median_sim_total_sec, {o.re_sql('avg(sim_total_sec)', 6)} AS mean_sim_total_sec,
  CAST((batch_id - 1) * {BATCH_SIZE} + 1 AS INTEGER) AS start_sim,
  CAST(least(batch_id * {BATCH_SIZE}, (SELECT count(*) FROM fx_design)) AS INTEGER) AS end_sim,
  CAST(ceil(min(sim_id) / {BATCH_SIZE}.0E0) AS INTEGER) = batch_id AND CAST(ceil(max(sim_id) / {BATCH_SIZE}.0E0) AS INTEGER) = batch_id AS batch_matches_design
FROM fx_timing GROUP BY batch_id"""))
def q_batch_timing(spark, sf_dir):
    """A8 + P10 + F17: per-batch medians and means, design slice of each batch."""
    st = Study(spark, sf_dir)
    n_runs = st.design.agg(F.count(F.lit(1))).scalar()
    return timing.batch_timing(st.timing, BATCH_SIZE, n_runs)


@register("study_timing", o.q(("fx_timing",), select=f"""
SELECT CAST(count(DISTINCT batch_id) AS INTEGER) AS n_batches, CAST(count(*) AS INTEGER) AS n_sims,
  {o.re_sql('median(energyplus_sec)', 6)} AS median_energyplus_sec, {o.re_sql('avg(energyplus_sec)', 6)} AS mean_energyplus_sec,
  {o.re_sql('median(model_load_sec)', 6)} AS median_model_load_sec, {o.re_sql('avg(model_load_sec)', 6)} AS mean_model_load_sec,
  {o.re_sql('median(sim_total_sec)', 6)} AS median_sim_total_sec, {o.re_sql('avg(sim_total_sec)', 6)} AS mean_sim_total_sec
FROM fx_timing"""))
def q_study_timing(spark, sf_dir):
    """Study-wide timing summary."""
    return timing.study_timing(Study(spark, sf_dir).timing)


@register("missing_runs_audit", o.q(o.RUN_FX, o.CTE_RUNS, select=f"""
SELECT CAST(ceil(sim_id / {BATCH_SIZE}.0E0) AS INTEGER) AS batch_id, count(*) AS n_runs,
  count(*) FILTER (WHERE has_summary) AS n_done, count(*) FILTER (WHERE run_status = 'ok') AS n_ok,
  count(*) FILTER (WHERE run_status = 'failed') AS n_failed, count(*) FILTER (WHERE run_status = 'summary_only') AS n_summary_only,
  count(*) FILTER (WHERE run_status = 'missing') AS n_missing, min(sim_id) AS first_sim, max(sim_id) AS last_sim,
  {o.re_sql("least(count(*) FILTER (WHERE has_summary), count(*)) * 100.0E0 / count(*)", 2)} AS pct_done
FROM runs GROUP BY 1"""))
def q_missing_runs_audit(spark, sf_dir):
    """Q2 + A18: per batch, finished, failed and missing runs, percent done."""
    return runs_ops.missing_runs_audit(Study(spark, sf_dir).runs, BATCH_SIZE)


@register("run_status_histogram", o.q(o.RUN_FX, o.CTE_RUNS, select="""
SELECT run_status, count(*) AS n_runs FROM runs GROUP BY run_status"""))
def q_run_status_histogram(spark, sf_dir):
    """Runs per state."""
    return runs_ops.run_status_histogram(Study(spark, sf_dir).runs)


@register("duplicate_runs", o.q(("fx_summary_repeated", "fx_timing"), select="""
SELECT source, sim_id, count(*) AS n_rows FROM (
  SELECT 'summary' AS source, sim_id FROM fx_summary_repeated UNION ALL SELECT 'timing', sim_id FROM fx_timing) u
GROUP BY source, sim_id HAVING count(*) > 1"""))
def q_duplicate_runs(spark, sf_dir):
    """Q3: run ids repeated within the summary or the timing table."""
    st = Study(spark, sf_dir)
    return runs_ops.duplicate_run_ids({"summary": st.fx.fx_summary_repeated, "timing": st.timing})

"""DuckDB statements that recompute each registered query independently.

They read only the driver's base views; the study inputs are inlined as the
fixture CTEs of ``hypercube.sources.fixtures``.  Formulations are chosen to
be independent of the Spark plans (plain ``row_number`` instead of sliced
ordinals, a self-join for the earliest peak instead of ``max(struct)``).
"""

from __future__ import annotations

from hypercube.sources.fixtures import with_fixtures

ZONES = ("zone_click", "zone_purchase", "zone_signup", "zone_view")
DESIGN_COLS = ("f_wall", "f_roof", "f_win", "setpoint", "hours", "inf", "vent", "misc", "shgc",
               "s_hours", "s_close", "cop")


def re_sql(x: str, n: int) -> str:
    """NumPy-style half-even rounding to n places."""
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def ts_sql(x: str) -> str:
    """Hour-24 stamp parse (blank -> NULL)."""
    t = rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
    pat = r"'^(\d+)/(\d+) (\d+):(\d+):(\d+)$'"
    p = [f"TRY_CAST(regexp_extract({t}, {pat}, {i}) AS INTEGER)" for i in range(1, 6)]
    return (f"(CASE WHEN length({t}) > 0 THEN make_timestamp(2001, {p[0]}, {p[1]}, 0, {p[3]}, "
            f"CAST({p[4]} AS DOUBLE)) + to_hours({p[2]}) END)")


def missing_sql(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))"


def row_total_sql(zones=ZONES) -> str:
    anym = " OR ".join(missing_sql(z) for z in zones)
    tot = " + ".join(f"CAST({z} AS DOUBLE)" for z in zones)
    return f"(CASE WHEN {anym} THEN NULL ELSE {tot} END)"


def nonzero_sql(zones=ZONES) -> str:
    return " + ".join(f"(CASE WHEN {missing_sql(z)} OR {z} <> 0 THEN 1 ELSE 0 END)" for z in zones)


# --- shared CTE blocks (each ends without a trailing comma) ----------------

CTE_ZONES = """
zm AS (SELECT zone_name, is_heated, z_level, area_sqm,
  CASE WHEN NOT is_heated THEN 'EXCLUDED'
       WHEN z_level = (SELECT min(z_level) FROM fx_zone WHERE is_heated) THEN 'GROUND'
       WHEN z_level = (SELECT max(z_level) FROM fx_zone WHERE is_heated) THEN 'TOP'
       ELSE 'MIDDLE' END AS cluster FROM fx_zone),
zc AS (SELECT CAST(row_number() OVER (ORDER BY zone_name) - 1 AS INTEGER) AS zone_id, zone_name,
  'zone_' || zone_name AS zone_label, cluster, z_level, area_sqm, is_heated FROM zm WHERE is_heated)"""


def cte_hourly(src: str = "fx_hourly_wide", zones=ZONES) -> str:
    zl = ", ".join(zones)
    return f"""
hw AS (SELECT sim_id, datetime, {zl}, {ts_sql('datetime')} AS timestamp FROM {src}),
hi AS (SELECT *, CAST(row_number() OVER (PARTITION BY sim_id ORDER BY timestamp ASC NULLS FIRST, datetime) - 1 AS INTEGER) AS hour_index,
  {row_total_sql(zones)} AS row_total, CAST({nonzero_sql(zones)} AS INTEGER) AS nonzero_cells FROM hw),
cal AS (SELECT hour_index, datetime, timestamp FROM hi WHERE sim_id = (SELECT min(sim_id) FROM hi)),
rs0 AS (SELECT sim_id, {re_sql('coalesce(sum(row_total), 0)', 6)} AS annual_total_heating_j,
  CAST(sum(CASE WHEN nonzero_cells > 0 THEN 1 ELSE 0 END) AS INTEGER) AS nonzero_hour_count,
  CAST(sum(nonzero_cells) AS INTEGER) AS nonzero_zone_observation_count, max(row_total) AS pv
  FROM hi GROUP BY sim_id),
pk AS (SELECT h.sim_id, min(h.hour_index) AS ph FROM hi h JOIN rs0 r ON h.sim_id = r.sim_id AND h.row_total = r.pv GROUP BY h.sim_id),
rs AS (SELECT r.sim_id, r.annual_total_heating_j, r.nonzero_hour_count, r.nonzero_zone_observation_count,
  CASE WHEN r.pv > 0 THEN r.pv ELSE 0.0E0 END AS peak_hour_total_heating_j,
  CAST(CASE WHEN r.pv > 0 THEN pk.ph ELSE 0 END AS INTEGER) AS peak_hour_index
  FROM rs0 r LEFT JOIN pk ON r.sim_id = pk.sim_id),
rsc AS (SELECT rs.*, c.datetime AS peak_datetime, c.timestamp AS peak_timestamp
  FROM rs LEFT JOIN cal c ON rs.peak_hour_index = c.hour_index)"""


def cte_sparse(zones=ZONES) -> str:
    """Needs hi and zc."""
    zl = ", ".join(zones)
    return f"""
lg AS (SELECT sim_id, hour_index, zone_label, value FROM (SELECT sim_id, hour_index, {zl} FROM hi)
  UNPIVOT INCLUDE NULLS (value FOR zone_label IN ({zl}))),
sp AS (SELECT CAST(lg.sim_id AS INTEGER) AS sim_id, lg.hour_index, zc.zone_id, CAST(lg.value AS FLOAT) AS value
  FROM lg JOIN zc ON lg.zone_label = zc.zone_label WHERE {missing_sql('lg.value')} OR lg.value <> 0)"""


CTE_RUNS = """
runs AS (SELECT d.*, s.kwh_sqm_ground, s.kwh_sqm_middle, s.kwh_sqm_top,
  t.batch_id, t.input_format, t.energyplus_sec, t.model_load_sec, t.sim_total_sec, t.energyplus_returncode,
  s.sim_id IS NOT NULL AS has_summary, t.sim_id IS NOT NULL AS has_timing,
  CASE WHEN t.energyplus_returncode IS NULL THEN (CASE WHEN s.sim_id IS NOT NULL THEN 'summary_only' ELSE 'missing' END)
       WHEN t.energyplus_returncode = 0 THEN 'ok' ELSE 'failed' END AS run_status
  FROM fx_design d LEFT JOIN fx_summary s ON d.sim_id = s.sim_id LEFT JOIN fx_timing t ON d.sim_id = t.sim_id)"""

HOURLY_FX = ("fx_hourly_wide",)
ZONE_FX = ("fx_zone",)
RUN_FX = ("fx_design", "fx_summary", "fx_timing")


def q(fixtures, *ctes: str, select: str) -> str:
    body = ",".join(c.strip("\n") for c in ctes)
    if body:
        return with_fixtures(fixtures, f"WITH {body}\n{select}")
    return with_fixtures(fixtures, select)

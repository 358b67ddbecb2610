"""Registered queries: zone mapping, sampling, schedules, scenario edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from hypercube.functions.timefmt import (heating_switch_times, shading_window_from_close,
                                         shading_window_symmetric)
from hypercube.operators import sampling, scenario
from hypercube.plans import oracle_sql as o
from hypercube.plans.queries import register
from hypercube.plans.study import Study
from hypercube.session import work_dir

re_ = o.re_sql

# --- oracle building blocks ------------------------------------------------

CTE_MODEL_MAP = f"""
geo AS (SELECT zone_name, sum(w * d) AS area, avg(z) AS avg_z FROM fx_floor WHERE lower(surface_type) = 'floor' GROUP BY zone_name),
mb AS (SELECT m.zone_name, coalesce(m.has_thermostat, false) AS is_heated, {re_('coalesce(g.avg_z, 0.0E0)', 2)} AS z_level,
  {re_('CASE WHEN coalesce(g.area, 0.0E0) = 0 THEN 20.0E0 ELSE coalesce(g.area, 0.0E0) END', 2)} AS area_sqm
  FROM fx_model_zone m LEFT JOIN geo g ON m.zone_name = g.zone_name),
mzm AS (SELECT zone_name, is_heated, z_level, area_sqm,
  CASE WHEN NOT is_heated THEN 'EXCLUDED'
       WHEN z_level = (SELECT min(z_level) FROM mb WHERE is_heated) THEN 'GROUND'
       WHEN z_level = (SELECT max(z_level) FROM mb WHERE is_heated) THEN 'TOP'
       ELSE 'MIDDLE' END AS cluster FROM mb)"""
MODEL_MAP_FX = ("fx_model_zone", "fx_floor")


def _levels_sql(tag: str, p) -> str:
    k = int(round((float(p.hi) - float(p.lo)) / float(p.step)))
    return (f"SELECT '{tag}' AS p, {re_(f'{float(p.lo)!r}E0 + k * {float(p.step)!r}E0', 3)} AS factor "
            f"FROM range(0, {k + 1}) r(k)")


def _lv(*names: str) -> str:
    parts = [_levels_sql(n, scenario.param(n)) for n in names]
    return "lv AS (" + " UNION ALL ".join(parts) + " UNION ALL SELECT 'none', 1.0E0)"


CTE_LAYERS = """
lp AS (SELECT construction_id, layer_ord, material_id,
  CAST(row_number() OVER (PARTITION BY construction_id ORDER BY layer_ord) AS INTEGER) AS layer_pos,
  count(*) OVER (PARTITION BY construction_id) AS n_layers FROM fx_layer WHERE material_id IS NOT NULL)"""

CTE_FIRST_TOUCH = """
cand AS (SELECT s.surface_ord, s.surface_type, l.layer_ord, l.layer_pos, m.material_id, m.conductivity, m.density, m.thickness
  FROM fx_surface s JOIN lp l ON s.construction_id = l.construction_id JOIN fx_material m ON l.material_id = m.material_id
  WHERE lower(s.outside_boundary) = 'outdoors' AND l.layer_pos < l.n_layers AND m.conductivity > 0.05E0),
ftr AS (SELECT *, row_number() OVER (PARTITION BY material_id ORDER BY surface_ord, layer_ord) AS rk FROM cand),
ft AS (SELECT material_id, surface_ord, layer_ord, layer_pos,
  CASE lower(surface_type) WHEN 'wall' THEN 1 WHEN 'roof' THEN 2 WHEN 'ceiling' THEN 2 ELSE 0 END AS factor_class,
  conductivity, density, thickness, surface_type FROM ftr WHERE rk = 1)"""
FT_FX = ("fx_surface", "fx_layer", "fx_material")

CTE_GLAZING = """
par AS (SELECT surface_ord AS parent_surface FROM fx_surface WHERE zone_name IN (SELECT zone_name FROM mzm WHERE cluster <> 'EXCLUDED')),
gw AS (SELECT w.window_ord, l.material_id AS glazing_id, g.kind, g.u_factor, g.conductivity FROM fx_window w
  JOIN par ON w.parent_surface = par.parent_surface JOIN fx_layer l ON l.construction_id = w.construction_id AND l.layer_ord = 1
  JOIN fx_glazing g ON l.material_id = g.glazing_id
  WHERE lower(w.window_type) = 'window' AND l.material_id NOT IN (SELECT material_id FROM ft)),
gr AS (SELECT *, row_number() OVER (PARTITION BY glazing_id ORDER BY window_ord) AS rk FROM gw),
gft AS (SELECT glazing_id, window_ord, kind, u_factor, conductivity FROM gr WHERE rk = 1)"""
GLZ_FX = FT_FX + MODEL_MAP_FX + ("fx_window", "fx_glazing")

MAT_DELTAS_SELECT = f"""
SELECT ft.material_id, ft.surface_ord, ft.surface_type, ft.layer_ord, ft.layer_pos,
  CASE ft.factor_class WHEN 1 THEN 'f_wall' WHEN 2 THEN 'f_roof' END AS factor_param, lv.factor, ft.thickness,
  ft.conductivity AS old_conductivity, {re_('ft.conductivity * lv.factor', 4)} AS new_conductivity,
  ft.density AS old_density, {re_('ft.density * (1.0E0 + (lv.factor - 1) * 0.5E0)', 1)} AS new_density
FROM ft JOIN lv ON lv.p = CASE ft.factor_class WHEN 1 THEN 'f_wall' WHEN 2 THEN 'f_roof' ELSE 'none' END"""

GLZ_DELTAS_SELECT = f"""
SELECT gft.glazing_id, gft.window_ord, gft.kind, 'f_win' AS factor_param, lv.factor,
  gft.u_factor AS old_u_factor, {re_('gft.u_factor * lv.factor', 3)} AS new_u_factor,
  gft.conductivity AS old_conductivity, {re_('gft.conductivity * lv.factor', 4)} AS new_conductivity
FROM gft JOIN lv ON lv.p = 'f_win'"""


def _model(st: Study):
    fx = st.fx
    return fx.fx_surface, fx.fx_layer, fx.fx_material


# --- zones ------------------------------------------------------------------


@register("zone_mapping", o.q(MODEL_MAP_FX, CTE_MODEL_MAP, select="SELECT * FROM mzm"))
def q_zone_mapping(spark, sf_dir):
    """Model zones -> heated flag (thermostats), floor area and level from
    floor polygons (F12, A9), cluster by heated z extremes (A10, P14, P19)."""
    return Study(spark, sf_dir).model_zone_mapping


# --- sampling ---------------------------------------------------------------


def _lhs_oracle(final: str, space=sampling.SPACE_12) -> str:
    vals = ", ".join(f"('{p.name}', {float(p.lo)!r}E0, {float(p.hi)!r}E0, {float(p.step)!r}E0)"
                     for p in space)
    snap = re_("round_even((lo + u * ((CASE WHEN hi > lo THEN hi ELSE hi + 1e-7 END) - lo)) / step, 0) * step", 3)
    ctes = f"""
ps(name, lo, hi, step) AS (VALUES {vals}),
lg AS (SELECT r.sim_id, p.name, p.lo, p.hi, p.step,
  md5('42:' || p.name || ':' || CAST(r.sim_id AS VARCHAR)) AS h,
  CAST(('0x' || substr(md5('42:j:' || p.name || ':' || CAST(r.sim_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0E0 AS jitter
  FROM fx_design r, ps p),
st AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h, sim_id) AS stratum FROM lg),
un AS (SELECT *, (stratum - 1 + jitter) / (SELECT count(*) FROM fx_design) AS u FROM st),
val AS (SELECT *, {snap} AS value FROM un)"""
    return o.q(("fx_design",), ctes, select=final)


def _lhs_pivot(space=sampling.SPACE_12) -> str:
    cols = []
    for p in space:
        v = f"max(value) FILTER (WHERE name = '{p.name}')"
        cols.append(f"CAST({v} AS INTEGER) AS {p.name}" if p.is_int else f"{v} AS {p.name}")
    return f"SELECT sim_id, {', '.join(cols)} FROM val GROUP BY sim_id"


@register("lhs_design", _lhs_oracle(_lhs_pivot()))
def q_lhs_design(spark, sf_dir):
    """A seeded Latin Hypercube design over the study's runs (12-parameter
    space): stratum permutation (W5), jitter, scale and step snap (F7, F16), pivot."""
    st = Study(spark, sf_dir)
    return sampling.lhs_design(st.design.select("sim_id"), sampling.SPACE_12, seed=42)


@register("lhs_design_11", _lhs_oracle(_lhs_pivot(sampling.SPACE_11), sampling.SPACE_11))
def q_lhs_design_11(spark, sf_dir):
    """D1 + C2: the design over the 11-parameter space, the space read from a table."""
    st = Study(spark, sf_dir)
    path = work_dir(spark, "parameter-space")
    sampling.space_frame(spark, sampling.SPACE_11).write.parquet(path)
    return sampling.lhs_design(st.design.select("sim_id"), sampling.space_from_frame(spark.read.parquet(path)), seed=42)


@register("lhs_stratum_check", _lhs_oracle("""
SELECT name, count(*) AS n_runs, count(DISTINCT CAST(floor(u * (SELECT count(*) FROM fx_design)) AS BIGINT)) AS n_strata,
  CAST(min(stratum) AS INTEGER) AS min_stratum, CAST(max(stratum) AS INTEGER) AS max_stratum,
  min(value) AS min_value, max(value) AS max_value,
  count(DISTINCT CAST(floor(u * (SELECT count(*) FROM fx_design)) AS BIGINT)) = count(*) AS all_once
FROM val GROUP BY name"""))
def q_lhs_stratum_check(spark, sf_dir):
    """W5 property: every parameter hits each of the n strata exactly once."""
    runs = Study(spark, sf_dir).design.select("sim_id")
    return sampling.stratum_check(sampling.lhs_long(runs, sampling.SPACE_12, 42), runs)


# --- schedules ----------------------------------------------------------------

SQL_TIMES = """
CASE WHEN hours <= 4 THEN '08:00' WHEN hours <= 8 THEN printf('%02d:00', 10 - (hours - 4)) ELSE '06:00' END AS morning_start,
CASE WHEN hours <= 4 THEN '08:00' ELSE '10:00' END AS morning_end,
CASE WHEN hours <= 4 THEN printf('%02d:00', 22 - hours) WHEN hours <= 8 THEN '18:00' ELSE printf('%02d:00', 22 - (hours - 4)) END AS evening_start,
'22:00' AS evening_end"""


@register("heating_hours_schedule", o.q(("fx_design",), select=f"""
SELECT sim_id, hours, {SQL_TIMES} FROM fx_design"""))
def q_heating_hours_schedule(spark, sf_dir):
    """heating-hours selector -> four switch times per run."""
    d = Study(spark, sf_dir).design
    return d.select("sim_id", "hours", heating_switch_times("hours").alias("t")).select("sim_id", "hours", "t.*")


@register("shading_schedule_close", o.q(("fx_design",), select="""
SELECT sim_id, s_hours, s_close, printf('%02d:00', s_close - s_hours) AS open, printf('%02d:00', s_close) AS close FROM fx_design"""))
def q_shading_schedule_close(spark, sf_dir):
    """shading window ending at the close hour."""
    d = Study(spark, sf_dir).design
    return d.select("sim_id", "s_hours", "s_close",
                    shading_window_from_close("s_hours", "s_close").alias("w")).select(
        "sim_id", "s_hours", "s_close", "w.*")


def _hm(x: str) -> str:
    h = f"CAST(trunc({x}) AS INTEGER)"
    return f"printf('%02d:%02d', {h}, CAST(trunc(({x} - {h}) * 60.0E0) AS INTEGER))"


@register("shading_schedule_symmetric", o.q(("fx_design",), select=f"""
SELECT sim_id, s_hours, {_hm('(14.0E0 - s_hours / 2.0E0)')} AS open, {_hm('(14.0E0 + s_hours / 2.0E0)')} AS close FROM fx_design"""))
def q_shading_schedule_symmetric(spark, sf_dir):
    """F4 (IDF variant): shading window centred on 14:00."""
    d = Study(spark, sf_dir).design
    return d.select("sim_id", "s_hours", shading_window_symmetric("s_hours").alias("w")).select(
        "sim_id", "s_hours", "w.*")


def _fields_sql(items: list[tuple[str, str]]) -> str:
    return "[" + ", ".join(f"{{'t': {t}, 'n': {n}}}" for t, n in items) + "]"


def _sched_oracle(join: str = "", more: str = "") -> str:
    T = lambda s: (f"'{s}'", "CAST(NULL AS DOUBLE)")
    U = lambda e: (f"'Until: ' || {e}", "CAST(NULL AS DOUBLE)")
    N = lambda e: ("CAST(NULL AS VARCHAR)", f"CAST({e} AS DOUBLE)")

    def day(lo, hi):
        return [U("ms"), N(lo), U("me"), N(hi), U("es"), N(lo), U("ee"), N(hi), T("Until: 24:00"), N(lo)]

    def seasonal(lo, hi):
        return ([T("Through: 31 Mar"), T("For: AllDays")] + day(lo, hi)
                + [T("Through: 30 Nov"), T("For: AllDays"), T("Until: 24:00"), N(lo)]
                + [T("Through: 31 Dec"), T("For: AllDays")] + day(lo, hi))
    shading = [T("Through: 31 Dec"), T("For: AllDays"), U("so"), N("shgc"), U("sc"), N("0.0E0"),
               T("Until: 24:00"), N("shgc")]
    scheds = [("Master_Shading_S", "On/Off", shading),
              ("Master_Heating_Setpoint_S", "Temperature", seasonal("12.0E0", "setpoint")),
              ("Master_Heating_Availability_S", "Fraction", seasonal("0.0E0", "1.0E0"))]
    parts = [f"SELECT sim_id, '{n}' AS schedule_name, '{lim}' AS type_limits, {_fields_sql(f)} AS f FROM t"
             for n, lim, f in scheds]
    ctes = f"""
t AS (SELECT sim_id, shgc, setpoint, {SQL_TIMES.replace(' AS morning_start', ' AS ms').replace(' AS morning_end', ' AS me').replace(' AS evening_start', ' AS es').replace(' AS evening_end', ' AS ee')},
  printf('%02d:00', s_close - s_hours) AS so, printf('%02d:00', s_close) AS sc FROM fx_design),
sl AS ({' UNION ALL '.join(parts)})"""
    return o.q(("fx_design",), ctes, select=f"""
SELECT sl.sim_id, schedule_name, type_limits, CAST(generate_subscripts(f, 1) AS INTEGER) AS field_ord,
  unnest(f).t AS field_text, unnest(f).n AS field_number{more} FROM sl {join}""")


@register("compact_schedules", _sched_oracle())
def q_compact_schedules(spark, sf_dir):
    """C5 + F13: the three compact schedules of every run, one row per field."""
    return scenario.schedule_rows(Study(spark, sf_dir).design)


@register("schedule_assignments", o.q(("fx_zone_object", "fx_shading_control"), """
sm AS (SELECT shading_device_material_name AS m FROM fx_shading_control WHERE coalesce(shading_device_material_name, '') <> '' ORDER BY control_ord LIMIT 1)""", select="""
SELECT 'ThermostatSetpoint:DualSetpoint' AS object_class, object_name,
  'heating_setpoint_temperature_schedule_name' AS field, 'Master_Heating_Setpoint_S' AS new_value FROM fx_zone_object
UNION ALL SELECT 'ZoneHVAC:IdealLoadsAirSystem', object_name, 'heating_availability_schedule_name', 'Master_Heating_Availability_S' FROM fx_zone_object
UNION ALL SELECT 'WindowShadingControl', name, 'schedule_name', 'Master_Shading_S' FROM fx_shading_control
UNION ALL SELECT 'WindowShadingControl', name, 'shading_control_type', 'OnIfScheduleAllows' FROM fx_shading_control
UNION ALL SELECT 'WindowShadingControl', name, 'shading_device_material_name', coalesce((SELECT m FROM sm), shading_device_material_name)
FROM fx_shading_control WHERE shading_device_material_name IS NOT NULL"""))
def q_schedule_assignments(spark, sf_dir):
    """J21 + A16: sibling updates, every thermostat, ideal-loads system and
    shading control of the model points at the new schedules (run-independent)."""
    fx = Study(spark, sf_dir).fx
    objects = fx.fx_zone_object.select(F.col("object_name").alias("zone_name"))
    return scenario.schedule_assignments(objects, objects, fx.fx_shading_control)


@register("shade_optics", o.q(("fx_design",), select=f"""
SELECT sim_id, {re_('shgc', 3)} AS solar_transmittance, {re_('1.0E0 - shgc - 0.1E0', 3)} AS solar_reflectance FROM fx_design"""))
def q_shade_optics(spark, sf_dir):
    """transmittance and reflectance of the shading material per run."""
    return scenario.shade_optics(Study(spark, sf_dir).design)


@register("shading_availability", o.q(("fx_design",), f"""
sw AS (SELECT sim_id, {_hm('(14.0E0 - s_hours / 2.0E0)')} AS so, {_hm('(14.0E0 + s_hours / 2.0E0)')} AS sc FROM fx_design),
sl AS (SELECT sim_id, {_fields_sql([("'Through: 31 Dec'", "CAST(NULL AS DOUBLE)"), ("'For: AllDays'", "CAST(NULL AS DOUBLE)"), ("'Until: ' || so", "CAST(NULL AS DOUBLE)"), ("CAST(NULL AS VARCHAR)", "0.0E0"), ("'Until: ' || sc", "CAST(NULL AS DOUBLE)"), ("CAST(NULL AS VARCHAR)", "1.0E0"), ("'Until: 24:00'", "CAST(NULL AS DOUBLE)"), ("CAST(NULL AS VARCHAR)", "0.0E0")])} AS f FROM sw)""", select="""
SELECT sim_id, 'Master_Shading_Availability_S' AS schedule_name, CAST(generate_subscripts(f, 1) AS INTEGER) AS field_ord, unnest(f).t AS field_text, unnest(f).n AS field_number FROM sl"""))
def q_shading_availability(spark, sf_dir):
    """F13 + F4: the shading availability schedule centred on 14:00, one row per field."""
    return scenario.shading_availability_rows(Study(spark, sf_dir).design)


@register("scenario_behavior_log", o.q(("fx_design",), f"""
bt AS (SELECT *, {SQL_TIMES} FROM fx_design)""", select="""
SELECT sim_id, 'BEHAVIOR' AS type, 'Shading_Sch' AS mat_id, 'Shading' AS layer, 'N/A' AS old_val,
  'Open ' || printf('%02d:00', s_close - s_hours) || '-' || printf('%02d:00', s_close) AS new_val FROM bt
UNION ALL SELECT sim_id, 'BEHAVIOR', 'Heating', 'Sched/Setp', 'N/A', CAST(setpoint AS VARCHAR) || 'C (' || morning_start || '-' || evening_end || ')' FROM bt
UNION ALL SELECT sim_id, 'BEHAVIOR', 'Infiltration', 'AirChanges', 'N/A', CAST(inf AS VARCHAR) || ' ACH' FROM bt
UNION ALL SELECT sim_id, 'BEHAVIOR', 'Ventilation', 'FreshAir', CAST(vent AS VARCHAR) || ' ACH', NULL FROM bt
UNION ALL SELECT sim_id, 'BEHAVIOR', 'MiscGains', 'Watts/sqm', 'N/A', CAST(misc AS VARCHAR) FROM bt
UNION ALL SELECT sim_id, 'SYSTEM', 'Boiler', 'COP', '0.75', CAST(cop AS VARCHAR) FROM bt"""))
def q_scenario_behavior_log(spark, sf_dir):
    """The run-specific rows of the legacy change log."""
    return scenario.behavior_log(Study(spark, sf_dir).design)


# --- layers and materials -------------------------------------------------------


@register("layer_stack", o.q(("fx_layer",), CTE_LAYERS, select="""
SELECT construction_id, layer_ord, layer_pos, material_id, layer_pos < n_layers AS editable FROM lp"""))
def q_layer_stack(spark, sf_dir):
    """F19 + W6: ordered layers per construction, the innermost not editable."""
    return scenario.layer_positions(Study(spark, sf_dir).fx.fx_layer)


@register("material_first_touch", o.q(FT_FX, CTE_LAYERS, CTE_FIRST_TOUCH, select="SELECT * FROM ft"))
def q_material_first_touch(spark, sf_dir):
    """W3 + J13: the first outdoor surface and layer reaching each aged material."""
    return scenario.material_first_touch(*_model(Study(spark, sf_dir)))


@register("material_deltas", o.q(FT_FX, CTE_LAYERS, CTE_FIRST_TOUCH, _lv("f_wall", "f_roof"),
                                 select=MAT_DELTAS_SELECT))
def q_material_deltas(spark, sf_dir):
    """C3 + F10: the opaque-material edit dictionary per factor level."""
    ft = scenario.material_first_touch(*_model(Study(spark, sf_dir)))
    return scenario.material_deltas(ft)


@register("glazing_deltas", o.q(GLZ_FX, CTE_LAYERS, CTE_FIRST_TOUCH, CTE_MODEL_MAP, CTE_GLAZING, _lv("f_win"),
                                select=GLZ_DELTAS_SELECT))
def q_glazing_deltas(spark, sf_dir):
    """C4 + J14 + F11: the glazing edit dictionary per window factor level."""
    st = Study(spark, sf_dir)
    ft = scenario.material_first_touch(*_model(st))
    fx = st.fx
    gft = scenario.glazing_first_touch(fx.fx_window, fx.fx_surface, fx.fx_layer, st.model_zone_mapping,
                                       fx.fx_glazing, ft)
    return scenario.glazing_deltas(gft)


@register("scenario_change_log", o.q(GLZ_FX, CTE_LAYERS, CTE_FIRST_TOUCH, CTE_MODEL_MAP, CTE_GLAZING,
                                     _lv("f_wall", "f_roof", "f_win"), f"""
md AS ({MAT_DELTAS_SELECT}), gd AS ({GLZ_DELTAS_SELECT})""", select="""
SELECT factor_param, factor, upper(surface_type) AS type, CAST(material_id AS VARCHAR) AS mat_id,
  'Layer ' || CAST(layer_pos AS VARCHAR) AS layer, CAST(thickness AS DOUBLE) AS thickness,
  old_conductivity AS old_val, new_conductivity AS new_val, old_density AS old_dens, new_density AS new_dens FROM md
UNION ALL
SELECT factor_param, factor, 'WINDOW', CAST(glazing_id AS VARCHAR), 'Glass', CAST(NULL AS DOUBLE),
  coalesce(old_conductivity, old_u_factor), coalesce(new_conductivity, new_u_factor), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM gd"""))
def q_scenario_change_log(spark, sf_dir):
    """C7 + U1: material and window edits in the legacy change-log shape."""
    st = Study(spark, sf_dir)
    ft = scenario.material_first_touch(*_model(st))
    fx = st.fx
    gft = scenario.glazing_first_touch(fx.fx_window, fx.fx_surface, fx.fx_layer, st.model_zone_mapping,
                                       fx.fx_glazing, ft)
    return scenario.change_log(scenario.material_deltas(ft), scenario.glazing_deltas(gft))


def _flow_objects(objs):
    inf = objs.select(F.lit(scenario.INFILTRATION).alias("object_class"), "object_name", "zone_name",
                      F.col("air_changes_per_hour").cast("double"))
    vent = objs.select(F.lit(scenario.VENTILATION).alias("object_class"), "object_name", "zone_name",
                       F.col("air_changes_per_hour").cast("double"))
    return inf.unionByName(vent)


@register("airflow_deltas", o.q(("fx_model_zone", "fx_zone_object"), _lv("inf", "vent"), select="""
SELECT o.object_class, o.object_name, lv.p AS factor_param, lv.factor, m.volume, m.zone_name,
  'Flow/Zone' AS design_flow_rate_calculation_method, (lv.factor * m.volume) / 3600.0E0 AS design_flow_rate
FROM (SELECT 'ZoneInfiltration:DesignFlowRate' AS object_class, 'inf' AS p, object_name, zone_name FROM fx_zone_object
      UNION ALL SELECT 'ZoneVentilation:DesignFlowRate', 'vent', object_name, zone_name FROM fx_zone_object) o
JOIN fx_model_zone m ON o.zone_name = m.zone_name JOIN lv ON lv.p = o.p WHERE m.volume IS NOT NULL"""))
def q_airflow_deltas(spark, sf_dir):
    """C6 + J15 + F9 + P20: infiltration/ventilation edit dictionary per ACH level."""
    fx = Study(spark, sf_dir).fx
    return scenario.airflow_deltas(_flow_objects(fx.fx_zone_object), fx.fx_model_zone)


@register("gain_deltas", o.q(("fx_zone_object",), _lv("misc"), select="""
SELECT 'OtherEquipment' AS object_class, o.object_name, 'misc' AS factor_param, lv.factor,
  'Watts/Area' AS design_level_calculation_method, lv.factor AS power_per_zone_floor_area
FROM fx_zone_object o JOIN lv ON lv.p = 'misc'"""))
def q_gain_deltas(spark, sf_dir):
    """C6 + P20: internal-gain edit dictionary per gain level."""
    eq = Study(spark, sf_dir).fx.fx_zone_object.select("object_name", "design_level")
    return scenario.gain_deltas(eq)


@register("assembly_u_value", o.q(FT_FX, CTE_LAYERS, f"""
pl AS (SELECT s.surface_ord, s.surface_type, s.construction_id IN (SELECT construction_id FROM fx_layer) AS has,
  m.material_id, m.thickness, m.conductivity FROM fx_surface s
  LEFT JOIN lp l ON s.construction_id = l.construction_id LEFT JOIN fx_material m ON l.material_id = m.material_id
  WHERE lower(s.outside_boundary) = 'outdoors'),
ag AS (SELECT surface_ord, surface_type, count(material_id) AS n_materials, coalesce(sum(thickness / nullif(conductivity, 0)), 0.0E0) AS r,
  bool_or(NOT has OR (material_id IS NOT NULL AND (thickness IS NULL OR conductivity IS NULL OR conductivity = 0))) AS bad FROM pl GROUP BY 1, 2)""", select=f"""
SELECT surface_ord, surface_type, n_materials, CASE WHEN NOT bad THEN {re_('0.17E0 + r', 6)} END AS r_total,
  CASE WHEN bad THEN 0.0E0 ELSE {re_('1.0E0 / (0.17E0 + r)', 3)} END AS u_value,
  surface_ord = min(surface_ord) OVER (PARTITION BY surface_type) AS first_of_type FROM ag"""))
def q_assembly_u_value(spark, sf_dir):
    """A15 (legacy): assembly U-value of every outdoor surface."""
    return scenario.assembly_u_value(*_model(Study(spark, sf_dir)))


_DICTIONARIES = f"""
md AS ({MAT_DELTAS_SELECT}), gd AS ({GLZ_DELTAS_SELECT}),
ad AS (SELECT lv.p AS factor_param, lv.factor, (lv.factor * m.volume) / 3600.0E0 AS new_value
  FROM fx_zone_object x JOIN fx_model_zone m ON x.zone_name = m.zone_name JOIN lv ON lv.p IN ('inf', 'vent') WHERE m.volume IS NOT NULL),
ed AS (SELECT factor_param, factor, new_conductivity AS new_value FROM md WHERE factor_param IS NOT NULL
  UNION ALL SELECT factor_param, factor, coalesce(new_conductivity, new_u_factor) FROM gd UNION ALL SELECT * FROM ad
  UNION ALL SELECT 'misc', lv.factor, lv.factor FROM fx_zone_object x JOIN lv ON lv.p = 'misc'),
es AS (SELECT factor_param, factor, count(*) AS n, sum(CAST(round_even(new_value * 10000, 0) AS BIGINT)) AS c FROM ed GROUP BY 1, 2),
rp AS (UNPIVOT (SELECT sim_id, f_wall, f_roof, f_win, inf, vent, misc FROM fx_design) ON f_wall, f_roof, f_win, inf, vent, misc INTO NAME factor_param VALUE v)"""
_GRID = {n: scenario.param(n) for n in ("f_wall", "f_roof", "f_win", "inf", "vent", "misc")}
_LEVEL = "CASE rp.factor_param " + " ".join(
    f"WHEN '{n}' THEN round_even((rp.v - {float(p.lo)!r}E0) / {float(p.step)!r}E0, 0)" for n, p in _GRID.items()) + " END"


@register("run_edits", o.q(GLZ_FX + ("fx_zone_object", "fx_design"), CTE_LAYERS, CTE_FIRST_TOUCH, CTE_MODEL_MAP, CTE_GLAZING,
                           _lv(*_GRID), _DICTIONARIES, select=f"""
SELECT rp.sim_id, rp.factor_param, CAST({_LEVEL} AS INTEGER) AS level, coalesce(es.n, 0) AS n_objects, CAST(coalesce(es.c, 0) AS BIGINT) AS checksum
FROM rp LEFT JOIN es ON es.factor_param = rp.factor_param AND abs(es.factor - rp.v) < 1e-6"""))
def q_run_edits(spark, sf_dir):
    """J18 + S14: per run and parameter the level, the number of objects that
    the run edits through it and a checksum of the new values."""
    st = Study(spark, sf_dir)
    fx = st.fx
    ft = scenario.material_first_touch(*_model(st))
    gft = scenario.glazing_first_touch(fx.fx_window, fx.fx_surface, fx.fx_layer, st.model_zone_mapping, fx.fx_glazing, ft)
    new = lambda df, value: df.select("factor_param", "factor", value.alias("new_value"))
    edits = (new(scenario.material_deltas(ft), F.col("new_conductivity"))
             .unionByName(new(scenario.glazing_deltas(gft), F.coalesce("new_conductivity", "new_u_factor")))
             .unionByName(new(scenario.airflow_deltas(_flow_objects(fx.fx_zone_object), fx.fx_model_zone), F.col("design_flow_rate")))
             .unionByName(new(scenario.gain_deltas(fx.fx_zone_object.select("object_name", "design_level")), F.col("power_per_zone_floor_area"))))
    return scenario.run_edits(st.design, edits)


@register("scenario_delta_json", _sched_oracle(
    "JOIN fx_design d USING (sim_id)", ", d.f_wall, d.f_roof, d.f_win, d.inf, d.vent, d.misc, d.cop, d.shgc"))
def q_scenario_delta_json(spark, sf_dir):
    """One JSON document per run (factor levels + schedules), written as
    text to the shared folder, read back and parsed to rows."""
    st = Study(spark, sf_dir)
    path = work_dir(spark, "scenario-json")
    scenario.scenario_documents(st.design).select("doc").write.text(path)
    return scenario.parse_documents(spark.read.text(path))

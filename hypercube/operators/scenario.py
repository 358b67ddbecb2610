"""Scenario edits of the building model, as relational deltas.

The reference edits a fresh copy of the model for every run.  Every edit
depends on the run through one parameter (a wall, roof or window ageing
factor, an air-change rate, a gain level) or, for schedules, through a few
of them.  So instead of materialising runs x objects, edits are published as
*edit dictionaries*: one row per (object, parameter level), where the levels
are the step grid of the parameter space (plan-time constants, e.g. 51 wall
factors).  A run's edit is the dictionary row at the run's level; the
dictionary grows with the model, never with the number of runs.  Schedules,
which combine several parameters, are built per run (``schedule_rows``).

First-touch rule (W3): a material is edited by the first outdoor surface
(model order), then the first layer, that reaches it; later surfaces do not
edit it again.  Only a construction's first outdoor surface can be that one,
so surfaces are reduced to one row per construction before they meet layers,
and the rest is a minimum of (surface, layer) per material: however many
surfaces share a construction, or constructions a material, nothing is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hypercube.functions.numeric import ach_to_flow, round_even
from hypercube.functions.schedules import (AVAILABILITY_SCHEDULE, LIMITS_FRACTION, LIMITS_ON_OFF,
                                           LIMITS_TEMPERATURE, SETPOINT_SCHEDULE,
                                           SHADING_CONTROL_TYPE, SHADING_SCHEDULE, SHADING_SCHEDULE_IDF,
                                           availability_schedule, setpoint_schedule,
                                           shading_schedule, shading_schedule_symmetric)
from hypercube.functions.timefmt import heating_switch_times, shading_window_from_close
from hypercube.operators.sampling import SPACE_12, Param
from hypercube.operators.zones import EXCLUDED

# Fixed values (must equal the reference): the outdoor boundary text, the
# conductivity threshold below which a material is not aged, the density
# response to ageing (half the factor's excess), the assembly surface
# resistance of the legacy U-value, and the edited object classes and fields.
OUTDOORS = "outdoors"
MIN_CONDUCTIVITY = 0.05
DENSITY_RESPONSE = 0.5
SURFACE_RESISTANCE = 0.17
WINDOW_TYPE = "window"
FLOW_METHOD = "Flow/Zone"
GAIN_METHOD = "Watts/Area"
INFILTRATION = "ZoneInfiltration:DesignFlowRate"
VENTILATION = "ZoneVentilation:DesignFlowRate"
OTHER_EQUIPMENT = "OtherEquipment"
DUAL_SETPOINT = "ThermostatSetpoint:DualSetpoint"
IDEAL_LOADS = "ZoneHVAC:IdealLoadsAirSystem"
SHADING_CONTROL = "WindowShadingControl"

OUTSIDE_LAYER = 1            # place of a construction's outside layer
WALL, ROOF_OR_CEILING, OTHER = 1, 2, 0


def param(name: str, space=SPACE_12) -> Param:
    return next(p for p in space if p.name == name)


def levels(p: Param) -> Column:
    """The step grid of a parameter, lo .. hi, as an array literal expression."""
    k = int(round((float(p.hi) - float(p.lo)) / float(p.step)))
    return F.transform(F.sequence(F.lit(0), F.lit(k)),
                       lambda i: round_even(F.lit(float(p.lo)) + i * F.lit(float(p.step)), 3))


def factor_class(surface_type) -> Column:
    t = F.lower(F.col(surface_type) if isinstance(surface_type, str) else surface_type)
    return (F.when(t == "wall", F.lit(WALL)).when(t.isin("roof", "ceiling"), F.lit(ROOF_OR_CEILING))
            .otherwise(F.lit(OTHER)))


# --- layers ------------------------------------------------------------------


def layer_positions(layers: DataFrame) -> DataFrame:
    """F19 + W6 on the long layer table ``(construction_id, layer_ord, material_id)``:
    empty entries removed, layers numbered in order (``layer_pos``), the
    innermost one not editable.  One window per construction, whose layers
    are a handful in the model format."""
    present = layers.where(F.col("material_id").isNotNull())
    of = Window.partitionBy("construction_id")
    return present.select("construction_id", "layer_ord",
                          F.row_number().over(of.orderBy("layer_ord", "material_id")).alias("layer_pos"), "material_id",
                          F.count(F.lit(1)).over(of).alias("_n")).select(
        "construction_id", "layer_ord", "layer_pos", "material_id", (F.col("layer_pos") < F.col("_n")).alias("editable"))


def outdoor_surfaces(surfaces: DataFrame) -> DataFrame:
    return surfaces.where(F.lower(F.col("outside_boundary")) == OUTDOORS)


# --- opaque materials (C3) ---------------------------------------------------


def material_first_touch(surfaces: DataFrame, layers: DataFrame, materials: DataFrame) -> DataFrame:
    """W3 + J13: per aged material, the surface and layer that edit it first.

    Candidates: outdoor surfaces -> their construction's editable layers ->
    existing materials with conductivity > 0.05.
    """
    first_surface = outdoor_surfaces(surfaces).groupBy("construction_id").agg(
        F.min(F.struct("surface_ord", "surface_type")).alias("_s"))
    first = (layer_positions(layers).where(F.col("editable")).join(first_surface, on="construction_id", how="inner")
             .groupBy("material_id").agg(F.min(F.struct(
                 F.col("_s.surface_ord").alias("surface_ord"), "layer_ord", "layer_pos",
                 F.col("_s.surface_type").alias("surface_type"))).alias("_f")))
    return (first.join(materials, on="material_id", how="inner").where(F.col("conductivity") > MIN_CONDUCTIVITY)
            .select("_f.surface_ord", "material_id", "_f.layer_ord", "_f.layer_pos",
                    factor_class(F.col("_f.surface_type")).alias("factor_class"),
                    "conductivity", "density", "thickness", "_f.surface_type"))


def material_deltas(first_touch: DataFrame, space=SPACE_12) -> DataFrame:
    """C3 + F10 edit dictionary: per material and factor level, the aged
    conductivity (4 places) and density (1 place).  Walls follow ``f_wall``,
    roofs and ceilings ``f_roof``, other surfaces keep factor 1.0."""
    fw, fr = param("f_wall", space), param("f_roof", space)
    cls = F.col("factor_class")
    grid = (F.when(cls == WALL, levels(fw)).when(cls == ROOF_OR_CEILING, levels(fr))
            .otherwise(F.array(F.lit(1.0))))
    pname = (F.when(cls == WALL, F.lit("f_wall")).when(cls == ROOF_OR_CEILING, F.lit("f_roof"))
             .otherwise(F.lit(None).cast("string")))
    f = F.col("factor")
    return (first_touch.withColumn("factor_param", pname)
            .withColumn("factor", F.explode(grid))
            .select("material_id", "surface_ord", "surface_type", "layer_ord", "layer_pos", "factor_param", "factor",
                    "thickness",
                    F.col("conductivity").alias("old_conductivity"),
                    round_even(F.col("conductivity") * f, 4).alias("new_conductivity"),
                    F.col("density").alias("old_density"),
                    round_even(F.col("density") * (F.lit(1.0) + (f - 1) * F.lit(DENSITY_RESPONSE)), 1)
                    .alias("new_density")))


# --- glazing (C4) -------------------------------------------------------------


def glazing_first_touch(windows: DataFrame, surfaces: DataFrame, layers: DataFrame, zone_mapping: DataFrame,
                        glazing: DataFrame, opaque_first_touch: DataFrame) -> DataFrame:
    """J14 + W3: windows whose parent surface lies in a target zone reach the
    outside layer of their construction; a glazing already aged as an opaque
    material is skipped; the first window (model order) per glazing edits it.

    ``windows(window_ord, window_type, parent_surface, construction_id)``: only
    those of type window count, in any case.  ``glazing(glazing_id, kind,
    u_factor, conductivity)``: a simple-glazing row wins over a glazing row of
    the same id.
    """
    targets = zone_mapping.where(F.col("cluster") != EXCLUDED).select("zone_name")
    parents = (surfaces.select(F.col("surface_ord").alias("parent_surface"), "zone_name")
               .join(targets, on="zone_name", how="left_semi"))
    outside = layers.where((F.col("layer_ord") == OUTSIDE_LAYER) & F.col("material_id").isNotNull()).select(
        "construction_id", F.col("material_id").alias("glazing_id"))
    first = (windows.where(F.lower("window_type") == WINDOW_TYPE)
             .join(parents, on="parent_surface", how="left_semi")
             .groupBy("construction_id").agg(F.min("window_ord").alias("window_ord"))
             .join(outside, on="construction_id", how="inner")
             .groupBy("glazing_id").agg(F.min("window_ord").alias("window_ord"))
             .join(opaque_first_touch.select(F.col("material_id").alias("glazing_id")), on="glazing_id", how="left_anti"))
    best = glazing.where(F.col("u_factor").isNotNull() | F.col("conductivity").isNotNull()).groupBy("glazing_id").agg(
        F.min(F.struct((F.col("kind") != "simple").alias("other"), "u_factor", "conductivity")).alias("_g"))
    return first.join(best, on="glazing_id", how="inner").select(
        "glazing_id", "window_ord", F.when(F.col("_g.other"), F.lit("glazing")).otherwise(F.lit("simple")).alias("kind"),
        "_g.u_factor", "_g.conductivity")


def glazing_deltas(first_touch: DataFrame, space=SPACE_12) -> DataFrame:
    """C4 + F11 edit dictionary: per glazing and ``f_win`` level, U-factor
    (3 places) and conductivity (4 places) scaled by the factor."""
    f = F.col("factor")
    return (first_touch.withColumn("factor", F.explode(levels(param("f_win", space))))
            .select("glazing_id", "window_ord", "kind", F.lit("f_win").alias("factor_param"), "factor",
                    F.col("u_factor").alias("old_u_factor"),
                    round_even(F.col("u_factor") * f, 3).alias("new_u_factor"),
                    F.col("conductivity").alias("old_conductivity"),
                    round_even(F.col("conductivity") * f, 4).alias("new_conductivity")))


# --- air flow and gains (C6) ---------------------------------------------------


def _edited(obj: Column, set_fields: dict, drop: list[str]) -> Column:
    for k, v in set_fields.items():
        obj = obj.withField(k, v)
    return obj.dropFields(*drop) if drop else obj


def airflow_deltas(flow_objects: DataFrame, zones: DataFrame, space=SPACE_12) -> DataFrame:
    """C6 + J15 + F9 + P20: infiltration and ventilation objects of zones with
    a volume get ``Flow/Zone``, flow = ACH x volume / 3600, and lose their
    ``air_changes_per_hour``; one row per object and ACH level.

    ``flow_objects(object_class, object_name, zone_name, air_changes_per_hour)``.
    """
    vol = zones.where(F.col("volume").isNotNull()).select("zone_name", "volume")
    grid = (F.when(F.col("object_class") == INFILTRATION, levels(param("inf", space)))
            .otherwise(levels(param("vent", space))))
    pname = F.when(F.col("object_class") == INFILTRATION, F.lit("inf")).otherwise(F.lit("vent"))
    obj = F.struct(F.col("zone_name"), F.lit(None).cast("string").alias("design_flow_rate_calculation_method"),
                   F.lit(None).cast("double").alias("design_flow_rate"),
                   F.col("air_changes_per_hour").cast("double").alias("air_changes_per_hour"))
    rows = (flow_objects.join(vol, on="zone_name", how="inner")
            .withColumn("factor_param", pname).withColumn("factor", F.explode(grid)))
    edited = _edited(obj, {"design_flow_rate_calculation_method": F.lit(FLOW_METHOD),
                           "design_flow_rate": ach_to_flow(F.col("factor"), F.col("volume"))},
                     ["air_changes_per_hour"])
    return rows.select("object_class", "object_name", "factor_param", "factor", "volume",
                       edited.alias("_o")).select(
        "object_class", "object_name", "factor_param", "factor", "volume",
        "_o.zone_name", "_o.design_flow_rate_calculation_method", "_o.design_flow_rate")


def gain_deltas(equipment: DataFrame, space=SPACE_12) -> DataFrame:
    """C6 + P20: every OtherEquipment object becomes ``Watts/Area`` at the
    run's gain level and loses its ``design_level``; per object and level.

    ``equipment(object_name, design_level)``.
    """
    obj = F.struct(F.lit(None).cast("string").alias("design_level_calculation_method"),
                   F.lit(None).cast("double").alias("power_per_zone_floor_area"),
                   F.col("design_level").cast("double").alias("design_level"))
    rows = equipment.withColumn("factor", F.explode(levels(param("misc", space))))
    edited = _edited(obj, {"design_level_calculation_method": F.lit(GAIN_METHOD),
                           "power_per_zone_floor_area": F.col("factor")}, ["design_level"])
    return rows.select(F.lit(OTHER_EQUIPMENT).alias("object_class"), "object_name",
                       F.lit("misc").alias("factor_param"), "factor", edited.alias("_o")).select(
        "object_class", "object_name", "factor_param", "factor", "_o.*")


# --- schedules (C5, J21, A16) --------------------------------------------------


def schedule_rows(design: DataFrame) -> DataFrame:
    """C5 + F13: the three compact schedules of every run, one row per field:
    ``(sim_id, schedule_name, type_limits, field_ord, field_text, field_number)``."""
    sched = F.array(
        F.struct(F.lit(SHADING_SCHEDULE).alias("name"), F.lit(LIMITS_ON_OFF).alias("limits"),
                 shading_schedule("s_hours", "s_close", "shgc").alias("fields")),
        F.struct(F.lit(SETPOINT_SCHEDULE).alias("name"), F.lit(LIMITS_TEMPERATURE).alias("limits"),
                 setpoint_schedule("hours", "setpoint").alias("fields")),
        F.struct(F.lit(AVAILABILITY_SCHEDULE).alias("name"), F.lit(LIMITS_FRACTION).alias("limits"),
                 availability_schedule("hours").alias("fields")))
    per = design.select("sim_id", F.explode(sched).alias("_s"))
    return (per.select("sim_id", F.col("_s.name").alias("schedule_name"),
                       F.col("_s.limits").alias("type_limits"),
                       F.posexplode("_s.fields").alias("field_ord", "_f"))
            .select("sim_id", "schedule_name", "type_limits", (F.col("field_ord") + 1).alias("field_ord"),
                    "_f.field_text", "_f.field_number"))


def shading_availability_rows(design: DataFrame) -> DataFrame:
    """F13 variant: the shading availability schedule of every run (0 outside,
    1 inside a window centred on 14:00), one row per field."""
    return (design.select("sim_id", F.lit(SHADING_SCHEDULE_IDF).alias("schedule_name"),
                          F.posexplode(shading_schedule_symmetric("s_hours")).alias("_at", "_f"))
            .select("sim_id", "schedule_name", (F.col("_at") + 1).alias("field_ord"), "_f.field_text", "_f.field_number"))


def schedule_assignments(thermostat_zones: DataFrame, hvac_zones: DataFrame,
                         shading_controls: DataFrame | None = None) -> DataFrame:
    """J21 + A16: run-independent sibling updates.  Every dual setpoint takes
    the setpoint schedule, every ideal-loads system the availability schedule,
    every shading control the shading schedule, ``OnIfScheduleAllows`` and the
    first non-empty shading material of the model (in control order)."""
    out = (thermostat_zones.select(F.lit(DUAL_SETPOINT).alias("object_class"),
                                   F.col("zone_name").alias("object_name"),
                                   F.lit("heating_setpoint_temperature_schedule_name").alias("field"),
                                   F.lit(SETPOINT_SCHEDULE).alias("new_value"))
           .unionByName(hvac_zones.select(F.lit(IDEAL_LOADS).alias("object_class"),
                                          F.col("zone_name").alias("object_name"),
                                          F.lit("heating_availability_schedule_name").alias("field"),
                                          F.lit(AVAILABILITY_SCHEDULE).alias("new_value"))))
    if shading_controls is None:
        return out
    material = shading_controls.agg(F.min_by(
        "shading_device_material_name",
        F.when(F.coalesce(F.col("shading_device_material_name"), F.lit("")) != "",
               F.col("control_ord")))).scalar()
    sc = shading_controls
    parts = [
        sc.select(F.lit(SHADING_CONTROL).alias("object_class"), F.col("name").alias("object_name"),
                  F.lit("schedule_name").alias("field"), F.lit(SHADING_SCHEDULE).alias("new_value")),
        sc.select(F.lit(SHADING_CONTROL), "name", F.lit("shading_control_type"), F.lit(SHADING_CONTROL_TYPE)),
        sc.where(F.col("shading_device_material_name").isNotNull())
          .select(F.lit(SHADING_CONTROL), "name", F.lit("shading_device_material_name"),
                  F.coalesce(material, F.col("shading_device_material_name"))),
    ]
    for p in parts:
        out = out.unionByName(p.toDF("object_class", "object_name", "field", "new_value"))
    return out


# --- change log (C7) and legacy U-value (A15) --------------------------------


def change_log(mat: DataFrame, glz: DataFrame) -> DataFrame:
    """Material and window edits in the legacy log shape (TYPE, MAT_ID,
    LAYER, THICKNESS, OLD_VAL, NEW_VAL, OLD_DENS, NEW_DENS), per factor level.

    The layer number counts the construction's non-empty layers.  Values stay
    numeric (DOUBLE); the legacy text ``-`` is NULL here.
    """
    opaque = mat.select(
        "factor_param", "factor", F.upper("surface_type").alias("type"),
        F.col("material_id").cast("string").alias("mat_id"),
        F.concat(F.lit("Layer "), F.col("layer_pos").cast("string")).alias("layer"),
        F.col("thickness").cast("double").alias("thickness"),
        F.col("old_conductivity").alias("old_val"), F.col("new_conductivity").alias("new_val"),
        F.col("old_density").alias("old_dens"), F.col("new_density").alias("new_dens"))
    window = glz.select(
        "factor_param", "factor", F.lit("WINDOW").alias("type"),
        F.col("glazing_id").cast("string").alias("mat_id"), F.lit("Glass").alias("layer"),
        F.lit(None).cast("double").alias("thickness"),
        F.coalesce(F.col("old_conductivity"), F.col("old_u_factor")).alias("old_val"),
        F.coalesce(F.col("new_conductivity"), F.col("new_u_factor")).alias("new_val"),
        F.lit(None).cast("double").alias("old_dens"), F.lit(None).cast("double").alias("new_dens"))
    return opaque.unionByName(window)


# Fixed values of the legacy log: kind, id and layer of a run's own rows, and the old values it states.
BEHAVIOR_LOG = (
    ("BEHAVIOR", "Shading_Sch", "Shading"),
    ("BEHAVIOR", "Heating", "Sched/Setp"),
    ("BEHAVIOR", "Infiltration", "AirChanges"),
    ("BEHAVIOR", "Ventilation", "FreshAir"),
    ("BEHAVIOR", "MiscGains", "Watts/sqm"),
    ("SYSTEM", "Boiler", "COP"),
)
OLD_COP = "0.75"
UNKNOWN_OLD = "N/A"


def behavior_log(design: DataFrame) -> DataFrame:
    """The run-specific rows of the legacy log, as text: shading and heating
    schedules, infiltration, ventilation, gains and boiler.

    As there, the ventilation row states its rate as the old value and has no
    new one.  Old values of the unedited model are not part of the design:
    ``N/A``.
    """
    text = lambda c: F.col(c).cast("string")
    window = shading_window_from_close("s_hours", "s_close")
    times = heating_switch_times("hours")
    ach = lambda c: F.concat(text(c), F.lit(" ACH"))
    values = (
        (F.lit(UNKNOWN_OLD), F.concat(F.lit("Open "), window["open"], F.lit("-"), window["close"])),
        (F.lit(UNKNOWN_OLD), F.concat(text("setpoint"), F.lit("C ("), times["morning_start"], F.lit("-"), times["evening_end"], F.lit(")"))),
        (F.lit(UNKNOWN_OLD), ach("inf")),
        (ach("vent"), F.lit(None).cast("string")),
        (F.lit(UNKNOWN_OLD), text("misc")),
        (F.lit(OLD_COP), text("cop")),
    )
    rows = [F.struct(F.lit(kind).alias("type"), F.lit(name).alias("mat_id"), F.lit(layer).alias("layer"),
                     old.alias("old_val"), new.alias("new_val"))
            for (kind, name, layer), (old, new) in zip(BEHAVIOR_LOG, values)]
    return design.select("sim_id", F.explode(F.array(*rows)).alias("_r")).select("sim_id", "_r.*")


def shade_optics(design: DataFrame) -> DataFrame:
    """solar transmittance and reflectance of the shading material, per run."""
    return design.select("sim_id", round_even("shgc", 3).alias("solar_transmittance"),
                         round_even(F.lit(1.0) - F.col("shgc") - F.lit(0.1), 3).alias("solar_reflectance"))


def assembly_u_value(surfaces: DataFrame, layers: DataFrame, materials: DataFrame) -> DataFrame:
    """A15 (legacy): per outdoor surface, R = 0.17 + sum(thickness/conductivity)
    over its construction's existing materials, U = 1/R to 3 places.

    A missing construction, a material without thickness or conductivity and a
    zero conductivity fail the surface: U = 0.0, no R.  ``first_of_type`` marks
    the surface the legacy report uses (first outdoor surface of its type).
    R is worked out once per construction.
    """
    known = materials.withColumn("_known", F.lit(True))
    per_layer = layers.join(known, on="material_id", how="left")
    broken = F.col("_known") & (F.col("thickness").isNull() | F.col("conductivity").isNull() | (F.col("conductivity") == 0))
    assembly = per_layer.groupBy("construction_id").agg(
        F.count("_known").alias("n_materials"),
        F.sum(F.when(F.coalesce(~broken, F.lit(False)), F.col("thickness") / F.col("conductivity"))).alias("_sum"),
        F.max(F.coalesce(broken, F.lit(False))).alias("_broken"))
    outdoor = outdoor_surfaces(surfaces).select("surface_ord", "construction_id", "surface_type")
    firsts = outdoor.groupBy("surface_type").agg(F.min("surface_ord").alias("_first"))
    failed = F.coalesce(F.col("_broken"), F.lit(True))
    r = F.lit(SURFACE_RESISTANCE) + F.coalesce(F.col("_sum"), F.lit(0.0))
    return (outdoor.join(assembly, on="construction_id", how="left").join(firsts, on="surface_type", how="left")
            .select("surface_ord", "surface_type", F.coalesce("n_materials", F.lit(0)).alias("n_materials"),
                    F.when(~failed, round_even(r, 6)).alias("r_total"),
                    F.when(failed, F.lit(0.0)).otherwise(round_even(F.lit(1.0) / r, 3)).alias("u_value"),
                    (F.col("surface_ord") == F.col("_first")).alias("first_of_type")))


# --- a run's own edits (J18) --------------------------------------------------


def level_index(value: Column, p: Param) -> Column:
    """Place of a design value on its parameter's step grid; a value off the
    grid, which no dictionary row stands for, raises an error."""
    at = F.rint((value - F.lit(float(p.lo))) / F.lit(float(p.step)))
    last = int(round((float(p.hi) - float(p.lo)) / float(p.step)))
    off = (F.abs(value - (F.lit(float(p.lo)) + at * F.lit(float(p.step)))) > 1e-9) | (at < 0) | (at > last)
    return F.when(off, F.raise_error(F.concat(F.lit(f"{p.name} off its grid: "), value.cast("string")))).otherwise(at).cast("int")


def run_edits(design: DataFrame, dictionaries: DataFrame, space=SPACE_12) -> DataFrame:
    """J18 + S14: what each run edits, one row per run and parameter:
    ``(sim_id, factor_param, level, n_objects, checksum)``.

    ``dictionaries(factor_param, factor, new_value)`` is the union of the edit
    dictionaries.  It is summed per parameter and level, a table as large as
    the grids, before runs meet it, so no run x object row exists.  The
    checksum adds the new values in ten-thousandths.
    """
    params = {p.name: p for p in space}
    names = ["f_wall", "f_roof", "f_win", "inf", "vent", "misc"]
    place = None
    for n in names:
        at = level_index(F.col("factor"), params[n])
        place = F.when(F.col("factor_param") == n, at) if place is None else place.when(F.col("factor_param") == n, at)
    per_level = (dictionaries.where(F.col("factor_param").isNotNull()).select("factor_param", place.alias("level"), "new_value")
                 .groupBy("factor_param", "level").agg(
                     F.count(F.lit(1)).alias("n_objects"),
                     F.sum(F.rint(F.col("new_value") * 10000).cast("long")).alias("checksum")))
    runs = design.select("sim_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("factor_param"), level_index(F.col(n), params[n]).alias("level")) for n in names])).alias("_p"))
    return (runs.select("sim_id", "_p.*").join(per_level, on=["factor_param", "level"], how="left")
            .select("sim_id", "factor_param", "level", F.coalesce("n_objects", F.lit(0)).alias("n_objects"),
                    F.coalesce("checksum", F.lit(0)).alias("checksum")))


def scenario_documents(design: DataFrame) -> DataFrame:
    """S14 re-aimed: one compact JSON document per run with the run's factor
    levels (keys into the edit dictionaries, see ``run_edits``) and its three schedules.

    Built from the run's own row (no shuffle); NULL fields are left out of
    the JSON, so each schedule field carries either its text or its number.
    """
    sched = F.array(
        F.struct(F.lit(SHADING_SCHEDULE).alias("schedule_name"), F.lit(LIMITS_ON_OFF).alias("type_limits"),
                 shading_schedule("s_hours", "s_close", "shgc").alias("data")),
        F.struct(F.lit(SETPOINT_SCHEDULE).alias("schedule_name"), F.lit(LIMITS_TEMPERATURE).alias("type_limits"),
                 setpoint_schedule("hours", "setpoint").alias("data")),
        F.struct(F.lit(AVAILABILITY_SCHEDULE).alias("schedule_name"), F.lit(LIMITS_FRACTION).alias("type_limits"),
                 availability_schedule("hours").alias("data")))
    levels_ = F.struct("f_wall", "f_roof", "f_win", "inf", "vent", "misc", "cop", "shgc")
    return design.select("sim_id", F.to_json(F.struct("sim_id", levels_.alias("levels"),
                                                       sched.alias("schedules"))).alias("doc"))



DOCUMENT_SCHEMA = ("sim_id int, levels struct<f_wall double, f_roof double, f_win double, inf double, vent double, misc double, "
                   "cop double, shgc double>, schedules array<struct<schedule_name string, type_limits string, "
                   "data array<struct<field_text string, field_number double>>>>")


def parse_documents(docs: DataFrame, column: str = "value") -> DataFrame:
    """Scenario documents back to rows, one per schedule field, with the run's levels."""
    d = docs.select(F.from_json(column, DOCUMENT_SCHEMA).alias("d"))
    per = d.select("d.sim_id", "d.levels.*", F.explode("d.schedules").alias("_s"))
    levels_ = ["f_wall", "f_roof", "f_win", "inf", "vent", "misc", "cop", "shgc"]
    return (per.select("sim_id", *levels_, "_s.schedule_name", "_s.type_limits", F.posexplode("_s.data").alias("_at", "_f"))
            .select("sim_id", *levels_, "schedule_name", "type_limits", (F.col("_at") + 1).alias("field_ord"),
                    "_f.field_text", "_f.field_number"))

"""Zones, runs, sampling and scenario edits on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hypercube.operators import results, runs, sampling, scenario, timing, zones


def test_single_heated_level_is_ground(spark):
    z = spark.createDataFrame([("a", True, 3.0, 20.0), ("b", True, 3.0, 20.0), ("c", False, 9.0, 20.0)],
                              "zone_name string, is_heated boolean, z_level double, area_sqm double")
    got = {r.zone_name: r.cluster for r in zones.classify_zones(z).collect()}
    assert got == {"a": "GROUND", "b": "GROUND", "c": "EXCLUDED"}


def test_no_heated_zone_all_excluded(spark):
    z = spark.createDataFrame([("a", False, 3.0, 20.0)], "zone_name string, is_heated boolean, z_level double, area_sqm double")
    assert zones.classify_zones(z).first().cluster == "EXCLUDED"


def test_zone_without_floor_defaults(spark):
    zs = spark.createDataFrame([("a",), ("b",)], "zone_name string")
    floors = spark.createDataFrame([], "zone_name string, surface_type string, vertices array<struct<x:double,y:double,z:double>>")
    therm = spark.createDataFrame([("a",)], "zone_name string")
    got = {r.zone_name: (r.is_heated, r.z_level, r.area_sqm, r.cluster)
           for r in zones.zone_mapping(zs, floors, therm).collect()}
    assert got == {"a": (True, 0.0, 20.0, "GROUND"), "b": (False, 0.0, 20.0, "EXCLUDED")}


def test_run_status_and_duplicates(spark):
    design = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)], "sim_id int, cop double")
    summary = spark.createDataFrame([(1, 5.0), (3, 6.0), (3, 6.5)], "sim_id int, kwh_sqm_ground double")
    tim = spark.createDataFrame([(1, 1, 0), (2, 1, 2)], "sim_id int, batch_id int, energyplus_returncode int")
    r = runs.runs_mart(design, summary, tim)
    got = sorted((x.sim_id, x.run_status, x.has_summary, x.has_timing) for x in r.collect())
    assert got == [(1, "ok", True, True), (2, "failed", False, True), (3, "summary_only", True, False),
                   (3, "summary_only", True, False), (4, "missing", False, False)]
    dup = runs.duplicate_run_ids({"summary": summary, "timing": tim}).collect()
    assert [(d.source, d.sim_id, d.n_rows) for d in dup] == [("summary", 3, 2)]
    no_rc = runs.runs_mart(design, summary, None)
    assert {x.sim_id: x.run_status for x in no_rc.collect()}[2] == "missing"


def test_run_summary_empty_cluster_and_no_zone(spark):
    design = spark.createDataFrame([(1, 1.0), (2, 1.0)], "sim_id int, cop double")
    mapping = spark.createDataFrame([("G1", True, "GROUND", 10.0), ("X", True, "TOP", 10.0)],
                                    "zone_name string, is_heated boolean, cluster string, area_sqm double")
    head = "{} IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)"
    raw = spark.createDataFrame([(1, 0, head.format("G1"), 3.6e7), (2, 0, head.format("OTHER"), 1.0)],
                                "sim_id int, h int, header string, joules double")
    inten = results.zone_intensity(results.zone_energy_exact(raw, mapping), design)
    got = {r.sim_id: (r.kwh_sqm_ground, r.kwh_sqm_middle, r.kwh_sqm_top)
           for r in results.run_summary(inten, design, raw).collect()}
    assert got == {1: (1.0, 0.0, 0.0), 2: (None, None, None)}


def test_substring_match_takes_longer_names(spark):
    design = spark.createDataFrame([(1, 1.0)], "sim_id int, cop double")
    mapping = spark.createDataFrame([("1", True, "GROUND", 1.0)],
                                    "zone_name string, is_heated boolean, cluster string, area_sqm double")
    head = "{} IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)"
    raw = spark.createDataFrame([(1, 0, head.format("1"), 3.6e6), (1, 0, head.format("11"), 3.6e6)],
                                "sim_id int, h int, header string, joules double")
    sub = results.zone_intensity(results.zone_energy_substring(raw, mapping), design).first()
    exact = results.zone_intensity(results.zone_energy_exact(raw, mapping), design).first()
    assert sub.kwh_sqm == 2.0 and exact.kwh_sqm == 1.0


def test_lhs_strata_and_reproducibility(spark):
    runs_df = spark.range(1, 201).select(F.col("id").cast("int").alias("sim_id"))
    long = sampling.lhs_long(runs_df, sampling.SPACE_12, 42)
    chk = sampling.stratum_check(long, runs_df).collect()
    assert len(chk) == 12 and all(r.all_once and r.n_runs == 200 for r in chk)
    a = sampling.lhs_design(runs_df, seed=42).orderBy("sim_id").collect()
    b = sampling.lhs_design(runs_df, seed=42).orderBy("sim_id").collect()
    c = sampling.lhs_design(runs_df, seed=7).orderBy("sim_id").collect()
    assert a == b and a != c
    for r in a:
        assert 1.0 <= r.f_wall <= 1.5 and 2 <= r.hours <= 14 and 16 <= r.s_close <= 20


def test_first_touch_shared_material_takes_wall(spark):
    surfaces = spark.createDataFrame([(1, 10, "Wall", "Outdoors", "z"), (2, 20, "Roof", "Outdoors", "z"),
                                      (3, 30, "Wall", "Ground", "z")],
                                     "surface_ord long, construction_id long, surface_type string, outside_boundary string, zone_name string")
    layers = spark.createDataFrame([(10, 1, 100), (10, 2, 999), (20, 1, 100), (20, 2, 200), (20, 3, 999),
                                    (30, 1, 300), (30, 2, 999)],
                                   "construction_id long, layer_ord int, material_id long")
    mats = spark.createDataFrame([(100, 1.0, 0.1, 1000.0), (200, 0.04, 0.1, 500.0), (300, 1.0, 0.1, 800.0),
                                  (999, 1.0, 0.1, 100.0)],
                                 "material_id long, conductivity double, thickness double, density double")
    ft = {r.material_id: (r.surface_ord, r.factor_class) for r in
          scenario.material_first_touch(surfaces, layers, mats).collect()}
    # 100: wall first; 200: conductivity too low; 300: not outdoors; 999: innermost everywhere
    assert ft == {100: (1, scenario.WALL)}
    d = scenario.material_deltas(scenario.material_first_touch(surfaces, layers, mats))
    row = d.where(F.col("factor") == 1.2).first()
    assert row.factor_param == "f_wall" and row.new_conductivity == 1.2 and row.new_density == 1100.0
    assert d.count() == 51


def test_single_layer_construction_not_edited(spark):
    surfaces = spark.createDataFrame([(1, 10, "Wall", "Outdoors", "z")],
                                     "surface_ord long, construction_id long, surface_type string, outside_boundary string, zone_name string")
    layers = spark.createDataFrame([(10, 1, 100)], "construction_id long, layer_ord int, material_id long")
    mats = spark.createDataFrame([(100, 1.0, 0.1, 1000.0)],
                                 "material_id long, conductivity double, thickness double, density double")
    assert scenario.material_first_touch(surfaces, layers, mats).count() == 0


def test_shading_material_first_non_empty(spark):
    sc = spark.createDataFrame([("c1", 1, ""), ("c2", 2, "ShadeMat"), ("c3", 3, "Other")],
                               "name string, control_ord int, shading_device_material_name string")
    zs = spark.createDataFrame([("z1",)], "zone_name string")
    out = scenario.schedule_assignments(zs, zs, sc)
    mats = {r.object_name: r.new_value for r in out.where(F.col("field") == "shading_device_material_name").collect()}
    assert mats == {"c1": "ShadeMat", "c2": "ShadeMat", "c3": "ShadeMat"}


def test_study_timing_totals(spark):
    detail = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 3, 3.0), (2, 4, 10.0)],
                                   "batch_id int, sim_id int, energyplus_sec double")
    batches = spark.createDataFrame([(1, 5.0, 1.5), (2, 7.0, 2.5)],
                                    "batch_id int, batch_total_sec double, input_load_sec double")
    r = timing.study_timing(detail, batches).first()
    assert r.n_batches == 2 and r.n_sims == 4
    assert r.median_energyplus_sec == 2.5 and r.mean_energyplus_sec == 4.0
    assert r.total_batch_total_sec == 12.0 and r.total_input_load_sec == 4.0


def test_exact_median_matches_numpy(spark):
    import random

    import numpy as np

    from hypercube.operators.quantile import exact_median
    rnd = random.Random(3)
    rows = [("hot", rnd.choice([1.5, 2.5, rnd.random() * 100])) for _ in range(3000)]
    rows += [("even", float(x)) for x in (1, 2, 3, 10)] + [("one", 7.0)]
    rows += [("ties", 4.0)] * 500 + [("ties", 5.0)] * 499
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", out="m", buckets=8).collect()}
    for g in ("hot", "even", "one", "ties"):
        assert got[g] == float(np.median([v for k, v in rows if k == g])), g
    glob = exact_median(df, [], "v", out="m", buckets=8).first().m
    assert glob == float(np.median([v for _, v in rows]))


def test_glazing_also_opaque_is_skipped(spark):
    surfaces = spark.createDataFrame([(1, 10, "Wall", "Outdoors", "z"), (2, 20, "Wall", "Outdoors", "z")],
                                     "surface_ord long, construction_id long, surface_type string, outside_boundary string, zone_name string")
    layers = spark.createDataFrame([(10, 1, 7), (10, 2, 999)], "construction_id long, layer_ord int, material_id long")
    mats = spark.createDataFrame([(7, 1.0, 0.1, 10.0), (999, 1.0, 0.1, 10.0)],
                                 "material_id long, conductivity double, thickness double, density double")
    opaque = scenario.material_first_touch(surfaces, layers, mats)
    layers = layers.unionByName(spark.createDataFrame([(30, 1, 8), (30, 2, 9), (40, 1, None)], layers.schema))
    windows = spark.createDataFrame([(10, "Door", 2, 30), (11, "Window", 1, 10), (12, "WINDOW", 2, 30), (13, "window", 1, 30), (14, "window", 1, 40),
                                     (15, "window", 3, 30)], "window_ord long, window_type string, parent_surface long, construction_id long")
    glazing = spark.createDataFrame([(7, "simple", 2.0, None), (8, "glazing", None, 0.9)],
                                    "glazing_id long, kind string, u_factor double, conductivity double")
    mapping = spark.createDataFrame([("z", "GROUND")], "zone_name string, cluster string")
    gft = scenario.glazing_first_touch(windows, surfaces, layers, mapping, glazing, opaque)
    # glazing 7 was already aged as an opaque layer; glazing 8 is first reached by window 12 (10 is a door)
    assert [(r.glazing_id, r.window_ord, r.kind) for r in gft.collect()] == [(8, 12, "glazing")]
    d = scenario.glazing_deltas(gft).where(F.col("factor") == 1.1).first()
    assert d.new_conductivity == 0.99 and d.new_u_factor is None


def test_zone_case_rule(spark):
    mapping = spark.createDataFrame([("Zone1", True, "GROUND", 1.0)],
                                    "zone_name string, is_heated boolean, cluster string, area_sqm double")
    head = "{} IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)"
    raw = spark.createDataFrame([(1, 0, head.format("Zone1"), 1.0), (2, 0, head.format("ZONE1"), 2.0)],
                                "sim_id int, h int, header string, joules double")
    for find in (results.zone_energy_exact, results.zone_energy_substring):
        assert [r.sim_id for r in find(raw, mapping).collect()] == [1]
        assert sorted(r.sim_id for r in find(raw, mapping, fold_case=True).collect()) == [1, 2]


def test_u_value_of_broken_assemblies(spark):
    surfaces = spark.createDataFrame([(k, k, "Wall", "Outdoors", "z") for k in range(1, 7)],
                                     "surface_ord long, construction_id long, surface_type string, outside_boundary string, zone_name string")
    layers = spark.createDataFrame([(1, 1, 10), (2, 1, 11), (3, 1, 12), (4, 1, 13), (5, 1, None), (5, 2, 99)],
                                   "construction_id long, layer_ord int, material_id long")
    materials = spark.createDataFrame([(10, 0.5, 0.1, 1.0), (11, 0.5, None, 1.0), (12, None, 0.1, 1.0), (13, 0.0, 0.1, 1.0)],
                                      "material_id long, conductivity double, thickness double, density double")
    got = {r.surface_ord: (r.u_value, r.n_materials) for r in scenario.assembly_u_value(surfaces, layers, materials).collect()}
    # 2, 3: a value is missing; 4: no conductivity; 5: no known material; 6: no such construction
    assert got == {1: (2.703, 1), 2: (0.0, 1), 3: (0.0, 1), 4: (0.0, 1), 5: (5.882, 0), 6: (0.0, 0)}


def test_change_log_counts_layers_that_are_there(spark):
    surfaces = spark.createDataFrame([(1, 10, "Wall", "Outdoors", "z")],
                                     "surface_ord long, construction_id long, surface_type string, outside_boundary string, zone_name string")
    layers = spark.createDataFrame([(10, 1, None), (10, 300, 7), (10, 301, 8)], "construction_id long, layer_ord int, material_id long")
    mats = spark.createDataFrame([(7, 1.0, 0.1, 10.0), (8, 1.0, 0.1, 10.0)], "material_id long, conductivity double, thickness double, density double")
    ft = scenario.material_first_touch(surfaces, layers, mats)
    empty = spark.createDataFrame([], "glazing_id long, window_ord long, kind string, u_factor double, conductivity double")
    log = scenario.change_log(scenario.material_deltas(ft), scenario.glazing_deltas(empty))
    assert {r.layer for r in log.collect()} == {"Layer 1"}


def test_off_grid_level_raises(spark):
    design = spark.createDataFrame([(1, 1.005, 1.0, 1.0, 0.3, 0.0, 1.0)],
                                   "sim_id int, f_wall double, f_roof double, f_win double, inf double, vent double, misc double")
    edits = spark.createDataFrame([], "factor_param string, factor double, new_value double")
    with pytest.raises(Exception, match="off its grid"):
        scenario.run_edits(design, edits).collect()


def test_medians_of_awkward_values(spark):
    from hypercube.operators.quantile import bounded_median, exact_median
    rows = [(1, v) for v in (-5.0, 1e6, 0.0, 0.25, 0.5)] + [(2, float("nan")), (2, None), (2, 3.0), (2, 4.0)] + [(3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    for find in (exact_median, bounded_median):
        assert {r.g: r.m for r in find(df, ["g"], "v", out="m").collect()} == {1: 0.25, 2: 3.5}


def test_zone_ids_of_names_that_begin_alike(spark):
    from hypercube.operators.zones import zone_catalog
    names = [f"Zone {i}" for i in range(3000)] + ["a", "Z"]
    mapping = spark.createDataFrame([(n, "c", 0.0, 1.0, True) for n in names],
                                    "zone_name string, cluster string, z_level double, area_sqm double, is_heated boolean").repartition(7)
    got = {r.zone_name: r.zone_id for r in zone_catalog(mapping).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_exploded_runs_are_not_broadcast(spark):
    runs_df = spark.range(1, 101).select(F.col("id").cast("int").alias("sim_id"))
    plan = sampling.lhs_long(runs_df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_median_ranges_go_to_the_values(spark, monkeypatch):
    from hypercube.operators import quantile
    plans, cut = [], quantile._materialize

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(quantile, "_materialize", noted)
    values = spark.range(101).select(F.lit("a").alias("g"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    assert quantile.exact_median(values, ["g"], "v", buckets=4).first()["median"] == 2500.0
    assert any("BuildRight" in p for p in plans) and not any("BuildLeft" in p for p in plans)


def test_run_tables_are_joined_by_shuffle(spark):
    from hypercube.plans.dashboard import RUN_STATS_COLUMNS, run_dashboard
    design = spark.createDataFrame([(1, 0.5), (2, 0.6)], "sim_id int, f_wall double")
    mart = runs.runs_mart(design, spark.createDataFrame([(1, 3.0)], "sim_id int, kwh_sqm_top double"),
                          spark.createDataFrame([(1, 0), (1, 1)], "sim_id int, energyplus_returncode int"))
    stats = spark.createDataFrame([(2, *[None] * len(RUN_STATS_COLUMNS))],
                                  "sim_id int, " + ", ".join(f"{c} int" for c in RUN_STATS_COLUMNS))
    both = run_dashboard(mart, stats)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 3
    assert sorted((r.sim_id, r.run_status) for r in both.collect()) == [(1, "failed"), (1, "ok"), (2, "missing")]

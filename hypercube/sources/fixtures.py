"""Study-shaped input tables derived from the driver's parquet tables.

The reference ships no inputs, so tests and registered queries derive tables
of the domain's shapes (zones, design matrix, hourly results, timing,
summary, building model) from the driver tables with the SQL below.  The
same text runs in Spark and in DuckDB, so an oracle inlines it as CTEs and
both engines start from identical rows.  These views only shape rows; none
of them does any of the work the library's operators do.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from hypercube.session import work_dir
from hypercube.sources.tables import BASE_TABLES, register_tables

# name -> (SELECT body, fixtures it reads)
FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_zone": ("""
SELECT event_type AS zone_name, event_type <> 'error' AS is_heated,
 CASE event_type WHEN 'view' THEN 6.0E0 WHEN 'click' THEN 0.0E0 WHEN 'error' THEN 0.0E0 ELSE 3.0E0 END AS z_level,
 20.0E0 + 5.5E0 * length(event_type) AS area_sqm FROM (SELECT DISTINCT event_type FROM events) e""", ()),
    "fx_design": ("""
SELECT CAST(c_custkey + 1 AS INT) AS sim_id,
 1.0E0 + (c_custkey % 51) * 0.01E0 AS f_wall, 1.0E0 + (c_custkey % 47) * 0.01E0 AS f_roof, 1.0E0 + (c_custkey % 31) * 0.01E0 AS f_win,
 17.0E0 + (c_custkey % 71) * 0.1E0 AS setpoint, CAST(2 + c_custkey % 13 AS INT) AS hours,
 0.3E0 + (c_custkey % 25) * 0.05E0 AS inf, (c_custkey % 17) * 0.05E0 AS vent, 1.0E0 + (c_custkey % 26) * 0.2E0 AS misc,
 0.1E0 + (c_custkey % 17) * 0.05E0 AS shgc, CAST(4 + c_custkey % 8 AS INT) AS s_hours, CAST(16 + c_custkey % 5 AS INT) AS s_close,
 0.65E0 + (c_custkey % 7) * 0.05E0 AS cop FROM customer""", ()),
    "fx_hourly_long": ("""
SELECT CAST(user_id + 1 AS INT) AS sim_id, CAST((day(ts) - 1) * 24 + hour(ts) AS INT) AS h,
 event_type AS zone_name, CAST(SUM(value) AS FLOAT) AS value FROM events GROUP BY 1, 2, 3""", ()),
    "fx_hourly_wide": ("""
SELECT sim_id, h, concat(' 01/', lpad(CAST(CAST(floor(h / 24) AS INT) + 1 AS STRING), 2, '0'), '  ', lpad(CAST(h % 24 + 1 AS STRING), 2, '0'), ':00:00') AS datetime,
 CAST(coalesce(max(CASE WHEN zone_name='click' THEN value END), 0) AS FLOAT) AS zone_click, CAST(coalesce(max(CASE WHEN zone_name='purchase' THEN value END), 0) AS FLOAT) AS zone_purchase,
 CAST(coalesce(max(CASE WHEN zone_name='signup' THEN value END), 0) AS FLOAT) AS zone_signup, CAST(coalesce(max(CASE WHEN zone_name='view' THEN value END), 0) AS FLOAT) AS zone_view
 FROM fx_hourly_long GROUP BY sim_id, h""", ("fx_hourly_long",)),
    # fx_hourly_wide plus the unheated zone's column, for the unknown-label check
    "fx_hourly_wide_all": ("""
SELECT sim_id, h, concat(' 01/', lpad(CAST(CAST(floor(h / 24) AS INT) + 1 AS STRING), 2, '0'), '  ', lpad(CAST(h % 24 + 1 AS STRING), 2, '0'), ':00:00') AS datetime,
 CAST(coalesce(max(CASE WHEN zone_name='click' THEN value END), 0) AS FLOAT) AS zone_click, CAST(coalesce(max(CASE WHEN zone_name='purchase' THEN value END), 0) AS FLOAT) AS zone_purchase,
 CAST(coalesce(max(CASE WHEN zone_name='signup' THEN value END), 0) AS FLOAT) AS zone_signup, CAST(coalesce(max(CASE WHEN zone_name='view' THEN value END), 0) AS FLOAT) AS zone_view,
 CAST(coalesce(max(CASE WHEN zone_name='error' THEN value END), 0) AS FLOAT) AS zone_error
 FROM fx_hourly_long GROUP BY sim_id, h""", ("fx_hourly_long",)),
    "fx_timing": ("""
SELECT CAST(ceil((c_custkey + 1) / 20.0E0) AS INT) AS batch_id, CAST(c_custkey + 1 AS INT) AS sim_id, 'epjson' AS input_format,
 15.0E0 + abs(c_acctbal) / 1000.0E0 AS energyplus_sec, 0.01E0 + (c_custkey % 9) * 0.001E0 AS model_load_sec, 16.0E0 + abs(c_acctbal) / 1000.0E0 AS sim_total_sec,
 CAST(CASE WHEN c_custkey % 25 = 0 THEN 1 ELSE 0 END AS INT) AS energyplus_returncode FROM customer WHERE c_custkey % 10 <> 9""", ()),
    "fx_summary": ("""
SELECT CAST(c_custkey + 1 AS INT) AS sim_id, c_acctbal / 100.0E0 AS kwh_sqm_ground,
 CASE WHEN c_custkey % 2 = 0 THEN c_acctbal / 90.0E0 END AS kwh_sqm_middle, c_acctbal / 80.0E0 AS kwh_sqm_top FROM customer WHERE c_custkey % 25 <> 0 AND c_custkey % 8 <> 7""", ()),
    "fx_raw_output": ("""
SELECT sim_id, h, concat(upper(zone_name), ' IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)') AS header, value * 1.0E6 AS joules FROM fx_hourly_long""",
                      ("fx_hourly_long",)),
    "fx_model_zone": ("""
SELECT n_name AS zone_name, CASE WHEN n_nationkey % 6 <> 5 THEN 60.0E0 + n_nationkey * 7.5E0 END AS volume, n_nationkey % 7 <> 3 AS has_thermostat FROM nation""", ()),
    # model objects that belong to a zone (infiltration, ventilation, equipment,
    # thermostat and HVAC objects), one per supplier, so their count grows with sf
    "fx_zone_object": ("""
SELECT s_suppkey AS object_id, s_name AS object_name, n_name AS zone_name,
 CASE WHEN s_suppkey % 3 = 0 THEN 0.5E0 + (s_suppkey % 5) * 0.1E0 END AS air_changes_per_hour,
 CASE WHEN s_suppkey % 4 = 0 THEN 100.0E0 + (s_suppkey % 50) END AS design_level
 FROM supplier JOIN nation ON s_nationkey = n_nationkey""", ()),
    "fx_floor": ("""
SELECT s_suppkey AS surface_id, n_name AS zone_name, CASE WHEN s_suppkey % 4 = 3 THEN 'Wall' ELSE 'FLOOR' END AS surface_type,
 2.0E0 + s_suppkey % 7 AS w, 3.0E0 + s_suppkey % 5 AS d, 3.0E0 * n_regionkey AS z FROM supplier JOIN nation ON s_nationkey = n_nationkey""", ()),
    "fx_surface": ("""
SELECT o_orderkey AS surface_ord, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 40 ELSE o_orderkey END AS construction_id,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Wall' WHEN '2-HIGH' THEN 'Roof' WHEN '3-MEDIUM' THEN 'Ceiling' WHEN '4-NOT SPECIFIED' THEN 'Floor' ELSE 'Wall' END AS surface_type,
 CASE o_orderstatus WHEN 'O' THEN 'Outdoors' WHEN 'F' THEN 'Ground' ELSE 'Surface' END AS outside_boundary, n_name AS zone_name
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""", ()),
    "fx_layer": ("""
SELECT l_orderkey AS construction_id, l_linenumber AS layer_ord, CASE WHEN (l_orderkey + l_linenumber) % 7 <> 3 THEN min(l_partkey) END AS material_id FROM lineitem WHERE l_orderkey % 29 <> 11 GROUP BY 1, 2""", ()),
    "fx_material": ("""
SELECT p_partkey AS material_id, p_size * 0.01E0 AS conductivity, CASE WHEN p_partkey % 17 <> 4 THEN 0.01E0 + (p_partkey % 20) * 0.01E0 END AS thickness, p_retailprice AS density FROM part WHERE p_partkey % 11 <> 10""", ()),
    "fx_window": ("""
SELECT l_orderkey * 10 + l_linenumber AS window_ord, CASE min(l_returnflag) WHEN 'R' THEN 'Window' WHEN 'A' THEN 'window' ELSE 'Door' END AS window_type, l_orderkey AS parent_surface, CASE WHEN l_linenumber = 1 THEN l_orderkey ELSE l_orderkey % 60 END AS construction_id FROM lineitem GROUP BY l_orderkey, l_linenumber""", ()),
    "fx_glazing": ("""
SELECT p_partkey AS glazing_id, CASE WHEN p_partkey % 2 = 0 THEN 'simple' ELSE 'glazing' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN 1.0E0 + p_size * 0.05E0 END AS u_factor, CASE WHEN p_partkey % 2 = 1 THEN 0.5E0 + p_size * 0.01E0 END AS conductivity FROM part WHERE p_partkey % 3 = 0""", ()),
    # shading controls of the model, some without a device
    "fx_shading_control": ("""
SELECT concat('control_', CAST(p_partkey AS STRING)) AS name, p_partkey AS control_ord,
 CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '' ELSE concat('shade_', CAST(p_size AS STRING)) END AS shading_device_material_name FROM part""", ()),
    # summary rows of which some landed twice
    "fx_summary_repeated": ("""
SELECT sim_id, kwh_sqm_top FROM fx_summary UNION ALL SELECT sim_id, kwh_sqm_top FROM fx_summary WHERE sim_id % 50 = 2""", ("fx_summary",)),
    # cost of each batch as its worker notes it
    "fx_batch_cost": ("""
SELECT CAST(ceil((c_custkey + 1) / 20.0E0) AS INT) AS batch_id, min(c_custkey % 11) * 0.25E0 AS input_load_sec, max(c_custkey % 13) * 0.5E0 AS hourly_write_sec,
 100.0E0 + count(*) AS batch_total_sec FROM customer GROUP BY 1""", ()),
    # hourly cells of a model with 1,024 zones, long
    "fx_many_zones_long": ("""
SELECT CAST(user_id % 16 + 1 AS INT) AS sim_id, CAST((day(ts) - 1) * 24 + hour(ts) AS INT) AS h, CAST(event_id % 1024 AS INT) AS zone,
 CAST(sum(CAST(round(value) AS INT)) AS FLOAT) AS value FROM events GROUP BY 1, 2, 3""", ()),
    # names that clash once they are normalised
    "fx_clashing_name": ("""
SELECT 'clash' AS source, r_name AS name FROM region UNION ALL SELECT 'clash', lower(r_name) FROM region
 UNION ALL SELECT 'clash', concat(lower(r_name), '_2') FROM region UNION ALL SELECT 'clash', concat(r_name, ' ', '2') FROM region""", ()),
    "fx_json": ("""
SELECT event_id, concat('{"Zone":{"Z', CAST(user_id AS STRING), '":{"volume":', CAST(event_id % 90 + 10 AS STRING), '}}}') AS doc, props FROM events""", ()),
}


def _ordered(names) -> list[str]:
    """Names plus their fixture dependencies, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        for dep in FIXTURE_SQL[n][1]:
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(names, body: str) -> str:
    """An oracle statement: the fixtures as CTEs followed by ``body``.

    ``body`` may itself start with further CTE definitions (without WITH),
    separated from the final SELECT by a comma.
    """
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n][0].strip()})" for n in _ordered(names))
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH RECURSIVE {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


_MATERIALIZED: dict[tuple[str, str, str], str] = {}


def _base_tables(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [t for t in BASE_TABLES if t in words]


class Fixtures:
    """Fixture DataFrames over one ``sf_dir``.

    Each fixture is computed once per process and data directory and written
    as zstd Parquet below the shared checkpoint folder; queries then scan it
    like any study table (column pruning and filters reach the scan).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self._frames: dict[str, DataFrame] = {}

    def _compute(self, name: str) -> DataFrame:
        sql, deps = FIXTURE_SQL[name]
        register_tables(self.spark, self.sf_dir, _base_tables(sql))
        for d in deps:
            self[d].createOrReplaceTempView(d)
        return self.spark.sql(sql)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        if not self.materialize:
            df = self._compute(name)
        else:
            key = (self.spark.sparkContext.applicationId, os.path.abspath(self.sf_dir), name)
            path = _MATERIALIZED.get(key)
            if path is None:
                path = work_dir(self.spark, name)
                # about one file per core, as a study's input would be split
                n = self.spark.sparkContext.defaultParallelism
                (self._compute(name).repartition(n).write.option("compression", "zstd")
                 .parquet(path))
                _MATERIALIZED[key] = path
            df = self.spark.read.parquet(path)
        self._frames[name] = df
        return df

    def artifact(self, name: str, write) -> str:
        """A folder of landed input files (e.g. simulator outputs, worker
        batches), written once per process and data directory by
        ``write(path)``; returns the folder."""
        key = (self.spark.sparkContext.applicationId, os.path.abspath(self.sf_dir), "artifact:" + name)
        path = _MATERIALIZED.get(key)
        if path is None:
            path = work_dir(self.spark, name)
            write(path)
            _MATERIALIZED[key] = path
        return path

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self[name]
        raise AttributeError(name)

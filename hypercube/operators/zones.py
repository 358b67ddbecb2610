"""Zone mapping (C1), zone catalog and cluster counts.

Zones, floor surfaces and thermostats are tables of one building model (a
dimension of hundreds to a few thousand zones).  They are joined with plain
equi-joins, which AQE turns into broadcast joins from measured sizes; heated
z extremes are scalar subqueries, not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercube.functions.geometry import mean_z, polygon_area
from hypercube.functions.names import zone_label
from hypercube.functions.numeric import round_even
from hypercube.operators.ordinal import sliced_row_number
from hypercube.session import cut_lineage

# Fixed values (must equal the reference): cluster names, the floor surface
# type, and the default floor area of a zone without floors.
GROUND, MIDDLE, TOP, EXCLUDED = "GROUND", "MIDDLE", "TOP", "EXCLUDED"
CLUSTERS = (GROUND, MIDDLE, TOP)
FLOOR_TYPE = "floor"
DEFAULT_FLOOR_AREA = 20.0


def zone_geometry(floors: DataFrame) -> DataFrame:
    """F12 + A9: per zone, floor area sum and mean over floor surfaces of the
    mean vertex height.  ``floors`` has ``zone_name, surface_type, vertices``;
    the surface type is compared case-insensitively."""
    surf = (floors.where(F.lower(F.col("surface_type")) == FLOOR_TYPE)
            .select("zone_name", polygon_area("vertices").alias("_area"),
                    mean_z("vertices").alias("_z")))
    return surf.groupBy("zone_name").agg(F.sum("_area").alias("floor_area"),
                                         F.avg("_z").alias("avg_z"))


def classify_zones(zones: DataFrame) -> DataFrame:
    """A10 + P14: cluster by heated z extremes; the lowest level is tested first.

    ``zones`` has ``zone_name, is_heated, z_level, area_sqm``.  The heated
    extremes are scalar subqueries (one row each), not joins.
    """
    heated = zones.where(F.col("is_heated"))
    zmin = heated.agg(F.min("z_level")).scalar()
    zmax = heated.agg(F.max("z_level")).scalar()
    cluster = (F.when(~F.col("is_heated"), F.lit(EXCLUDED))
               .when(F.col("z_level") == zmin, F.lit(GROUND))
               .when(F.col("z_level") == zmax, F.lit(TOP))
               .otherwise(F.lit(MIDDLE)))
    return zones.withColumn("cluster", cluster)


def zone_mapping(zones: DataFrame, floors: DataFrame, thermostat_zones: DataFrame) -> DataFrame:
    """``zone_name, is_heated, z_level, area_sqm, cluster`` per model zone.

    is_heated = a thermostat names the zone (J11, mark join on the distinct
    names); floors joined left (J12); no floors -> z 0 and area 20.0 (P19).
    """
    marks = (thermostat_zones.select(F.col("zone_name")).where(F.col("zone_name").isNotNull())
             .distinct().withColumn("_thermostat", F.lit(True)))
    geo = zone_geometry(floors)
    base = (zones.select("zone_name").join(marks, on="zone_name", how="left")
            .join(geo, on="zone_name", how="left"))
    area = F.coalesce(F.col("floor_area"), F.lit(0.0))
    mapped = base.select(
        "zone_name",
        F.coalesce(F.col("_thermostat"), F.lit(False)).alias("is_heated"),
        round_even(F.coalesce(F.col("avg_z"), F.lit(0.0)), 2).alias("z_level"),
        round_even(F.when(area == 0, F.lit(DEFAULT_FLOOR_AREA)).otherwise(area), 2).alias("area_sqm"))
    return classify_zones(mapped)


def zone_catalog(mapping: DataFrame) -> DataFrame:
    """Heated zones with a dense 0-based ``zone_id`` in zone-name order and
    ``zone_label = 'zone_' || zone_name`` (P1, P9, P21, W4, P4).

    Zones are numbered within ranges of names, which Spark draws so that they
    hold about as many each, whatever the names begin with; the ranges are
    written once, so that counts and numbers are of the same ranges."""
    heated = cut_lineage(mapping.where(F.col("is_heated"))
                         .withColumn("zone_name", F.col("zone_name").cast("string"))
                         .orderBy("zone_name").withColumn("_slice", F.spark_partition_id()))
    numbered = sliced_row_number(heated, [], "_slice", ["zone_name"], out="zone_id", start=0)
    return numbered.select(
        F.col("zone_id").cast("int"), "zone_name", zone_label("zone_name").alias("zone_label"),
        "cluster", F.col("z_level").cast("double"), F.col("area_sqm").cast("double"),
        F.col("is_heated").cast("boolean"))


def cluster_counts(mapping: DataFrame) -> DataFrame:
    """Zones per cluster, with the number of distinct zone names."""
    return (mapping.groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n_zones"),
                 F.count_distinct("zone_name").alias("n_distinct_zones"),
                 F.count_if(F.col("is_heated")).alias("n_heated")))

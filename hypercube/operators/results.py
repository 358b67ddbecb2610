"""Simulator output -> hourly rows and the run KPI summary.

Raw output arrives long: one row per run, output row and output column
(``sim_id, h, header, joules``); ``sources.raw_output`` produces this shape
from the simulator's wide CSV files.  Heating columns are found by header
text; the zone is the header text before `` IDEAL LOADS AIR``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercube.functions.names import (HEATING_MARKER, zone_from_header, zone_from_header_py,
                                       zone_label)
from hypercube.functions.numeric import joules_to_kwh, round_even
from hypercube.operators.zones import CLUSTERS


def heating_rows(raw: DataFrame) -> DataFrame:
    """P5 + F6: heating columns only, with the zone key parsed from the header."""
    return (raw.where(F.col("header").contains(HEATING_MARKER))
            .withColumn("zone_key", zone_from_header("header")))


def parse_hourly(raw: DataFrame) -> DataFrame:
    """Long hourly heating values ``(sim_id, h, zone_label, value FLOAT)``.

    Several heating columns of one zone are summed per row (D6), then
    narrowed to float as the workers store them (P6, P8).
    """
    return (heating_rows(raw)
            .groupBy("sim_id", "h", "zone_key")
            .agg(F.sum("joules").alias("_j"))
            .select(F.col("sim_id").cast("int"), F.col("h").cast("int"),
                    zone_label("zone_key").alias("zone_label"), F.col("_j").cast("float").alias("value")))


def hourly_projection(wide: DataFrame) -> DataFrame:
    """C8 + P18: output files' rows as they are -> the wide hourly table the
    workers write: ``sim_id, datetime, zone_<ZONE>`` (float).

    A projection: heating columns are kept, those of one zone added up (blank
    cells count as nothing unless all are blank), names and types narrowed.
    """
    zones: dict[str, list[str]] = {}
    for header in wide.columns:
        if HEATING_MARKER in header:
            zones.setdefault(zone_from_header_py(header), []).append(header)

    def total(headers: list[str]):
        cells = F.array(*[F.col(f"`{h}`").cast("double") for h in headers])
        present = F.filter(cells, lambda x: x.isNotNull())
        return F.when(F.size(present) > 0, F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)).cast("float")

    return wide.select(F.col("sim_id").cast("int"), "datetime",
                       *[total(zones[z]).alias(f"zone_{z}") for z in sorted(zones)])


def header_catalog(raw: DataFrame) -> DataFrame:
    """Per zone key, how many heating columns the output has and which, by name."""
    heads = heating_rows(raw).select("zone_key", "header").distinct()
    return heads.groupBy("zone_key").agg(F.count(F.lit(1)).alias("n_heating_columns"),
                                         F.sort_array(F.collect_list("header")).alias("headers"))


def _key(column, fold_case: bool):
    return F.upper(column) if fold_case else F.col(column)


def _heated(mapping: DataFrame) -> DataFrame:
    return mapping.where(F.col("is_heated")).select(
        F.col("zone_name").cast("string").alias("zone_name"), "cluster", "area_sqm")


def zone_energy_exact(raw: DataFrame, mapping: DataFrame, fold_case: bool = False) -> DataFrame:
    """Per (run, heated zone) the joules of the columns whose header zone
    equals the zone name; with ``fold_case`` both sides are compared in upper
    case.  Runs are aggregated before the zone lookup."""
    per_zone = (heating_rows(raw).groupBy("sim_id", _key("zone_key", fold_case).alias("_match"))
                .agg(F.sum("joules").alias("joules")))
    zones = _heated(mapping).withColumn("_match", _key("zone_name", fold_case))
    return per_zone.join(zones, on="_match", how="inner").drop("_match")


def zone_energy_substring(raw: DataFrame, mapping: DataFrame, fold_case: bool = False) -> DataFrame:
    """J16 (legacy): a column belongs to every heated zone whose name occurs
    anywhere in its header, so zone ``1`` also takes ``11``; with ``fold_case``
    both sides are compared in upper case.

    Done as an equi-join: of each distinct header (headers are schema-sized,
    not data-sized) the substrings that are as long as some zone name meet
    the zone names, so a header's rows are its length times the distinct
    lengths of names; the matched (header, zone) pairs then join the data on
    header.
    """
    zones = _heated(mapping).withColumn("_match", _key("zone_name", fold_case))
    lengths = zones.agg(F.collect_set(F.length("_match"))).scalar()
    heads = heating_rows(raw).select("header").distinct().withColumn("_text", _key("header", fold_case))
    subs = (heads.withColumn("_len", F.explode(lengths)).where(F.col("_len").between(1, F.length("_text")))
            .withColumn("_start", F.explode(F.sequence(F.lit(1), F.length("_text") - F.col("_len") + 1)))
            .select("header", F.expr("substring(_text, _start, _len)").alias("_match"))
            .distinct())
    pairs = subs.join(zones, on="_match", how="inner")
    per_header = raw.groupBy("sim_id", "header").agg(F.sum("joules").alias("joules"))
    matched = per_header.join(pairs, on="header", how="inner")
    return (matched.groupBy("sim_id", "zone_name", "cluster", "area_sqm")
            .agg(F.sum("joules").alias("joules")))


def zone_intensity(zone_energy: DataFrame, design: DataFrame) -> DataFrame:
    """A1 + J19 + F8: kWh per m2 of a zone = joules / 3.6e6 / cop / area, 2 places.

    The design is a per-run table joined on sim_id (shuffle join)."""
    kwh = joules_to_kwh("joules") / F.col("cop")
    return (zone_energy.join(design.select("sim_id", "cop"), on="sim_id", how="inner")
            .select("sim_id", "zone_name", "cluster",
                    round_even(kwh / F.col("area_sqm"), 2).alias("kwh_sqm")))


def run_summary(intensity: DataFrame, design: DataFrame, runs_with_output: DataFrame) -> DataFrame:
    """C9 + A2 + P18 + P19: one row per run that produced output: its design
    row plus kWh_sqm per cluster = mean of the rounded zone values, rounded
    to 2.  A cluster without zones gives 0.0 when the run matched at least one
    zone; a run that matched none has NULL KPIs (D5)."""
    kpis = (intensity.groupBy("sim_id").pivot("cluster", list(CLUSTERS))
            .agg(F.avg("kwh_sqm"))
            .withColumn("_matched", F.lit(True)))
    out = runs_with_output.select("sim_id").distinct().join(design, on="sim_id", how="inner")
    out = out.join(kpis, on="sim_id", how="left")
    cols = []
    for c in CLUSTERS:
        v = round_even(F.coalesce(F.col(c), F.lit(0.0)), 2)
        cols.append(F.when(F.col("_matched"), v).alias(f"kwh_sqm_{c.lower()}"))
    return out.select(*[F.col(c) for c in design.columns], *cols)

"""Hourly marts: wide hourly results -> hour index, calendar, run stats, sparse fact.

Input: the wide hourly table ``(sim_id INT, datetime STRING, zone_* FLOAT)``
as the workers write it, one row per run and simulator hour.

Plan shape (one exchange of wide rows):
  wide -> parse stamp (F1), day slice -> hour index per run (W1, sliced) ->
  { horizontal row aggregates (A14) -> run stats (A3, A4: partial + final
    aggregation on sim_id), calendar of the reference run (W2),
    explode of the kept cells to the sparse fact (P17, P3) with a zone lookup (J10) }.
Row totals are taken on the wide row, never after the explode, so the
run-level aggregation shuffles one partial row per run and partition.

NULL/NaN cells follow the reference's NumPy semantics: such a cell counts
as non-zero, stays in the sparse fact, and makes its row total NaN, so the
row is left out of the annual sum and the peak search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypercube.functions.names import ZONE_PREFIX
from hypercube.functions.numeric import is_missing, round_even
from hypercube.functions.timefmt import hour24_timestamp
from hypercube.operators.ordinal import sliced_row_number

_EPOCH_SLICE = "0001-01-01"


def zone_columns(wide: DataFrame) -> list[str]:
    """Zone value columns, detected from the schema (no data pass)."""
    return [c for c in wide.columns if c.startswith(ZONE_PREFIX)]


def with_hour_index(wide: DataFrame, out: str = "hour_index") -> DataFrame:
    """0-based hour ordinal per run in time order.

    The order key is the parsed stamp (hour 24 = next day 00:00), then the raw
    text.  Rows are numbered per (run, day) and offset by the rows of the
    run's earlier days, so no window partition holds more than one day of
    one run, however long a run is.
    """
    ts = hour24_timestamp("datetime")
    staged = (wide.withColumn("timestamp", ts)
              .withColumn("_day", F.coalesce(F.to_date("timestamp"), F.lit(_EPOCH_SLICE).cast("date"))))
    indexed = sliced_row_number(staged, ["sim_id"], "_day",
                                [F.col("timestamp").asc_nulls_first(), F.col("datetime")],
                                out=out, start=0)
    return indexed.drop("_day")


def _cells(zones: list[str], kind: str) -> Column:
    """The zone cells of a wide row as one array, so that no expression grows with their number."""
    return F.array(*[F.col(f"`{z}`").cast(kind) for z in zones]) if zones else F.array().cast(f"array<{kind}>")


def _kept(x: Column) -> Column:
    """Non-zero, NULL and NaN cells."""
    return is_missing(x) | (x != 0)


def with_row_aggregates(wide: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Per wide row, the double total over zones and the non-zero cell count.

    ``row_total`` is NULL when a cell is NULL/NaN (NumPy sums give NaN).
    ``nonzero_cells`` counts cells that are non-zero, NULL or NaN.  Any number
    of zone columns: cells are aggregated as an array.
    """
    zones = zone_columns(wide) if zones is None else zones
    total = F.aggregate("_cells", F.lit(0.0), lambda acc, x: acc + x)
    return (wide.withColumn("_cells", _cells(zones, "double"))
            .withColumn("row_total", F.when(~F.exists("_cells", is_missing), total))
            .withColumn("nonzero_cells", F.size(F.filter("_cells", _kept)))
            .drop("_cells"))


def reference_run(wide: DataFrame) -> Column:
    """Scalar subquery: the run whose stamps define the calendar (lowest sim_id).

    Taken on the unindexed rows: a one-column scan with a partial min."""
    return wide.agg(F.min("sim_id")).scalar()


def calendar(indexed: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """hour_index -> (datetime text, timestamp) taken from the reference run.

    The filter on the run pushes below the hour-index window, so only the
    reference run's rows are numbered."""
    ref = indexed.where(F.col("sim_id") == reference_run(indexed if wide is None else wide))
    # the hour index is a row number within the run, so each hour occurs
    # once: "first stamp per hour" is the run's own row, no aggregation
    return ref.select(F.col("hour_index").cast("int").alias("hour_index"), "datetime",
                      hour24_timestamp("datetime").alias("timestamp"))


def run_stats(rows: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    """A3 + A4 (+ J9 when a calendar is given) per run.

    ``rows`` carries ``sim_id, hour_index, row_total, nonzero_cells``.
    Annual total = sum of row totals (NaN rows skipped), rounded to 6 places;
    peak = largest positive row total at its earliest hour, else (0.0, 0).
    """
    peak = F.max(F.when(F.col("row_total").isNotNull(),
                        F.struct(F.col("row_total").alias("v"), (-F.col("hour_index")).alias("neg_h"))))
    stats = (rows.groupBy("sim_id").agg(
        F.sum("row_total").alias("_annual"),
        F.sum(F.when(F.col("nonzero_cells") > 0, 1).otherwise(0)).alias("nonzero_hour_count"),
        F.sum("nonzero_cells").alias("nonzero_zone_observation_count"),
        peak.alias("_peak"))
        .select(
            F.col("sim_id").cast("int").alias("sim_id"),
            round_even(F.coalesce(F.col("_annual"), F.lit(0.0)), 6).alias("annual_total_heating_j"),
            F.col("nonzero_hour_count").cast("int").alias("nonzero_hour_count"),
            F.col("nonzero_zone_observation_count").cast("int").alias("nonzero_zone_observation_count"),
            F.when(F.col("_peak.v") > 0, F.col("_peak.v")).otherwise(F.lit(0.0))
            .alias("peak_hour_total_heating_j"),
            F.when(F.col("_peak.v") > 0, -F.col("_peak.neg_h")).otherwise(F.lit(0))
            .cast("int").alias("peak_hour_index")))
    if cal is None:
        return stats
    # one row per run against one row per calendar hour: both sides are
    # small per row; AQE turns this into a broadcast join from measured sizes
    lookup = cal.select(F.col("hour_index").alias("peak_hour_index"),
                        F.col("datetime").alias("peak_datetime"),
                        F.col("timestamp").alias("peak_timestamp"))
    return stats.join(lookup, on="peak_hour_index", how="left").select(
        "sim_id", "annual_total_heating_j", "nonzero_hour_count", "nonzero_zone_observation_count",
        "peak_hour_total_heating_j", "peak_hour_index", "peak_datetime", "peak_timestamp")


def unknown_zone_labels(wide: DataFrame, zone_catalog: DataFrame) -> DataFrame:
    """Zone columns of the hourly table that the catalog does not know, sorted."""
    spark = wide.sparkSession
    labels = spark.createDataFrame([(c,) for c in zone_columns(wide)], "zone_label string")
    return (labels.join(zone_catalog.select("zone_label"), on="zone_label", how="left_anti")
            .orderBy("zone_label"))


def assert_known_zone_labels(wide: DataFrame, zone_catalog: DataFrame) -> None:
    """Raise ``KeyError`` listing unknown zone columns (the reference's guard)."""
    bad = [r.zone_label for r in unknown_zone_labels(wide, zone_catalog).collect()]
    if bad:
        raise KeyError(f"Zone columns missing from zone catalog: {', '.join(sorted(bad))}")


def sparse_fact(indexed: DataFrame, zone_catalog: DataFrame,
                zones: list[str] | None = None) -> DataFrame:
    """P17 + P3 + J10: zone columns to rows, non-zero and NULL/NaN cells only,
    map labels to zone ids.  ``(sim_id INT, hour_index INT, zone_id INT, value FLOAT)``."""
    zones = zone_columns(indexed) if zones is None else zones
    labels = F.array(*[F.lit(z) for z in zones]) if zones else F.array().cast("array<string>")
    kept = F.filter(F.transform(_cells(zones, "float"), lambda x, i: F.struct(i.alias("at"), x.alias("value"))),
                    lambda c: _kept(c["value"]))
    # only the cells that stay become rows
    long = (indexed.select("sim_id", "hour_index", F.explode(kept).alias("_c"))
            .select("sim_id", "hour_index", F.element_at(labels, F.col("_c.at") + 1).alias("zone_label"), "_c.value"))
    return long.join(zone_catalog.select("zone_label", "zone_id"), on="zone_label", how="inner").select(
        F.col("sim_id").cast("int"), F.col("hour_index").cast("int"),
        F.col("zone_id").cast("int"), F.col("value").cast("float"))


def kept_cells(zones: list[str]) -> list[Column]:
    """The cells of a wide row that stay, as two arrays that Arrow carries
    whole: ``cells`` their places among ``zones``, from 1, negative for a NULL
    cell, and ``cell_values`` (0 for a NULL cell, NaN stays NaN)."""
    cells = F.filter(F.transform(_cells(zones, "float"), lambda x, i: F.struct((i + 1).alias("at"), x.alias("value"))),
                     lambda c: _kept(c["value"]))
    return [F.transform(cells, lambda c: F.when(c["value"].isNull(), -c["at"]).otherwise(c["at"])).alias("cells"),
            F.transform(cells, lambda c: F.coalesce(c["value"], F.lit(0.0).cast("float"))).alias("cell_values")]


def cells_to_fact(rows: DataFrame, zone_catalog: DataFrame, zones: list[str]) -> DataFrame:
    """Rows with :func:`kept_cells` and ``hour_index`` -> the sparse fact."""
    labels = F.array(*[F.lit(z) for z in zones]) if zones else F.array().cast("array<string>")
    long = (rows.select("sim_id", "hour_index", F.explode(F.arrays_zip("cells", "cell_values")).alias("_c"))
            .select("sim_id", "hour_index", F.element_at(labels, F.abs("_c.cells")).alias("zone_label"),
                    F.when(F.col("_c.cells") > 0, F.col("_c.cell_values")).alias("value")))
    return long.join(zone_catalog.select("zone_label", "zone_id"), on="zone_label", how="inner").select(
        F.col("sim_id").cast("int"), F.col("hour_index").cast("int"),
        F.col("zone_id").cast("int"), F.col("value").cast("float"))


def zero_fraction(rows: DataFrame, n_zone_columns: int) -> DataFrame:
    """A5: one row with total cells, non-zero cells and the zero fraction (6 places)."""
    agg = rows.agg(F.count(F.lit(1)).alias("_rows"),
                   F.coalesce(F.sum("nonzero_cells"), F.lit(0)).cast("long").alias("nonzero_cells"))
    total = (F.col("_rows") * F.lit(n_zone_columns)).cast("long")
    return agg.select(
        total.alias("total_cells"), "nonzero_cells",
        F.when(total > 0, round_even(F.lit(1.0) - F.col("nonzero_cells") / total, 6))
        .otherwise(F.lit(0.0)).alias("hourly_zero_fraction"))


def hourly_marts(wide: DataFrame, zone_catalog: DataFrame, check_labels: bool = True) -> dict:
    """Calendar, run_stats, hourly_sparse and the zero-fraction row.

    The indexed wide rows are shared by all outputs; callers that act on
    several outputs write ``marts['indexed']`` to shared storage first
    (``marts_from_indexed`` takes it from there).
    """
    zones = zone_columns(wide)
    if check_labels:
        assert_known_zone_labels(wide, zone_catalog)
    base = wide.select(F.col("sim_id").cast("int").alias("sim_id"), "datetime", *zones)
    rows = with_row_aggregates(base, zones)
    return marts_from_indexed(with_hour_index(rows), zone_catalog, base, rows)


def marts_from_indexed(indexed: DataFrame, zone_catalog: DataFrame, base: DataFrame | None = None,
                       rows: DataFrame | None = None) -> dict:
    """The marts from indexed wide rows with their aggregates.

    ``base`` and ``rows`` stand for it where hour order plays no part, so that
    such outputs need not number the rows."""
    zones = zone_columns(indexed)
    cal = calendar(indexed, indexed if base is None else base)
    return {
        "indexed": indexed,
        "calendar": cal,
        "run_stats": run_stats(indexed, cal),
        "hourly_sparse": sparse_fact(indexed, zone_catalog, zones),
        "zero_fraction": zero_fraction(indexed if rows is None else rows, len(zones)),
    }

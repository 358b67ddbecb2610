"""Hourly marts on hand-made wide rows (FIXTURES.md section C)."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hypercube.operators import hourly
from hypercube.operators.ordinal import sliced_row_number

WIDE = "sim_id int, datetime string, zone_a float, zone_b float"


def _catalog(spark):
    return spark.createDataFrame([(0, "a", "zone_a"), (1, "b", "zone_b")],
                                 "zone_id int, zone_name string, zone_label string")


def _marts(spark, rows):
    wide = spark.createDataFrame(rows, WIDE)
    return hourly.hourly_marts(wide, _catalog(spark))


def test_peak_tie_keeps_earliest(spark):
    rows = [(1, " 01/01  01:00:00", 2.0, 3.0), (1, " 01/01  02:00:00", 3.0, 4.0),
            (1, " 01/01  03:00:00", 7.0, 0.0)]
    s = _marts(spark, rows)["run_stats"].first()
    assert s.peak_hour_total_heating_j == 7.0 and s.peak_hour_index == 1
    assert s.annual_total_heating_j == 19.0
    assert s.nonzero_hour_count == 3 and s.nonzero_zone_observation_count == 5
    assert s.peak_datetime == " 01/01  02:00:00"


def test_all_zero_run(spark):
    rows = [(2, f" 01/01  0{h}:00:00", 0.0, 0.0) for h in (1, 2, 3)]
    m = _marts(spark, rows)
    s = m["run_stats"].first()
    assert (s.annual_total_heating_j, s.peak_hour_total_heating_j, s.peak_hour_index,
            s.nonzero_hour_count, s.nonzero_zone_observation_count) == (0.0, 0.0, 0, 0, 0)
    assert m["hourly_sparse"].count() == 0
    z = m["zero_fraction"].first()
    assert z.total_cells == 6 and z.nonzero_cells == 0 and z.hourly_zero_fraction == 1.0


def test_null_and_nan_cells(spark):
    rows = [(3, " 01/01  01:00:00", 1.0, None), (3, " 01/01  02:00:00", float("nan"), 5.0),
            (3, " 01/01  03:00:00", 2.0, 0.0)]
    m = _marts(spark, rows)
    s = m["run_stats"].first()
    # rows with a NULL/NaN cell count as non-zero but leave sums and the peak
    assert s.annual_total_heating_j == 2.0
    assert s.peak_hour_total_heating_j == 2.0 and s.peak_hour_index == 2
    assert s.nonzero_hour_count == 3 and s.nonzero_zone_observation_count == 5
    sparse = sorted((r.hour_index, r.zone_id, r.value) for r in m["hourly_sparse"].collect())
    assert len(sparse) == 5
    assert (0, 1, None) in sparse
    assert any(h == 1 and z == 0 and v is not None and math.isnan(v) for h, z, v in sparse)


def test_hour_index_orders_by_stamp_with_hour_24(spark):
    rows = [(5, " 01/02  01:00:00", 1.0, 0.0), (5, " 01/01  24:00:00", 1.0, 0.0),
            (5, " 01/01  23:00:00", 1.0, 0.0)]
    wide = spark.createDataFrame(rows, WIDE)
    got = {r.datetime: r.hour_index for r in hourly.with_hour_index(wide).collect()}
    assert got == {" 01/01  23:00:00": 0, " 01/01  24:00:00": 1, " 01/02  01:00:00": 2}


def test_calendar_from_lowest_run(spark):
    rows = [(7, " 01/01  05:00:00", 1.0, 0.0), (4, " 01/01  01:00:00", 1.0, 0.0),
            (4, " 01/01  02:00:00", 1.0, 0.0)]
    cal = _marts(spark, rows)["calendar"].orderBy("hour_index").collect()
    assert [(r.hour_index, r.datetime) for r in cal] == [(0, " 01/01  01:00:00"), (1, " 01/01  02:00:00")]


def test_unknown_zone_label_raises(spark):
    wide = spark.createDataFrame([(1, " 01/01  01:00:00", 1.0, 2.0, 3.0)], WIDE + ", zone_x float")
    with pytest.raises(KeyError, match="zone_x"):
        hourly.hourly_marts(wide, _catalog(spark))


def test_sliced_row_number_matches_plain_window(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 3), rnd.randint(0, 40), rnd.random()) for _ in range(600)]
    rows = list({(g, s, v) for g, s, v in rows})
    df = spark.createDataFrame(rows, "g int, s int, v double")
    ours = sliced_row_number(df, ["g"], "s", ["v"], out="rn")
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("s", "v")))
    assert sorted(ours.collect()) == sorted(plain.select(*ours.columns).collect())


def test_sparse_equals_wide_totals(spark, sf_small):
    """Property: sum of the sparse fact = sum of the wide cells; the sparse row
    count = the non-zero observation count summed over runs."""
    from hypercube.plans.study import Study
    st = Study(spark, sf_small)
    m = st.marts
    sparse_sum, sparse_n = m["hourly_sparse"].agg(F.sum("value"), F.count(F.lit(1))).first()
    zs = hourly.zone_columns(st.hourly_wide)
    wide_sum = st.hourly_wide.agg(sum(F.sum(c) for c in zs)).first()[0]
    stats_n = m["run_stats"].agg(F.sum("nonzero_zone_observation_count")).first()[0]
    assert abs(sparse_sum - wide_sum) < 1e-6 * max(1.0, abs(wide_sum))
    assert sparse_n == stats_n


def test_unpivot_then_pivot_is_identity(spark, sf_small):
    """Property: pivoting the sparse fact back (zero-filled) gives the wide cells."""
    from hypercube.plans.study import Study
    st = Study(spark, sf_small)
    m = st.marts
    cat = st.zone_catalog
    zs = hourly.zone_columns(st.hourly_wide)
    back = (m["hourly_sparse"].join(cat.select("zone_id", "zone_label"), "zone_id")
            .groupBy("sim_id", "hour_index").pivot("zone_label", zs).agg(F.first("value")).na.fill(0.0))
    orig = m["indexed"].select("sim_id", "hour_index", *zs)
    nonzero_rows = orig.where(sum((F.col(z) != 0).cast("int") for z in zs) > 0)
    assert back.select("sim_id", "hour_index", *zs).exceptAll(nonzero_rows).count() == 0
    assert nonzero_rows.exceptAll(back.select("sim_id", "hour_index", *zs)).count() == 0


def test_five_thousand_zones(spark):
    zones = [f"zone_{k}" for k in range(5000)]
    rows = [(1, f"01/01  0{i + 1}:00:00", *[float(k % 3 * i) for k in range(5000)]) for i in range(3)]
    wide = spark.createDataFrame(rows, "sim_id int, datetime string, " + ", ".join(f"{z} float" for z in zones))
    catalog = spark.createDataFrame(list(enumerate(zones)), "zone_id int, zone_label string")
    row = sum(k % 3 for k in range(5000))
    rows = hourly.with_row_aggregates(wide)
    assert sorted((r.row_total, r.nonzero_cells) for r in rows.select("row_total", "nonzero_cells").collect()) == [
        (0.0, 0), (float(row), 3333), (2.0 * row, 3333)]
    sparse = hourly.sparse_fact(hourly.with_hour_index(wide), catalog)
    got = sparse.agg(F.count(F.lit(1)), F.sum("value"), F.sum(F.col("zone_id").cast("long"))).first()
    ids = sum(k for k in range(5000) if k % 3)
    assert tuple(got) == (6666, 3.0 * row, 2 * ids)


def test_no_zone_columns(spark):
    wide = spark.createDataFrame([(1, "01/01  01:00:00")], "sim_id int, datetime string")
    row = hourly.with_row_aggregates(wide).first()
    assert (row.row_total, row.nonzero_cells) == (0.0, 0)
    catalog = spark.createDataFrame([], "zone_id int, zone_label string")
    assert hourly.sparse_fact(hourly.with_hour_index(wide), catalog).collect() == []

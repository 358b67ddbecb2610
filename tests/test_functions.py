"""Golden micro-cases for the column expressions (hand-made rows)."""

from __future__ import annotations

import time

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hypercube.functions import (editable_layers, heating_switch_times, hour24_timestamp,
                                 layer_list, normalize_columns, normalize_name, normalize_name_table, polygon_area, rectangle, round_even,
                                 shading_window_from_close, shading_window_symmetric, zone_from_header)
from hypercube.functions.geometry import mean_z


def test_hour24_timestamp(spark):
    df = spark.createDataFrame([(" 12/31  24:00:00",), ("02/28 24:00:00",), ("   ",), ("01/01  01:00:00",)], "s string")
    got = [r.t for r in df.select(hour24_timestamp("s").alias("t")).collect()]
    assert got == [dt.datetime(2002, 1, 1), dt.datetime(2001, 3, 1), None, dt.datetime(2001, 1, 1, 1)]


@pytest.mark.parametrize("text", ["01/01  25:00:00", "13/01  01:00:00", "02/30 01:00:00", "01/01", "01/01  01:60:00", "noon", "01/01  -1:00:00"])
def test_malformed_stamp_raises(spark, text):
    with pytest.raises(Exception, match="not a simulator stamp"):
        spark.createDataFrame([(text,)], "s string").select(hour24_timestamp("s")).collect()


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (-0.125,)], "x double")
    got = [r.y for r in df.select(round_even("x", 2).alias("y")).collect()]
    assert got == [0.12, 0.38, 2.5, -0.12]
    got0 = [r.y for r in spark.createDataFrame([(2.5,), (3.5,)], "x double")
            .select(round_even("x", 0).alias("y")).collect()]
    assert got0 == [2.0, 4.0]


@pytest.mark.parametrize("names, expected", [
    (["a b", "A-B", "9x", "__"], ["a_b", "a_b_2", "col_9x", "col"]),
    (["a", "a", "a_2"], ["a", "a_2", "a_2_2"]),
    (["A", "a", "a_2"], ["a", "a_2", "a_2_2"]),
    (["a_2", "a", "a", "a"], ["a_2", "a", "a_3", "a_4"]),
    (["x_2_2", "x_2", "x", "x", "x_2"], ["x_2_2", "x_2", "x", "x_3", "x_2_3"]),
    (["#", "col", "1", "col_1"], ["col", "col_2", "col_1", "col_1_2"]),
])
def test_name_normalisation_and_clash(spark, names, expected):
    table = spark.createDataFrame(list(enumerate(names)), "i int, n string")
    got = normalize_name_table(table, "n", ["i"]).orderBy("i").collect()
    assert [r.deduped for r in got] == expected and [r.n for r in got] == names


def test_a_large_family_of_names(spark):
    """100,000 names of one family, every tenth twice, and the bare name 500 times."""
    n = 100_000
    names = (spark.range(2, n + 2).selectExpr("id AS i", "concat('Zone ', id) AS n")
             .union(spark.range(0, n, 10).selectExpr("id + 1000000 AS i", "concat('zone-', id + 2) AS n"))
             .union(spark.range(500).selectExpr("id + 2000000 AS i", "'ZONE' AS n")))
    began = time.monotonic()
    got = {r.i: r.deduped for r in normalize_name_table(names, "n", ["i"]).collect()}
    took = time.monotonic() - began
    assert len(got) == len(set(got.values())) == n + n // 10 + 500
    assert got[7] == "zone_7" and got[1000010] == "zone_12_2"
    assert got[2000000] == "zone" and got[2000001] == f"zone_{n + 2}" and got[2000499] == f"zone_{n + 500}"
    assert took < 60, took


def test_column_names_are_normalised(spark):
    df = spark.range(1).selectExpr("1 AS `Zone 1`", "2 AS `zone-1`", "3 AS `9`")
    assert normalize_columns(df).columns == ["zone_1", "zone_1_2", "col_9"]


def test_normalize_name_column(spark):
    df = spark.createDataFrame([("a b",), ("A-B",), ("9x",), ("__",), (" Zone 1: Heat [J] ",)], "n string")
    got = [r.v for r in df.select(normalize_name("n").alias("v")).collect()]
    assert got == ["a_b", "a_b", "col_9x", "col", "zone_1_heat_j"]


def test_heating_switch_times(spark):
    df = spark.createDataFrame([(h,) for h in (2, 4, 5, 8, 9, 14)], "h int")
    got = [tuple(r.t) for r in df.select(heating_switch_times("h").alias("t")).collect()]
    assert got == [("08:00", "08:00", "20:00", "22:00"), ("08:00", "08:00", "18:00", "22:00"),
                   ("09:00", "10:00", "18:00", "22:00"), ("06:00", "10:00", "18:00", "22:00"),
                   ("06:00", "10:00", "17:00", "22:00"), ("06:00", "10:00", "12:00", "22:00")]


def test_shading_windows(spark):
    df = spark.createDataFrame([(5, 18), (16, 20)], "h int, c int")
    close = [tuple(r.w) for r in df.select(shading_window_from_close("h", "c").alias("w")).collect()]
    sym = [tuple(r.w) for r in df.select(shading_window_symmetric("h").alias("w")).collect()]
    assert close == [("13:00", "18:00"), ("04:00", "20:00")]
    assert sym == [("11:30", "16:30"), ("06:00", "22:00")]


def test_polygon_area_and_mean_z(spark):
    df = spark.createDataFrame([(4.0, 5.0, 3.0)], "w double, d double, z double")
    r = df.select(polygon_area(rectangle("w", "d", "z")).alias("a"),
                  mean_z(rectangle("w", "d", "z")).alias("z")).first()
    assert r.a == 20.0 and r.z == 3.0
    tilted = spark.sql("select array(named_struct('x',0d,'y',0d,'z',0d), named_struct('x',3d,'y',0d,'z',0d),"
                       " named_struct('x',3d,'y',4d,'z',4d), named_struct('x',0d,'y',4d,'z',4d)) as v")
    assert abs(tilted.select(polygon_area("v").alias("a")).first().a - 3 * 32 ** 0.5) < 1e-12


def test_zone_from_header(spark):
    df = spark.createDataFrame([("ZONE1 IDEAL LOADS AIR:Zone Ideal Loads Supply Air Total Heating Energy [J](Hourly)",)], "h string")
    assert df.select(zone_from_header("h").alias("z")).first().z == "ZONE1"


def test_layer_list_and_editable(spark):
    df = spark.createDataFrame([("A", "B", None, "", "C")], "o string, l2 string, l3 string, l4 string, l5 string")
    r = df.select(layer_list("o", "l2", "l3", "l4", "l5").alias("l")).select(
        "l", editable_layers("l").alias("e")).first()
    assert r.l == ["A", "B", "C"] and r.e == ["A", "B"]
    one = spark.createDataFrame([("A",)], "o string").select(layer_list("o").alias("l"))
    assert one.select(editable_layers("l").alias("e")).first().e == []


def test_ceil_div(spark):
    from hypercube.functions import ceil_div
    df = spark.createDataFrame([(1,), (20,), (21,), (40,)], "s int")
    assert [r.b for r in df.select(ceil_div("s", F.lit(20)).alias("b")).collect()] == [1, 1, 2, 2]

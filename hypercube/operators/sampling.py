"""Latin Hypercube design matrix (C2: W5, F7, P18, F16).

Contract of the sampler: for every parameter, the n runs fall one per
stratum [k/n, (k+1)/n), with uniform jitter inside the stratum, reproducibly
for a seed.  The permutation of strata per parameter is the order of a keyed
hash ``md5(seed:param:sim_id)``; the jitter is the first 32 bits of a second
hash.  Values are scaled to [lo, hi], snapped to the step grid and rounded
to 3 places, as the reference does.

Distribution: the long form has one row per (parameter, run), made by
exploding the (small, plan-time) parameter list on each run row, never by a
join.  The stratum is a row number per parameter, numbered inside slices of
the hash prefix (4,096 slices) plus slice offsets, so a parameter's n rows
never meet in one task.  The pivot back to one row per run is a
hash aggregation on sim_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypercube.functions.numeric import round_even
from hypercube.operators.ordinal import sliced_row_number


@dataclass(frozen=True)
class Param:
    name: str
    lo: float
    hi: float
    step: float

    @property
    def is_int(self) -> bool:
        return float(self.step).is_integer() and float(self.lo).is_integer()


# Fixed values (must equal the reference): parameter ranges (lo, hi, step).
# Default = the 12-parameter space that the worker phase and the docs use.
SPACE_12 = (
    Param("f_wall", 1.0, 1.5, 0.01),
    Param("f_roof", 1.0, 1.5, 0.01),
    Param("f_win", 1.0, 1.3, 0.01),
    Param("setpoint", 17.0, 24.0, 0.1),
    Param("hours", 2, 14, 1),
    Param("inf", 0.3, 1.5, 0.05),
    Param("vent", 0.0, 0.8, 0.05),
    Param("misc", 1.0, 6.0, 0.2),
    Param("shgc", 0.1, 0.9, 0.05),
    Param("s_hours", 4, 11, 1),
    Param("s_close", 16, 20, 1),
    Param("cop", 0.65, 0.95, 0.05),
)
# The current sampler's 11-parameter space (no s_close, s_hours 1..16).
SPACE_11 = (
    Param("f_wall", 1.0, 1.5, 0.01),
    Param("f_roof", 1.0, 1.5, 0.01),
    Param("f_win", 1.0, 1.3, 0.01),
    Param("setpoint", 17.0, 24.0, 0.1),
    Param("hours", 2, 14, 1),
    Param("inf", 0.3, 1.5, 0.05),
    Param("vent", 0.0, 0.8, 0.05),
    Param("misc", 1.0, 6.0, 0.2),
    Param("shgc", 0.1, 0.9, 0.05),
    Param("s_hours", 1, 16, 1),
    Param("cop", 0.65, 0.95, 0.05),
)
DEFAULT_SEED = 42
HASH_SLICE_HEX_DIGITS = 3
JITTER_SCALE = 4294967296.0  # 2**32
DEGENERATE_WIDEN = 1e-7


def space_frame(spark, space=SPACE_12) -> DataFrame:
    """The parameter space as a table ``(name, lo, hi, step, ord)``."""
    return spark.createDataFrame([(p.name, float(p.lo), float(p.hi), float(p.step), i)
                                  for i, p in enumerate(space)],
                                 "name string, lo double, hi double, step double, ord int")


def space_from_frame(df: DataFrame) -> tuple[Param, ...]:
    """Read a parameter-space table (a handful of rows) into plan-time constants."""
    rows = df.orderBy("ord").collect()
    return tuple(Param(r["name"], r["lo"], r["hi"], r["step"]) for r in rows)


def _key(seed: int, tag: str | None, name: Column, sim_id: Column) -> Column:
    parts = [F.lit(f"{seed}:")] + ([F.lit(f"{tag}:")] if tag else []) + [
        name, F.lit(":"), sim_id.cast("string")]
    return F.md5(F.concat(*parts))


def scale_and_snap(u: Column, lo: Column, hi: Column, step: Column) -> Column:
    """lo + u*(hi-lo) (hi widened by 1e-7 when hi <= lo), snapped to the
    step grid with half-even rounding, then rounded to 3 places."""
    top = F.when(hi > lo, hi).otherwise(hi + F.lit(DEGENERATE_WIDEN))
    scaled = lo + u * (top - lo)
    return round_even(F.rint(scaled / step) * step, 3)


def lhs_long(runs: DataFrame, space=SPACE_12, seed: int = DEFAULT_SEED) -> DataFrame:
    """One row per (parameter, run): stratum, jitter, unit sample u, value."""
    params = F.array(*[F.struct(F.lit(p.name).alias("name"), F.lit(float(p.lo)).alias("lo"),
                                F.lit(float(p.hi)).alias("hi"), F.lit(float(p.step)).alias("step"))
                       for p in space])
    n = runs.agg(F.count(F.lit(1))).scalar()
    long = (runs.select(F.col("sim_id").cast("int").alias("sim_id"), F.explode(params).alias("p"))
            .select("sim_id", "p.*"))
    long = (long.withColumn("_h", _key(seed, None, F.col("name"), F.col("sim_id")))
            .withColumn("_slice", F.conv(F.substring("_h", 1, HASH_SLICE_HEX_DIGITS), 16, 10).cast("int")))
    ranked = sliced_row_number(long, ["name"], "_slice", ["_h", "sim_id"], out="stratum", start=1)
    jitter = (F.conv(F.substring(_key(seed, "j", F.col("name"), F.col("sim_id")), 1, 8), 16, 10)
              .cast("long") / F.lit(JITTER_SCALE))
    return (ranked.drop("_h", "_slice")
            .withColumn("jitter", jitter)
            .withColumn("u", (F.col("stratum") - 1 + F.col("jitter")) / n)
            .withColumn("value", scale_and_snap(F.col("u"), F.col("lo"), F.col("hi"), F.col("step"))))


def lhs_design(runs: DataFrame, space=SPACE_12, seed: int = DEFAULT_SEED) -> DataFrame:
    """``sim_id`` plus one column per parameter (integer-step ones as INT)."""
    long = lhs_long(runs, space, seed)
    cols = []
    for p in space:
        v = F.max(F.when(F.col("name") == p.name, F.col("value")))
        cols.append((v.cast("int") if p.is_int else v).alias(p.name))
    return long.groupBy("sim_id").agg(*cols)


def stratum_check(long: DataFrame, runs: DataFrame) -> DataFrame:
    """W5 property: per parameter, runs, distinct strata hit by u, whether
    every stratum is hit exactly once, and the value range."""
    n = runs.agg(F.count(F.lit(1))).scalar()
    hit = F.floor(F.col("u") * n).cast("long")
    return (long.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_distinct(hit).alias("n_strata"),
        F.min("stratum").alias("min_stratum"), F.max("stratum").alias("max_stratum"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"))
        .withColumn("all_once", F.col("n_strata") == F.col("n_runs")))

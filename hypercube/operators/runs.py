"""Run-level marts: runs (C11), column catalog (C12), audits.

All run-level tables are keyed by ``sim_id`` and grow with the study, so they
are joined by shuffle on ``sim_id`` (never broadcast); the joins share one
hash partitioning, so the design is shuffled once for both lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercube.functions.names import normalize_columns
from hypercube.functions.numeric import ceil_div, round_even

# Fixed values (must equal the reference): run states, the parameter columns,
# the runtime identifiers, and the column descriptions of the catalog.
OK, FAILED, SUMMARY_ONLY, MISSING = "ok", "failed", "summary_only", "missing"
PARAMETER_COLUMNS = ("f_wall", "f_roof", "f_win", "setpoint", "hours", "inf", "vent", "misc",
                     "shgc", "s_hours", "s_close", "cop")
RUNTIME_COLUMNS = ("batch_id", "input_format", "energyplus_returncode")
STATUS_COLUMNS = ("run_status", "has_summary", "has_timing")
COLUMN_DESCRIPTIONS = {
    "sim_id": "Simulation identifier",
    "f_wall": "Envelope aging factor for exterior walls",
    "f_roof": "Envelope aging factor for roofs",
    "f_win": "Envelope aging factor for windows",
    "setpoint": "Heating setpoint in Celsius",
    "hours": "Heating schedule hours selector",
    "inf": "Infiltration rate in air changes per hour",
    "vent": "Ventilation rate in air changes per hour",
    "misc": "Miscellaneous internal gains in W/m2",
    "shgc": "Solar heat gain coefficient",
    "s_hours": "Shading schedule hours selector",
    "s_close": "Shading close hour selector",
    "cop": "Boiler coefficient of performance",
    "kwh_sqm_ground": "Heating energy intensity for ground floor zones",
    "kwh_sqm_middle": "Heating energy intensity for middle floor zones",
    "kwh_sqm_top": "Heating energy intensity for top floor zones",
    "run_status": "Run outcome derived from EnergyPlus return code and outputs",
    "has_summary": "Whether aggregated simulation outputs were produced",
    "has_timing": "Whether timing instrumentation data was produced",
}


def run_status(has_summary, returncode=None):
    """NULL return code -> summary_only / missing; 0 -> ok; else failed.
    Without a return-code column: ok if summarised, else missing."""
    hs = F.col(has_summary) if isinstance(has_summary, str) else has_summary
    by_summary = F.when(hs, F.lit(SUMMARY_ONLY)).otherwise(F.lit(MISSING))
    if returncode is None:
        return F.when(hs, F.lit(OK)).otherwise(F.lit(MISSING))
    rc = F.col(returncode) if isinstance(returncode, str) else returncode
    return F.when(rc.isNull(), by_summary).when(rc == 0, F.lit(OK)).otherwise(F.lit(FAILED))


def runs_mart(design: DataFrame, summary: DataFrame | None = None,
              timing: DataFrame | None = None) -> DataFrame:
    """C11: design LEFT JOIN summary (only columns the design lacks) LEFT JOIN
    timing, presence flags, run status, names normalised.

    Duplicate ids in summary or timing multiply rows, as plain left joins do
    (see ``duplicate_run_ids``).
    """
    runs = design
    has_rc = False
    if summary is not None:
        extra = [c for c in summary.columns if c not in design.columns]
        s = summary.select("sim_id", *extra).withColumn("_has_summary", F.lit(True))
        runs = runs.join(s.hint("merge"), on="sim_id", how="left")
    if timing is not None:
        t = timing.withColumn("_has_timing", F.lit(True))
        runs = runs.join(t.hint("merge"), on="sim_id", how="left")
        has_rc = "energyplus_returncode" in timing.columns
    has_summary = F.coalesce(F.col("_has_summary"), F.lit(False)) if summary is not None else F.lit(False)
    has_timing = F.coalesce(F.col("_has_timing"), F.lit(False)) if timing is not None else F.lit(False)
    runs = (runs.withColumn("has_summary", has_summary).withColumn("has_timing", has_timing)
            .withColumn("run_status", run_status("has_summary",
                                                 "energyplus_returncode" if has_rc else None))
            .drop("_has_summary", "_has_timing")
            .withColumn("sim_id", F.col("sim_id").cast("int")))
    return normalize_columns(runs)


def column_catalog(runs: DataFrame) -> DataFrame:
    """One row per runs column with its group, its description and
    the number of runs that have a value in it, counted in one pass."""
    spark = runs.sparkSession
    columns = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                                 F.col(f"_n{i}").alias("n_values")) for i, c in enumerate(runs.columns)])
    names = (runs.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(runs.columns)])
             .select(F.explode(columns).alias("_c")).select("_c.*"))
    descriptions = spark.createDataFrame(list(COLUMN_DESCRIPTIONS.items()),
                                         "column_name string, description string")
    c = F.col("column_name")
    group = (F.when(c == "sim_id", "identifier")
             .when(c.isin(*PARAMETER_COLUMNS), "parameter")
             .when(c.startswith("kwh_sqm_"), "summary_kpi")
             .when(c.endswith("_sec") | c.isin(*RUNTIME_COLUMNS), "runtime")
             .when(c.isin(*STATUS_COLUMNS), "status")
             .otherwise("metric"))
    # descriptions: the fixed 19-row table above, a proven broadcast bound
    return (names.join(F.broadcast(descriptions), on="column_name", how="left")
            .select("ordinal", "column_name", group.alias("group_name"),
                    F.coalesce(F.col("description"), F.lit("")).alias("description"), "n_values"))


def batch_of(sim_id, batch_size: int):
    """P10: batch b holds runs (b-1)*B+1 .. b*B."""
    return ceil_div(sim_id, F.lit(batch_size))


def missing_runs_audit(runs: DataFrame, batch_size: int) -> DataFrame:
    """Q2 + A18: per batch, design rows, finished runs, states, percent done."""
    st = F.col("run_status")
    agg = (runs.withColumn("batch_id", batch_of("sim_id", batch_size))
           .groupBy("batch_id").agg(
               F.count(F.lit(1)).alias("n_runs"),
               F.count_if(F.col("has_summary")).alias("n_done"),
               F.count_if(st == OK).alias("n_ok"),
               F.count_if(st == FAILED).alias("n_failed"),
               F.count_if(st == SUMMARY_ONLY).alias("n_summary_only"),
               F.count_if(st == MISSING).alias("n_missing"),
               F.min("sim_id").alias("first_sim"), F.max("sim_id").alias("last_sim")))
    done = F.least(F.col("n_done"), F.col("n_runs"))
    return agg.withColumn("pct_done", round_even(done * F.lit(100.0) / F.col("n_runs"), 2))


def run_status_histogram(runs: DataFrame) -> DataFrame:
    """Runs per state."""
    return runs.groupBy("run_status").agg(F.count(F.lit(1)).alias("n_runs"))


def duplicate_run_ids(tables: dict[str, DataFrame], key: str = "sim_id") -> DataFrame:
    """Q3: ids occurring more than once within a source table."""
    parts = [df.select(F.lit(name).alias("source"), F.col(key).cast("int").alias(key))
             for name, df in tables.items()]
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p)
    return (unioned.groupBy("source", key).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))

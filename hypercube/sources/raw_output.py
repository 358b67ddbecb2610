"""Simulator output files -> long raw rows.

Each run writes one wide CSV (``Date/Time`` + one column per output
variable) in a folder named ``Run_<sim_id>``.  ``read_raw_output`` reads all
of them, a portion of the files at a time, takes ``sim_id`` from the file path, numbers output
rows by their stamp, and unpivots the value columns to
``(sim_id, datetime, header, joules)``.  Files with different headers are
read separately, by their own column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.session import work_dir
from hypercube.sources.csv import PORTION_SETTINGS, header_portions, read_text_columns, settings

RUN_DIR_PATTERN = r"Run_(\d+)"
STAMP_COLUMN = "Date/Time"


def scan_raw_output(spark: SparkSession, paths: list[str] | str,
                    take: Callable[[DataFrame], DataFrame] | None = None) -> list[DataFrame]:
    """All runs' output files below ``paths`` as they are, one frame per
    different header: ``sim_id, datetime`` and the output variables as text, or
    what ``take``, a projection, makes of these.

    Columns are taken by name: files are grouped by their header line, and
    each group's reader checks it again.  A study has a file a run, so a portion
    of the files is read at a time and its rows are kept as Parquet, in one
    folder per header: the driver never holds all files.
    """
    root, kept = work_dir(spark, "raw-output-rows"), {}

    def keep(head: str, files: list[str]) -> None:
        df = read_text_columns(spark, files)
        df = (df.withColumn("sim_id", F.regexp_extract(F.col("_metadata.file_path"), RUN_DIR_PATTERN, 1).cast("int"))
              .withColumnRenamed(STAMP_COLUMN, "datetime"))
        df = take(df) if take else df
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # headers need not be names that Parquet takes
        path, _, _ = kept.setdefault(head, (f"{root}/{len(kept)}", plain.schema, df.columns))
        plain.write.mode("append").option("compression", "zstd").parquet(path)

    with settings(spark, PORTION_SETTINGS):
        for heads in header_portions(spark, paths):
            for head, files in heads.items():
                keep(head, files)
    return [spark.read.schema(schema).parquet(path).toDF(*names) for _, (path, schema, names) in sorted(kept.items())]


def read_raw_output(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Long rows ``(sim_id, datetime, header, joules)`` of all runs' output files."""
    out = None
    for df in scan_raw_output(spark, paths):
        values = [c for c in df.columns if c not in ("sim_id", "datetime")]
        long = df.unpivot(["sim_id", "datetime"], [F.col(f"`{c}`") for c in values], "header", "_text").select(
            "sim_id", "datetime", "header", F.col("_text").cast("double").alias("joules"))
        out = long if out is None else out.unionByName(long)
    return out if out is not None else spark.createDataFrame([], "sim_id int, datetime string, header string, joules double")


def write_run_files(wide: DataFrame, root: str) -> None:
    """Write one simulator-style CSV folder per run (``Run_<sim_id>``), with
    ``Date/Time`` first, as the simulator leaves them (used to land test data).

    The cost of a run is its file, not its bytes, so the number of tasks is
    given: adaptive execution would join them by their bytes.  A task's runs are
    in a folder of their own, as a worker's are, so that no folder has all runs."""
    n = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in wide.columns if c not in ("sim_id", STAMP_COLUMN)]
    (wide.withColumn("run", F.concat(F.lit("Run_"), F.col("sim_id").cast("string")))
     .select(F.pmod(F.hash("run"), F.lit(n)).alias("worker"), "run", STAMP_COLUMN, *cols)
     .repartition(n, "run").write.partitionBy("worker", "run").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))

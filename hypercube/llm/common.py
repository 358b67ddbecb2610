"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.session import work_dir

#: What the operators call a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spare(df: DataFrame, *names: str) -> list[str]:
    """The given names, prefixed as far as needed to differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    work, and several readers share one computation.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """In a Python worker: memory that was freed goes back to the system.

    Arrow and the C library (glibc) would keep it, in a worker that runs
    other tasks next, beside what those allocate.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)

"""Base table registration for the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from hypercube.session import path_exists

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_READS: dict[tuple[str, str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning and filters reach the scan through Catalyst.

    The DataFrame (a plan, not data) is reused per application and path.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(table_path(sf_dir, name))
    return _READS[key]


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Register each table present under ``sf_dir`` as a temp view of its own name."""
    for name in names:
        path = table_path(sf_dir, name)
        if path_exists(spark, path):
            read_table(spark, sf_dir, name).createOrReplaceTempView(name)

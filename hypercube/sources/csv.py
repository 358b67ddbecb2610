"""CSV batch files whose headers drift between groups.

Spark's CSV reader binds columns by position.  Files written by different
worker versions can order or omit columns differently, so files are grouped by
their header line, each group read with its header validated against every
file (``enforceSchema=False`` fails on a differing header), cast to the
declared type of each column by name, and unioned by name; a column a group
lacks is NULL.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.session import path_exists

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# files of a portion, about: the driver holds some KB for each while the portion is read
FILES_AT_ONCE = 10_000
# entries of a folder that the driver looks into itself; tasks list below the entries of larger ones
FEW_ENTRIES = 32
# many small files to a task, one listing job for all folders, and no list of files kept after its portion
PORTION_SETTINGS = {"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
                    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1"}


def header_groups(spark: SparkSession, paths: list[str] | str) -> list[list[str]]:
    """The CSV files below ``paths``, those with the same header line together.

    One text pass; ids grow along a file, so the smallest id of the part that
    begins the file marks its first line.  The driver gets one path per file,
    as its file listing does.
    """
    return list(_files_by_header(spark, [paths] if isinstance(paths, str) else list(paths)).values())


def _files_by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    if not paths:
        return {}
    with listing_tasks(spark):
        found = spark.read.option("recursiveFileLookup", True).text(paths)
    lines = (found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value",
                          F.monotonically_increasing_id().alias("id")).where("at = 0"))
    heads = lines.groupBy("file").agg(F.min_by("value", "id").alias("head"))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    return {r["head"]: r["files"] for r in groups}


def header_portions(spark: SparkSession, paths: list[str] | str) -> Iterator[dict[str, list[str]]]:
    """``header_groups`` for any number of files: header line -> files, of about
    ``FILES_AT_ONCE`` files at a time, which is all that the driver holds of them.

    How many entries make a portion follows from what the one before held.  Python's
    references to a portion's frames are in cycles, so they are collected after it: until
    then the JVM keeps their lists of files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    entries = _entries(spark, paths)
    first = next(entries, None)
    if first is None:
        return
    at_once, entries = FILES_AT_ONCE // max(1, len(_listed(spark, first))), chain([first], entries)
    while portion := list(islice(entries, max(1, at_once))):
        heads = _files_by_header(spark, portion)
        found = sum(len(files) for files in heads.values())
        at_once = min(FILES_AT_ONCE, FILES_AT_ONCE * len(portion) // max(1, found))
        if heads:
            yield heads
        gc.collect()


def _entries(spark: SparkSession, paths: list[str]) -> Iterator[str]:
    """Files and folders that hold all files below ``paths``, each of them once."""
    roots: set[str] = set()
    for path in paths:
        found = _names(spark, _statuses(spark, path, "globStatus"))
        if not found:
            spark.read.text(path)  # says what is missing
        roots.update(found)
    within = {r for r in roots if any(r[:i] in roots for i, c in enumerate(r) if c == "/")}
    return _looked_into(spark, sorted(roots - within))


def _looked_into(spark: SparkSession, entries: list[str]) -> Iterator[str]:
    if len(entries) > FEW_ENTRIES:
        yield from entries
        return
    for entry in entries:
        if _statuses(spark, entry, "getFileStatus").isDirectory():
            yield from _looked_into(spark, _listed(spark, entry))
        else:
            yield entry


def _listed(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder that Spark's readers see (of a file, itself)."""
    hidden = spark.sparkContext._jvm.org.apache.spark.util.HadoopFSUtils.shouldFilterOutPathName
    names = ((p, p.rpartition("/")[2]) for p in _names(spark, _statuses(spark, path, "listStatus")))
    return [p for p, name in names if not ((name[0] in "._" or name.endswith("_")) and hidden(name))]


def _statuses(spark: SparkSession, path: str, call: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return getattr(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), call)(where)


def _names(spark: SparkSession, statuses) -> list[str]:
    """Paths of statuses; they come from the JVM by the thousand."""
    n = len(statuses or ())
    jvm = spark.sparkContext._jvm
    paths = jvm.scala.Predef.genericWrapArray(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)) if n else None
    return [name for i in range(0, n, 10_000) for name in paths.slice(i, i + 10_000).mkString("\0").split("\0")]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are these meanwhile."""
    own = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in own.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def listing_tasks(spark: SparkSession):
    """Files are listed by a few tasks a core meanwhile, not by a task a path:
    ten thousand tasks of one path each cost more than the listing."""
    return settings(spark, {LISTING: str(4 * spark.sparkContext.defaultParallelism)})


def read_text_columns(spark: SparkSession, files: list[str]) -> DataFrame:
    """Files of one header: columns named by the first file's header and read as
    text; every file's header is checked against it as it is read.  The names
    come from one file, so that the others are listed once."""
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("enforceSchema", False).option("mode", "FAILFAST"))
    with listing_tasks(spark):
        return reader.schema(reader.csv(files[0]).schema).csv(files)


def read_csv_group(spark: SparkSession, files: list[str], types: dict[str, str]) -> DataFrame:
    """One header group: each known column cast by name."""
    raw = read_text_columns(spark, files)
    return raw.select(*[F.col(f"`{n}`").cast(types.get(n, "string")).alias(n) for n in raw.columns])


def read_csv_union(spark: SparkSession, paths: list[str] | str, types: dict[str, str]) -> DataFrame:
    """S2 + U1: all CSV files below ``paths``, whatever their headers, by column name (missing -> NULL)."""
    out = None
    for files in header_groups(spark, paths):
        frame = read_csv_group(spark, files, types)
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in types.items()))


def read_optional_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A missing file gives an empty table with the declared columns."""
    if path_exists(spark, path):
        return read_csv_union(spark, path, types)
    return spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in types.items()))


def write_csv(df: DataFrame, path: str, order_by: list[str] | None = None,
              mode: str = "errorifexists") -> None:
    """CSV with a header, rows in key order when asked."""
    out = df.orderBy(*order_by) if order_by else df
    (out.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def type_map(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}

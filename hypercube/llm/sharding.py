"""Sharding by histogram sort (operator 12).

Rows are ordered by a key; the keys that cut all bytes into equal shards are
found by counting the exact bytes below candidate keys, round by round between
the closest candidates, and only then do rows move, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from hypercube.llm.common import columns, spare, table, written

#: A shard's end may miss its place by this share of a shard, or by one row.
TOLERANCE = 0.0005
#: Candidates in each open interval and round.
PROBES = 8
#: Pieces that a shard's rows are numbered in.
PIECES = 512

Key = tuple[int, int, int]


def _below(key: list[str], bounds: list[Key]) -> Column:
    """How many of the sorted ``bounds`` are not above the row's key."""
    if not bounds:
        return F.lit(0)
    here = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])
    there = F.array(*[F.struct(*[F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(b)]) for b in bounds])
    return F.size(F.filter(there, lambda b: b <= here))


def splitters(rows: DataFrame, key: list[str], size: str, shards: int, tolerance: float = TOLERANCE) -> list[Key]:
    """``shards - 1`` keys (shards start at them) that cut the bytes evenly.

    A round counts the exact bytes between all candidates, in one aggregation
    with a row for each interval, and draws ``PROBES`` rows of each interval at
    random by hash.  Intervals that hold a wanted cut are searched further; a
    cut is found if its bytes are within ``tolerance`` or no key lies between
    the candidates around it.  The driver holds the candidates only.
    """
    bounds: list[Key] = []
    probes = [[F.min_by(F.col(c), F.xxhash64(*key, F.lit(p))) for c in key] for p in range(PROBES)]
    flat = [column.alias(f"p{p}_{i}") for p, three in enumerate(probes) for i, column in enumerate(three)]
    while True:
        found = {r["at"]: r for r in rows.groupBy(_below(key, bounds).alias("at")).agg(F.sum(size).alias("bytes"), *flat).collect()}
        total = sum(r["bytes"] for r in found.values())
        if not total:
            return []
        # bytes below the start of each interval, and below the end of the last
        starts = [0]
        for at in range(len(bounds) + 1):
            starts.append(starts[-1] + (found[at]["bytes"] if at in found else 0))
        chosen, wanted = [], set()
        for shard in range(1, shards):
            target = total * shard / shards
            at = max(k for k in range(len(bounds) + 1) if starts[k] <= target)
            around = [k for k in (at, at + 1) if 0 < k <= len(bounds)]
            near = min(around, key=lambda k: abs(starts[k] - target), default=None)
            low = bounds[at - 1] if at else None
            row = found.get(at)
            fresh = {tuple(row[f"p{p}_{i}"] for i in range(len(key))) for p in range(PROBES)} - {low} if row else set()
            if fresh and (near is None or abs(starts[near] - target) > tolerance * total / shards):
                wanted |= fresh
            wanted |= {bounds[k - 1] for k in around}
            chosen.append(bounds[near - 1] if near else low)
        if wanted <= set(bounds):
            if None in chosen:
                # a single key: everything lies in the first shard
                return [c for c in chosen if c is not None]
            return sorted(chosen)
        bounds = sorted(wanted)


def sharded(docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (named anew where taken).

    A row's size is the UTF-8 bytes of its text plus one (null: one).  Rows are
    ordered by a hash of the text, then doc_id (null first), then where the
    table holds them, so copies of a text stand side by side and are parted
    only where a shard ends, a group of any size included.  Repeated rows are
    rows of their own; a row longer than a shard leaves others empty.  Slots
    number a shard's rows from 0 without gaps, in no order.  No rows give no
    rows.
    """
    names = spare(docs, "size", "shard", "slot", "__hash", "__doc", "__row", "__piece", "__before", "__shard", "__part")
    size, shard, slot, h, d, row, piece, before, of, part = names
    # the row number is drawn once: what is read again keeps it
    rows = written(docs.select(
        *columns(docs), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias(size),
        F.xxhash64("text").alias(h), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias(d),
        F.monotonically_increasing_id().alias(row)), "sharding-rows")
    key = [h, d, row]
    cuts = splitters(rows, key, size, shards, tolerance)
    placed = rows.withColumn(shard, _below(key, cuts).cast("int")).withColumn(
        piece, F.pmod(F.xxhash64(row), F.lit(PIECES)).cast("int"))
    counts = placed.groupBy(F.col(shard).alias(of), F.col(piece).alias(part)).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(of, part, F.coalesce(
        F.sum("n").over(Window.partitionBy(of).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    # at most shards * PIECES offsets
    numbered = placed.withColumn(slot, F.row_number().over(Window.partitionBy(shard, piece).orderBy(*key)) - 1)
    return (numbered.join(F.broadcast(offsets), (F.col(shard) == F.col(of)) & (F.col(piece) == F.col(part)))
            .withColumn(slot, (F.col(slot) + F.col(before)).cast("long"))
            .select(*columns(docs), size, shard, slot))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's place in eight shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return sharded(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

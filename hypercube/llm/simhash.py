"""SimHash near-duplicates by bit-sliced comparison (operator 9)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import columns, give_back, spare, table, written
from hypercube.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
#: Members of a bucket above which it is split by further bits.
BUCKET = 2048
#: Bytes of a text that are shingled at a time.
BLOCK = 1 << 20
#: Bucket rows that a task compares at a time, and (row, block) pairs of them.
ROWS, PAIRS = 100_000, 500_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(text: str, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of a text's word shingles, repeats included, a block at a time."""
    data = text.encode().translate(_LOWER)
    carry: list[bytes] = []
    at, some = 0, False
    while at < len(data):
        cut = at + BLOCK
        stop = _SPACE.search(data, cut) if cut < len(data) else None
        cut = stop.start() if stop else len(data)
        words = carry + data[at:cut].split()
        at = cut
        if len(words) < shingle:
            carry = words
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        yield np.array([digest(joined[i:j], SEED) for i, j in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
        some, carry = True, words[len(words) - shingle + 1:]
    if carry and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The text's fingerprint as a signed 64-bit integer; zero without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text or "", shingle):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [simhash(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])
            give_back()

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


# ------------------------------------------------------- bit-sliced comparison
def neighbours(fps: np.ndarray, runs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs ``(i, j)`` of one run, i < j, within ``radius`` differing bits.

    ``runs`` holds the starts of the runs and the end.  Each run is stored as
    blocks of 64 members, one word per bit plane.  A member meets the blocks
    of its run: plane by plane the differing bits enter carry-save counters
    that hold 64 distances at once, and a (member, block) pair is abandoned
    as soon as all its distances exceed the radius.
    """
    sizes = np.diff(runs)
    n_blocks = (sizes + 63) // 64
    first_block = np.concatenate([[0], np.cumsum(n_blocks)])
    run_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(fps)) - runs[run_of]
    slot = (first_block[run_of] + place // 64) * 64 + place % 64
    dense = np.zeros(first_block[-1] * 64, np.uint64)
    dense[slot] = fps
    bits = np.unpackbits(dense.astype("<u8").view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    planes = np.packbits(bits, axis=1, bitorder="little").transpose(0, 2, 1).copy().view("<u8")[:, :, 0]
    filled = np.zeros(len(dense), np.uint8)
    filled[slot] = 1
    filled = np.packbits(filled, bitorder="little").view("<u8")
    member_at = np.full(len(dense), -1, np.int64)
    member_at[slot] = np.arange(len(fps))

    # a member meets its own block and the later ones of its run
    meets = n_blocks[run_of] - place // 64
    ends = np.cumsum(meets)
    found_i, found_j = [], []
    start = 0
    while start < len(fps):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right")))
        count = meets[start:stop]
        who = np.repeat(np.arange(start, stop), count)
        block = np.repeat(slot[start:stop] // 64, count) + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        mine = fps[who]
        counters = [np.zeros(len(who), np.uint64) for _ in range(radius.bit_length())]
        over = ~filled[block]
        for bit in range(BITS):
            carry = planes[block, bit] ^ (np.uint64(0) - ((mine >> np.uint64(bit)) & np.uint64(1)))
            for k, c in enumerate(counters):
                counters[k], carry = c ^ carry, c & carry
            over = over | carry | _above(counters, radius)
            if bit % 8 == 7:
                keep = ~over != 0
                if not keep.all():
                    who, block, mine, over = who[keep], block[keep], mine[keep], over[keep]
                    counters = [c[keep] for c in counters]
        if len(who):
            hit = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, col = np.nonzero(hit)
            i, j = who[row], member_at[block[row] * 64 + col]
            found_i.append(i[i < j])
            found_j.append(j[i < j])
        start = stop
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(found_i), join(found_j)


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds ``radius``, most significant bit first."""
    more = np.zeros_like(counters[0]) if counters else np.uint64(0)
    same = ~more
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same = same & counters[k]
        else:
            more, same = more | (same & counters[k]), same & ~counters[k]
    return more


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the smallest one it is linked with by any chain."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _bucket_links(radius: int):
    """Rows sorted by (mask, key, fp) to links that connect what a bucket connects."""
    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray):
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
        runs = np.concatenate([np.flatnonzero(new), [len(fp)]])
        i, j = neighbours(fp.view(np.uint64), runs, radius)
        root = smallest_linked(len(fp), i, j)
        linked = root != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, np.asarray(batch.column(k))]) for k, h in enumerate(held)]
            if len(held[0]) < ROWS:
                continue
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield links(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(*held)

    return run


# ------------------------------------------------------------------ candidates
def _parts(bits: list[int], n: int) -> list[int]:
    """The given bit places dealt into ``n`` runs, as masks."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits, int), n)]


def masks(radius: int, bits: list[int] | None = None, spare: int = 3) -> list[int]:
    """Masks of which two words within ``radius`` bits agree under one at least.

    The bits are dealt into ``radius + spare`` parts; differing bits touch
    ``radius`` parts at most, so some ``spare`` parts are equal.
    """
    parts = _parts(list(range(BITS)) if bits is None else bits, radius + spare)
    return [sum(x) for x in combinations(parts, spare)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask)


def _under(mask_list: list[int]) -> Column:
    return F.array(*[F.struct(_signed(m).cast("long").alias("mask"),
                              F.col("fp").bitwiseAND(_signed(m)).alias("key")) for m in mask_list])


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all links of ``distinct(fp)``.

    Buckets are fingerprints that agree under a mask.  A bucket of more than
    ``BUCKET`` members is dealt anew under masks with more bits, by the same
    argument within the bits left free; for radius 2 such a bucket leaves 14
    bits free and so holds at most 16,384 different fingerprints.  Nothing is
    dropped, and every bucket yields fewer links than it has members.
    """
    if radius == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    outer = masks(radius)
    rows = distinct.select("fp", F.explode(_under(outer)).alias("k")).select("fp", "k.mask", "k.key")
    sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    finer = None
    for m in outer:
        free = [b for b in range(BITS) if not m >> b & 1]
        inner = _under([m | x for x in masks(radius, free, radius)])
        here = F.col("mask") == _signed(m)
        finer = F.when(here, inner) if finer is None else finer.when(here, inner)
    dealt = rows.join(sizes, ["mask", "key"]).select("fp", F.explode(
        F.when(F.col("n") > BUCKET, finer).otherwise(F.array(F.struct("mask", "key")))).alias("k"))
    return (dealt.select("k.mask", "k.key", "fp").repartition("mask", "key")
            .sortWithinPartitions("mask", "key", "fp").mapInArrow(_bucket_links(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id)`` per row of ``docs(doc_id, text)``.

    Texts without words (null, empty, white space) have fingerprint zero and
    link like any other.  ``component_id`` is the smallest non-null doc_id
    reachable over links of at most ``radius`` differing bits (null if all of
    them are null).  Repeated rows each keep their row.  An empty table gives
    no rows; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle), "simhash")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    stars = connected_components(fingerprint_links(distinct, radius))
    rooted = (distinct.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(found, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents whose doc_id names their group, one row each, all columns kept.

    Rows that share a doc_id stand for one document; of rows with equal
    doc_id and text one stays.  Groups without any doc_id keep one row per
    different text.
    """
    doc, text, own = spare(docs, "__doc", "__kept", "__text")
    kept = (near_duplicates(docs, shingle, radius).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text)).distinct())
    stay = docs.withColumn(own, F.xxhash64("text")).join(
        kept, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(text)), "left_semi")
    return stay.dropDuplicates(["doc_id", own]).select(*columns(docs))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

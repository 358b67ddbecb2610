"""Document fingerprints by locally consistent parsing (operator 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import table

#: Levels of phrases above the characters; a phrase holds about 3 to 4 of the level below.
LEVELS = 3
#: Signatures that a fingerprint keeps, the smallest ones.
KEEP = 64
#: Code points of a text that are parsed together, and of several texts.
SLICE, CHARS = 1 << 22, 1 << 18

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _toss(label: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Twice the lowest bit place in which two labels differ, plus that bit of the first."""
    differ = label ^ before
    place = np.frexp((differ & (~differ + np.uint64(1))).astype(np.float64))[1] - 1
    place = np.maximum(place, 0).astype(np.uint64)
    return (place * np.uint64(2) + ((label >> place) & np.uint64(1))).astype(np.uint8)


#: The same for labels below 128, by label * 128 + label before.
_TOSS = _toss(np.repeat(np.arange(128, dtype=np.uint64), 128), np.tile(np.arange(128, dtype=np.uint64), 128))


def _level(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of the next level: their names, and which begin a text.

    Runs of one name become a phrase first.  Then neighbouring names differ,
    and four rounds of coin tossing against the left neighbour leave labels
    below 6 that differ from their neighbours'.  A phrase begins at each local
    maximum of the labels and at the start of a text; its name is a hash of
    the names in it.  Where a phrase begins depends on a few names around.
    """
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(names))).astype(np.uint64)
    first = first[at]
    names = np.where(length > 1, _mix(names[at] + length * _STEP), names[at])
    if not len(names):
        return names, first
    before = np.concatenate([names[:1], names[:-1]])
    before[first] = ~names[first]
    label = _toss(names, before)
    for _ in range(3):
        before = np.concatenate([label[:1], label[:-1]])
        before[first] = label[first] ^ 1
        label = _TOSS[label.astype(np.uint16) * np.uint16(128) + before]
    last = np.append(first[1:], True)
    up = np.concatenate([[True], label[1:] > label[:-1]]) & ~first
    down = np.append(label[:-1] > label[1:], True) & ~last
    begin = (up & down) | first
    at = np.flatnonzero(begin)
    place = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
    parts = _mix(names + place.astype(np.uint64) * _STEP + _M1)
    return _mix(np.add.reduceat(parts, at)), first[at]


def _signatures(texts: list[str]) -> list[np.ndarray]:
    """For each non-empty text the names of its phrases of the last level."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    first = np.zeros(len(points), bool)
    first[np.cumsum([0] + [len(t) for t in texts[:-1]])] = True
    names = points
    for _ in range(LEVELS):
        names, first = _level(names, first)
    return np.split(names, np.flatnonzero(first)[1:])


def _sketch(names: np.ndarray) -> np.ndarray:
    return np.unique((names >> np.uint64(32)).astype(np.uint32))[:KEEP]


def sketches(texts: list[str]) -> list[np.ndarray]:
    """Each text's fingerprint: the smallest of its phrases' names, sorted; none for an empty text.

    A text of over ``SLICE`` code points is parsed in slices of that length,
    so that memory is bounded.
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    held: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            for (n, _), names in zip(held, _signatures([t for _, t in held])):
                new = _sketch(names)
                out[n] = np.unique(np.concatenate([out[n], new]))[:KEEP] if len(out[n]) else new
        held, size = [], 0

    for n, text in enumerate(texts):
        for start in range(0, len(text), SLICE):
            held.append((n, text[start: start + SLICE]))
            size += len(held[-1][1])
            if size >= CHARS:
                flush()
    flush()
    return out


def as_text(sketch: np.ndarray) -> str:
    """A fingerprint as hexadecimal digits, 8 for each signature."""
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of signatures that two fingerprints have in common, 0 to 1.

    Of the smallest signatures of both together, the common ones estimate the
    Jaccard index J of all signatures; the share is 2J / (1 + J).  Two empty
    fingerprints are equal, an empty one is like no other.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:KEEP]
    j = np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)
    j = float(j.sum()) / len(both)
    return 2 * j / (1 + j)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` per row of ``docs(doc_id, text)``; null texts are empty, and an
    empty text has the empty fingerprint.  Repeated rows each keep their row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([as_text(s) for s in found], pa.string())],
                                             ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, fingerprint string")


# ------------------------------------------------------- each text and the next
def _cuts(keys: DataFrame, blocks: int) -> np.ndarray:
    """The smallest key of each of about ``blocks`` blocks of neighbouring keys.

    As many numbers as blocks come to the driver, whatever the input's size.
    """
    near = np.unique(np.array(keys.approxQuantile("key", [i / blocks for i in range(1, blocks)], 0.25 / blocks) if blocks > 1 else [], float))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            key = np.asarray(batch.column(0))
            order = np.lexsort((key, block := np.searchsorted(near, key.astype(float), side="right")))
            at, where = np.unique(block[order], return_index=True)
            for b, k in zip(at.tolist(), key[order][where].tolist()):
                found[b] = min(k, found.get(b, k))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["block", "key"])

    mins = keys.mapInArrow(least, "block long, key long").groupBy("block").agg(F.min("key").alias("key")).collect()
    return np.sort(np.array([r["key"] for r in mins], np.int64))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``(block, key, follow, doc_id, text)``, each block sorted within one partition.

    Blocks hold neighbouring doc_ids; the row after a block's last, the first
    of the next block (after the last block: of the first), stands at its end
    again as ``follow``.  Null doc_ids come first, rows of one doc_id in order
    of their texts.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = _cuts(rows.select("key"), 4 * parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column(0))
            block = np.searchsorted(cuts, key, side="right") - 1
            again = np.flatnonzero(cuts[block] == key)
            rows = batch.take(pa.array(np.concatenate([np.arange(len(key)), again])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([block, (block[again] - 1) % len(cuts)])), rows.column(0),
                 pa.array(np.arange(len(key) + len(again)) >= len(key)), rows.column(1), rows.column(2)],
                ["block", "key", "follow", "doc_id", "text"])

    return (rows.mapInArrow(deal, "block long, key long, follow boolean, doc_id long, text string")
            .repartition(parts, "block").sortWithinPartitions("block", "follow", "key", "text"))


def _edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """The result's rows for all texts but the last, which is the next of the one before."""
    edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
    found = sketches(texts + edited)
    own, changed = found[: len(texts)], found[len(texts):]
    return pa.RecordBatch.from_arrays([
        pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([as_text(s) for s in own[:-1]], pa.string()), pa.array([as_text(s) for s in changed], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The edited text ends in the first code points of the next document instead
    of its own last quarter.  Null texts are empty.  A single row is its own
    next; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done, size = None, False, 0
        ids: list = []
        texts: list[str] = []
        for batch in batches:
            for b, follow, doc_id, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                if b != block:
                    block, done, ids, texts, size = b, False, [], [], 0
                if done:
                    continue
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if follow or (size >= CHARS and len(texts) > 1):
                    yield _compared(ids, texts)
                    done, ids, texts, size = follow, ids[-1:], texts[-1:], len(texts[-1])

    return with_next(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's fingerprint against its edited text's and the next one's."""
    return compare_with_edit(table(spark, sf_dir, "documents"))

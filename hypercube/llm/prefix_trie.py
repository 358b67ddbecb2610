"""Trie of conversation prefixes by a splitter skeleton (operator 13).

A conversation is the path of its turns.  Paths are ranged into sorted shards
between splitters, which are paths too.  Only prefixes of a splitter can have
members in several shards: these nodes, the skeleton, get partial aggregates
from every shard, which are reduced; a shard finishes all other nodes alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import table, written

#: Hex digits of a turn's digest in a path.
WIDTH = 32
#: Turns of a splitter; with the number of shards it bounds the skeleton.
SPLITTER_TURNS = 256
#: Paths looked at for each splitter.
SAMPLES = 8
#: Conversations that may share the first turns of one, and how many at most.
FAMILY, HEAD = 100, 6

NOTHING = hashlib.sha256().hexdigest()
_NODE = ("skeleton boolean, id string, parent string, parent_skeleton boolean, depth long, conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string")
_ARROW = pa.schema([("skeleton", pa.bool_()), ("id", pa.string()), ("parent", pa.string()), ("parent_skeleton", pa.bool_()),
                    *[(n, pa.int64()) for n in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")],
                    ("ends_sha256", pa.string())])
_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def paths(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: per conversation the (digest, chars) of its turns in order.

    Turns of one number (null first) stand in order of their digest.  A null
    role or text is empty; rows without a conv_id belong to no conversation.
    Digests and lengths are gathered, never texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, WIDTH).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "chars")))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def rebuilt(found: DataFrame) -> DataFrame:
    """Each conversation c of ``paths``: the first h turns of c - c % 100, then its own after its first h; h = crc32(c) % 6."""
    heads = found.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("of"), F.slice("turns", 1, HEAD - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    none = F.filter("turns", lambda t: F.lit(False))
    return (found.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("of"), "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                        F.slice("turns", h + 1, F.size("turns"))).alias("turns")))


def splitters(ranged: DataFrame, shards: int) -> list[str]:
    """At most ``shards - 1`` paths that cut the conversations into ranges of about the same size.

    From a bounded sample: the conversations whose hashed ids are smallest.
    """
    sample = sorted(r["head"] for r in ranged.select(
        F.substring("path", 1, WIDTH * SPLITTER_TURNS).alias("head"), F.xxhash64("conv_id").alias("at"))
        .orderBy("at", "head").limit(SAMPLES * shards).collect())
    return sorted({sample[k * len(sample) // shards] for k in range(1, shards)} - {""}) if sample else []


def _shared(a: str, b: str, start: int = 0) -> int:
    """Turns that two paths share, if they share ``start`` at least."""
    k, most = start, min(len(a), len(b)) // WIDTH
    while k < most and a.startswith(b[k * WIDTH: (k + 1) * WIDTH], k * WIDTH):
        k += 1
    return k


class _Node:
    __slots__ = ("id", "chars", "conv", "n", "children", "leaves", "saved", "ends")

    def __init__(self, name: str, chars: int):
        self.id, self.chars = name, chars
        self.conv, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, None

    def member(self, conv: int, n: int) -> None:
        self.n += n
        self.conv = conv if self.conv is None else min(self.conv, conv)


def _nodes(ranged: DataFrame, cuts: list[str], shards: int) -> DataFrame:
    """Rows of ``_NODE``: finished nodes, and one partial row per skeleton node and shard.

    A task holds the nodes of one path and the rows not yet given out.
    """
    shard_of = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("path"))) if cuts else F.lit(0)
    known = ranged.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = known.value
        out: list[list] = [[] for _ in _ARROW]
        stack: list[_Node] = []
        before, shard, spine = "", None, -1

        def give() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW)], schema=_ARROW)
            for c in out:
                c.clear()
            return batch

        def pop() -> None:
            node, depth = stack.pop(), len(stack)
            skeleton = depth <= spine
            parent = stack[-1] if stack else None
            if not skeleton:
                node.leaves += not node.children
                node.saved += (node.n - 1) * node.chars
            for col, value in zip(out, (skeleton, node.id, parent.id if parent else None, bool(parent) and depth - 1 <= spine, depth,
                                        node.conv, node.n, node.children, node.leaves, node.saved, node.chars,
                                        node.ends.hexdigest() if node.ends else None)):
                col.append(value)
            if parent:
                parent.member(node.conv, node.n)
                parent.leaves += node.leaves
                parent.saved += node.saved
                parent.children += not skeleton

        for batch in batches:
            for k in range(batch.num_rows):
                here, path, conv, chars = (batch.column(c)[k].as_py() for c in range(4))
                if here != shard:
                    while stack:
                        pop()
                    shard, before = here, ""
                    stack.append(_Node("", 0))
                same = _shared(path, before)
                while len(stack) > same + 1:
                    pop()
                    if len(out[0]) >= 4096:
                        yield give()
                # the path's nodes that are proper prefixes of the splitters around it
                spine = max((min(_shared(path, c), len(c) // WIDTH - 1) for c in bounds[max(here - 1, 0): here + 1]), default=-1)
                for d in range(same, len(path) // WIDTH):
                    name = hashlib.blake2b((stack[-1].id + path[d * WIDTH: (d + 1) * WIDTH]).encode(), digest_size=16).hexdigest()
                    stack.append(_Node(name, chars[d]))
                top = stack[-1]
                top.member(conv, 1)
                if top.ends is None:
                    top.ends = hashlib.sha256(str(conv).encode())
                else:
                    top.ends.update(f",{conv}".encode())
                before = path
        while stack:
            pop()
            if len(out[0]) >= 4096:
                yield give()
        yield give()

    return (ranged.select(shard_of.cast("int").alias("shard"), "path", "conv_id", "chars")
            .repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, _NODE))


def _skeleton(nodes: DataFrame) -> list[dict]:
    """The skeleton's nodes, finished: partial rows are reduced by id, then summed up the skeleton from its deepest nodes.

    At most ``shards`` times ``SPLITTER_TURNS`` rows.  A skeleton node always
    has a child, since its splitter goes on.
    """
    rows = [r.asDict() for r in nodes.filter("skeleton").groupBy("id", "parent", "depth", "chars").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")],
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256")).collect()]
    by_id = {r["id"]: r for r in rows}
    for r in rows:
        r["rest"] = 0
    for r in sorted(rows, key=lambda r: -r["depth"]):
        # what the shards summed already counts the shards' nodes of the whole subtree
        r["rest"] += (r["n_convs"] - 1) * r["chars"]
        r["saved_tokens"] += r["rest"]
        parent = by_id.get(r["parent"])
        r["parent_conv_id"] = parent["conv_id"] if parent else None
        if parent:
            parent["rest"] += r["rest"]
            parent["n_children"] += 1
    return rows


def prefix_trie(found: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``found(conv_id, turns)``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    Conversations without turns are members of the root; no conversations give
    no rows.  Copies of a conversation lie in one shard, in order of conv_id,
    and are streamed; a task holds the nodes of one path, so memory follows
    the longest conversation's number of turns, not its text.
    """
    spark = found.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(found.select("conv_id", F.array_join("turns.digest", "").alias("path"), F.col("turns.chars").alias("chars")), "trie-paths")
    nodes = written(_nodes(ranged, splitters(ranged, shards), shards), "trie-nodes")
    skeleton = _skeleton(nodes)
    fields = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
              "ends_sha256 string, id string")
    spine = spark.createDataFrame([[r[n] for n in (*_RESULT, "id")] for r in skeleton], fields)
    own = nodes.filter("not skeleton")
    # a parent in the skeleton may have any number of children, but there are few such parents
    below = own.filter("parent_skeleton").join(
        F.broadcast(spine.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))), "parent")
    inside = own.filter("not parent_skeleton").join(
        own.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", "left")
    return (below.select(*_RESULT).unionByName(inside.select(*_RESULT)).unionByName(spine.select(*_RESULT))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the nodes of all rebuilt conversations."""
    return prefix_trie(rebuilt(paths(table(spark, sf_dir, "conversations"))))

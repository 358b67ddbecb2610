"""Chat formatting as a prefix tree (operator 8).

Output: ``nodes`` holds every different turn prefix once, its tokens in
depth-first order; ``conversations`` says which of them a conversation reads.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hypercube.llm.common import table, written

#: Template of a turn: ``### role: text</turn>`` and a line feed.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: Role whose text is trained on.
TRAINED = "assistant"
#: Stands for a null conv_id inside.
NO_ID = -(1 << 63)

_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ROLE_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)|:(?= )")
_ESCAPED = re.compile(r"\\(.)", re.S)

_tokenizers: dict = {}


def escape(text: str, role: bool = False) -> str:
    """A text in which no control string of the template stands: a backslash
    precedes each one's first character, and each backslash."""
    return (_ROLE_CONTROL if role else _CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer(path: str):
    """A lossless (byte-level) tokenizer; special tokens' names in texts are ordinary text."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
        _tokenizers[path].encode_special_tokens = True
    return _tokenizers[path]


@dataclass
class PrefixTree:
    """``nodes``: tree, start, stop (the node's tokens in the tree's depth-first
    order), position (of its first token in any conversation that reads it),
    owner and depth (the smallest conversation that reads it and its turn
    there), ids, head, tail (tokens of the marks before and after the text),
    trained, attends (intervals of the tree's tokens that it sees besides its
    own earlier ones).

    ``conversations``: conv_id, tree, n_turns, spans (owner, from, until) of
    the nodes that it reads, in order.
    """

    nodes: DataFrame
    conversations: DataFrame


def _turns(conversations: DataFrame, path: str) -> DataFrame:
    """Each turn with a digest of the turns up to it and its tokens.

    A conversation's rows stand together, in order; the task goes through
    them once and keeps a digest and a token count only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        conv, chain, depth, position = None, b"", 0, 0
        for batch in batches:
            cols: list[list] = [[] for _ in range(9)]
            for cid, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if cid != conv:
                    conv, chain, depth, position = cid, b"", 0, 0
                chain = hashlib.blake2b(chain + f"{len(role.encode())}:{role}{text}".encode(), digest_size=16).digest()
                head, body, tail = (e.ids for e in encode.encode_batch(
                    [OPEN + escape(role, True) + MIDDLE, escape(text), CLOSE], add_special_tokens=False))
                ids = head + body + tail
                for col, value in zip(cols, (cid, depth, position, chain, ids, len(head), len(tail), role == TRAINED, len(ids))):
                    col.append(value)
                depth, position = depth + 1, position + len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()),
                                                       pa.int32(), pa.int32(), pa.bool_(), pa.int64()))],
                ["cid", "depth", "position", "node", "ids", "head", "tail", "trained", "n"])

    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("cid"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (rows.repartition("cid").sortWithinPartitions("cid", "turn", "role", "text")
            .mapInArrow(run, "cid long, depth long, position long, node binary, ids array<int>, head int, tail int, "
                             "trained boolean, n long"))


def _starts(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``start``: the tokens before each in its tree's depth-first order.

    Rows are ranged by that order and written; sums of each partition's trees
    then carry over to the next partition, so a tree may span many of them.
    """
    order = ["tree", "way", "depth"]
    ranged = written(nodes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "chat-order")
    sums = ranged.groupBy("tree", "part").agg(F.sum("n").alias("n"))
    carry = sums.select("tree", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carry"))
    within = Window.partitionBy("part", "tree").orderBy("way", "depth").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
            .join(carry, ["tree", "part"]).withColumn("start", F.col("carry") + F.col("within"))
            .drop("carry", "within", "part"))


def prefix_tree(conversations: DataFrame, path: str) -> PrefixTree:
    """Merges the conversations that share initial turns.

    ``conversations(conv_id, turn, role, text)``: rows of one conversation are
    its turns, in order of turn, then role and text; repeated rows are turns
    of their own.  Null roles and texts are empty; null conv_ids form one
    conversation.  Children of a node stand in order of their smallest
    conversation: that conversation's own turns first, then the branches, the
    deepest first.  No rows give an empty tree.
    """
    turns = written(_turns(conversations, path), "chat-turns")
    owners = turns.groupBy("node").agg(F.min("cid").alias("owner"))
    owned = written(turns.select("cid", "depth", "node").join(owners, "node").select("cid", "depth", "owner"), "chat-owners")
    hops = (owned.groupBy("cid", "owner").agg(F.min("depth").alias("from"), (F.max("depth") + 1).alias("until"))
            .groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("from", "until", "owner"))).alias("hops")))
    hops = written(hops, "chat-hops")
    # a conversation's own nodes come before the branches off them, deeper branches first
    way = F.transform(F.slice(F.col("hops"), 2, F.greatest(F.size("hops") - 1, F.lit(1))),
                      lambda h: F.struct((-h["from"]).alias("branch"), h["owner"].alias("owner")))
    nodes = (turns.join(owned.filter("cid = owner").select("cid", "depth"), ["cid", "depth"])
             .join(hops, "cid").select(F.col("hops")[0]["owner"].alias("tree"), way.alias("way"), F.col("cid").alias("owner"),
                                       "depth", "position", "ids", "head", "tail", "trained", "n", "hops"))
    placed = written(_starts(nodes).select("tree", "start", (F.col("start") + F.col("n")).alias("stop"), "position", "owner",
                                           "depth", "ids", "head", "tail", "trained", "hops"), "chat-placed")
    # what a node sees of each conversation on its way: one interval, from the branch to the next one
    seen = (placed.select("owner", "depth", F.explode("hops").alias("h")).filter("h.from <= depth")
            .select("owner", "depth", F.col("h.owner").alias("of"), F.col("h.from").alias("from"),
                    F.least(F.col("h.until") - 1, F.col("depth")).alias("last")))
    ends = placed.select(F.col("owner").alias("of"), F.col("depth").alias("at"), "start", "stop")
    attends = (seen.join(ends.select("of", F.col("at").alias("from"), F.col("start").alias("a")), ["of", "from"])
               .join(ends.select("of", F.col("at").alias("last"), F.col("stop").alias("b")), ["of", "last"])
               .groupBy("owner", "depth").agg(F.sort_array(F.collect_list(F.struct("from", "a", "b"))).alias("seen"))
               .select("owner", "depth", F.transform("seen", lambda s: F.struct(s["a"].alias("start"), s["b"].alias("stop"))).alias("attends")))
    return PrefixTree(
        nodes=placed.drop("hops").join(attends, ["owner", "depth"]),
        conversations=hops.select(
            F.when(F.col("cid") != NO_ID, F.col("cid")).alias("conv_id"), F.col("hops")[0]["owner"].alias("tree"),
            F.element_at("hops", -1)["until"].alias("n_turns"),
            F.transform("hops", lambda h: F.struct(h["owner"].alias("owner"), h["from"].alias("from"), h["until"].alias("until"))).alias("spans")))


def read_back(tree: PrefixTree, path: str) -> DataFrame:
    """Every conversation's turns as read from the tree's tokens:
    ``(cid, depth, formatted, role, text, trained)``, sorted by both within one partition per conversation.

    Only node tokens, marks and spans are used.  A conversation without id is ``NO_ID``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokenizer(path)
        for batch in batches:
            ids, head, tail = (batch.column(k).to_pylist() for k in (2, 3, 4))
            starts = decode.decode_batch([i[:h] for i, h in zip(ids, head)], skip_special_tokens=False)
            bodies = decode.decode_batch([i[h: len(i) - t] for i, h, t in zip(ids, head, tail)], skip_special_tokens=False)
            whole = decode.decode_batch(ids, skip_special_tokens=False)
            roles = [unescape(s[len(OPEN): -len(MIDDLE)]) for s in starts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(whole, pa.string()), pa.array(roles, pa.string()),
                 pa.array([unescape(b) for b in bodies], pa.string()), batch.column(5)],
                ["cid", "depth", "formatted", "role", "text", "trained"])

    reads = (tree.conversations.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("cid"), F.explode("spans").alias("s"))
             .select("cid", "s.owner", F.explode(F.sequence(F.col("s.from"), F.col("s.until") - 1)).alias("depth")))
    return (reads.join(tree.nodes.select("owner", "depth", "ids", "head", "tail", "trained"), ["owner", "depth"])
            .select("cid", "depth", "ids", "head", "tail", "trained").repartition("cid").sortWithinPartitions("cid", "depth")
            .mapInArrow(run, "cid long, depth long, formatted string, role string, text string, trained boolean"))


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``read_back``: digests of its turns and of its trained text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            return [None if conv == NO_ID else conv, n, every.hexdigest(), loss_chars, loss.hexdigest(), chars]

        conv, n, loss_chars, chars = None, 0, 0, 0
        every, loss = hashlib.sha256(), hashlib.sha256()
        done: list[list] = []

        def batch_of(rows):
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for cid, formatted, role, text, trained in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if cid != conv:
                    if n:
                        done.append(row())
                    conv, n, loss_chars, chars = cid, 0, 0, 0
                    every, loss = hashlib.sha256(), hashlib.sha256()
                n += 1
                chars += len(formatted)
                every.update(f"{role}\n{text}\n".encode())
                if trained:
                    loss_chars += len(text)
                    loss.update(text.encode())
            yield batch_of(done)
            done = []
        if n:
            yield batch_of([row()])

    return turns.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The conversation that the query adds.
PLANTED = r"\### Assistant: </turn> ok"


def op8_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every conversation, and number -7, as read back from the prefix tree."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)],
                                 "conv_id long, turn long, role string, text string")
    path = tokenizer_path()
    return digests(read_back(prefix_tree(own.unionByName(more), path), path))

"""Conversation structure repair by depth-first branch-and-bound (operator 11).

A conversation's turns should read ``(s?(ua)+)?`` by the first letters of
their roles.  Each row is kept (0), given another role (1) or deleted (2), an
empty turn may be inserted anywhere (5), and a truncated row that stays costs
5 more.  The cheapest edits win; of equally cheap ones the least audit string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercube.llm.common import WORD, table, written

#: Cost of each edit, and of leaving a truncated row in.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of one search; longer conversations are searched block by block.  A search corrects the
#: nodes it has passed, which can grow faster than its rows, so blocks are short.
BLOCK = 24
#: Blocks of one conversation that are joined in one step.
FAN_IN = 32
#: Salts of the rows whose role and text repeat within a conversation.
SALTS = 16

#: Where a conversation may stand: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: (place, initial) -> next place.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only place that a rewritten or inserted turn leads to, from each place.
NEXT = (USER, USER, ASSISTANT, USER)
#: Inserts that complete a conversation which stops at a place.
CLOSING = ("", "II", "I", "")


def _least(kind: str, initial: str) -> int:
    """The least that a row of its own costs, wherever it stands."""
    if kind == "x" or kind == "t":
        return DELETE
    return KEEP if initial in "sua" else REROLE


def search(rows: list[tuple[str, str]], entry: int, whole: bool) -> dict[int, tuple[int, str]]:
    """Place at the end -> (cost, audit) of the cheapest edits that lead there from ``entry``.

    ``rows`` are (initial, kind): kind ``x`` must go, ``t`` is truncated, ``k``
    is sound.  Depth first with an explicit stack; a prefix goes no further if
    its cost and the least cost of the rows left exceed the incumbent, or if
    its node (row, place) was reached by a prefix no dearer, and of the same
    cost with no greater audit.  The stack runs empty only when every prefix
    left is proved worse.  Inserts stand before a row, never at the end.
    With ``whole`` the conversation ends here, so one incumbent, over all
    places and the inserts that close them, bounds every prefix.
    """
    n = len(rows)
    left = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        left[i] = left[i + 1] + _least(rows[i][1], rows[i][0])
    ends = {entry: (DELETE * n, "D" * n)}
    if not n:
        return ends
    reachable = {entry, USER, ASSISTANT}
    if entry == START and any(initial == "s" and kind != "x" for initial, kind in rows):
        reachable.add(SYSTEM)

    def incumbent():
        if whole:
            return min((cost + INSERT * len(CLOSING[at]), audit + CLOSING[at]) for at, (cost, audit) in ends.items())
        if len(ends) < len(reachable):
            return 1 << 62, ""
        return max(cost for cost, _ in ends.values()), ""

    best, best_audit = incumbent()
    seen: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    while stack:
        i, at, cost, audit = stack.pop()
        if seen[i, at] != (cost, audit):
            continue
        bound = cost + left[i]
        if bound > best or (whole and bound == best and audit > best_audit[:len(audit)]):
            continue
        if i == n:
            if at not in ends or (cost, audit) < ends[at]:
                ends[at] = (cost, audit)
                best, best_audit = incumbent()
            continue
        initial, kind = rows[i]
        options = [(i + 1, at, cost + DELETE, audit + "D"), (i, NEXT[at], cost + INSERT, audit + "I")]
        if kind != "x":
            extra = TRUNCATED if kind == "t" else 0
            if (at, initial) in STEP:
                options.append((i + 1, STEP[at, initial], cost + KEEP + extra, audit + "K"))
            options.append((i + 1, NEXT[at], cost + REROLE + extra, audit + "R"))
        # the most promising is pushed last, so it is followed first
        options.sort(key=lambda o: (o[2] + left[o[0]], o[3]), reverse=True)
        for option in options:
            node, value = option[:2], option[2:]
            known = seen.get(node)
            if known is None or value < known:
                seen[node] = value
                stack.append(option)
    return ends


def closed(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest complete repair among the ends of a conversation."""
    return min((cost + INSERT * len(CLOSING[at]), audit + CLOSING[at]) for at, (cost, audit) in ends.items())


def chained(first: dict, second: dict) -> dict:
    """Ends of two blocks in a row: entry -> place -> (cost, audit).

    No block's audit is a proper prefix of another's over the same rows (the
    last letter is a row's), so the least concatenation is the least audit.
    """
    out: dict = {}
    for entry, middle in first.items():
        ends: dict = {}
        for at, (cost, audit) in middle.items():
            for last, (more, rest) in second[at].items():
                value = (cost + more, audit + rest)
                if last not in ends or value < ends[last]:
                    ends[last] = value
        out[entry] = ends
    return out


def _turn(conv_id: str, turn: str) -> Column:
    return F.concat(F.coalesce(F.col(conv_id).cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col(turn).cast("string"), F.lit(" ")))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults planted by crc32(``conv_id:turn``) % 20 (nulls are one space):
    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes the user say it."""
    fault = F.crc32(_turn("conv_id", "turn")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn("fault", fault)
    return rows.filter("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows by ``cid`` (a conversation's number as text, empty for none), with a digest that decides which texts are equal."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("cid"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), F.substring(F.sha2(text, 256), 1, 32).alias("digest"))


def _distinct(keyed: DataFrame) -> DataFrame:
    """One small row per different (conversation, turn, role, text): its copies, initial and fault."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    kind = F.when(~F.col("text").rlike(WORD), "b").when(~last.isin(".", "!", "?"), "t").otherwise("k")
    rows = (keyed.select("cid", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), kind.alias("kind"))
            .groupBy("cid", "turn", "role", "digest", "initial", "kind").agg(F.count(F.lit(1)).alias("copies")))
    rows = written(rows, "repair-rows")
    # the first turn of each role and text that stands at several turns; nulls come first
    repeats = (rows.groupBy("cid", "role", "digest")
               .agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("least"), F.max(F.isnull("turn")).alias("none"))
               .filter("n > 1").select("cid", "role", "digest", "least", "none",
                                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    later = F.coalesce(F.when(F.col("none"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least")), F.lit(False))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
            .join(repeats, ["cid", "role", "digest", "salt"], "left")
            .select("cid", "turn", "role", "digest", "initial", "copies",
                    F.when((F.col("kind") != "b") & later, "d").otherwise(F.col("kind")).alias("kind")))


_BLOCKS = ("cid string, part int, number long, whole boolean, first string, last string, illegal long, "
           "ends array<struct<entry:int,place:int,cost:long,audit:string>>")


def _solved(rows: list[tuple[str, str]], whole: bool) -> list[dict]:
    entries = (START,) if whole else range(4)
    return [{"entry": e, "place": at, "cost": cost, "audit": audit}
            for e in entries for at, (cost, audit) in search(rows, e, whole).items()]


def _blocks(distinct: DataFrame) -> DataFrame:
    """Each conversation's rows, in order, searched in blocks of at most ``BLOCK``.

    Rows are ranged by (conversation, turn, ...), so one conversation may span
    any number of tasks; a task holds one block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done: list[dict] = []
        held: list[tuple[str, str]] = []
        conv, number, at_start, before, illegal = None, 0, True, None, 0

        def block(ends_here: bool, at_end: bool):
            whole = ends_here and number == 0 and not at_start and not at_end
            rows = [(i, "x" if kind in "bd" else kind) for i, kind in held]
            done.append({"cid": conv, "part": part, "number": number, "whole": whole, "first": held[0][0], "last": held[-1][0],
                         "illegal": illegal, "ends": _solved(rows, whole)})

        for batch in batches:
            for cid, initial, kind in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if conv is not None and (cid != conv or len(held) == BLOCK):
                    block(cid != conv, False)
                    at_start = at_start and cid == conv
                    number = 0 if cid != conv else number + 1
                    held, illegal = [], 0
                elif held:
                    illegal += held[-1][0] + initial not in ("su", "ua", "au")
                conv = cid
                held.append((initial, kind))
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done.clear()
        if held:
            block(True, True)
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    schema = pa.schema([("cid", pa.string()), ("part", pa.int32()), ("number", pa.int64()), ("whole", pa.bool_()),
                        ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
                        ("ends", pa.list_(pa.struct([("entry", pa.int32()), ("place", pa.int32()), ("cost", pa.int64()),
                                                     ("audit", pa.string())])))])
    order = ["cid", "turn", "role", "digest"]
    return (distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("cid", "initial", "kind")
            .mapInArrow(run, _BLOCKS))


def _joined(blocks: DataFrame) -> DataFrame:
    """Blocks of each conversation joined to one, ``FAN_IN`` neighbours at a time.

    A step reads the steps before from the shared folder; the number of steps
    is the logarithm of the longest conversation's blocks.
    """
    schema = pa.schema([("cid", pa.string()), ("at", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
                        ("ends", pa.list_(pa.struct([("entry", pa.int32()), ("place", pa.int32()), ("cost", pa.int64()),
                                                     ("audit", pa.string())])))])

    def by_entry(ends) -> dict:
        out: dict = {e: {} for e in range(4)}
        for e in ends:
            out[e["entry"]][e["place"]] = (e["cost"], e["audit"])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                parts = row["parts"]
                ends, illegal = by_entry(parts[0]["ends"]), parts[0]["illegal"]
                for a, b in zip(parts, parts[1:]):
                    ends = chained(ends, by_entry(b["ends"]))
                    illegal += b["illegal"] + (a["last"] + b["first"] not in ("su", "ua", "au"))
                out.append({"cid": row["cid"], "at": row["up"], "first": parts[0]["first"], "last": parts[-1]["last"], "illegal": illegal,
                            "ends": [{"entry": e, "place": p, "cost": c, "audit": a} for e, to in ends.items() for p, (c, a) in to.items()]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    # blocks per (conversation, part) are counted, so a block's place needs no window over the whole conversation
    counts = blocks.groupBy("cid", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("cid", "part", F.coalesce(F.expr(
        "sum(n) over (partition by cid order by part rows between unbounded preceding and 1 preceding)"), F.lit(0)).alias("before"))
    now = written(blocks.join(before, ["cid", "part"])
                  .select("cid", (F.col("before") + F.col("number")).alias("at"), "first", "last", "illegal", "ends"), "repair-joined")
    while (now.agg(F.max("at")).first()[0] or 0) > 0:
        groups = (now.groupBy("cid", F.floor(F.col("at") / FAN_IN).alias("up"))
                  .agg(F.sort_array(F.collect_list(F.struct("at", "first", "last", "illegal", "ends"))).alias("parts")))
        now = written(groups.mapInArrow(run, "cid string, at long, first string, last string, illegal long, "
                                             "ends array<struct<entry:int,place:int,cost:long,audit:string>>"), "repair-joined")
    return now.select("cid", "illegal", "ends")


def _audits(solved: DataFrame) -> DataFrame:
    """The cheapest complete repair of each conversation (one letter per different row, and inserts)."""
    closing = [F.lit(c) for c in CLOSING]
    options = F.transform(
        F.filter("ends", lambda e: e["entry"] == START),
        lambda e: F.struct((e["cost"] + INSERT * F.length(F.get(F.array(*closing), e["place"]))).alias("cost"),
                           F.concat(e["audit"], F.get(F.array(*closing), e["place"])).alias("audit")))
    return solved.select("cid", "illegal", F.array_min(options).alias("best")).select("cid", "illegal", "best.cost", "best.audit")


#: Columns of a repaired turn.
TURNS = "cid string, position long, edit string, turn long, role string, text string"


def _edited(keyed: DataFrame, audits: DataFrame) -> DataFrame:
    """Every row of every conversation with its edit, and the inserted ones, in order (``TURNS``).

    A conversation's audit comes first, then its rows; the task goes through
    them once and holds the audit only.  Of equal rows of one turn the first
    has the audit's letter and the others go.
    """
    schema = pa.schema([("cid", pa.string()), ("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                        ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, position, last, conv = "", 0, START, 0, None, None
        cols: list[list] = [[] for _ in schema]

        def put(*row):
            nonlocal position
            for col, value in zip(cols, (conv, position, *row)):
                col.append(value)
            position += 1

        def inserts():
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                place = NEXT[place]
                put("I", None, "user" if place == USER else "assistant", "")
                at += 1

        for batch in batches:
            for cid, kind, turn, role, digest, text in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if kind == 0:
                    inserts()
                    conv, audit, at, place, position, last = cid, text, 0, START, 0, None
                    continue
                if (turn, role, digest) == last:
                    put("D", turn, role, text)
                    continue
                last = (turn, role, digest)
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    place = STEP[place, role[:1]]
                elif edit == "R":
                    place = NEXT[place]
                    role = "user" if place == USER else "assistant"
                put(edit, turn, role, text)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
            cols = [[] for _ in schema]
        inserts()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    heads = audits.select("cid", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("digest"), F.col("audit").alias("text"))
    rows = keyed.select("cid", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    return (heads.unionByName(rows).repartition("cid").sortWithinPartitions("cid", "kind", "turn", "role", "digest")
            .mapInArrow(run, TURNS))


class Repair:
    """``turns`` (``TURNS``: every row and every inserted turn with its edit, each
    conversation's in order within one partition) and ``report``, one row per
    conversation with rows: cid, blank, duplicate, truncated, illegal, cost, gaps."""

    def __init__(self, conversations: DataFrame):
        keyed = _keyed(conversations)
        distinct = written(_distinct(keyed), "repair-distinct")
        blocks = written(_blocks(distinct), "repair-blocks")
        whole = blocks.filter("whole").select("cid", "illegal", "ends")
        self.audits = written(_audits(whole.unionByName(_joined(blocks.filter("not whole")))), "repair-audits")
        self.turns = _edited(keyed, self.audits)
        days = distinct.groupBy("cid", "turn").agg(
            F.sum(F.when(F.col("kind") == "b", F.col("copies")).otherwise(0)).alias("blank"),
            F.sum(F.when(F.col("kind") == "b", 0).when(F.col("kind") == "d", F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
            F.sum(F.when(F.col("kind") == "t", 1).otherwise(0)).alias("truncated"), F.sum(F.col("copies") - 1).alias("again"))
        wide = F.col("turn").cast("decimal(20,0)")
        counts = days.groupBy("cid").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "again")],
            F.coalesce((F.max(wide) - F.min(wide) + 1 - F.count("turn")).try_cast("long"), F.lit(0).cast("long")).alias("gaps"))
        # copies within a turn stand side by side: their pairs are never legal, and each costs a deletion
        self.report = (counts.join(self.audits, "cid").select(
            "cid", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("again")).alias("illegal"),
            (F.col("cost") + DELETE * F.col("again")).alias("cost")))


def repaired(conversations: DataFrame) -> Repair:
    """The cheapest repair of every conversation.

    ``conversations(conv_id, turn, role, text)``; other columns are ignored.
    Rows stand in order of turn (nulls first), of one turn in order of role,
    then of a digest of the text.  A null role or text is empty: an empty role
    fits nowhere, an empty text is blank.  Null conv_ids are one conversation.
    Repeated rows are turns of their own.  A conversation of any length is
    searched in blocks, so its length bounds no task's memory but for the
    audit, one letter a row.  No rows give no conversations.
    """
    return Repair(conversations)


def fingerprints(turns: DataFrame) -> DataFrame:
    """Per conversation of ``Repair.turns``: the audit, and the digest of what the repair reads (``role:text`` lines)."""
    schema = pa.schema([("cid", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, digest, any_yet = None, [], hashlib.sha256(), False
        done: list[dict] = []

        def row():
            return {"cid": conv, "audit": "".join(edits), "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            for cid, edit, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 4, 5))):
                if cid != conv:
                    if conv is not None:
                        done.append(row())
                    conv, edits, digest, any_yet = cid, [], hashlib.sha256(), False
                edits.append(edit)
                if edit != "D":
                    digest.update((f"\n{role}:{text}" if any_yet else f"{role}:{text}").encode())
                    any_yet = True
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
        if conv is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    return turns.mapInArrow(run, "cid string, audit string, repaired_sha256 string")


def repair_report(originals: DataFrame, damaged_rows: DataFrame) -> DataFrame:
    """One row per conversation of ``originals``, repaired as ``damaged_rows`` tell; those without rows there have zeros."""
    repair = repaired(damaged_rows)
    every = originals.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("cid")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (every.join(repair.report, "cid", "left").join(fingerprints(repair.turns), "cid", "left").select(
        F.when(F.col("cid") != "", F.col("cid").cast("long")).alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every conversation, damaged and repaired."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(own, damaged(own))

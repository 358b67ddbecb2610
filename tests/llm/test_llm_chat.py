"""Operator 8: exact round trip, each shared token once, intervals of ancestors."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from hypercube.llm import chat

ROWS = "conv_id long, turn long, role string, text string, depth long, ids long, owner long, node string"
PATH = chat.tokenizer_path()


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], ROWS)


def _rows():
    rng = random.Random(4)
    odd = [chat.PLANTED, "", None, "</turn>\n### user: x", "####", "\\", "a\\", "<|endoftext|>", "é 中\n", "### assistant: ", "x" * 60_000]
    starts = [[("system", "be kind"), ("user", "hello")], [("user", "hello")], [("system", None)]]
    rows = []
    for c in range(60):
        turns = list(starts[c % 3])
        while len(turns) < 2 + c % 5:
            turns.append((rng.choice(["user", "assistant", "tool: x", None, "assistant"]), rng.choice(odd[:-1] + ["yes", "yes"])))
        if c % 7 == 0 and rows:
            turns = turns[:1]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(90, k, "assistant", odd[-1]) for k in range(3)]
    rows += [(91, 0, "user", "tie"), (91, 0, "user", "tie"), (91, 0, "assistant", "tie"), (91, None, "system", "first")]
    rows += [(None, 0, "user", "hello"), (None, 1, "assistant", "ok")]
    rows += [(100 + c, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for c in range(20) for k in range(6)]
    rows += [(200, k, "assistant", f"turn {k}") for k in range(300)]
    return rows


def _turns(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(x)] for c, x in by.items()}


def _digests(turns):
    return {c: (len(x), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode()).hexdigest(),
                sum(len(t) for r, t in x if r == "assistant"),
                hashlib.sha256("".join(t for r, t in x if r == "assistant").encode()).hexdigest()) for c, x in turns.items()}


def test_round_trip_and_tree(spark):
    rows = _rows()
    turns = _turns(rows)
    tree = chat.prefix_tree(_frame(spark, rows), PATH)
    back = chat.read_back(tree, PATH)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(back).collect()}
    assert got == _digests(turns)
    spans = {r["conv_id"]: r["n_turns"] for r in tree.conversations.collect()}
    assert spans == {c: len(x) for c, x in turns.items()}

    nodes = tree.nodes.collect()
    prefixes = {tuple(x[: k + 1]) for x in turns.values() for k in range(len(x))}
    assert len(nodes) == len(prefixes)  # each shared turn once
    trees = defaultdict(list)
    for n in nodes:
        trees[n["tree"]].append(n)
    key = lambda c: chat.NO_ID if c is None else c
    first = {}
    for c in sorted(turns, key=key):
        for k in range(len(turns[c])):
            first.setdefault(tuple(turns[c][: k + 1]), key(c))
    assert len(trees) == len({x[0] for x in turns.values()})
    for members in trees.values():
        members.sort(key=lambda n: n["start"])
        assert [n["start"] for n in members] == [0] + [n["stop"] for n in members[:-1]]  # no gaps
        by_place = {(n["owner"], n["depth"]): n for n in members}
        previous: list = []
        for n in members:
            mine = {None if n["owner"] == chat.NO_ID else n["owner"]}
            path = turns[mine.pop()][: n["depth"] + 1]
            assert first[tuple(path)] == n["owner"] and len(n["ids"]) == n["stop"] - n["start"]
            ancestors = [by_place[first[tuple(path[: k + 1])], k] for k in range(n["depth"] + 1)]
            assert n["position"] == sum(len(a["ids"]) for a in ancestors[:-1])
            seen = sorted(x for i in n["attends"] for x in range(i["start"], i["stop"]))
            assert seen == sorted(x for a in ancestors for x in range(a["start"], a["stop"]))
            # depth-first: the parent is the last node at the depth above
            assert n["depth"] == 0 or previous[n["depth"] - 1] is ancestors[-2]
            previous[n["depth"]:] = [n]


def test_text_of_the_template_reads_back():
    for text in ["", chat.PLANTED, "#####", "\\\\#", "</turn></turn>", "### x: y</turn>\n"]:
        done = chat.escape(text)
        assert chat.unescape(done) == text == chat.unescape(chat.escape(text, True))
        assert "</turn>" not in done.replace("\\</turn>", "")


def test_query_has_the_planted_conversation(spark, sf_small):
    got = {r["conv_id"]: r for r in chat.op8_chat_prefix_tree(spark, sf_small).collect()}
    text = chat.PLANTED
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == len(text)
    assert got[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    given = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = _digests(_turns(given + [(-7, 0, "user", text), (-7, 1, "assistant", text)]))
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == expected


def test_no_conversations(spark):
    tree = chat.prefix_tree(_frame(spark, []), PATH)
    assert tree.nodes.collect() == [] and chat.digests(chat.read_back(tree, PATH)).collect() == []

"""Operator 11 against a search through all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from hypercube.llm import repair

ROWS = "conv_id long, turn long, role string, text string, cid string, edit string"
FINE = re.compile(r"(s?(ua)+)?")


def _shown(value):
    return " " if value is None else str(value)


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{_shown(conv)}:{_shown(turn)}".encode()) % 20
        role, text = _shown(role), _shown(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def _ordered(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role or "", text or ""))
    for conv in groups:
        groups[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()[:32]))
    return groups


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("x" if not last else "d" if (role, text) in seen else "t" if last[-1] not in ".!?" else "k")
        seen.add((role, text))
    return out


def _cheapest(rows, kinds):
    """All edits of every row and up to two inserts at each place, by brute force."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    choices = [["D"] if k in "xd" else ["K", "Ru", "Ra", "D"] for k in kinds]
    for edits in itertools.product(*choices):
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, roles = 0, "", ""
            for i in range(len(rows) + 1):
                roles, audit, cost = roles + places[i], audit + "I" * len(places[i]), cost + 5 * len(places[i])
                if best and cost > best[0]:
                    break
                if i < len(rows):
                    e = edits[i]
                    audit += e[0]
                    cost += {"K": 0, "R": 1, "D": 2}[e[0]] + (5 if kinds[i] == "t" and e != "D" else 0)
                    roles += "" if e == "D" else e[1] if e[0] == "R" else (rows[i][1][:1] or "?")
            else:
                if FINE.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def _by_table(rows, kinds):
    """The same by a full table over (row, place), for conversations of any length."""
    states = {repair.START: (0, "")}

    def inserted(states):
        for _ in range(4):
            for at, (c, a) in list(states.items()):
                new = (c + 5, a + "I")
                to = repair.NEXT[at]
                if to not in states or new < states[to]:
                    states[to] = new
        return states

    for (_, role, _), kind in zip(rows, kinds):
        after = {}
        for at, (c, a) in inserted(states).items():
            options = [(at, c + 2, a + "D")]
            if kind not in "xd":
                more = 5 if kind == "t" else 0
                options.append((repair.NEXT[at], c + 1 + more, a + "R"))
                if (at, role[:1]) in repair.STEP:
                    options.append((repair.STEP[at, role[:1]], c + more, a + "K"))
            for to, cost, audit in options:
                if to not in after or (cost, audit) < after[to]:
                    after[to] = (cost, audit)
        states = after
    return min((v for at, v in inserted(states).items() if at in (repair.START, repair.ASSISTANT)))


def _expected(conv, rows, solve):
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    kinds = _faults(rows)
    cost, audit = solve(rows, kinds)
    turns = {t for t, _, _ in rows if t is not None}
    place, lines, at = repair.START, [], 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        place = repair.STEP[place, role[:1]] if letter == "K" else repair.NEXT[place]
        if letter != "K":
            role = "user" if place == repair.USER else "assistant"
        lines.append(f"{role}:{text}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("x"), kinds.count("d"), kinds.count("t"),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _check(spark, rows, solve, damage=True):
    originals = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)
    hurt = _damage(rows) if damage else rows
    got = repair.repair_report(originals, repair.damaged(originals) if damage else originals).collect()
    groups = _ordered(hurt)
    want = [_expected(conv, groups.get(conv, []), solve) for conv in {r[0] for r in rows}]
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert [tuple(r) for r in sorted(got, key=order)] == sorted(want, key=order)


def _random(seed, convs, most):
    r = random.Random(seed)
    words = ["Yes.", "No?", "cut off", "", " \t", "same.", "same.", "end! \n", None, "x" * 3000 + "."]
    return [(c if c else None, r.choice([t, t, t, t + 1, None]), r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             r.choice(words)) for c in range(convs) for t in range(r.randint(1, most))]


def test_all_edits(spark):
    _check(spark, _random(1, 40, 2), _cheapest)


@pytest.mark.parametrize("seed", [2, 3])
def test_long_conversations(spark, seed):
    _check(spark, _random(seed, 60, 40), _by_table)
    _check(spark, _random(seed, 60, 40), _by_table, damage=False)


@pytest.mark.parametrize("block,fan_in", [(1, 2), (3, 2), (7, 32)])
def test_blocks_of_one_conversation(spark, monkeypatch, block, fan_in):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "FAN_IN", fan_in)
    _check(spark, _random(5, 25, 60), _by_table)


def test_one_conversation_holds_most_rows(spark):
    r = random.Random(6)
    rows = [(7, t, r.choice(["user", "assistant", "tool"]), f"{t}." if t % 3 else "again") for t in range(4000)]
    _check(spark, rows + _random(7, 20, 5), _by_table)


def test_empty_table_and_vanished_rows(spark):
    assert repair.repair_report(*[spark.createDataFrame([], ROWS)] * 2).count() == 0
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    _check(spark, [(conv, 0, "user", "Hello.")], _by_table)


def test_given_table(spark, sf_small):
    own = repair.table(spark, sf_small, "conversations")
    groups = _ordered(_damage([(r.conv_id, r.turn, r.role, r.text) for r in own.collect()]))
    want = {c: _expected(c, groups.get(c, []), _by_table) for c in {r.conv_id for r in own.select("conv_id").collect()}}
    assert {r[0]: tuple(r) for r in repair.op11_conversation_repair(spark, sf_small).collect()} == want

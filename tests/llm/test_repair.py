"""Repair of conversations against a plain shortest path over (row, state) with strings."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest

from basketlens.llm import conversation_repair as C
from basketlens.llm.queries import llm_queries, op12_four_russians

SF = "/root/testdata/sf0.01"
COLUMNS = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of the conversations that have rows."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role, text))
    return {conv: brute_one(sorted(own)) for conv, own in by_conv.items()}


def brute_one(rows):
    faults, seen = [], set()
    for _, _, role, text in rows:
        core = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        )
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, put=0):
        if i == len(rows):
            tail = {"": "", "a": "", "u": "a", "s": "ua"}[state]
            return 5 * len(tail), "I" * len(tail), tuple((c, None) for c in tail)
        ways = []

        def way(letter, cost, to, what, j, n=0):
            rest = best(j, to, n)
            ways.append((cost + rest[0], letter + rest[1], (*what, *rest[2])))

        role, bad = rows[i][2], 5 if faults[i] == "truncated" else 0
        way("D", 2, state, (), i + 1)
        if put < 3:
            way("I", 5, after[state], ((after[state], None),), i, put + 1)
        if faults[i] not in ("blank", "duplicate"):
            if role[:1] == after[state] or role[:1] == "s" and state == "":
                way("K", bad, role[:1], ((role, i),), i + 1)
            way("R", 1 + bad, after[state], ((after[state], i),), i + 1)
        return min(ways, key=lambda w: w[:2])

    for i in range(len(rows), 0, -1):  # keeps the recursion shallow
        for state in after:
            best(i, state)
    cost, audit, turns = best(0, "")
    full = {"u": "user", "a": "assistant"}
    text = "\n".join(f"{full.get(r, r)}:{'' if i is None else rows[i][3]}" for r, i in turns)
    known = [t for has, t, *_ in rows if has]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def found(repaired):
    rows = defaultdict(list)
    for r in repaired.collect():
        rows[r["conv_id"]].append(r)
    audits = {r["conv_id"]: (r["audit"], r["sha256"]) for r in C.audits(repaired).collect()}
    out = {}
    for conv, own in rows.items():
        own.sort(key=lambda r: r["place"])
        known = [r["turn"] for r in own if r["turn"] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        counts = [sum(r["fault"] == f for r in own) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, sum(r["illegal"] for r in own), sum(r["cost"] for r in own), *audits[conv])
    return out


def made_rows(seed, sizes):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "usher"]
    texts = ["Yes.", "No", "", "  \n", "Why?", "And then", "Fine! \t", "é"]
    rows = []
    for conv, n in enumerate(sizes):
        for turn in range(n):
            text = str(rng.choice(texts)) + ("" if rng.random() < 0.3 else f" {rng.integers(0, 50)}.")
            rows.append((conv, None if rng.random() < 0.02 else int(turn + rng.integers(0, 3)), str(rng.choice(roles)), text))
    return rows


def test_tables_are_small_and_blocks_equal_single_steps():
    t = C.tables()
    assert len(t.vectors) < 400
    rng = np.random.default_rng(1)
    for _ in range(200):
        v, symbols = int(rng.integers(0, len(t.vectors))), rng.integers(0, 10, 4)
        now, paid = v, 0
        for s in symbols[::-1]:
            paid += t.cost[now, s]
            now = t.step[now, s]
        code = int(symbols @ (10 ** np.arange(3, -1, -1)))
        assert (t.block[v, code], t.block_cost[v, code]) == (now, paid)


@pytest.mark.parametrize("fragment_rows", [65_536, 7])
def test_repair_equals_brute_force(spark, fragment_rows):
    rows = made_rows(2, [*range(12), 1, 2, 3, 120, 5, 4, 41, *([3] * 60), *([6] * 60)])
    df = spark.createDataFrame(rows, COLUMNS)
    assert found(C.repair(df, fragment_rows)) == brute_repair(rows)


def test_one_long_conversation_over_many_fragments(spark):
    rows = [(7, *r[1:]) for r in made_rows(3, [900])] + made_rows(4, [3, 3])
    assert found(C.repair(spark.createDataFrame(rows, COLUMNS), 50)) == brute_repair(rows)


def test_odd_conversations(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hello."), (1, 1, "user", "Same."), (1, 1, "user", "Same."),
        (2, 5, "system", "Only a system turn."), (3, -4, "assistant", "word " * 50_000 + "."), (3, 9, "user", "x" * 300_000),
        (4, 1, "", ""), (8, 1, "system", "Be."), (8, 2, "user", "Hi."), (8, 3, "user", "Yo."), (8, 4, "assistant", "Bye."),
        (8, 5, "user", "One."), (8, 6, "assistant", "Two."),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", place long, edit string")
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    repaired = C.repair(df)
    assert found(repaired) == brute_repair(plain)
    turns = defaultdict(list)
    for r in sorted(C.repaired_turns(repaired).collect(), key=lambda r: (r["place"], r["nth"])):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    assert {conv: "".join(role[0] for role, _ in t) for conv, t in turns.items()} == {8: "suaua"}
    assert C.repair(df.limit(0)).count() == 0 and C.audits(C.repair(df.limit(0))).count() == 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, scale):
    path = f"/root/testdata/{scale}"
    given = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = brute_repair(brute_damage(given))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    out = {r[0]: tuple(r[1:]) for r in llm_queries()["op12_four_russians"](spark, path).collect()}
    assert out == {conv: expected.get(conv, nothing) for conv in {r[0] for r in given}}


def test_query_over_odd_tables(spark, tmp_path):
    rows = [(None, None, None, None), (None, 3, "user", None), (5, None, "system", "A."), (5, 2, "user", "B."), (6, 1, "tool", "?")]
    for name, given in (("some", rows), ("none", [])):
        spark.createDataFrame(given, COLUMNS).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        expected = brute_repair(brute_damage(given))
        nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        out = {r[0]: tuple(r[1:]) for r in op12_four_russians(spark, f"{tmp_path}/{name}").collect()}
        assert out == {conv: expected.get(conv, nothing) for conv in {r[0] for r in given}}

"""Conversation repair against a plain search for the cheapest, ASCII-least edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediameta.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {0: "u", 1: "u", 2: "a", 3: "u"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.extend([(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def plain_repair(rows, faults):
    """Least (cost, letters) by a search over (row, state), then the rows it gives."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, letters, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, letters, made
        role = MADE[state]
        named = {"u": "user", "a": "assistant"}[role]
        heapq.heappush(heap, (cost + 2, letters + "I", i, NEXT[state, role], (*made, f"{named}:")))
        if i < len(rows):
            _, _, own, text = rows[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, state, made))
            extra = faults[i] == "truncated"
            if faults[i] not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + 2 + extra, letters + "R", i + 1, NEXT[state, role], (*made, f"{named}:{text}")))
                if (state, own[:1]) in NEXT:
                    heapq.heappush(heap, (cost + extra, letters + "K", i + 1, NEXT[state, own[:1]], (*made, f"{own}:{text}")))
    raise AssertionError("no way")


def plain_report(rows, damaged):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, digest(*r[2:])))
        faults = plain_faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, letters, made = plain_repair(mine, faults)
        out[conv] = (
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            pairs, cost, letters, hashlib.sha256("\n".join(made).encode()).hexdigest(),
        )
    return out


def some_rows(seed, conversations_=60, longest=14):
    pick = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", "  \t", None, "Ünd so.", "end. \n"]
    rows = []
    for conv in [*range(conversations_), None]:
        for _ in range(pick.randint(1, longest)):
            rows.append((conv, pick.choice([None, *range(longest)]), pick.choice(roles), pick.choice(texts)))
    return rows


def test_report_equals_search(spark):
    rows = some_rows(1)
    given = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("pos", F.lit(2)).repartition(5)
    got = {r[0]: tuple(r) for r in conversations.damage_and_repair(given).collect()}
    assert got == plain_report(rows, plain_damage(rows))


def test_one_long_conversation_in_small_segments(spark):
    pick = random.Random(2)
    rows = [(7, n, pick.choice(["user", "assistant", "system", "x"]), f"{pick.choice(['a', 'b'])}{n % 90}{pick.choice(['.', ''])}") for n in range(700)]
    rows += some_rows(3, 10)
    plan = conversations.Repair(spark.createDataFrame(rows, SCHEMA), segment=3, fan=2)
    shown = [(c, t, *(" " if x is None else x for x in r)) for c, t, *r in rows]
    assert {r[0]: tuple(r) for r in plan.report().collect()} == plain_report(rows, shown)
    # The repaired rows by segment are those of the digests.
    lines = [f"{r.role}:{r.text}" for r in plan.rows().filter("key = '=7'").orderBy("pos").collect() if r.edit != "I"]
    assert lines and set(lines) <= {f"{role}:{text}" for _, _, _, text in rows for role in ("user", "assistant", "system") if text}


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 5, "user", "Same.")] * 40 + [(2, None, None, None)]
    got = {r[0]: tuple(r) for r in conversations.damage_and_repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_report(rows, plain_damage(rows))
    assert conversations.damage_and_repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ranks_choose_the_least_path():
    rng = np.random.default_rng(0)
    codes = [rng.integers(0, 4, n).astype(np.uint8) for n in (1, 2, 9, 40)]
    costs, exits, audits = conversations.least_paths(codes, np.tile(np.array([0, 4, 2, 0]), (4, 1)))
    for c, cost, left, words in zip(codes, costs, exits, audits, strict=True):
        rows = [(0, 0, "uas?"[x], "Full.") for x in c]
        best = plain_repair(rows, [""] * len(rows))
        assert (cost[0], words[0] + {0: "", 1: "II", 2: "I", 3: ""}[int(left[0])]) == best[:2]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r) for r in queries.QUERIES["op12_conversation_repair"](spark, d).collect()}
    assert got == plain_report(rows, plain_damage(rows))

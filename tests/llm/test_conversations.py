"""Repair of conversations against a search over all edits, and long ones against short buffers."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from millrace.llm import conversations
from millrace.llm.conversations import Conversation, Costs, Program
from millrace.llm.runtime import ready

WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows, costs=Costs()):
    """``(cost, letters, repaired)`` by keeping every best path as a string, role pattern by hand."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def offer(found, key, entry):
        if key not in found or entry[:2] < found[key][:2]:
            found[key] = entry

    def with_inserts(states):
        for _ in range(3):
            grown = dict(states)
            for last, (cost, letters, out) in states.items():
                new = follow[last]
                role = {"u": "user", "a": "assistant"}[new]
                offer(grown, new, (cost + costs.insert, letters + "I", (*out, (role, ""))))
            states = grown
        return states

    for role, text, fault in rows:
        found = {}
        for last, (cost, letters, out) in best.items():
            offer(found, last, (cost + costs.delete, letters + "D", out))
        if fault not in (1, 2):
            extra = costs.truncated if fault == 3 else 0
            for last, (cost, letters, out) in with_inserts(best).items():
                new = follow[last]
                if last == "" and role[:1] == "s" and not out:
                    offer(found, "s", (cost + extra, letters + "K", (*out, (role, text))))
                if role[:1] == new:
                    offer(found, new, (cost + extra, letters + "K", (*out, (role, text))))
                name = {"u": "user", "a": "assistant"}[new]
                offer(found, new, (cost + extra + costs.rerole, letters + "R", (*out, (name, text))))
        best = found
    ends = with_inserts(best)
    return min(ends[k] for k in ("", "a") if k in ends)


def report(conv_id, rows):
    """The contract's columns of ``(turn, role, text)`` in order."""
    seen, faulty, counts = set(), [], [0, 0, 0, 0]
    for turn, role, text in rows:
        stripped = text.strip(WHITE)
        fault = 1 if not stripped else 2 if (role, text) in seen else 3 if stripped[-1] not in ".!?" else 0
        seen.add((role, text))
        counts[fault] += 1
        faulty.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, letters, out = cheapest(faulty)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (conv_id, gaps, *counts[1:], illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def damage(table):
    """Rows per conversation after the damage, in order."""
    kept = defaultdict(list)
    for conv_id, turn, role, text in table:
        rows = kept[conv_id]
        name = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {k: sorted(v, key=order) for k, v in kept.items()}


def odd_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No", "", " \t", None, "Why?\n", "é!", "a:b\nc.", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "u"]
    table = []
    for conv_id in [*range(400), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            usual = ["user", "assistant"][turn % 2]
            role = usual if rng.random() < 0.6 else rng.choice(roles)
            text = f"Turn {rng.randint(0, 3)}." if rng.random() < 0.6 else rng.choice(texts)
            at = turn * rng.choice([1, 1, 2]) if rng.random() < 0.95 else None
            table.append((conv_id, at, role, text))
            if rng.random() < 0.03:
                table.append(table[-1])
    return table


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def key(row):
    return (row[0] is None, row[0] or 0)


def test_odd_conversations(spark):
    table = odd_rows()
    df = ready(spark).createDataFrame([(*r, "x", 1) for r in table], SCHEMA + ", fault string, copy int").repartition(5)
    got = sorted(map(tuple, conversations.damaged_and_repaired(df).collect()), key=key)
    assert got == sorted((report(k, v) for k, v in damage(table).items()), key=key)


def test_the_table(spark, sf_dir):
    df = ready(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    table = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, conversations.damaged_and_repaired(df).collect()), key=key)
    assert got == sorted((report(k, v) for k, v in damage(table).items()), key=key)


@pytest.mark.parametrize("costs", [Costs(), Costs(3, 2, 1, 4), Costs(1, 9, 1, 0), Costs(1, 1, 1, 1)])
def test_program_finds_the_least_string(costs):
    rng = random.Random(4)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), f"t{k}", rng.choice([0, 0, 0, 1, 3])) for k in range(rng.randint(0, 9))]
        own = Conversation(Program(costs), "", 1 << 30)
        for k, row in enumerate(rows):
            own.add(k, row[0], row[1], row[2])
        edits = list(own.finish())
        cost, letters, out = cheapest(rows, costs)
        assert (own.cost, "".join(e for e, _, _ in edits)) == (cost, letters)
        assert tuple((r, t) for e, r, t in edits if e != "D") == out


def test_giant_conversation_is_spilled(spark):
    """One conversation owns nearly all rows; the buffer holds a small part of it."""
    n = 60_000
    df = ready(spark).range(n).selectExpr(
        "IF(id % 100 = 0, id, 7) AS conv_id", "id AS turn",
        "CASE WHEN id % 11 = 0 THEN 'tool' WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role",
        "concat('Text ', id % 50000, IF(id % 13 = 0, '', '.')) AS text",
    )
    whole = sorted(map(tuple, conversations.repair_report(df).collect()), key=key)
    assert sorted(map(tuple, conversations.repair_report(df, buffer_bytes=50_000).collect()), key=key) == whole
    table = [tuple(r) for r in df.collect()]
    rows = sorted([r[1:] for r in table if r[0] == 7], key=order)
    assert [r for r in whole if r[0] == 7] == [report(7, rows)]
    turns = conversations.repaired_turns(df, buffer_bytes=50_000).where("conv_id = 7").orderBy("place").collect()
    text = "\n".join(f"{t.role}:{t.text}" for t in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == [r for r in whole if r[0] == 7][0][-1]


def test_empty(spark):
    empty = ready(spark).createDataFrame([], SCHEMA)
    assert conversations.damaged_and_repaired(empty).collect() == []
    assert conversations.repaired_turns(empty).collect() == []

"""Conversation repair against plain versions: all audits of short turn lists, cheapest ways of long ones."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from strata.llm import conversations as C
from strata.llm.common import table

SF = "/root/testdata/sf0.001"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
LETTERS = {"u": "v", "a": "b", "s": "t", "o": "p"}
SCHEMA = "conv_id long, turn long, role string, text string, row int, part string, mark int, audit string"


def every_audit(turns):
    """Least (cost, audit) over all edit scripts."""

    @functools.lru_cache(None)
    def go(i, state, inserts):
        out = [(0, "")] if i == len(turns) and state in (0, 3) else []

        def add(cost, edit, rest):
            if rest:
                out.append((cost + rest[0], edit + rest[1]))

        if i < len(turns):
            c, more = turns[i], 5 if turns[i].isupper() else 0
            add(2, "D", go(i + 1, state, inserts))
            if c != "x" and c not in LETTERS.values():
                for wanted, to in NEXT[state].items():
                    if c.lower() == wanted:
                        add(more, "K", go(i + 1, to, inserts))
                    elif wanted != "s":
                        add(1 + more, "R", go(i + 1, to, inserts))
        if inserts:
            for wanted, to in NEXT[state].items():
                if wanted != "s":
                    add(5, "I", go(i, to, inserts - 1))
        return min(out) if out else None

    return go(0, 0, len(turns) + 2)


def cheapest(turns):
    """The same for long lists, by the least way to each state after each turn."""

    def with_inserts(ways):
        for _ in range(3):
            for state, (cost, audit) in list(ways.items()):
                for wanted, to in NEXT[state].items():
                    if wanted != "s":
                        ways[to] = min(ways.get(to, (cost + 5, audit + "I")), (cost + 5, audit + "I"))
        return ways

    ways = with_inserts({0: (0, "")})
    for c in turns:
        new = {}
        for state, (cost, audit) in ways.items():
            new[state] = min(new.get(state, (cost + 2, audit + "D")), (cost + 2, audit + "D"))
            if c != "x" and c not in LETTERS.values():
                for wanted, to in NEXT[state].items():
                    if c.lower() == wanted or wanted != "s":
                        keep = c.lower() == wanted
                        way = (cost + (0 if keep else 1) + (5 if c.isupper() else 0), audit + ("K" if keep else "R"))
                        new[to] = min(new.get(to, way), way)
        ways = with_inserts(new)
    return min(ways[x] for x in (0, 3) if x in ways)


def report(rows):
    """conv_id -> the query's columns, for [(conv_id, turn, role, text)]."""
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        conv_id_text, turn_text, role, text = (" " if x is None else str(x) for x in (conv_id, turn, role, text))
        fault = zlib.crc32(f"{conv_id_text}:{turn_text}".encode()) % 20
        kept = by[conv_id]
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv_id, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(f"{t[1]}\0{t[2]}".encode()).digest()))
        initials = [role[:1] if role[:1] and role[:1] in "uas" else "o" for _, role, _ in turns]
        seen, letters, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for (_, role, text), initial in zip(turns, initials, strict=True):
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            if fault:
                count[fault] += 1
            seen.add((role, text))
            letters += initial if not fault else initial.upper() if fault == "truncated" else LETTERS[initial]
        cost, audit = cheapest(letters)
        lines, state, i = [], 0, 0
        for edit in audit:
            wanted = "a" if state == 2 else "u"
            name = {"u": "user", "a": "assistant"}[wanted]
            if edit == "I":
                lines.append(name + ":")
            else:
                _, role, text = turns[i]
                i += 1
                if edit == "D":
                    continue
                wanted = role[0] if edit == "K" else wanted
                lines.append(f"{role if edit == 'K' else name}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[wanted]
        numbers = [t for t, _, _ in turns if t is not None]
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, count["blank"], count["duplicate"], count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def made(spark, rows, parts=1):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(parts)


@pytest.fixture()
def many_tasks(spark):
    """Small exchanges keep all their partitions, so that conversations fall into several pieces."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def compare(frame, rows):
    got = C.repair_report(frame).collect()
    want = report(rows)
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want


@pytest.mark.parametrize("block", [1, 2, 5, 32])
def test_audits_are_the_cheapest_and_least(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    C.ways_of.cache_clear()
    rng = random.Random(block)
    for _ in range(400):
        turns = rng.choice("usaUSAov") + "".join(rng.choice("uuuaaasUASoOvbtpx") for _ in range(rng.randint(0, 8)))
        want = every_audit(turns)
        assert want == cheapest(turns) == C.whole_conversation(turns)
        ends = [w[:2] for (enter, leave), w in C.piece_ways(turns).items() if enter == C.START and leave in (C.START, C.AFTER_A)]
        assert min(ends) == want
    C.ways_of.cache_clear()


def test_the_band_holds_the_cheapest_way():
    rng = random.Random(4)
    for _ in range(50):
        turns = "".join(rng.choice("uaUAso") for _ in range(12))
        target = "ua" * rng.randint(0, 7)
        whole = C.table_of(turns, target, C.FAR // 4)[0][0] if len(target) < 1 else C.table_of(turns, target, 200)[0][0]
        assert C.table_of(turns, target, whole)[0][0] == whole
        assert C.backtrace(turns, target, C.table_of(turns, target, whole)) == C.backtrace(turns, target, C.table_of(turns, target, 200))


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_given_conversations(spark, sf_dir):
    frame = table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in entry.queries()["op13_conversation_repair"](spark, sf_dir).collect()}
    assert got == report(rows)


def test_nulls_ties_and_hot_conversations(spark, many_tasks):
    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        conv_id = rng.choice([None, 7, 7, 7, rng.randint(10, 300)])  # a third and more on one id and on none
        turn = rng.choice([None, rng.randint(0, 1500), rng.randint(0, 30)])
        rows.append((conv_id, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "ux"]), rng.choice(["a.", "b", "c?", " ", "", None, f"x{rng.randint(0, 999)}.", f"y{rng.randint(0, 999)}!"])))
    rows += [(8, 1, "user", "Same again.")] * 500  # copies of one row
    compare(made(spark, rows, 7), rows)


def test_a_long_conversation_spreads_over_tasks(spark, many_tasks):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(3000)]
    plan = C.plan(C.damaged(made(spark, rows, 4)))
    assert plan.pieces.count() > 2
    compare(made(spark, rows, 4), rows)
    lines = [(r["role"], r["text"]) for r in C.repaired(plan).orderBy("at", "k").collect()]
    assert "".join(role[0] for role, _ in lines) == "ua" * (len(lines) // 2)


def test_edges(spark):
    # conversations of which damage leaves nothing, long texts, far turns
    gone = [(k, 0, "user", "Hello.") for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    rows = [*gone, (5001, -(2**62), "user", "far."), (5001, 2**62, "assistant", "apart."), (5002, None, None, None), (5003, 1, "user", "long " * 100_000), (5004, 1, "System", "\t ")]
    assert gone
    compare(made(spark, rows), rows)
    got = {r["conv_id"]: r for r in C.repair_report(made(spark, gone)).collect()}
    assert all((r["cost"], r["audit"], r["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest()) for r in got.values())
    assert C.repair_report(made(spark, [])).collect() == []

"""Operator 13 against plain recursion over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest

from gleaner.llm import chat_repair, queries

TURNS = "conv_id long, turn long, role string, text string, conv string, tag int, letters string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        row = (conv, turn, "user" if fate == 4 else role, text)
        out += [row] * {0: 0, 3: 2}.get(fate, 1)
    return out


def plain_repair(rows):
    """The contract's columns for the damaged rows (turn, role, text) of one conversation, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    ahead = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserted=0):
        """(cost, audit, roles and texts) from here on."""
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(price, letter, rest, line=()):
            options.append((price + rest[0], letter + rest[1], line + rest[2]))

        if inserted < 3:
            for new in "ua":
                if new in ahead[state]:
                    role = {"u": "user", "a": "assistant"}[new]
                    add(2, "I", best(i, new, inserted + 1), ((role, ""),))
        if i < len(rows):
            _, role, text = rows[i]
            add(3, "D", best(i + 1, state))
            if faults[i] in ("", "truncated"):
                more = faults[i] == "truncated"
                if role[:1] and role[0] in ahead[state]:
                    add(more, "K", best(i + 1, role[0]), ((role, text),))
                for new, name in (("u", "user"), ("a", "assistant")):
                    if new in ahead[state]:
                        add(2 + more, "R", best(i + 1, new), ((name, text),))
        return min(options, default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "")
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in (
        "blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def plain(rows):
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in plain_damage(rows):
        out[conv].append((turn, role, text))
    return {c: plain_repair(sorted(r, key=lambda x: (x[0] is not None, x[0]))) for c, r in out.items()}


def conversations(rng, n):
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 4, 7, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "s", "", None])
            text = rng.choice(["Yes.", "Yes.", "no", " \t", "", None, "What?\n", f"Turn {turn}!", "a.  "])
            rows.append((conv if conv else None, turn * rng.choice([1, 1, 2]) if turn != 5 else None, role, text))
    # rows of one turn would leave their order open
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


def result(spark, tmp_path, rows):
    path = tmp_path / "in"
    path.mkdir()
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS).write.parquet(f"{path}/conversations.parquet")
    got = queries.op13_chat_repair(spark, str(path)).collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
             for r in got}
    assert len(found) == len(got)
    return found


@pytest.mark.parametrize("block, hot", [(4096, 200_000), (2, 200_000), (3, 4)])
def test_all_damage_against_recursion(spark, tmp_path, monkeypatch, block, hot):
    monkeypatch.setattr(chat_repair, "BLOCK", block)
    monkeypatch.setattr(chat_repair, "HOT_ROWS", hot)
    rows = conversations(random.Random(block), 60)
    assert result(spark, tmp_path, rows) == plain(rows)


def test_given_conversations(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, tmp_path, rows) == plain(rows)


def test_repeated_rows_count_as_duplicates_and_no_rows_give_none(spark, tmp_path):
    rows = [(1, 2, "user", "Same."), (1, 2, "user", "Same."), (1, 2, "user", "Same.")]
    assert result(spark, tmp_path, rows) == plain(rows)
    (tmp_path / "none").mkdir()
    assert result(spark, tmp_path / "none", []) == {}


def test_a_long_conversation_is_cut_and_streamed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chat_repair, "BLOCK", 64)
    monkeypatch.setattr(chat_repair, "HOT_ROWS", 50)
    rng, before = random.Random(9), sys.getrecursionlimit()
    sys.setrecursionlimit(10_000)
    rows = [(5, i, rng.choice(["user", "assistant"]), "x" * rng.choice([1, 5, 100_000 if i == 77 else 3]) + f"{i}.")
            for i in range(400)]
    assert result(spark, tmp_path, rows) == plain(rows)
    sys.setrecursionlimit(before)


def test_repaired_rows(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye."), (2, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_repair.repaired(turns, chat_repair.audited(turns)).orderBy("conv_id", "nth").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "K", "system", "Be kind."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "Hello."),
        (1, 3, "K", "user", "Bye."), (1, 4, "I", "assistant", "")]


def test_least_audits_of_long_letters_in_blocks(monkeypatch):
    rng = random.Random(4)
    told = ["".join(rng.choice("AEIMDHLBFC") for _ in range(n)) for n in (0, 1, 5, 33, 200, 200)]
    whole = chat_repair.cheapest_edits(told)
    monkeypatch.setattr(chat_repair, "BLOCK", 7)
    assert chat_repair.cheapest_edits(told) == whole

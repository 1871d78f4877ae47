"""Conversation repair against an exhaustive search, and on awkward tables."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
import regex
from gridloom.llm import conversation_repair as cr
from gridloom.llm import queries as q
from pyspark.sql import functions as F

GRAMMAR = regex.compile("(s?(ua)+)?")
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(turns):
    """(cost, audit, repaired): edits in order of cost and string, until one string of roles is whole."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while True:
        cost, audit, i, roles, kept = heapq.heappop(heap)
        if (i, roles, cost, audit) in seen:
            continue
        seen.add((i, roles, cost, audit))
        if i == len(turns) and GRAMMAR.fullmatch(roles):
            return cost, audit, kept
        steps = [(3, "I", i, "u", ("user", "")), (3, "I", i, "a", ("assistant", ""))]
        if i < len(turns):
            role, text, fault = turns[i]
            steps.append((4, "D", i + 1, "", None))
            if fault in (None, "truncated"):
                more = 3 if fault else 0
                steps.append((more, "K", i + 1, role[:1] or "?", (role, text)))
                steps += [(3 + more, "R", i + 1, r[0], (r, text)) for r in ("user", "assistant")]
        for more, edit, j, role, turn in steps:
            if GRAMMAR.fullmatch(roles + role, partial=True):
                heapq.heappush(heap, (cost + more, audit + edit, j, roles + role, kept + ((turn,) if turn else ())))


def plain(rows):
    """conv_id to the expected row; rows of (conv_id, turn, role, text, absent)."""
    by = defaultdict(list)
    for conv, turn, role, text, absent in rows:
        by[conv]
        if not absent:
            by[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen = [], set()
        for turn in turns:
            text = regex.sub(r"[\x20\x09-\x0D]+\Z", "", turn[2])
            faults.append("blank" if not text else "duplicate" if turn[1:] in seen else "truncated" if text[-1] not in ".!?" else None)
            seen.add(turn[1:])
        initials = [t[1][:1] for t in turns]
        known = [t[0] for t in turns if t[0] is not None]
        cost, audit, kept = cheapest([(t[1], t[2], f) for t, f in zip(turns, faults, strict=True)])
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        blank = lambda v: " " if v is None else str(v)
        way = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if way == 1 else regex.sub("[.!?]", "", text) if way == 2 else text
        for _ in range(2 if way == 3 else 1):
            yield conv, turn, "user" if way == 4 else role, text, way == 0


def got(frame):
    rows = frame.select("conv_id", *SUMMARY, "audit", "repaired_sha256").collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_an_exhaustive_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(q.op13_conversation_repair(spark, sf)) == plain(damaged(rows))


def test_query_on_nulls_repeats_and_other_roles(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(7)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "User", None])
            text = rng.choice(["a.", "b", "Why?\n", " ", "", None, "é!", "x. y"])
            rows.append((conv, rng.choice([turn, turn, 2, None, -3]), role, text))
    table = spark.createDataFrame([(*r, "clash", 7) for r in rows], "conv_id long, turn int, role string, text string, fault string, at int")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    assert got(q.op13_conversation_repair(spark, str(tmp_path))) == plain(damaged(rows))


def test_every_string_of_roles_and_faults(spark):
    rows = []
    for n in range(5):
        for code in range(7**n):
            word = [code // 7**i % 7 for i in range(n)]
            kinds = lambda i, k: [("system", f"{i}."), ("user", f"{i}."), ("assistant", f"{i}."), ("user", f"{i}"), ("assistant", ""), ("tool", f"{i}."), ("assistant", f"{i}")][k]
            rows += [(f"{n}-{code}", i, *kinds(i, k), False) for i, k in enumerate(word)] or [(f"{n}-{code}", 0, "user", "x", True)]
    table = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, absent boolean")
    assert got(cr.digests(cr.repair(table, F.col("absent")))) == plain(rows)


@pytest.mark.parametrize("kind", ["user", "assistant", "system", "mixed", "blank"])
def test_long_conversations_go_out_piece_by_piece(spark, monkeypatch, kind):
    """The same edits whether turns wait for the end or not, on conversations that do not fit a piece."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system"]
    rows = [(1, i, rng.choice(roles) if kind in ("mixed", "blank") else kind, "" if kind == "blank" and i else f"{i}" + rng.choice(".!,")) for i in range(1500)]
    one, outs = cr._Conversation(), []
    monkeypatch.setattr(cr, "WAITING", 10**9)
    for _, turn, role, text in rows:
        one.read(turn, role, text, "blank" if not text else "truncated" if text[-1] not in ".!?" else None, outs)
    one.close(outs)
    monkeypatch.undo()
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    ours = cr.repair(table).collect()
    assert [(r["at"], r["edit"], r["fault"], r["turn"], r["role"], r["text"], r["summary"] and r["summary"].asDict()) for r in ours] == outs
    if kind != "blank":
        assert len(one.waiting) == 0
    kept = "".join(r["role"][0] for r in ours if r["edit"] and r["edit"] != "D")
    assert GRAMMAR.fullmatch(kept)


def test_repaired_rows_and_empty_tables(spark):
    table = spark.createDataFrame([("a", 0, "system", "Be kind."), ("a", 1, "assistant", "Yes."), ("b", 0, "tool", "1.")], "conv_id string, turn int, role string, text string")
    rows = {(r["conv_id"], r["at"]): (r["edit"], r["role"], r["text"]) for r in cr.repair(table).where("edit is not null").collect()}
    assert rows[("a", 0)] == ("K", "system", "Be kind.") and rows[("a", 1)] == ("I", "user", "") and rows[("a", 2)] == ("K", "assistant", "Yes.")
    assert rows[("b", 0)][0] == "D" and ("b", 1) not in rows
    none = cr.digests(cr.repair(table.limit(0)))
    assert none.count() == 0 and none.columns == ["conv_id", *SUMMARY, "audit", "repaired_sha256"]
    gone = cr.digests(cr.repair(table, F.lit(True))).collect()
    assert [tuple(r)[1:] for r in gone] == [(0,) * 6 + ("", EMPTY)] * 2

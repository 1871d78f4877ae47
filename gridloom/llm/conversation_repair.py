"""Repair of conversations by weighted finite-state composition.

Three machines: the conversation as a chain of turns (the input acceptor), edits with their weights
(the transducer: keep, rename the role, delete, insert an empty turn) and an acceptor of the roles'
initials.  Their composition is never built; at each turn only the grammar states that can be reached
are live, each with the least weight of the paths that lead there.  A weight is a pair of cost and
edit string, ordered by cost and then by the string.

Weights may be compared before the paths are complete: of two paths over the same turns with the same
cost, neither string is the beginning of the other, since what is left of the longer one would be
insertions, which cost something.  So the strings differ at a place that both have, and what is
appended to both cannot turn their order.

A conversation's turns pass through one task in order, as a stream.  As soon as the strings of all live
states begin alike, the edits of that beginning are settled and their turns go out, so that a
conversation of any length is held only as far as its paths differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .storage import small_batches

# The grammar (s?(ua)+)? as states, and the edits' costs.
GRAMMAR = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\f\r"
#: Turns that may wait before their settled beginning goes out, and rows and characters of a batch of results.
WAITING, OUT_ROWS, OUT_CHARS = 256, 1024, 8_000_000

SUMMARY = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long>"

Weights = dict[int, tuple[int, str]]


def _put(live: Weights, state: int, cost: int, edits: str) -> None:
    if state not in live or (cost, edits) < live[state]:
        live[state] = (cost, edits)


def _with_insertions(live: Weights) -> Weights:
    """Paths that go on by inserted turns.  Two at most: a third would come back to a state it has left."""
    for _ in range(2):
        for state, (cost, edits) in list(live.items()):
            for role in ROLES:
                if role in GRAMMAR[state]:
                    _put(live, GRAMMAR[state][role], cost + INSERT, edits + "I")
    # whatever follows state 1 may follow state 3 too, and whatever follows state 0, but for one system turn
    if 3 in live:
        if 1 in live and live[1] > live[3]:
            del live[1]
        if 0 in live and live[0][0] > live[3][0] + DELETE:
            del live[0]
    return live


def _read(live: Weights, initial: str, fault: str | None) -> Weights:
    """Paths over one more turn."""
    after: Weights = {}
    more = TRUNCATED if fault == "truncated" else 0
    for state, (cost, edits) in live.items():
        _put(after, state, cost + DELETE, edits + "D")
        if fault is None or more:
            for role, to in GRAMMAR[state].items():
                if role == initial:
                    _put(after, to, cost + more, edits + "K")
                elif role in ROLES:
                    _put(after, to, cost + RENAME + more, edits + "R")
    return _with_insertions(after)


class _Conversation:
    """One conversation, turn by turn; ``out`` gets (at, edit, fault, turn, role, text, summary)."""

    def __init__(self) -> None:
        self.live = _with_insertions({0: (0, "")})
        self.state, self.at = 0, 0  # behind the settled edits
        self.waiting: list[tuple] = []
        self.first = self.last = self.initial = None
        self.n_turns = 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def read(self, turn, role: str, text: str, fault: str | None, out: list) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.n_turns = turn, self.n_turns + 1
        if fault is not None:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.initial = role[:1]
        self.live = _read(self.live, role[:1], fault)
        self.waiting.append((turn, role, text, fault))
        if len(self.waiting) % WAITING == 0:
            settled = commonprefix([edits for _, edits in self.live.values()])
            self.live = {s: (c, e[len(settled) :]) for s, (c, e) in self.live.items()}
            self._settle(settled, out)

    def _settle(self, edits: str, out: list) -> None:
        """A string of edits fixes the path: each state has at most one role that is no system turn."""
        used = 0
        for edit in edits:
            if edit == "I":
                role = next(r for r in ROLES if r in GRAMMAR[self.state])
                self.state = GRAMMAR[self.state][role]
                out.append((self.at, edit, None, None, ROLES[role], "", None))
            else:
                turn, role, text, fault = self.waiting[used]
                used += 1
                if edit == "R":
                    initial = next(r for r in ROLES if r in GRAMMAR[self.state])
                    role = ROLES[initial]
                if edit != "D":
                    self.state = GRAMMAR[self.state][role[:1]]
                out.append((self.at, edit, fault, turn, role, text, None))
            self.at += 1
        del self.waiting[:used]

    def close(self, out: list) -> None:
        cost, edits = min(self.live[s] for s in FINAL if s in self.live)
        self._settle(edits, out)
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.n_turns, 2**63 - 1)
        out.append((self.at, None, None, None, None, None, {"gaps": gaps, **self.counts, "cost": cost}))


def _stream(schema: T.StructType):
    form = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, key = None, None
        keys, out = [], []
        size = 0

        def batch() -> pa.RecordBatch:
            columns = [keys, *zip(*out, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, form, strict=True)], schema=form)

        for rows in batches:
            for conv, turn, role, text, fault, absent in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if one is None or conv != key:
                    if one is not None:
                        one.close(out)
                        keys += [key] * (len(out) - len(keys))
                    one, key = _Conversation(), conv
                if not absent:
                    one.read(turn, role, text, fault, out)
                    size += len(text)
                keys += [key] * (len(out) - len(keys))
                if len(out) >= OUT_ROWS or (size >= OUT_CHARS and out):
                    yield batch()
                    keys, out, size = [], [], 0
        if one is not None:
            one.close(out)
            keys += [key] * (len(out) - len(keys))
        if out:
            yield batch()

    return run


def repair(rows: DataFrame, absent: Column | None = None) -> DataFrame:
    """The cheapest edits that make each conversation's roles follow the grammar.

    ``rows`` has conv_id, turn, role and text; other columns are not looked at.  Turns come in the order of
    turn (null first), role and text; equal rows are turns of their own, of which all but the first are
    duplicates.  A null role or text is one space; null conv_ids are one conversation.  Rows for which
    ``absent`` holds count for nothing, but their conversations have a result.  An empty table gives an
    empty one.

    A row of the result is an edit: conv_id, at (from 0), edit (K, R, D or I), fault (blank, duplicate or
    truncated), turn, and role and text as repaired.  The last row of a conversation has no edit and a
    summary: numbers of gaps, faults and illegal neighbours, and the cost.  A conversation's rows lie in
    order in one partition.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    gone = F.coalesce(absent, F.lit(False)) if absent is not None else F.lit(False)
    turns = small_batches(rows).select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("absent"))
    # spread by conversation alone: numbering equal rows within it needs no other shuffle
    same = Window.partitionBy("conv_id", "absent", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    turns = turns.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(end == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth"]
    turns = turns.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", fault.alias("fault"), "absent")
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, at long, edit string, fault string, turn long, role string, text string, summary {SUMMARY}"
    schema = rows.sparkSession.createDataFrame([], schema).schema
    return turns.mapInArrow(_stream(schema), schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, the summary's columns, ``audit`` (a conversation's edits) and ``repaired_sha256`` (of its
    turns as role:text, a line each) of what :func:`repair` returns, in its order."""
    import hashlib

    spark = repaired.sparkSession
    schema = spark.createDataFrame([], repaired.schema).select("conv_id", "summary.*").withColumns({"audit": F.lit("").cast("string"), "repaired_sha256": F.lit("").cast("string")}).schema
    form = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, empty = [], hashlib.sha256(), True
        for rows in batches:
            out = []
            for conv, edit, role, text, summary in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if edit is None:
                    out.append((conv, *summary.values(), "".join(audit), digest.hexdigest()))
                    audit, digest, empty = [], hashlib.sha256(), True
                    continue
                audit.append(edit)
                if edit != "D":
                    digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    empty = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), form, strict=True)], schema=form)

    return repaired.select("conv_id", "edit", "role", "text", "summary").mapInArrow(run, schema)

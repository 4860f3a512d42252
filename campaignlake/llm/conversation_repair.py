"""Conversation structure repair, by Four-Russians block tables.

A conversation is well formed if it is empty or its turns are an optional system
turn and then pairs of user and assistant.  ``repair`` finds the cheapest edits
that make it so: keep a turn (0), give it the role user or assistant (3), delete
it (4), insert an empty turn of user or assistant (3); a truncated turn that stays
costs 3 more, blank and repeated turns must go.  Which role a new or changed turn
gets follows from the turns before it, so the edits' initials, the audit, tell
the whole repair; of equally cheap audits the least in ASCII order wins.

A turn is one of nine symbols: it must go, or it is one of four roles, truncated
or not.  The cost of finishing from each of four states is a vector; less its
least entry there are few of them, numbered once.  The block table gives, for
each of them and every block of four symbols, the vector before the block and
what it adds.  A conversation is processed from its end, a block a lookup.  For
the trace each block is expanded backward from the vector at its right border
into the vectors between its turns, and the least initial that loses nothing is
taken, turn by turn, from the front.

Defined results: turns sort by number, then role, then text, nulls first; a null
role or text is one space; a null id is a conversation of its own; repeated rows
are duplicates; no rows give no result.  A conversation is one output row with
the whole repaired text, so its turns, and no others, meet in a task, which holds
one conversation at a time.
"""

from __future__ import annotations

import re
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, raw

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
BLOCK = 4
START, SYSTEM, USER, PAIR = range(4)              # what stands before
ENDS = (START, PAIR)
FORCED = (USER, USER, PAIR, USER)                 # state after a new or changed turn: its role is forced
ROLE_INTO = {USER: b"user", PAIR: b"assistant"}
KEPT = {(START, b"s"): SYSTEM, (START, b"u"): USER, (SYSTEM, b"u"): USER, (USER, b"a"): PAIR, (PAIR, b"u"): USER}
INITIALS = (b"s", b"u", b"a", b"")                # the last: any other
GONE = 0                                          # symbol of a turn that must go
SYMBOLS = 1 + 2 * len(INITIALS)
LEGAL = (b"su", b"ua", b"au")

INK = re.compile(rb"[^\x20\x09-\x0D]")
CLOSED = re.compile(rb"[.!?][\x20\x09-\x0D]*\Z")


def symbol(initial: bytes, truncated: bool) -> int:
    return 1 + 2 * (INITIALS.index(initial) if initial in INITIALS[:3] else 3) + truncated


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(2):  # a third insert would only repeat a state
        costs = [min(c, INSERT + costs[FORCED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _before(after: tuple[int, ...], x: int) -> tuple[int, ...]:
    """Costs to finish from before a turn of symbol ``x``, from those after it."""
    costs = [DELETE + c for c in after]
    if x != GONE:
        initial, extra = INITIALS[(x - 1) // 2], TRUNCATED * ((x - 1) % 2)
        for q in range(4):
            costs[q] = min(costs[q], REROLE + extra + after[FORCED[q]])
            if (q, initial) in KEPT:
                costs[q] = min(costs[q], KEEP + extra + after[KEPT[q, initial]])
    return _with_inserts(costs)


class Tables:
    """Normalised vectors, the step of one symbol and the step of a block, from right to left."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _with_inserts([0 if q in ENDS else 10 ** 6 for q in range(4)])
        numbers, self.vectors, self.step = {end: 0}, [end], []
        for v in self.vectors:  # grows while it is gone through
            row = []
            for x in range(SYMBOLS):
                before = _before(v, x)
                low = min(before)
                normal = tuple(c - low for c in before)
                if normal not in numbers:
                    numbers[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((numbers[normal], low))
            self.step.append(row)
        self.end = 0
        step = np.array(self.step)                               # vector, symbol -> (vector, added)
        codes = np.array(list(product(range(SYMBOLS), repeat=block)))
        at = np.repeat(np.arange(len(self.vectors))[:, None], len(codes), axis=1)
        added = np.zeros_like(at)
        for place in reversed(range(block)):
            now = step[at, codes[:, place]]
            at, added = now[..., 0], added + now[..., 1]
        self.blocks, self.adds = at.tolist(), added.tolist()

    def code(self, symbols) -> int:
        out = 0
        for x in symbols:
            out = out * SYMBOLS + x
        return out

    def solve(self, symbols: list[int]) -> tuple[int, str]:
        """The least cost and the audit."""
        rest = len(symbols) % self.block  # turns before the first whole block go one by one
        borders, v, total = [self.end], self.end, 0
        for at in range(len(symbols) - self.block, rest - 1, -self.block):
            code = self.code(symbols[at:at + self.block])
            total += self.adds[v][code]
            v = self.blocks[v][code]
            borders.append(v)
        audit, state = [], START
        inner = self.expand(symbols[:rest], v)
        total += sum(add for _, add, _ in inner) + self.vectors[inner[0][0] if inner else v][START]
        state = self.trace(symbols[:rest], inner, state, audit)
        borders.pop()
        for at in range(rest, len(symbols), self.block):
            part = symbols[at:at + self.block]
            state = self.trace(part, self.expand(part, borders.pop()), state, audit)
        while state not in ENDS:
            audit.append("I")
            state = FORCED[state]
        return total, "".join(audit)

    def expand(self, symbols: list[int], v: int) -> list[tuple[int, int, int]]:
        """Per turn the vector before it, what it adds, and the vector after it."""
        out = []
        for x in reversed(symbols):
            before, add = self.step[v][x]
            out.append((before, add, v))
            v = before
        return out[::-1]

    def trace(self, symbols: list[int], inner: list[tuple[int, int, int]], q: int, audit: list[str]) -> int:
        for x, (before, add, after) in zip(symbols, inner):
            here, there = self.vectors[before], self.vectors[after]
            while True:
                best = here[q] + add
                if DELETE + there[q] == best:
                    audit.append("D")
                    break
                if INSERT + here[FORCED[q]] == here[q]:
                    audit.append("I")
                    q = FORCED[q]
                    continue
                extra = TRUNCATED * ((x - 1) % 2)
                kept = KEPT.get((q, INITIALS[(x - 1) // 2]))
                if kept is not None and KEEP + extra + there[kept] == best:
                    audit.append("K")
                    q = kept
                else:
                    audit.append("R")
                    q = FORCED[q]
                break
        return q


def faults(turns: list[tuple[bytes, bytes]]) -> tuple[list[int], dict[str, int]]:
    """Each turn's symbol, and how many have which first fault."""
    seen, symbols, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in turns:
        if not INK.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if CLOSED.search(text) else "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols.append(GONE if fault in ("blank", "duplicate") else symbol(role[:1], fault == "truncated"))
    return symbols, counts


def repaired(turns: list[tuple[bytes, bytes]], audit: str) -> list[tuple[bytes, bytes]]:
    """The turns that an audit leaves."""
    out, left, q = [], iter(turns), START
    for edit in audit:
        if edit == "I":
            q = FORCED[q]
            out.append((ROLE_INTO[q], b""))
            continue
        role, text = next(left)
        if edit == "K":
            q = KEPT[q, role[:1]]
            out.append((role, text))
        elif edit == "R":
            q = FORCED[q]
            out.append((ROLE_INTO[q], text))
    return out


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per conversation: its id, gaps in the turn numbers, faults, illegal neighbours, cost,
    audit, and ``repaired``, its turns after the edits."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    kind = rows.schema["conv"].dataType

    def run(batches):
        tables = Tables()
        out, size = [], 0

        def flush():
            flat = [t for r in out for t in r[-1]]
            strings = lambda values: pa.array(values, pa.binary()).view(pa.string())
            turns = pa.StructArray.from_arrays([strings([t[0] for t in flat]), strings([t[1] for t in flat])],
                                               ["role", "text"])
            ends = np.cumsum([0, *(len(r[-1]) for r in out)])
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], conv_type), *(pa.array([r[i] for r in out], pa.int64())
                                                             for i in range(1, 7)),
                 pa.array([r[7] for r in out], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), turns)],
                ["conv", *FIGURES, "audit", "repaired"])

        def rows_of():
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield from zip(batch.column("conv").to_pylist(), batch.column("turn").to_pylist(),
                               raw(batch.column("role")), raw(batch.column("text")))

        conv_type = None
        for conv, group in groupby(rows_of(), key=lambda r: r[0]):
            group = list(group)
            numbers = {r[1] for r in group} - {None}
            said = [r[2:] for r in group]
            symbols, counts = faults(said)
            initials = [r[2][:1] for r in group]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            cost, audit = tables.solve(symbols)
            gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
            out.append((conv, gaps, *counts.values(), illegal, cost, audit, repaired(said, audit)))
            size += sum(len(r[3]) for r in group) + 64 * len(group)
            if size > 4_000_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    schema = (f"conv {kind.simpleString()}, " + ", ".join(f"`{c}` long" for c in FIGURES)
              + ", audit string, repaired array<struct<role: string, text: string>>")
    return map_arrow(dealt, run, schema).withColumnRenamed("conv", conv_col)

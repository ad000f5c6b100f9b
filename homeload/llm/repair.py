"""Conversation structure repair: a depth-first branch-and-bound search for the cheapest edits of each conversation.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then users and assistants in turn, or nothing at all. A
search node is a number of rows dealt with and the last role written. The
stack is explicit; children are pushed so that they come off in ASCII order of
their edit, hence prefixes are met in ASCII order of their audit. A node falls

- by bound: its cost and the least cost of the rows that are left (the suffix
  bound, in which the conversation may stop after any role) exceed the
  incumbent, or equal an incumbent that the search has reached itself, whose
  audit comes first;
- by dominance: the node's table entry shows a prefix no dearer, which for equal
  costs had the smaller audit as it came earlier.

The first incumbent is a dive along the least bounds. As that bound is at most
the price of a broken end below the truth, a node is opened a small number of
times and the search is linear in the conversation's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import runs

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a role of this initial, where it may follow.
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state after the role that a rewritten or inserted turn must have.
FORCED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
SAID = re.compile(r"[^\x20\x09-\x0D]")
ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
PAIRS = {"su", "ua", "au"}


def faults(turns: Iterable[tuple[str, str]]) -> list[int]:
    """The first fault of each ``(role, text)``, 0 for none."""
    seen, out = set(), []
    for turn in turns:
        text = turn[1]
        out.append(BLANK if not SAID.search(text) else DUPLICATE if turn in seen else 0 if ENDED.search(text) else TRUNCATED)
        seen.add(turn)
    return out


def _edits(initial: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """``(edit, cost, next state)`` of one row, by ASCII; inserts are apart."""
    out = [(DELETE, DELETE_COST, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    if initial in AFTER[state]:
        out.append((KEEP, extra, AFTER[state][initial]))
    out.append((REROLE, REROLE_COST + extra, FORCED[state]))
    return out


def suffix_bounds(initials: list[str], found: list[int]) -> list[tuple[int, ...]]:
    """Per number of rows done and state, the least cost of the rest if the conversation may end after any role."""
    bounds = [(0, 0, 0, 0)]
    for initial, fault in zip(reversed(initials), reversed(found)):
        later = bounds[-1]
        own = [min(cost + later[to] for _, cost, to in _edits(initial, fault, s)) for s in range(4)]
        once = [min(own[s], INSERT_COST + own[FORCED[s]]) for s in range(4)]
        bounds.append(tuple(min(once[s], INSERT_COST + once[FORCED[s]]) for s in range(4)))
    return bounds[::-1]


def _children(initials, found, row: int, state: int) -> list[tuple[str, int, int, int]]:
    """``(edit, cost, row, state)`` of all next nodes, by ASCII."""
    insert = (INSERT, INSERT_COST, row, FORCED[state])
    if row == len(initials):
        return [insert]
    own = [(edit, cost, row + 1, to) for edit, cost, to in _edits(initials[row], found[row], state)]
    return [own[0], insert, *own[1:]]


def _dive(initials, found, bounds) -> int:
    """Cost of the path that follows the least bounds."""
    row, state, spent = 0, START, 0
    while row < len(initials) or state not in ENDS:
        _, cost, row, state = min(_children(initials, found, row, state), key=lambda c: c[1] + bounds[c[2]][c[3]])
        spent += cost
    return spent


def cheapest(initials: list[str], found: list[int]) -> tuple[int, str]:
    """``(cost, audit)`` of the cheapest edits, of equal ones that with the ASCII-least audit."""
    bounds = suffix_bounds(initials, found)
    best, audit = _dive(initials, found, bounds), None
    table: dict[tuple[int, int], int] = {}
    path: list[str] = []
    stack = [(0, START, 0, 0, "")]
    while stack:
        row, state, spent, depth, edit = stack.pop()
        least = spent + bounds[row][state]
        if least > best or (least == best and audit is not None) or table.get((row, state), spent + 1) <= spent:
            continue
        table[row, state] = spent
        del path[depth:]
        path.append(edit)
        if row == len(initials) and state in ENDS:
            best, audit = spent, "".join(path)
        for name, cost, to_row, to_state in reversed(_children(initials, found, row, state)):
            stack.append((to_row, to_state, spent + cost, depth + 1, name))
    return best, audit or ""


def applied(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The conversation after the edits."""
    out, row, state = [], 0, START
    for edit in audit:
        if edit == KEEP:
            out.append(turns[row])
            state = AFTER[state][turns[row][0][0]]
        elif edit != DELETE:
            state = FORCED[state]
            out.append((NAMES[state], turns[row][1] if edit == REROLE else ""))
        row += edit != INSERT
    return out


def repaired(turns: list[tuple[int | None, str, str]]) -> dict:
    """All figures of one conversation, its ``(turn, role, text)`` in order."""
    said = [(role, text) for _, role, text in turns]
    initials, found = [role[:1] for role, _ in said], faults(said)
    numbers = {t for t, _, _ in turns if t is not None}
    cost, audit = cheapest(initials, found)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": found.count(BLANK), "duplicate": found.count(DUPLICATE), "truncated": found.count(TRUNCATED),
        "illegal": sum(a + b not in PAIRS for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
        "repaired": [{"role": r, "text": x} for r, x in applied(said, audit)],
    }


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_MESSAGE = pa.struct([("role", pa.string()), ("text", pa.string())])
_KIND = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in FIGURES], ("audit", pa.string()), ("repaired", pa.list_(_MESSAGE))])


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id``, faults counted, ``cost``, ``audit`` and ``repaired array<struct<role, text>>`` per conversation of ``rows``.

    Rows need ``conv_id, turn, role, text``; other columns are ignored. They are
    taken by turn, null turns first, equal turns by role and text. Null roles
    and texts are empty: a null role is no known one, a null text is blank. Rows
    with null ``conv_id`` are one conversation. Repeated rows are duplicates. An
    empty table gives an empty one. A task holds one conversation at a time.
    """
    own = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]

    def walk(batches: Iterator[pa.RecordBatch]):
        for part in runs(batches, ["conv_id"]):
            turns = list(zip(*(part.column(c).to_pylist() for c in ("turn", "role", "text"))))
            yield pa.RecordBatch.from_pylist([{"conv_id": part.column("conv_id")[0].as_py()} | repaired(turns)], _KIND)

    kind = "conv_id long, " + ", ".join(f"{c} long" for c in FIGURES) + ", audit string, repaired array<struct<role: string, text: string>>"
    return own.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(walk, kind)

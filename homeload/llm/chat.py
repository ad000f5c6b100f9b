"""Chat formatting from a declarative template, with turn order checked by a finite-state machine.

Only built-in functions. A conversation is one record: its turns are collected
into one row, which is what a formatted text is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.functions.arrays import let


@dataclass(frozen=True)
class Template:
    """What marks a turn, which roles may follow which, and whose text carries loss.

    ``controls`` are the strings a text may not hold as they are: each is
    written as a backslash and its number, a backslash as ``\\0``. None may
    hold a backslash, and ``close`` must hold one of them.
    """

    labels: Mapping[str, str]
    after: Mapping[str, Sequence[str]]
    accepting: Sequence[str]
    loss: Sequence[str]
    open: str = "### "
    mark: str = ": "
    other: str = "?"
    close: str = " </turn>\n"
    controls: Sequence[str] = field(default=("###", "</turn>", ":"))

    def __post_init__(self):
        if any("\\" in c or not c for c in self.controls) or len(self.controls) > 9:
            raise ValueError("controls are one to nine strings without backslashes")
        if not any(c in self.close for c in self.controls) or any(self.close.startswith(self.close[-i:]) for i in range(1, len(self.close))):
            raise ValueError("close must hold a control and must not overlap itself")

    def escape(self, text: Column) -> Column:
        pairs = [("\\", "\\0"), *((c, f"\\{i}") for i, c in enumerate(self.controls, 1))]
        return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)

    def unescape(self, text: Column) -> Column:
        pairs = [*((f"\\{i}", c) for i, c in enumerate(self.controls, 1)), ("\\0", "\\")]
        return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)

    def header(self, role: Column) -> Column:
        label = reduce(lambda rest, r: F.when(role == r, F.lit(self.labels[r])).otherwise(rest), self.labels, F.concat(F.lit(self.other), self.escape(role)))
        return F.concat(F.lit(self.open), label, F.lit(self.mark))

    def role_of(self, label: Column) -> Column:
        other = self.unescape(label.substr(F.lit(len(self.other) + 1), F.length(label)))
        return reduce(lambda rest, r: F.when(label == self.labels[r], F.lit(r)).otherwise(rest), self.labels, other)


TURNS = Template(
    labels={"system": "System", "user": "User", "assistant": "Assistant"},
    after={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    accepting=("assistant",), loss=("assistant",),
)


def order_state(roles: Column, template: Template = TURNS) -> Column:
    """``struct<state, n_ok>`` of the machine run over an array of roles; ``rejected`` is final, ``n_ok`` turns came before it."""
    steps = F.array(*[F.lit(f"{a}>{b}") for a, nexts in template.after.items() for b in nexts])
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("n_ok"))

    def step(s: Column, role: Column) -> Column:
        fits = F.array_contains(steps, F.concat(s["state"], F.lit(">"), role))
        return F.struct(F.when(fits, role).otherwise(F.lit("rejected")).alias("state"), (s["n_ok"] + fits.cast("int")).alias("n_ok"))

    return F.aggregate(roles, start, step)


def format_chats(rows: DataFrame, template: Template = TURNS) -> DataFrame:
    """``conv_id, segments array<struct<text, loss>>, formatted, valid, n_ok`` per conversation of ``conv_id, turn, role, text`` rows.

    ``formatted`` is all segments joined. A turn is three segments: header, text,
    close; only the texts of loss roles are flagged. Rows go by turn, then role,
    then text, null turns first; null texts and roles are empty; repeated rows
    are turns of their own. Unknown roles are formatted too, the conversation is
    then not valid. Rows with null ids form one conversation.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def parts(t: Column) -> Column:
        def part(text, loss):
            return F.struct(text.alias("text"), loss.alias("loss"))

        quiet = F.lit(False)
        return F.array(
            part(template.header(t["role"]), quiet), part(template.escape(t["text"]), t["role"].isin(*template.loss)),
            part(F.lit(template.close), quiet),
        )

    segments = F.flatten(F.transform("turns", parts))
    machine = order_state(F.transform("turns", lambda t: t["role"]), template)
    made = sorted_turns.select("conv_id", let(machine, lambda m: F.struct(m["state"].isin(*template.accepting).alias("valid"), m["n_ok"].alias("n_ok"))).alias("order"),
                               let(segments, lambda s: F.struct(s.alias("segments"), F.array_join(F.transform(s, lambda x: x["text"]), "").alias("formatted"))).alias("made"))
    return made.select("conv_id", "made.*", "order.*")


def read_turns(formatted: Column, template: Template = TURNS) -> Column:
    """``array<struct<role, text>>`` back from a formatted text."""
    pieces = F.split(formatted, re.escape(template.close), -1)  # the pattern is a regular expression
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        body = piece.substr(F.lit(len(template.open) + 1), F.length(piece))
        label = F.substring_index(body, template.mark, 1)
        text = body.substr(F.length(label) + F.lit(len(template.mark) + 1), F.length(body))
        return F.struct(template.role_of(label).alias("role"), template.unescape(text).alias("text"))

    return F.transform(turns, one)


def read_loss(segments: Column, template: Template = TURNS) -> Column:
    """All text under the loss mask, unescaped and in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")

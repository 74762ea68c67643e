"""Chat formatting from a declarative template, with column functions only.

A finite-state machine over the roles says whether the turns come in a valid order. Each turn gives
three segments: its opening, its text with control characters escaped, and its closing; a segment
under the loss mask is flagged. The text of all segments, joined, is the formatted conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles are trained on, and which turn may follow which.

    `escapes` must name every character a control string starts with, and the escape sign first.
    """

    opening: tuple[str, str] = ("<turn ", ">\n")  # around the role
    closing: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
    role_escapes: tuple[tuple[str, str], ...] = ((">", "&gt;"), ("\n", "&#10;"))
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)


def escape(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Each character as its escape; the escape sign itself is escaped first."""
    for plain, escaped in pairs:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """The reverse, the escape sign last."""
    for plain, escaped in reversed(pairs):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def end_state(roles: Column, template: Template) -> Column:
    """The machine's state after all roles: the last role, or `error` from the first misplaced turn on."""
    steps = [
        x for state, after in template.transitions.items() for role in after for x in (F.lit(f"{state}\n{role}"), F.lit(role))
    ]
    table = F.create_map(*steps)
    return F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\n"), role)), F.lit("error")),
    )


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row a conversation: conv_id, state, valid and `segments` (text, loss).

    Turns are ordered by `turn`, nulls first, equal ones by role and text; repeated rows stay. A
    null text or role is empty. Rows without conv_id are conversations of one turn. A conversation
    out of order is formatted all the same, with `valid` false. Other columns are ignored.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    grouped = turns.select("conv_id", alone.alias("alone"), row.alias("row")).groupBy("conv_id", "alone").agg(
        F.sort_array(F.collect_list("row")).alias("rows")
    )

    def segments(turn: Column) -> Column:
        role = escape(turn["role"], template.escapes + template.role_escapes)
        parts = [
            (F.concat(F.lit(template.opening[0]), role, F.lit(template.opening[1])), F.lit(False)),
            (escape(turn["text"], template.escapes), turn["role"].isin(*template.loss_roles)),
            (F.lit(template.closing), F.lit(False)),
        ]
        return F.array(*(F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts))

    state = end_state(F.col("rows.role"), template)
    return grouped.select(
        "conv_id",
        state.alias("state"),
        state.isin(*template.final).alias("valid"),
        F.flatten(F.transform("rows", segments)).alias("segments"),
    )


def formatted(segments: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(segments["text"], "")


def turns_of(text: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(text, re.escape(template.closing))
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    before, after = template.opening

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, after, 1)
        role = F.substr(head, F.lit(len(before) + 1))
        body = F.substr(piece, F.length(head) + len(after) + 1)
        return F.struct(
            unescape(role, template.escapes + template.role_escapes).alias("role"),
            unescape(body, template.escapes).alias("text"),
        )

    return F.transform(pieces, turn)


def digests(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Format, write, read back: counts and digests of each conversation's turns and loss text."""
    written = staged(format_conversations(turns, template), "conversations")
    text = formatted(F.col("segments"))
    loss = F.filter("segments", lambda s: s["loss"])
    read = written.select(
        "conv_id",
        "valid",
        turns_of(text, template).alias("turns"),
        F.array_join(F.transform(loss, lambda s: unescape(s["text"], template.escapes)), "").alias("loss"),
        F.length(text).cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )

"""Chat formatting with a finite-state machine over roles, with DataFrame functions only.

A template names, per role, what opens and closes a turn, whether its text is under the loss, and which roles
may follow. Markers start with ``[`` or ``<``; texts are escaped so that neither occurs in them, which makes
markers unmistakable and the whole reversible.

At scale: one shuffle, on the conversation. A conversation is one row of the output, so it has to fit a row;
its turns are sorted within it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How the turns of a role are marked. ``then`` lists the roles that may come next."""

    open: str
    close: str
    loss: bool
    then: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    start: tuple[str, ...] = ("system", "user")
    roles: Mapping[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<sys>", "</sys>\n", False, ("user",)),
        "user": Turn("[INST] ", " [/INST]\n", False, ("assistant",)),
        "assistant": Turn("<out>", "</s>\n", True, ("user",)),
    })
    #: Turns of any other role: the role stands, escaped, between the first two.
    other: tuple[str, str, str] = ("<turn>", "</turn>", "</end>\n")

    def __post_init__(self):
        marks = [self.other[0], *(t.open for t in self.roles.values())]
        if any(m[:1] not in ("[", "<") for m in marks) or len(set(marks)) < len(marks):
            raise ValueError("turns open with markers of their own that start with [ or <")


def escape(text: Column) -> Column:
    """The text without ``[`` and ``<``, reversibly."""
    for char, code in (("\\", "\\0"), ("[", "\\1"), ("<", "\\2")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in (("<", "\\2"), ("[", "\\1"), ("\\", "\\0")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def format_chats(
    conversations: DataFrame, template: Template = Template(), conv_column: str = "conv_id",
    turn_column: str = "turn", role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, segments (text, loss), formatted, valid, first_bad_turn.

    Rows come in order of turn (null last, equal turns by role, then text). Null texts and roles count as
    empty; any role, also an empty one, can be formatted and read back. ``formatted`` is the segments joined.
    ``valid`` tells whether the roles follow the template from its start; ``first_bad_turn`` is the place (from
    0) of the first that does not. Rows without conv_id are one conversation. Repeated rows are turns of their
    own. Only the named columns are read. No rows give no rows.
    """
    turn, role, text = F.col(turn_column), F.coalesce(role_column, F.lit("")), F.coalesce(text_column, F.lit(""))
    turns = conversations.select(
        F.col(conv_column).alias("conv_id"),
        F.struct(turn.isNull().alias("last"), turn.alias("turn"), role.alias("role"), text.alias("text")).alias("turn"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template)))
    begin = F.array(_segment(F.lit(template.begin), False))
    bad = F.filter(
        F.transform("turns", lambda t, i: F.when(~_allowed(F.get("turns", i - 1)["role"], t["role"], i, template), i)),
        lambda i: i.isNotNull(),
    )
    out = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.concat(begin, segments).alias("segments"), F.get(bad, 0).alias("first_bad_turn"))
    return out.select(
        "conv_id", "n_turns", "segments", F.array_join(F.col("segments")["text"], "").alias("formatted"),
        F.col("first_bad_turn").isNull().alias("valid"), "first_bad_turn",
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation."""
    body = r"[^\[<]*"
    marks = [re.escape(t.open) + body + re.escape(t.close) for t in template.roles.values()]
    start, middle, end = template.other
    marks.append(re.escape(start) + body + re.escape(middle) + body + re.escape(end))

    def read(turn: Column) -> Column:
        inner = F.substring(turn, len(start) + 1, F.char_length(turn) - len(start) - len(end))
        out = F.struct(
            unescape(F.substring_index(inner, middle, 1)).alias("role"),
            unescape(F.substring_index(inner, middle, -1)).alias("text"),
        )
        for role, mark in template.roles.items():
            text = F.substring(turn, len(mark.open) + 1, F.char_length(turn) - len(mark.open) - len(mark.close))
            known = F.struct(F.lit(role).alias("role"), unescape(text).alias("text"))
            out = F.when(turn.startswith(mark.open), known).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit("|".join(marks)), F.lit(0)), read)


def read_loss(segments: Column) -> Column:
    """All text under the loss, one after another."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _segments(role: Column, text: Column, template: Template) -> Column:
    start, middle, end = template.other
    marked = F.concat(F.lit(start), escape(role), F.lit(middle))
    out = F.array(_segment(marked, False), _segment(escape(text), False), _segment(F.lit(end), False))
    for name, mark in template.roles.items():
        known = F.array(
            _segment(F.lit(mark.open), False), _segment(escape(text), mark.loss), _segment(F.lit(mark.close), False)
        )
        out = F.when(role == name, known).otherwise(out)
    return out


def _allowed(before: Column, role: Column, place: Column, template: Template) -> Column:
    """Whether the machine, in the state that the role before left, accepts ``role``."""
    out = F.lit(False)
    for name, mark in template.roles.items():
        out = F.when(before == name, role.isin(*mark.then)).otherwise(out)
    return F.when(place == 0, role.isin(*template.start)).otherwise(F.coalesce(out, F.lit(False)))

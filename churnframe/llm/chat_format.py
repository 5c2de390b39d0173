"""Operator 13, chat formatting: a finite-state machine over roles and a
declarative template that gives text segments with loss flags.

A ``Template`` states all there is to know: how a turn begins and ends, which
roles are trained on, and the machine (for each state, which roles may follow
and where the conversation may end).  A conversation becomes an array of
segments ``(text, loss)``; joined they are the formatted text.  Per turn there
are three: header, text, footer.  Only the text of trained roles has loss.

Control strings inside texts are broken up by a backslash *inside* them
(``</turn>`` becomes ``<\\/turn>``), and backslashes are doubled.  The footer
therefore never occurs in an escaped text, so that ``read_back`` is a plain
split with no look at what precedes, and unescaping is one rule: a backslash
gives way to the character behind it.

Columns and SQL functions only.  The turns of a conversation meet in one row,
as one training example is one row; they are collected map-side first, and no
conversation is collected with any other.

Defined results: null text formats as the empty text, a null role as the empty
role; turns are ordered by ``turn`` (nulls first), ties by role, then text, and
repeated rows are repeated turns; rows with a null ``conv_id`` form one
conversation; texts of any length are kept whole; unknown roles are written by
name, end the machine and have no loss; extra columns are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, FAILED = "", "!"


@dataclass(frozen=True)
class Template:
    """``names``: role -> name in its header; ``trained``: roles with loss;
    ``next_roles``: state -> roles that may follow (the state after a turn is
    its role, ``START`` before the first); ``final``: states that may end."""

    mark: str = "### "
    colon: str = ": "
    footer: str = "</turn>\n"
    other: str = "Role "
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    trained: tuple = ("assistant",)
    next_roles: dict = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)

    def controls(self) -> list[str]:
        """Strings that may not stand in a text as they are."""
        return [self.mark.strip(), self.footer.strip()]


CHAT = Template()


def _broken(c: Column, controls: list[str]) -> Column:
    """``c`` with doubled backslashes and a backslash inside each control
    string, overlapping ones included."""
    inside = "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in controls)
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), inside, r"$0\\")


def escape(c: Column, template: Template = CHAT) -> Column:
    return _broken(c, template.controls())


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _header(role: Column, t: Template) -> Column:
    named = F.create_map(*[F.lit(x) for kv in t.names.items() for x in kv])
    name = F.coalesce(F.try_element_at(named, role), F.concat(F.lit(t.other), _broken(role, t.controls() + [t.colon])))
    return F.concat(F.lit(t.mark), name, F.lit(t.colon))


def _run(roles: Column, t: Template) -> Column:
    """The machine over an array of roles: struct(state, steps taken)."""
    def step(acc: Column, role: Column) -> Column:
        ok = reduce(lambda a, b: a | b, [(acc["state"] == F.lit(s)) & role.isin(*follow) for s, follow in t.next_roles.items()])
        return F.struct(F.when(ok, role).otherwise(F.lit(FAILED)).alias("state"),
                        (acc["steps"] + F.when(ok, 1).otherwise(0)).alias("steps"))
    return F.aggregate(roles, F.struct(F.lit(START).alias("state"), F.lit(0).alias("steps")), step)


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 template: Template = CHAT) -> DataFrame:
    """One row per conversation: ``conv``, ``segments`` array<struct<text,
    loss>>, ``valid`` (the machine accepts the roles) and ``bad_turn``
    (position of the first turn it refuses, the number of turns if only the
    end is refused, null if valid)."""
    t = template
    rows = df.select(F.col(conv).alias("c"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # the footer lies in a segment of its own, so the joined text ends each turn by it
    one = lambda x: F.array(
        F.struct(_header(x["role"], t).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.trained).alias("loss")),
        F.struct(F.lit(t.footer).alias("text"), F.lit(False).alias("loss")))
    end = _run(F.transform("turns", lambda x: x["role"]), t)
    out = turns.select("c", F.flatten(F.transform("turns", one)).alias("segments"), end.alias("m"))
    valid = F.col("m.state").isin(*t.final)
    return out.select(F.col("c").alias(conv), "segments", valid.alias("valid"),
                      F.when(~valid, F.col("m.steps")).alias("bad_turn"))


def segment_rows(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``format_chats`` as rows: ``conv``, ``at``, ``text``, ``loss``."""
    return formatted.select(conv, F.posexplode("segments").alias("at", "s")).select(conv, "at", "s.text", "s.loss")


def joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """Turns of a formatted text: array<struct<role, text>>, unescaped."""
    t = template
    parts = F.split(formatted, re.escape(t.footer))
    parts = F.slice(parts, 1, F.size(parts) - 1)
    roles = F.create_map(*[F.lit(x) for k, v in t.names.items() for x in (v, k)])

    def turn(p: Column) -> Column:
        at = F.instr(p, t.colon)
        name = F.substring(p, F.lit(len(t.mark) + 1), at - F.lit(len(t.mark) + 1))
        plain = unescape(F.substring(name, F.lit(len(t.other) + 1), F.length(name)))
        return F.struct(F.coalesce(F.try_element_at(roles, name), plain).alias("role"),
                        unescape(F.substring(p, at + len(t.colon), F.length(p))).alias("text"))
    return F.transform(parts, turn)


def digest(formatted: DataFrame, conv: str = "conv_id", template: Template = CHAT) -> DataFrame:
    """Figures of ``format_chats``, read back from its segments."""
    text = formatted.select(conv, "valid", "bad_turn", joined(F.col("segments")).alias("f"),
                            loss_text(F.col("segments")).alias("l"))
    back = text.select(conv, "valid", "bad_turn", "f", "l", read_back(F.col("f"), template).alias("turns"))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(conv, F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("l").cast("long").alias("loss_chars"), F.sha2(F.col("l"), 256).alias("loss_sha256"),
                       F.length("f").cast("long").alias("formatted_chars"), "valid", F.col("bad_turn").cast("long").alias("bad_turn"))

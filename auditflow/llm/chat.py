"""Conversations checked by a state machine over roles and written out by a declarative template.

DataFrame operations only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are marked, which of them are learned from, and which role may follow which.

    ``roles`` gives the opening and closing mark of a role, ``other`` the three marks of
    any other role, whose name stands between the first two.  Marks that occur inside a
    text are escaped by replacing their first character with a backslash and a letter,
    and a backslash itself likewise.  ``after`` is the machine: the roles that may
    follow a state, where a state is the last role, and ``start`` the empty one.
    """

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "</s>")
    learned: tuple[str, ...] = ("assistant",)
    after: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    codes: dict[str, str] = field(default_factory=lambda: {"[": "s", "<": "l", "\\": "b"})

    def __post_init__(self):
        for mark in self.marks:
            if mark[0] not in self.codes or mark[0] == "\\" or set(mark[1:]) & set(self.codes):
                raise ValueError(f"{mark!r} must begin with a character that has a code and hold no other such character")

    @property
    def marks(self) -> list[str]:
        """Every control string once."""
        return list(dict.fromkeys([m for pair in self.roles.values() for m in pair] + list(self.other)))

    def escape(self, text: Column) -> Column:
        plain = F.replace(text, F.lit("\\"), F.lit("\\" + self.codes["\\"]))
        return reduce(lambda t, m: F.replace(t, F.lit(m), F.lit("\\" + self.codes[m[0]] + m[1:])), self.marks, plain)

    def unescape(self, text: Column) -> Column:
        """Every backslash of an escaped text starts a code, and the backslash's own code comes last."""
        ordered = sorted(self.codes.items(), key=lambda c: c[0] == "\\")
        return reduce(lambda t, c: F.replace(t, F.lit("\\" + c[1]), F.lit(c[0])), ordered, text)

    def segments(self, role: Column, text: Column) -> Column:
        """Three segments of a turn: mark, text, mark; only the text of a learned role carries loss."""
        def three(opening: Column, closing: str, loss: bool) -> Column:
            parts = ((opening, False), (self.escape(text), loss), (F.lit(f" {closing}\n"), False))
            return F.array(*[F.struct(t.alias("text"), F.lit(flag).alias("loss")) for t, flag in parts])

        begin, end, close = self.other
        out = three(F.concat(F.lit(f"{begin} "), self.escape(F.coalesce(role, F.lit(""))), F.lit(f" {end} ")), close, False)
        for name, (opening, closing) in self.roles.items():
            out = F.when(role == name, three(F.lit(f"{opening} "), closing, name in self.learned)).otherwise(out)
        return out

    def parse(self, formatted: Column) -> Column:
        """The turns ``(role, text)`` of a formatted conversation; a null role reads back as empty."""
        q = re.escape
        begin, end, close = self.other
        shapes = [f"{q(o)} .*? {q(c)}\n" for o, c in self.roles.values()] + [f"{q(begin)} .*? {q(end)} .*? {q(close)}\n"]
        turns = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(shapes)), F.lit(0))

        def inner(turn: Column, opening: str, closing: str) -> Column:
            return F.substring(turn, F.lit(len(opening) + 2), F.length(turn) - (len(opening) + len(closing) + 3))

        def read(turn: Column) -> Column:
            body = inner(turn, begin, close)
            mark = F.lit(f" {end} ")
            name = F.substring_index(body, f" {end} ", 1)
            text = F.substring(body, F.length(name) + F.length(mark) + 1, F.length(body))
            out = F.struct(self.unescape(name).alias("role"), self.unescape(text).alias("text"))
            for role, (opening, closing) in self.roles.items():
                own = F.struct(F.lit(role).alias("role"), self.unescape(inner(turn, opening, closing)).alias("text"))
                out = F.when(turn.startswith(f"{opening} "), own).otherwise(out)
            return out

        return F.transform(turns, read)


TEMPLATE = Template()


def first_fault(roles: Column, template: Template = TEMPLATE) -> Column:
    """Place, from 0, of the first turn that may not follow the one before it; null if there is none.

    The machine goes on from the role it saw, so the array is walked once.
    """
    states = {state: "^" if state == "start" else f":{state}" for state in template.after}
    allowed = F.array(*[F.lit(f"{states[state]}>{role}") for state, follow in template.after.items() for role in follow])
    begin = F.struct(F.lit("^").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(seen: Column, role: Column) -> Column:
        fits = F.coalesce(F.array_contains(allowed, F.concat(seen["state"], F.lit(">"), role)), F.lit(False))
        bad = F.when(seen["bad"].isNotNull(), seen["bad"]).when(~fits, seen["at"])
        return F.struct(F.concat(F.lit(":"), F.coalesce(role, F.lit(""))).alias("state"), (seen["at"] + 1).alias("at"), bad.alias("bad"))

    return F.aggregate(roles, begin, step, lambda seen: seen["bad"])


def format_chats(turns: DataFrame, template: Template = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, first_fault, complete``.

    ``segments`` are ``(text, loss)`` in order and ``formatted`` their chain.  Turns of
    equal number are ordered by role and text, a null number comes first, a null text is
    empty, a null role is the role of no name; rows of a null conversation are one
    conversation, repeated rows are repeated turns.  A conversation that breaks the
    order of turns is formatted like any other and names its first fault; ``complete``
    says that it ends with a learned turn.  A conversation is one value of the output,
    so its turns meet in one row; other columns of the input are not read.
    """
    said = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: template.segments(t["role"], t["text"])))
    last = F.element_at("turns", -1)["role"]
    out = grouped.select("conv_id", "turns", segments.alias("segments"))
    return out.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        first_fault(F.transform("turns", lambda t: t["role"]), template).alias("first_fault"),
        F.coalesce(last.isin(*template.learned), F.lit(False)).alias("complete"))


def digests(chats: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What reading the formatted conversations back gives: turns and learned text, as counts and digests."""
    read = chats.select("conv_id", "formatted", "first_fault", "complete", template.parse(F.col("formatted")).alias("said"),
                        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "").alias("learned"))
    lines = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("said").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.col("first_fault").isNull().alias("in_order"), "complete")


def _sql_escape(text: str, template: Template = TEMPLATE) -> str:
    out = f"replace({text}, '\\', '\\b')"
    for mark in template.marks:
        out = f"replace({out}, '{mark}', '\\{template.codes[mark[0]]}{mark[1:]}')"
    return out


ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER t AS n, lag(role) OVER t AS before, row_number() OVER t = count(*) OVER (PARTITION BY conv_id) AS is_last
      FROM c WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)),
f AS (SELECT *, length({_sql_escape('text')}) + CASE role WHEN 'system' THEN 6 + 8 WHEN 'user' THEN 7 + 9 WHEN 'assistant' THEN 6 + 6
             ELSE 7 + length({_sql_escape("coalesce(role, '')")}) + 9 + 6 END AS size,
             CASE WHEN coalesce((n = 1 AND role IN ('system', 'user')) OR (n > 1 AND (before || '>' || role) IN
               ('system>user', 'user>assistant', 'assistant>user')), false) THEN NULL ELSE n - 1 END AS fault FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars, min(fault) IS NULL AS in_order,
       bool_or(is_last AND coalesce(role = 'assistant', false)) AS complete
FROM f GROUP BY conv_id"""

"""Conversations as training text: a role state machine, a template, loss flags per segment.

A template is a declaration: a tag per role, the roles whose text counts for the loss, and the
moves of the state machine. Each turn becomes three segments, ``<s>[TAG] ``, the text, and
`` [/TAG]</s>``; only the text of a loss role is under the loss mask. A control string inside a
text gets a backslash after its first character (and one more if it has some there already), so
no text can close a turn and the way back is exact.

Column functions only. Turns are ordered by (turn, role, text), nulls first; repeated rows are
turns of their own. A null text is empty, a null role is the empty role; roles the template does
not name get the tag ROLE with their name in it. A conversation that breaks the order of roles is
formatted all the same and says where. An empty table gives no row. Only ``conv_id``, ``turn``,
``role`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OTHER = "ROLE"


@dataclass(frozen=True)
class Template:
    """Tags by role, roles under the loss, and (state, role) moves; a state is left by no other."""

    tags: dict[str, str] = field(default_factory=lambda: {
        "system": "SYS", "user": "INST", "assistant": "ANS"})
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked"})

    def control(self) -> list[str]:
        """Every string that means something to a reader of the output."""
        tags = [*self.tags.values(), _OTHER]
        return ["<s>", "</s>", f"[{_OTHER}=", *(f"[{t}]" for t in tags), *(f"[/{t}]" for t in tags)]

    def _pattern(self, slashes: str) -> str:
        tails = "|".join(re.escape(c[1:]) for c in self.control())
        return rf"([<\[]){slashes}({tails})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"(\\*)"), r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\(\\*)"), "$1$2$3")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, segments (text, loss), valid, first_bad_turn (position from 0, or null).

    One shuffle brings the turns of a conversation together; texts are escaped once they are in order.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tags = F.create_map(*(F.lit(x) for pair in template.tags.items() for x in pair))
    known = role.isin(*template.tags)
    opened = F.when(known, tags[role]).otherwise(
        F.concat(F.lit(f"{_OTHER}="), F.url_encode(role)))
    closed = F.when(known, tags[role]).otherwise(F.lit(_OTHER))
    turns = rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.concat(F.lit("<s>["), opened, F.lit("] ")).alias("open"),
        F.concat(F.lit(" [/"), closed, F.lit("]</s>")).alias("close"))
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "role", "text", "open", "close"))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        _segment(t["open"], F.lit(False)),
        _segment(template.escape(t["text"]), t["role"].isin(*template.loss_roles)),
        _segment(t["close"], F.lit(False)))))
    moves = F.create_map(*(F.lit(x) for (state, name), to in template.moves.items()
                           for x in (f"{state}|{name}", to)))

    def step(state: Column, turn: Column) -> Column:
        to = F.element_at(moves, F.concat(state["name"], F.lit("|"), turn["role"]))
        stopped = state["bad"].isNotNull()
        return F.struct(
            F.when(stopped | to.isNull(), state["name"]).otherwise(to).alias("name"),
            F.when(stopped, state["bad"]).when(to.isNull(), state["at"]).alias("bad"),
            (state["at"] + 1).alias("at"))

    start = F.struct(F.lit("start").alias("name"), F.lit(None).cast("long").alias("bad"),
                     F.lit(0).cast("long").alias("at"))
    bad = F.aggregate("turns", start, step)["bad"]
    return gathered.select("conv_id", segments.alias("segments"), bad.isNull().alias("valid"),
                           bad.alias("first_bad_turn"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, parsed from the segments alone."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    tags = "|".join(template.tags.values())
    pattern = rf"(?s)<s>\[({tags}|{_OTHER}=[^\]]*)\] (.*?) \[/(?:{tags}|{_OTHER})\]</s>"
    roles = F.create_map(*(F.lit(x) for role, tag in template.tags.items() for x in (tag, role)))

    def role_of(tag: Column) -> Column:
        return F.when(tag.startswith(f"{_OTHER}="), F.url_decode(F.substr(
            tag, F.lit(len(_OTHER) + 2)))).otherwise(roles[tag])

    parsed = formatted.select("conv_id", "segments", "valid", "first_bad_turn",
                              whole.alias("formatted"))
    found = F.arrays_zip(
        F.regexp_extract_all("formatted", F.lit(pattern), F.lit(1)).alias("tag"),
        F.regexp_extract_all("formatted", F.lit(pattern), F.lit(2)).alias("body"))
    turns = F.transform(found, lambda t: F.struct(
        role_of(t["tag"]).alias("role"), template.unescape(t["body"]).alias("text")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: template.unescape(s["text"])), "")
    return parsed.select("conv_id", "formatted", "valid", "first_bad_turn", turns.alias("turns"),
                         loss.alias("loss_text"))

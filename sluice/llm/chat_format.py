"""Chat formatting: a state machine over roles checks the order of turns, and a template turns them into text segments.

All of it is Spark expressions. A conversation is the rows of one conv_id by turn; its segments carry a loss flag each, so
that a trainer masks everything but what the assistant says.

Defined cases: a null text or role is the empty string; rows with the same turn are ordered by role and text, repeated rows
included; a null conv_id is a conversation of its own; an empty table gives no rows; extra columns are not read. A
conversation whose order of roles the machine does not accept is formatted all the same, with valid false.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: State after a role in a state. What is not listed leads to "invalid", which no role leaves.
TURN_ORDER = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
}


@dataclass(frozen=True)
class Template:
    """A turn is open + role + mid + text + close. Text under roles in loss_roles is what the loss covers.

    Control strings inside roles and texts are escaped: "&" becomes "&amp;", and the first character of a control string
    its entity, so that a formatted text has a control string only where the template put one."""

    open: str = "<s>[INST] "
    mid: str = " [/INST]"
    close: str = "</s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    entities: dict[str, str] = field(default_factory=lambda: {"<": "&lt;", "[": "&lsqb;"})

    def escape(self, c: Column) -> Column:
        c = F.replace(c, F.lit("&"), F.lit("&amp;"))
        for x in self.control:
            c = F.replace(c, F.lit(x), F.lit(self.entities[x[0]] + x[1:]))
        return c

    def unescape(self, c: Column) -> Column:
        for x in self.control:
            c = F.replace(c, F.lit(self.entities[x[0]] + x[1:]), F.lit(x))
        return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _machine(turns: Column, order: dict[tuple[str, str], str]) -> Column:
    """The state after all turns."""

    def step(state: Column, turn: Column) -> Column:
        out = F.when(F.lit(False), F.lit("invalid"))
        for (at, role), to in order.items():
            out = out.when((state == at) & (turn["role"] == role), F.lit(to))
        return out.otherwise(F.lit("invalid"))

    return F.aggregate(turns, F.lit("start"), step)


def format_chats(df: DataFrame, template: Template = Template(), order: dict[tuple[str, str], str] = TURN_ORDER) -> DataFrame:  # noqa: B008
    """(conv_id, valid, segments array<struct<text, loss>>, formatted): one row per conversation.

    One shuffle by conv_id; a conversation's turns are sorted inside its row."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct("turn", empty("role").alias("role"), empty("text").alias("text"))
    chats = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = lambda t: F.array(
        F.struct(F.concat(F.lit(template.open), template.escape(t["role"]), F.lit(template.mid)).alias("text"), F.lit(False).alias("loss")),
        F.struct(template.escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
        F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
    )
    out = chats.select("conv_id", (_machine(F.col("turns"), order) == "assistant").alias("valid"), F.flatten(F.transform("turns", parts)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse_chats(formatted: Column, template: Template = Template()) -> Column:  # noqa: B008
    """array<struct<role, text>>: what format_chats() was given, read back from its text."""
    turns = F.filter(F.split(formatted, template.close), lambda x: F.length(x) > 0)

    def read(x: Column) -> Column:
        at = F.locate(template.mid.strip(), x)
        role = F.substring(x, len(template.open) + 1, at - F.lit(len(template.open) + 2))
        text = F.substring(x, at + F.lit(len(template.mid.strip())), F.length(x))
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    return F.transform(turns, read)


def loss_text(segments: Column, template: Template = Template()) -> Column:  # noqa: B008
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")

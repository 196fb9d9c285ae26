"""Operator 7: chat formatting by a declarative template.

A template names the strings around a turn, the roles whose text is learned
and the moves a role state machine allows.  A conversation becomes a list of
segments ``(text, loss)``; joined, they are its formatted text.  Control
strings inside texts get one backslash between ``<`` and ``|`` (and so do
texts that already hold backslashes there), which is undone when reading.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Every control string starts with ``<|``."""
    start: str = "<|im_start|>"
    line: str = "<|nl|>"            # a line break inside a role
    end: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("begin", "system"): "system", ("begin", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    accept: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def format_chats(turns: DataFrame, template: Template = CHATML, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, segments array<struct<text, loss>>,
    formatted, state`` (where the role machine ends; 'error' once a move isn't
    allowed) and ``valid`` (it ends in an accepting state).

    Turns go by number, nulls first; turns with equal numbers by role, then
    text; repeated rows are turns of their own.  A null role or text is empty,
    and rows with a null id are one conversation.  Invalid conversations are
    formatted like valid ones.  Other columns are ignored; an empty table
    gives no rows."""
    t = template
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                   F.coalesce(text_col, F.lit("")).alias("text"))
    chats = turns.groupBy(F.col(id_col).alias("conv")).agg(F.sort_array(F.collect_list(one)).alias("turns"))

    def segments(x: Column) -> Column:
        head = F.concat(F.lit(t.start), F.replace(escape(x["role"]), F.lit("\n"), F.lit(t.line)), F.lit("\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(x["text"]).alias("text"), x["role"].isin(*t.learned).alias("loss")),
                       F.struct(F.lit(t.end).alias("text"), F.lit(False).alias("loss")))

    state: Column = F.lit("error")
    def move(at: Column, x: Column) -> Column:
        out = state
        for (a, role), b in t.moves.items():
            out = F.when((at == a) & (x["role"] == role), b).otherwise(out)
        return out

    chats = chats.select("conv", F.flatten(F.transform("turns", segments)).alias("segments"),
                         F.aggregate("turns", F.lit(t.begin), move).alias("state"))
    return chats.select(F.col("conv").alias(id_col), "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        "state", F.col("state").isin(*t.accept).alias("valid"))


def parse_turns(formatted: Column, template: Template = CHATML) -> Column:
    """``array<struct<role, text>>`` read back from a formatted text."""
    t = template

    def turn(chunk: Column) -> Column:
        head = F.substring_index(chunk, "\n", 1)
        role = unescape(F.replace(F.substring(head, len(t.start) + 1, F.char_length(head)), F.lit(t.line), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substring(chunk, F.char_length(head) + 2, F.char_length(chunk))).alias("text"))

    chunks = F.split(formatted, "\\Q" + t.end + "\\E", -1)
    return F.transform(F.slice(chunks, F.lit(1), F.size(chunks) - 1), turn)


def chat_digest(chats: DataFrame, template: Template = CHATML, id_col: str = "conv_id") -> DataFrame:
    """What ``format_chats`` wrote, read back: turns from the formatted text,
    learned text from the flagged segments."""
    back = chats.select(
        F.col(id_col), "formatted", "valid", parse_turns(F.col("formatted"), template).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("learned"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")

"""Chat formatting of conversations with a loss mask, by Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
become one block, whose texts stay apart by a mark. A formatted conversation is

    <|im_start|> role <|im_sep|> text [<|im_next|> text ...] <|im_end|>  (no spaces; repeated)

Control strings, also those of other common templates, are escaped inside roles and texts with
a backslash behind their first character, and backslashes are doubled; so a text can never
end its turn, and reading the output back gives the turns as they were.

Defined results: a null text, role or turn number counts as empty, empty and smallest. Rows
with equal turn numbers are ordered by role and text; repeated rows are turns of their own. Rows with
a null conv_id form one conversation. An empty table gives no conversations. Extra columns are ignored.
A conversation is one row of the result, so it has to fit into a row.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
# Of this template, and of others a text should not imitate.
CONTROL_STRINGS = [START, SEPARATOR, NEXT, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                   "<<SYS>>", "<</SYS>>"]
_CONTROL = "|".join(re.sub(r"([^A-Za-z0-9_/])", r"\\\1", c) for c in CONTROL_STRINGS)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"(?=(?:{_CONTROL}))(.)", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(conversations: DataFrame, trained_roles: tuple = ("assistant",)) -> DataFrame:
    """conv_id, formatted text, and loss_spans: (start, length) of each text to train on.

    Starts count code points from 0. One text is one span; the marks between texts are outside.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    turn = F.struct("turn", role.alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    collected = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(t, i):
        """What stands before a text, and the text: a new block, or the next text of the block."""
        first, same = i == 0, F.get("turns", i - 1)["role"] == t["role"]
        head = F.concat(F.lit(START), escaped(t["role"]), F.lit(SEPARATOR))
        before = F.when(first, head).when(same, F.lit(NEXT)).otherwise(F.concat(F.lit(END), head))
        return F.struct(before.alias("before"), escaped(t["text"]).alias("text"), t["role"].alias("role"))

    pieces = collected.select("conv_id", F.transform("turns", piece).alias("pieces"))

    def spans(state, p):
        start = state["at"] + F.char_length(p["before"])
        length = F.char_length(p["text"])
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length).alias("at"),
            F.when(p["role"].isin(*trained_roles), F.concat(state["spans"], span))
            .otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    text = F.concat(
        F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"])), ""), F.lit(END))
    return pieces.select(
        "conv_id", text.alias("formatted"),
        F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")), spans,
                    lambda state: state["spans"]).alias("loss_spans"))


def turns_of(text: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    def literal(control):
        return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", control)

    def block_turns(block):
        parts = F.split(block, literal(SEPARATOR), 2)
        return F.transform(F.array(parts), lambda p: F.transform(
            F.split(F.get(p, 1), literal(NEXT)),
            lambda t: F.struct(unescaped(F.replace(F.get(p, 0), F.lit(START), F.lit(""))).alias("role"),
                               unescaped(t).alias("text"))))

    blocks = F.filter(F.split(text, literal(END)), lambda b: b != "")
    return F.flatten(F.flatten(F.transform(blocks, block_turns)))


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")

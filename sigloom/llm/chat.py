"""Chat formatting as a relational plan: Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged into a block by array
functions; blocks become text by concatenation. A formatted conversation is

    <turn>role<text>first text<next>second text</turn><turn>...

`<next>` stands between the texts that were merged, so every turn can be read back. Where a role or text holds a control string, with any
number of backslashes behind its `<`, one backslash more is put there; reading back takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, TEXT, NEXT, END = "<turn>", "<text>", "<next>", "</turn>"
ASSISTANT = "assistant"
_CONTROL = r"(\\*)(turn>|text>|next>|/turn>)"


def escape(text: Column) -> Column:
    """The text without any control string."""
    return F.regexp_replace(text, "<" + _CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    """The inverse of `escape`."""
    return F.regexp_replace(text, r"<\\" + _CONTROL, "<$1$2")


def conversations(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): structs (turn, role, text) in order; null roles and texts are empty.

    Ties of one turn number go by role, then text; a null number comes first. Rows that repeat are turns of their own.
    """
    one = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def merged(sorted_turns: DataFrame) -> DataFrame:
    """Rows (conv_id, blocks): structs (role, texts), a block for each longest stretch of turns of one role."""
    last = F.size("turns") - 1
    role = lambda i: F.element_at("turns", i + 1)["role"]
    first = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (role(i) != F.coalesce(F.get("turns", i - 1)["role"], F.lit(""))))
    starts = sorted_turns.withColumn("starts", first)
    ends = starts.withColumn("ends", F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("turns"))))

    def block(start: Column, end: Column) -> Column:
        texts = F.transform(F.slice("turns", start + 1, end - start), lambda t: t["text"])
        return F.struct(role(start).alias("role"), texts.alias("texts"))

    return ends.select("conv_id", F.zip_with("starts", "ends", block).alias("blocks"))


def pieces(blocks: Column, learned: str) -> Column:
    """Structs (text, loss) whose texts make up the formatted conversation; loss marks the escaped texts of the learned role."""

    def of(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block(b: Column) -> Column:
        loss = b["role"] == F.lit(learned)
        head = of(F.concat(F.lit(BEGIN), escape(b["role"]), F.lit(TEXT)), F.lit(False))
        between = F.flatten(F.transform(b["texts"], lambda t: F.array(of(F.lit(NEXT), F.lit(False)), of(escape(t), loss))))
        inside = F.slice(between, F.lit(2), F.size(b["texts"]) * 2)
        return F.concat(F.array(head), inside, F.array(of(F.lit(END), F.lit(False))))

    return F.flatten(F.transform(blocks, block))


def format_turns(turns: DataFrame, learned: str = ASSISTANT) -> DataFrame:
    """Rows (conv_id, formatted, pieces), one for each conversation of turns (conv_id, turn, role, text).

    `pieces` has the formatted text in parts, each with its place under the loss mask: exactly the texts of the `learned` role. Rows without a
    conv_id are one conversation. An empty table has none. Other columns are ignored. A conversation is one row, as a training example is, so
    it has to fit into one; grouping is the only shuffle.
    """
    made = merged(conversations(turns.select("conv_id", "turn", "role", "text")))
    made = made.select("conv_id", pieces(F.col("blocks"), learned).alias("pieces"))
    return made.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces")


def read_turns(formatted: Column) -> Column:
    """Structs (role, text) of every turn, read back from a formatted conversation."""

    def block(b: Column) -> Column:
        parts = F.split(F.substr(b, F.lit(len(BEGIN) + 1)), TEXT, -1)
        role = unescape(F.element_at(parts, 1))
        return F.transform(F.split(F.element_at(parts, 2), NEXT, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, END, -1)
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), block))


def read_learned(made: Column) -> Column:
    """All text under the loss mask, read back from the pieces of a formatted conversation."""
    return F.array_join(F.transform(F.filter(made, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")

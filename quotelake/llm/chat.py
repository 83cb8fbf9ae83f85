"""Chat formatting with Spark expressions.

A conversation is ``<|start|>role<|text|>text<|part|>text<|end|>`` per block, a
block being adjacent turns of one role. Inside roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so no mark can come from a text and the
output can be read back to the turns it was made of. The output is a list of
segments, each with its part in the loss; their concatenation is the formatted
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, PART, END = "<|start|>", "<|text|>", "<|part|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _blocks(turns: Column) -> Column:
    """Sorted turns to (role, texts) per run of one role, linear in the turns."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    bounds = F.concat(starts, F.array(F.size(turns)))
    ranges = F.arrays_zip(starts.alias("a"), F.slice(bounds, 2, F.size(turns)).alias("b"))
    return F.transform(
        ranges,
        lambda r: F.struct(
            F.get(turns, r["a"])["role"].alias("role"),
            F.transform(F.slice(turns, r["a"] + 1, r["b"] - r["a"]), lambda t: t["text"]).alias(
                "texts"
            ),
        ),
    )


def _segments(blocks: Column, learned: str) -> Column:
    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(block):
        head = segment(
            F.concat(F.lit(START), escape(block["role"]), F.lit(TEXT)), F.lit(False)
        )
        texts = F.transform(
            block["texts"],
            lambda t, i: F.concat(
                F.when(i > 0, F.array(segment(F.lit(PART), F.lit(False)))).otherwise(
                    F.array().cast("array<struct<text:string,loss:boolean>>")
                ),
                F.array(segment(escape(t), block["role"] == learned)),
            ),
        )
        return F.concat(
            F.array(head), F.flatten(texts), F.array(segment(F.lit(END), F.lit(False)))
        )

    return F.flatten(F.transform(blocks, of_block))


def format_chats(conversations: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, segments, formatted.

    Turns are sorted by (turn, role, text), nulls first; a null role or text is
    empty; equal rows stay as many turns as there are rows; rows without conv_id
    form one conversation. Other columns are not read. An empty table gives no
    rows. A conversation is one output row, so its size is bounded by that.
    """
    turns = conversations.groupBy(F.col("conv_id")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    parts = blocks.select("conv_id", _segments(F.col("blocks"), learned).alias("segments"))
    return parts.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_turns(formatted: Column) -> Column:
    """The turns, array<struct<role, text>>, that a formatted conversation holds."""

    def marked(mark):
        return "\\Q" + mark + "\\E"

    blocks = F.filter(F.split(formatted, marked(END), -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            F.transform(
                blocks,
                lambda b: F.split(F.substr(b, F.lit(len(START) + 1)), marked(TEXT), -1),
            ),
            lambda halves: F.transform(
                F.split(F.get(halves, F.lit(1)), marked(PART), -1),
                lambda t: F.struct(
                    unescape(F.get(halves, F.lit(0))).alias("role"), unescape(t).alias("text")
                ),
            ),
        )
    )


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )

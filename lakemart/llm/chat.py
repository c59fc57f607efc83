"""Chat formatting: conversations as training text with a loss mask, by Spark expressions alone.

The turns of a conversation are collected as structs and sorted, neighbours of one role become one block, and blocks
are joined to segments of text, each inside or outside the loss:

    <|turn|>user<|says|>Hello<|more|>Are you there?<|end|>
    <|turn|>assistant<|says|>Yes.<|end|>

Texts and roles are escaped so that none of them can hold a control string: a backslash becomes two, and `<|` becomes
`<\\|`. `turns_of` and `loss_of` read turns and trained texts back from the output.

A conversation is one value of the output, so its own turns, and only these, meet in one task; like any string it can
have 2 GB at most. The work grows with its length alone: no array is appended to turn by turn.

Defined results: a null role or text becomes empty; rows of a null conv_id are one conversation; turns are ordered by
turn (null first), then role and text, and repeated rows stay as repeated turns; an empty table gives no rows; further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bind

# The control strings. All begin with "<|", which no escaped text contains.
TURN, SAYS, MORE, END = "<|turn|>", "<|says|>", "<|more|>", "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _blocks(turns: Column) -> Column:
    """Neighbouring turns of one role as one block: role, texts."""

    def merged(turns: Column, starts: Column) -> Column:
        def block(start: Column, k: Column) -> Column:
            n = F.coalesce(F.get(starts, k + 1), F.size(turns)) - start
            texts = F.transform(F.slice(turns, start + 1, n), lambda t: escaped(t["text"]))
            return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

        return F.transform(starts, block)

    def starts(turns: Column) -> Column:
        role = lambda i: F.get(turns, i)["role"]
        return F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))

    return bind(turns, lambda t: bind(starts(t), lambda s: merged(t, s)))


def _segments(blocks: Column, trained: Sequence[str]) -> Column:
    """The blocks as text in order, cut wherever the loss begins or ends."""

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(block: Column) -> Column:
        loss, off = block["role"].isin(list(trained)), F.lit(False)
        head = segment(F.concat(F.lit(TURN), escaped(block["role"]), F.lit(SAYS)), off)
        said = F.transform(
            block["texts"],
            lambda text, i: F.when(i == 0, F.array(segment(text, loss))).otherwise(
                F.array(segment(F.lit(MORE), off), segment(text, loss))
            ),
        )
        return F.concat(F.array(head), F.flatten(said), F.array(segment(F.lit(END), off)))

    return F.flatten(F.transform(blocks, of_block))


def format_conversations(turns: DataFrame, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row for each conversation: conv_id, n_blocks, segments (text, loss).

    `turns` has conv_id, turn, role, text. The formatted text is the segments' text joined (`text_of`); the loss mask is
    theirs too: segments with `loss` hold the text of a turn of a `trained` role and nothing else.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("turns"))
    blocks = grouped.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    return blocks.select("conv_id", F.size("blocks").alias("n_blocks"), _segments(F.col("blocks"), trained).alias("segments"))


def text_of(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_of(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"])), "")


def turns_of(text: Column) -> Column:
    """The turns (role, text) that a formatted text holds, read from its control strings alone."""

    def turns(block: Column) -> Column:
        parts = F.split(block, r"<\|says\|>")

        def said(parts: Column) -> Column:
            body = F.substring(parts[1], F.lit(1), F.length(parts[1]) - len(END))
            role = unescaped(parts[0])
            return F.transform(
                F.split(body, r"<\|more\|>"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))
            )

        return bind(parts, said)

    blocks = F.split(text, r"<\|turn\|>")
    return F.flatten(F.transform(bind(blocks, lambda b: F.slice(b, F.lit(2), F.size(b))), turns))

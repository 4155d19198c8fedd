"""Chat formatting with relational operations only.

The turns of a conversation are collected as structs and sorted by turn, then role and
text. Adjacent turns of one role become one block, and the blocks are concatenated:

    ### user:
    text<part/>text</turn>

Backslash, ``<`` and ``#`` inside texts and roles are replaced (``\\b``, ``\\l``, ``\\h``; in
roles also ``:`` by ``\\c``), so that marks occur only where the template puts them: the turns
can be read back exactly, whatever they say. The loss mask covers the assistant's texts.

Null texts and roles count as empty, a null conversation id is one conversation, null turns
come first, and repeated rows are repeated turns. A conversation is one row of the result
and so must fit into one (2 GB), and takes time in proportion to its turns; conversations do not share a task's memory beyond that.
An empty table gives an empty table. Other columns of the input are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, HEAD_END, PART, END = "### ", ":\n", "<part/>", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]


def escape(text: Column, escapes: list[tuple[str, str]] = ESCAPES) -> Column:
    for char, code in escapes:
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    # The backslash comes last: undone earlier, it could make up another code.
    for char, code in reversed(ROLE_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def collect_turns(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id`` and its sorted ``turns``."""
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return df.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))


def merged_blocks(turns: Column) -> Column:
    """Adjacent turns of one role as one struct of ``role`` and ``parts``."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    blocks = F.zip_with(
        starts,
        F.concat(F.slice(starts, 2, F.size(turns)), F.array(F.size(turns))),
        lambda start, end: F.struct(
            F.get(turns, start)["role"].alias("role"),
            F.transform(F.slice(turns, start + 1, end - start), lambda t: t["text"]).alias("parts"),
        ),
    )
    return blocks


def pieces(blocks: Column, learn: str) -> Column:
    """What the formatted text is made of, in order, each with whether it is to be learnt."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def block(b: Column) -> Column:
        no, yes = F.lit(False), b["role"] == learn
        parts = F.transform(
            b["parts"],
            lambda p, i: F.array(
                piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), no),
                piece(escape(p), yes),
            ),
        )
        head = piece(F.concat(F.lit(HEAD), escape(b["role"], ROLE_ESCAPES), F.lit(HEAD_END)), no)
        return F.concat(F.array(head), F.flatten(parts), F.array(piece(F.lit(END), no)))

    return F.flatten(F.transform(blocks, block))


def format_chats(df: DataFrame, learn: str = "assistant", **columns) -> DataFrame:
    """One row per conversation: ``conv_id``, the ``formatted`` text and its ``loss_spans``.

    A span is start (from 0) and length, in code points, of a piece to be learnt. The pieces are
    numbered rows for as long as their lengths are added up, which takes time in proportion to their
    number; rows of a conversation are together already and are not shuffled again.
    """
    blocks = collect_turns(df, **columns).select("conv_id", merged_blocks(F.col("turns")).alias("blocks"))
    parts = blocks.select("conv_id", F.posexplode(pieces(F.col("blocks"), learn)).alias("at", "piece"))
    length = F.length("piece.text").cast("long")
    before = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(before), F.lit(0).cast("long"))
    placed = parts.select("conv_id", F.struct("at", "piece.text", "piece.loss", start.alias("start"), length.alias("length")).alias("piece"))
    pieced = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    learnt = F.transform(
        F.filter("pieces", lambda p: p["loss"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))
    )
    return pieced.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        learnt.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made of."""

    def block(b: Column) -> Column:
        head = F.substring_index(b, HEAD_END, 1)
        role = unescape(F.substring(head, len(HEAD) + 1, F.length(head)))
        rest = F.substring(b, F.length(head) + len(HEAD_END) + 1, F.length(b))
        return F.transform(
            F.split(rest, PART), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(F.filter(F.split(formatted, END), lambda b: b != ""), block))


def read_loss(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, as they were before formatting."""
    return F.transform(
        loss_spans,
        lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))),
    )

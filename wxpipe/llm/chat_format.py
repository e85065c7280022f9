r"""Conversations as one training text each, and back.

Turns of a conversation are collected, sorted and merged into blocks of one role; a block is
``<turn:ROLE>part<next>part</turn>`` and a line end. Inside roles and texts ``\`` becomes
``\b``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``, so no text can hold a control string and
every text comes back as it was. The loss mask is a list of (start, length) runs of code points:
the texts of the learned roles, one run per turn, without markup.

Spark expressions only. The shuffle is by conversation, whose text is one output value and so
must fit in a task; turns are merged, and the places of the loss mask found, in linear time.

Defined cases: null texts and roles are empty; rows without conversation id form one
conversation; rows without turn number come first; equal turn numbers are ordered by role, then
text; repeated rows are repeated turns; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, let, text_of

OPEN, CLOSE_NAME, NEXT, CLOSE = "<turn:", ">", "<next>", "</turn>\n"
#: Order matters when reading back: the escape character itself comes last.
_ESCAPES = ((">", "\\g"), ("<", "\\l"), ("\\", "\\b"))


def escape(text: Column) -> Column:
    for plain, escaped in reversed(_ESCAPES):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def _merge(turns: Column) -> Column:
    """Sorted turns as blocks: adjacent turns of one role share a block, as its parts."""

    def blocks(starts: Column) -> Column:
        def block(start: Column, n: Column) -> Column:
            size = F.coalesce(F.get(starts, n + 1), F.size(turns)) - start
            return F.struct(
                turns[start]["role"].alias("role"),
                F.transform(F.slice(turns, start + 1, size), lambda t: t["text"]).alias("parts"),
            )

        return F.transform(starts, block)

    first = F.sequence(F.lit(0), F.size(turns) - 1)
    changes = lambda i: (i == 0) | (turns[i]["role"] != F.get(turns, i - 1)["role"])
    return let(F.filter(first, changes), blocks)


def _text(blocks: Column) -> Column:
    def one(block: Column) -> Column:
        body = F.array_join(block["parts"], NEXT)
        return F.concat(F.lit(OPEN), block["role"], F.lit(CLOSE_NAME), body, F.lit(CLOSE))

    return F.array_join(F.transform(blocks, one), "")


def _starts(turns: DataFrame, conversation: str) -> DataFrame:
    """Turns with ``start``: the code point at which their text will begin.

    A running sum in the order in which turns are collected, so it is linear in the turns; the
    collecting that follows needs no other shuffle.
    """
    order = Window.partitionBy(conversation).orderBy("turn", "role", "text")
    before = F.lag("role").over(order)
    head = F.length("role") + len(OPEN) + len(CLOSE_NAME)
    # What stands between the text before, if any, and this one.
    between = (
        F.when(before.isNull(), head)
        .when(before == F.col("role"), F.lit(len(NEXT)))
        .otherwise(head + len(CLOSE))
    )
    so_far = F.sum(F.col("between") + F.length("text")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return turns.withColumn("between", between).select(
        conversation, "turn", "role", "text", (so_far - F.length("text")).cast("int").alias("start")
    )


def _mask(turns: Column, learned: Collection[str]) -> Column:
    """The places of the learned roles' texts."""
    mine = F.filter(turns, lambda t: unescape(t["role"]).isin(*learned))
    return F.transform(
        mine, lambda t: F.struct(t["start"].alias("start"), F.length(t["text"]).alias("length"))
    )


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: Collection[str] = ("assistant",),
) -> DataFrame:
    """One row per conversation: its id, formatted, n_blocks and loss_spans."""
    rows = turns.select(
        F.col(f"`{conversation}`").alias(conversation),
        F.col(f"`{turn}`").alias("turn"),
        escape(text_of(role)).alias("role"),
        escape(text_of(text)).alias("text"),
    )
    own = fresh(["turn", "role", "text", "start", "between"], conversation)
    placed = _starts(rows.toDF(own, "turn", "role", "text"), own)
    collected = placed.groupBy(own).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "start"))).alias("turns")
    )
    blocks = collected.select(own, "turns", _merge(F.col("turns")).alias("blocks"))
    return blocks.select(
        F.col(own).alias(conversation),
        _text(F.col("blocks")).alias("formatted"),
        F.size("blocks").alias("n_blocks"),
        _mask(F.col("turns"), learned).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""

    def block(body: Column) -> Column:
        name = F.regexp_extract(body, f"^{OPEN}([^{CLOSE_NAME}]*){CLOSE_NAME}", 1)
        rest = F.substr(body, F.length(name) + len(OPEN) + len(CLOSE_NAME) + 1)
        return F.transform(
            F.split(rest, NEXT, -1),
            lambda part: F.struct(unescape(name).alias("role"), unescape(part).alias("text")),
        )

    bodies = F.filter(F.split(formatted, CLOSE, -1), lambda body: body != "")
    return F.flatten(F.transform(bodies, block))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    cut = lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))
    return F.transform(spans, cut)

"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; runs of turns of one role
are merged into one block; blocks are concatenated:

    <|im_start|>role
    first text<|im_sep|>second text<|im_end|>

A backslash is put into every ``<|`` of a text or role, ``<\\|``, and one more where there are
some (``<\\|`` becomes ``<\\\\|``), so no text can hold a control string, and taking one away
gives the text back.  The loss mask is a list of spans (start, length) in code points of the
formatted text, one for the text of each assistant turn.

Turns are ordered by turn number, then role, then text, nulls first; ties are rows that equal
each other, and all stay.  A null role or text counts as empty.  Line breaks of a role are
written as ``<|br|>``.  Rows without a conversation id form one conversation.  A conversation
is one row of the result, so its turns come together in one task; nothing else is gathered.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# The control strings of the template.
START, SEP, END, BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|br|>"
ASSISTANT = "assistant"
#: Lengths summed together when starts are found.
BLOCK = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(BREAK))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(BREAK), F.lit("\n")))


def starts(lengths: Column) -> Column:
    """Sum of the lengths before each: blocks are summed first, so long lists stay cheap."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    numbers = lambda n: F.filter(F.sequence(F.lit(0), n), lambda i: i < n)
    sums = F.transform(
        numbers(F.ceil(F.size(lengths) / BLOCK).cast("int")), lambda b: total(F.slice(lengths, b * BLOCK + 1, BLOCK))
    )
    before = lambda sums: F.transform(numbers(F.size(sums)), lambda b: total(F.slice(sums, F.lit(1), b)))
    inner = lambda befores: F.transform(
        lengths,
        lambda _, i: F.get(befores, (i / BLOCK).cast("int"))
        + total(F.slice(lengths, (i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
    )
    return let(sums, lambda s: let(before(s), inner))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` of each conversation."""
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(turns: Column) -> Column:
        """Opening, text and closing of each turn; merged turns share opening and closing."""

        def piece(t: Column, i: Column) -> Column:
            first = (i == 0) | (F.get(turns, i - 1)["role"] != t["role"])
            last = (i == F.size(turns) - 1) | (F.get(turns, i + 1)["role"] != t["role"])
            return F.struct(
                F.when(first, F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"))).otherwise(SEP).alias("opening"),
                escaped(t["text"]).alias("text"),
                F.when(last, F.lit(END + "\n")).otherwise("").alias("closing"),
                (t["role"] == ASSISTANT).alias("loss"),
            )

        return F.transform(turns, piece)

    def whole(made: Column) -> Column:
        lengths = F.transform(
            made, lambda p: (F.length(p["opening"]) + F.length(p["text"]) + F.length(p["closing"])).cast("long")
        )
        spans = let(lengths, starts)
        spans = F.transform(
            F.filter(F.arrays_zip(made.alias("p"), spans.alias("s")), lambda z: z["p"]["loss"]),
            lambda z: F.struct(
                (z["s"] + F.length(z["p"]["opening"])).alias("start"),
                F.length(z["p"]["text"]).cast("long").alias("length"),
            ),
        )
        text = F.array_join(F.transform(made, lambda p: F.concat(p["opening"], p["text"], p["closing"])), "")
        return F.struct(text.alias("formatted"), spans.alias("loss_spans"))

    built = chats.select("conv_id", let(F.col("turns"), lambda t: let(pieces(t), whole)).alias("w"))
    return built.select("conv_id", "w.formatted", "w.loss_spans")


def turns_of(formatted: Column) -> Column:
    """The turns read back from a formatted conversation: structs of role and text."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda _, i: i > 0)

    def turns(block: Column) -> Column:
        cut = F.instr(block, "\n")
        role = unescaped_role(F.substring(block, F.lit(1), cut - 1))
        body = F.substring(block, cut + 1, F.length(block) - cut - len(END) - 1)
        texts = F.split(body, r"<\|im_sep\|>")
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def text_under(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, nothing between the spans."""
    part = lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, part), "")


def read_back(chats: DataFrame) -> DataFrame:
    """Facts about each conversation from its formatted text and loss mask alone."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = chats.select(
        "conv_id", "formatted", turns_of(F.col("formatted")).alias("turns"), text_under(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted by turn, and adjacent turns of
one role are merged into one block by an array aggregation; the blocks are concatenated.

Template: ``<s>`` then per block ``[INST:role]`` part (``[+]`` part)* ``[/INST]``; an
assistant's block ends with ``</s>`` instead. Every ``\\``, ``<``, ``[`` and ``]`` inside a
role or a text is written with a ``\\`` before it, so no text can hold a mark, and ``\\x`` always
reads back as ``x``. A merged block keeps its parts apart with ``[+]``, so each turn can be
read back. The loss mask covers the assistants' parts alone.

Cases: a null text or role counts as empty; a null conv_id is a conversation; turns of equal
number go by role and text; repeated rows are repeated turns; a conversation is one value
of the result by definition, so its turns meet in one row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE_ROLE, PART, CLOSE, END = "<s>", "[INST:", "]", "[+]", "[/INST]", "</s>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[\]])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def blocks(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, blocks): per conversation the merged blocks (role, parts), in order."""
    empty = F.lit("")
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # a run starts where the role differs from the turn before; a slice of the turns is a block
    at = F.sequence(F.lit(0), F.size("turns") - 1)
    role_at = lambda i: F.get("turns", i)["role"]
    starts = F.filter(at, lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    # each of the ends is the next start, and the number of turns for the last
    spans = F.zip_with("starts", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns"))),
                       lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    merged = F.transform(spans, lambda s: F.struct(
        role_at(s["a"]).alias("role"),
        F.transform(F.slice("turns", s["a"] + 1, s["n"]), lambda t: t["text"]).alias("parts")))
    return sorted_turns.withColumn("starts", starts).select("conv_id", merged.alias("blocks"))


def segments(merged: DataFrame) -> DataFrame:
    """(conv_id, segments): the formatted text as consecutive pieces (text, train); the loss
    mask covers the pieces with ``train``."""
    def piece(text: Column, train: Column | bool = False) -> Column:
        return F.struct(text.alias("text"), (F.lit(train) if isinstance(train, bool) else train).alias("train"))

    def block(b: Column) -> Column:
        trained = F.coalesce(b["role"] == TRAINED_ROLE, F.lit(False))
        head = F.array(piece(F.concat(F.lit(OPEN), escape(b["role"]), F.lit(CLOSE_ROLE))))
        parts = F.flatten(F.transform(b["parts"], lambda p, k: F.when(
            k == 0, F.array(piece(escape(p), trained))).otherwise(
            F.array(piece(F.lit(PART)), piece(escape(p), trained)))))
        tail = F.array(piece(F.when(trained, F.lit(END)).otherwise(F.lit(CLOSE))))
        return F.concat(head, parts, tail)
    return merged.select("conv_id", F.concat(
        F.array(piece(F.lit(BEGIN))), F.flatten(F.transform("blocks", block))).alias("segments"))


def chat_format(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, formatted, segments) of all conversations."""
    return segments(blocks(turns, **columns)).select("conv_id", F.array_join(F.transform(
        "segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda s: s["train"]), lambda s: unescape(s["text"])), "")


#: Text without a bare mark: escaped pairs and plain characters. Possessive, so that long
#: texts need no stack.
_BODY = r"(?:\\.|[^\\<\[\]])*+"


def read_back(formatted: Column) -> Column:
    """The array of (role, text) turns read from a formatted text alone."""
    block = rf"(?s)\[INST:({_BODY})\]((?:{_BODY}\[\+\])*+{_BODY})(?:\[/INST\]|</s>)"
    part = rf"(?s)({_BODY})\[\+\]"
    found = F.arrays_zip(F.regexp_extract_all(formatted, F.lit(block), F.lit(1)).alias("role"),
                         F.regexp_extract_all(formatted, F.lit(block), F.lit(2)).alias("body"))
    return F.flatten(F.transform(found, lambda b: F.transform(
        F.regexp_extract_all(F.concat(b["body"], F.lit(PART)), F.lit(part), F.lit(1)),
        lambda p: F.struct(unescape(b["role"]).alias("role"), unescape(p).alias("text")))))

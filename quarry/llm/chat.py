"""Chat formatting: conversations to one training string each, with a loss mask.

Relational formatting: the turns of a conversation are collected as structs
and sorted, adjacent turns of one role share a header (array aggregation over
the sorted structs), and the pieces are concatenated.  Spark expressions only.

Template (fixed values)::

    <s>[role]text<t>text</s><s>[role]text</s>

``<s>[role]`` opens a block, ``<t>`` parts adjacent turns of the same role and
``</s>`` closes a block.  Inside roles and texts ``\\``, ``<``, ``[`` and ``]``
are written as ``\\0 \\1 \\2 \\3``, so no control string can occur there and the
escape can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Escapes, in the order of writing; undone in reverse order (fixed values).
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))
OPEN, TURN, CLOSE = "<s>", "<t>", "</s>"


def escape(c: Column) -> Column:
    for raw, code in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def format_chats(turns: DataFrame, loss_role: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``id_col, formatted, loss_spans``.

    ``loss_spans`` is an array of (start, end) code-point offsets into
    ``formatted``, one for each non-empty turn of ``loss_role``, in order.

    A null role or text counts as empty.  Turns sort by turn, then role, then
    text (null turn first), so ties and repeated rows have one order; repeated
    rows are kept.  Rows with a null conversation id form one conversation.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        F.col(id_col).alias(id_col),
        F.struct(F.col(turn_col).alias("t"), F.coalesce(F.col(role_col), F.lit("")).alias("r"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("x")).alias("turn"))
    sorted_turns = rows.groupBy(id_col).agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1), F.get("turns", i + 1)
        head = F.when(before["r"] == x["r"], F.lit(TURN)).otherwise(
            F.concat(F.lit(OPEN + "["), escape(x["r"]), F.lit("]")))
        tail = F.when(after["r"] == x["r"], F.lit("")).otherwise(F.lit(CLOSE))
        return F.struct(head.alias("head"), escape(x["x"]).alias("body"), tail.alias("tail"),
                        (x["r"] == loss_role).alias("loss"))

    pieces = sorted_turns.select(id_col, F.transform("turns", piece).alias("pieces"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        spans = F.when(p["loss"] & (end > start), F.array_append(acc["spans"], F.struct(start.alias("start"), end.alias("end"))))
        return F.struct((end + F.length(p["tail"])).cast("int").alias("at"), spans.otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return pieces.select(
        id_col,
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("pieces", zero, step)["spans"].alias("loss_spans"))


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Undo ``format_chats``: ``id_col, turns`` (array of role, text) and
    ``loss_text``, all taken from the formatted string and its loss spans."""
    blocks = F.filter(F.split("formatted", OPEN), lambda b: b != "")

    def block_turns(b: Column) -> Column:
        role = unescape(F.substring_index(F.substring(b, 2, 2147483647), "]", 1))
        inner = F.substring(b, F.instr(b, "]") + 1, F.length(b) - F.instr(b, "]") - len(CLOSE))
        return F.transform(F.split(inner, TURN, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    masked = F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    return formatted.select(id_col, F.flatten(F.transform(blocks, block_turns)).alias("turns"),
                            unescape(F.array_join(masked, "")).alias("loss_text"),
                            F.length("formatted").alias("formatted_chars"))

r"""Chat formatting, relational and reversible.

The turns of a conversation are collected as structs, sorted by (turn, role,
text), and written block by block, where adjacent turns of one role share a
block:

    <s>[role]text<sep>text</s>

Inside texts and roles the characters that control strings are made of are
escaped: ``\`` as ``\b``, ``<`` as ``\l``, ``[`` as ``\s``, ``]`` as ``\c``. So a ``<`` or
``[`` in the output always starts a control string, whatever a text says, and the
output can be read back.

``segments`` holds the same output in pieces with a loss flag: exactly the
texts of the roles to be learnt are under the mask, no control string is.

Everything is a Spark expression. A conversation is one output row, so its turns
meet in one group, as large as that row; conversations are independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template (fixed values).
OPEN, SEP, CLOSE = "<s>", "<sep>", "</s>"
_ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("[", "\\s"), ("]", "\\c")]


def escape(text: Column) -> Column:
    for raw, safe in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(_ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def format_chats(turns: DataFrame, learn: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, segments) per conversation.

    Null roles and texts are empty; rows without a conversation id form one
    conversation of their own (null). Null turns come first; ties are ordered
    by role, then text; repeated rows are turns of their own.
    """
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                   F.coalesce(text_col, F.lit("")).alias("text"))
    sorted_ = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.array_sort(F.collect_list(row)).alias("turns"))
    role = F.transform("turns", lambda t: t["role"])
    with_role = sorted_.withColumn("roles", role)

    def piece(t: Column, i: Column) -> Column:
        # A turn joins its predecessor's block if the role is the same.
        before = F.get(F.col("roles"), i - 1)
        after = F.get(F.col("roles"), i + 1)
        opened = F.concat(F.lit(OPEN + "["), escape(t["role"]), F.lit("]"))
        lead = F.when((i > 0) & (before == t["role"]), F.lit(SEP)).otherwise(opened)
        tail = F.when(after.isNotNull() & (after == t["role"]), F.lit("")).otherwise(F.lit(CLOSE))
        return F.array(F.struct(lead.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"),
                                t["role"].isin(*learn).alias("loss")),
                       F.struct(tail.alias("text"), F.lit(False).alias("loss")))

    pieces = F.filter(F.flatten(F.transform("turns", piece)), lambda s: s["text"] != "")
    out = with_role.select("conv_id", pieces.alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "")
                      .alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns that an output stands for."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "]", 1)
        name = unescape(F.substring(role, len(OPEN) + 2, 2 ** 30))
        body = F.substring(block, F.length(role) + 2, F.length(block))
        return F.transform(F.split(body, SEP), lambda t: F.struct(name.alias("role"),
                                                                  unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its output says, read back from it."""
    turns = formatted.withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                      lambda s: s["text"]), "")
    loss = unescape(masked)
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))

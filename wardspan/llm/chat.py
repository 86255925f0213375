"""Chat formatting by relational steps: turns are collected as structs, sorted, merged and joined.

A run of turns with one role becomes one section::

    <turn:user>
    first text<next/>second text</turn>

Inside texts a control string gets a backslash after its ``<`` (one more, if there are some), so
``</turn>`` becomes ``<\\/turn>`` and reading back removes exactly one. Roles may hold anything, as
``%``, ``<`` and ``>`` are percent-coded in them.

A conversation is merged in two steps, first in blocks of ``block`` turn numbers and then block by
block, so that a very long one is sorted and merged by many tasks; only its finished text, which is
one value of the result, meets in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, OPEN_END, NEXT, CLOSE = "<turn:", ">\n", "<next/>", "</turn>\n"
_CONTROLS = r"(turn:|/turn>|next/>)"
_GROUPS = "array<struct<role:string,texts:array<string>>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)" + _CONTROLS, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)" + _CONTROLS, r"<$1$2")


def _escape_role(role: Column) -> Column:
    for plain, coded in (("%", "%25"), ("<", "%3C"), (">", "%3E")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def _unescape_role(role: Column) -> Column:
    for plain, coded in ((">", "%3E"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def _append(groups: Column, more: Column) -> Column:
    """``groups`` and ``more`` in a row; where the last and the first role agree, one group."""
    last, first = F.element_at(groups, -1), F.element_at(more, 1)
    joint = F.struct(last["role"].alias("role"), F.concat(last["texts"], first["texts"]).alias("texts"))
    merged = F.concat(
        F.slice(groups, F.lit(1), F.size(groups) - 1),
        F.array(joint),
        F.slice(more, F.lit(2), F.size(more)),
    )
    agree = (F.size(groups) > 0) & (last["role"] == first["role"])
    return F.when(agree, merged).otherwise(F.concat(groups, more)).cast(_GROUPS)


def _merge(parts: Column, groups_of) -> Column:
    none = F.array().cast(_GROUPS)
    return F.aggregate(parts, none, lambda done, part: _append(done, groups_of(part)))


def _one(turn: Column) -> Column:
    return F.array(F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts")))


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _pieces(group: Column, loss_role: str) -> Column:
    no = F.lit(False)
    texts = F.transform(
        group["texts"],
        lambda t, i: F.when(
            i == 0, F.array(_piece(escape(t), group["role"] == loss_role))
        ).otherwise(F.array(_piece(F.lit(NEXT), no), _piece(escape(t), group["role"] == loss_role))),
    )
    return F.concat(
        F.array(_piece(F.concat(F.lit(OPEN), _escape_role(group["role"]), F.lit(OPEN_END)), no)),
        F.flatten(texts),
        F.array(_piece(F.lit(CLOSE), no)),
    )


def format_chats(turns: DataFrame, loss_role: str = "assistant", block: int = 256) -> DataFrame:
    """One row per ``conv_id`` of ``turns`` (conv_id, turn, role, text): ``pieces`` and ``formatted``.

    ``formatted`` is the text of all pieces in a row; ``pieces`` carry ``loss``, true for the texts
    of ``loss_role`` and nothing else, which is the loss mask.

    A null role or text counts as empty, turns with a null number come first, and turns with one
    number follow in the order of role and text; repeated rows stay repeated. Rows with a null
    conv_id form one conversation. An empty table gives an empty table; other columns are ignored.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    blocks = clean.groupBy("conv_id", F.floor(F.col("turn") / block).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    merged = blocks.select("conv_id", "block", _merge(F.col("turns"), _one).alias("groups"))
    whole = merged.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "groups"))).alias("blocks")
    )
    groups = whole.select("conv_id", _merge(F.col("blocks"), lambda b: b["groups"]).alias("groups"))
    pieces = F.flatten(F.transform("groups", lambda g: _pieces(g, loss_role)))
    return groups.select("conv_id", pieces.alias("pieces")).withColumn(
        "formatted", F.array_join(F.col("pieces")["text"], "")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order, as an array of (role, text)."""
    sections = F.split(formatted, CLOSE)
    sections = F.slice(sections, F.lit(1), F.size(sections) - 1)  # nothing follows the last close

    def turns(section: Column) -> Column:
        end = F.instr(section, OPEN_END)
        role = _unescape_role(F.substring(section, F.lit(len(OPEN) + 1), end - len(OPEN) - 1))
        texts = F.split(F.substring(section, end + len(OPEN_END), F.length(section)), NEXT)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(sections, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(kept, lambda p: unescape(p["text"])), "")


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digests of what ``format_chats`` returned, read back from its text and mask."""
    read = chats.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("pieces")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )

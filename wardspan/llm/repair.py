"""Conversation structure repair by a generalised LR parser with weighted edits.

Valid conversations are ``C -> nothing | s P | P`` and ``P -> u a | P u a`` over the initials of the
roles system, user and assistant. The parser reads a conversation's turns from left to right and
holds a graph-structured stack: stacks that share their lower part share its nodes. At each turn every
stack is continued by each action allowed there (keep, rerole, delete; and inserts before and after
it), reducing as far as it goes; stacks that became equal are merged, keeping the smaller (cost,
audit), where the audit spells the edits so far. A shorter audit of the same turns and cost is no
beginning of a longer one, as an insert costs; so the smaller of two stays the smaller whatever follows.

Turns are numbered in one order over all conversations, and a conversation is parsed in blocks of
that order. One that lies in a single block, as nearly all do, is parsed as it is. Of the others each
block is parsed from every stack there can be, by any task, and the blocks' tables are joined in
order, so a conversation of any length is spread over many tasks. Only its finished audit, one letter
an edit, meets in one place. Texts are not moved but for joining the turns that stay to their edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardspan.operators.ids import dense_ids
from wardspan.runtime import stage

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT is added by a truncated turn that stays
BLOCK_BITS = 10
ROLES = {"s": "system", "u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"

# The parser's tables. State 0 has read nothing, 1 an s, 2 a P, 3 a u, 4 s P, 5 P u, 6 u a, 7 P u a.
SHIFTS = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 3, (2, "u"): 5, (4, "u"): 5, (3, "a"): 6, (5, "a"): 7}
REDUCES = {6: 2, 7: 3}  # to P, by the number of symbols
GOTOS = {(0, "P"): 2, (1, "P"): 4}
ACCEPTS = {0, 2, 4}

Value = tuple[int, str]  # cost and audit


class Node(NamedTuple):
    """A stack by its top; what is below it is shared."""

    state: int
    below: Node | None


@lru_cache(maxsize=None)  # as many entries as there are stacks and symbols: a few dozen
def shift(top: Node, symbol: str) -> Node | None:
    """The stack after reading ``symbol`` and reducing; None if the symbol cannot follow."""
    state = SHIFTS.get((top.state, symbol))
    if state is None:
        return None
    node = Node(state, top)
    while node.state in REDUCES:
        rest = node
        for _ in range(REDUCES[node.state]):
            rest = rest.below
        node = Node(GOTOS[rest.state, "P"], rest)
    return node


START = Node(0, None)


def _stacks() -> list[Node]:
    """All stacks there can be after whole reductions."""
    found = [START]
    for node in found:
        found += [n for s in ROLES if (n := shift(node, s)) is not None and n not in found]
    return found


STACKS = _stacks()
Tops = dict[Node, Value]


def _offer(tops: Tops, node: Node | None, value: Value) -> bool:
    """Merge into the equal stack; whether this one is better."""
    if node is None or (node in tops and tops[node] <= value):
        return False
    tops[node] = value
    return True


def insert(tops: Tops) -> Tops:
    """With what any number of inserts makes of the stacks."""
    waiting = list(tops)
    for node in waiting:
        cost, audit = tops[node]
        for symbol in "ua":
            after = shift(node, symbol)
            if _offer(tops, after, (cost + INSERT, audit + "I")):
                waiting.append(after)
    return tops


def read(tops: Tops, turn: str) -> Tops:
    """The stacks after a turn: s, u, a, x (another role), in capitals if truncated, or ``-`` for one
    that has to go."""
    after: Tops = {}
    for node, (cost, audit) in tops.items():
        _offer(after, node, (cost + DELETE, audit + "D"))
        if turn == "-":
            continue
        stays = cost + (CUT if turn.isupper() else 0)
        _offer(after, shift(node, turn.lower()), (stays + KEEP, audit + "K"))
        for symbol in "ua":
            _offer(after, shift(node, symbol), (stays + REROLE, audit + "R"))
    return insert(after)


@lru_cache(maxsize=20_000)
def parse(turns: str) -> Value:
    """The cheapest edits of a whole conversation; of several, those with the least audit."""
    tops = insert({START: (0, "")})
    for turn in turns:
        tops = read(tops, turn)
    return min(value for node, value in tops.items() if node.state in ACCEPTS)


@lru_cache(maxsize=200)
def passage(turns: str) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) by number of stack, for a block whose first stack is not known yet."""
    out = []
    for start, entry in enumerate(STACKS):
        tops = {entry: (0, "")}
        for turn in turns:
            tops = read(tops, turn)
        out += [(start, STACKS.index(node), *value) for node, value in tops.items()]
    return out


def follow(tops: Tops, steps: list[tuple[int, int, int, str]]) -> Tops:
    """The stacks after a block, given those before it."""
    after: Tops = {}
    for start, end, cost, audit in steps:
        if STACKS[start] in tops:
            before = tops[STACKS[start]]
            _offer(after, STACKS[end], (before[0] + cost, before[1] + audit))
    return after


def edits(audit: str) -> Iterator[tuple[int, int, str, str | None]]:
    """(turn, place, edit, role) for each letter: turns count from 0, an insert has the turn before
    it (the first turn, if there is none) and a place beside it. A kept turn keeps its role."""
    left = sum(letter != "D" for letter in audit)
    number, lead, turn, place = 0, left % 2, -1, 0  # an odd number of turns begins with the system's
    ahead = len(audit) - len(audit.lstrip("I"))
    for letter in audit:
        if letter == "I":
            place += 1
        else:
            turn, place = turn + 1, 0
        role = None
        if letter != "D":
            if letter != "K":
                role = ROLES["ua"[(number - lead) % 2]]
            number += 1
        yield (0, place - ahead - 1, letter, role) if turn < 0 else (turn, place, letter, role)


# Spark


@dataclass
class Repair:
    """``report``: a row per conversation. ``repaired``: its turns after repair, in the order of
    (at, place). ``edits``: what was done to each turn, deleted ones included."""

    report: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    repaired: DataFrame  # conv_id, at, place, edit, role, text
    edits: DataFrame  # at, place, edit, role


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, fields.values())], names=list(fields)
    )


def _parse_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns").to_pylist()
        rows = [(at, *parse(t)) for at, t in zip(batch.column("first").to_pylist(), turns)]
        yield _batch(rows, {"first": pa.int64(), "cost": pa.int64(), "audit": pa.string()})


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for conversation, first, turns in zip(*[batch.column(c).to_pylist() for c in ("start", "first", "turns")]):
            rows = [(conversation, first, *step) for step in passage(turns)]
            yield _batch(
                rows,
                {"start": pa.int64(), "first": pa.int64(), "a": pa.int64(), "b": pa.int64(), "cost": pa.int64(), "audit": pa.string()},
            )


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations come whole and in order of their blocks; one is held as its audits so far."""
    start, first, steps, tops = None, None, [], {}

    def done() -> pa.RecordBatch:
        cost, audit = min(v for n, v in follow(tops, steps).items() if n.state in ACCEPTS)
        return _batch([(start, cost, audit)], {"first": pa.int64(), "cost": pa.int64(), "audit": pa.string()})

    for batch in batches:
        for conversation, at, *step in zip(*[batch.column(c).to_pylist() for c in ("start", "first", "a", "b", "cost", "audit")]):
            if conversation != start:
                if start is not None:
                    yield done()
                start, first, steps, tops = conversation, at, [], insert({START: (0, "")})
            elif at != first:
                tops, steps, first = follow(tops, steps), [], at
            steps.append(tuple(step))
    if start is not None:
        yield done()


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = {"at": pa.int64(), "place": pa.int64(), "edit": pa.string(), "role": pa.string()}
    for batch in batches:
        rows = []
        for first, audit in zip(batch.column("first").to_pylist(), batch.column("audit").to_pylist()):
            for turn, place, edit, role in edits(audit):
                rows.append((first + turn, place, edit, role))
                if len(rows) == 10_000:
                    yield _batch(rows, fields)
                    rows = []
        yield _batch(rows, fields)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def repair(turns: DataFrame, block_bits: int = BLOCK_BITS) -> Repair:
    """Find the cheapest repair of each conversation in ``turns`` (conv_id, turn, role, text).

    Turns come by ``turn``, nulls first, then role and text; a null role or text is one space. The
    first fault of a turn counts: blank (nothing but ASCII white space), duplicate (role and text seen
    earlier in the conversation), truncated (its last character that is not white space is not one of
    ``.!?``). Blank and duplicate turns have to be deleted. A role counts by its first letter, and
    another one than s, u, a has to be changed or deleted. The report also has ``gaps`` in the turn
    numbers and ``illegal`` pairs of neighbours, as the conversation was given.

    A null conv_id is a conversation. An empty table gives empty ones. Other columns are ignored.
    Turns are staged, numbered and parsed when this is called.
    """
    given = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    told = given.withColumns({"named": F.col("conv_id").isNotNull(), "timed": F.col("turn").isNotNull()})
    order = ["named", "conv_id", "timed", "turn", "role", "text"]
    # Structs compare with nulls as equal, so a null conv_id can be joined.
    placed = dense_ids(told, order, "at").withColumn("key", F.struct("named", "conv_id"))
    bare = F.rtrim("text", F.lit(SPACE))
    slim = stage(
        placed.select(
            "key",
            "at",
            "turn",
            _initial(F.col("role")).alias("initial"),
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("content"),
            (bare == "").alias("blank"),
            F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"),
        ),
        "repair-turns",
    )
    firsts = slim.groupBy("key", "content").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    )
    judged = slim.join(firsts, "at", "left").withColumn("fault", F.coalesce(fault, F.lit("")))
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), "-")
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    counts = [F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")]
    blocks = judged.withColumn("symbol", symbol).groupBy("key", F.shiftright("at", block_bits).alias("block")).agg(
        F.min("at").alias("first"),
        F.sort_array(F.collect_list(F.struct("at", "symbol", "initial"))).alias("run"),  # a block at most
        *counts,
    )
    initials = F.col("run")["initial"]
    bad = F.filter(
        F.transform(initials, lambda x, i: F.concat(F.get(initials, i - 1), x)),
        lambda p: ~p.isin("su", "ua", "au"),  # null for the first
    )
    lines = blocks.select(
        "key", "first", "blank", "duplicate", "truncated",
        F.array_join(F.col("run")["symbol"], "").alias("turns"),
        F.size(bad).alias("inside"),
        F.get(initials, F.lit(0)).alias("head"),
        F.element_at(initials, -1).alias("tail"),
    )
    together = Window.partitionBy("key")
    across = F.concat(F.lag("tail").over(together.orderBy("first")), "head")
    parts = stage(
        lines.withColumns(
            {
                "start": F.min("first").over(together),
                "blocks": F.count(F.lit(1)).over(together),
                "illegal": F.col("inside") + F.coalesce(~across.isin("su", "ua", "au"), F.lit(False)).cast("long"),
            }
        ),
        "repair-blocks",
    )
    whole = parts.filter("blocks = 1").select("first", "turns").mapInArrow(
        _parse_whole, "first long, cost long, audit string"
    )
    cut = parts.filter("blocks > 1").select("start", "first", "turns").repartition("start", "first")
    tables = cut.mapInArrow(_parse_blocks, "start long, first long, a long, b long, cost long, audit string")
    joined = tables.repartition("start").sortWithinPartitions("start", "first").mapInArrow(
        _join_blocks, "first long, cost long, audit string"
    )
    found = stage(whole.unionByName(joined), "repair-audits")

    sums = parts.groupBy("key").agg(
        F.min("first").alias("first"), *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = slim.groupBy("key").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    report = sums.join(gaps, "key").join(found, "first").select(
        F.col("key.conv_id").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    spelled = found.select("first", "audit").mapInArrow(_spell, "at long, place long, edit string, role string")
    own = placed.select("at", "conv_id", F.col("role").alias("old"), "text")
    kept = spelled.filter("edit <> 'D'").join(own, "at").select(
        "conv_id",
        "at",
        "place",
        "edit",
        F.coalesce("role", "old").alias("role"),
        F.when(F.col("place") == 0, F.col("text")).otherwise("").alias("text"),
    )
    return Repair(report, kept, spelled)


def digest(repaired: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of ``role:text`` of the repaired turns, joined by newlines."""
    line = F.concat("role", F.lit(":"), "text").alias("line")
    rows = repaired.select("conv_id", F.struct("at", "place", line).alias("row"))
    blocks = rows.groupBy("conv_id", F.shiftright("row.at", block_bits).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("row"))["line"], "\n").alias("lines")
    )
    return blocks.groupBy("conv_id").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(F.struct("block", "lines")))["lines"], "\n"), 256).alias("repaired_sha256")
    )


def damage(turns: DataFrame) -> DataFrame:
    """Faults planted in ``turns`` (conv_id, turn, role, text) by the CRC-32 of ``conv_id:turn``
    modulo 20: 0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes
    its role user. A null anywhere counts as one space."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    times = F.when(F.col("kind") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .filter("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(times).alias("again"),
        )
        .drop("again")
    )


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The report and digest of the repair of ``turns`` for every conv_id in ``conversations``; one
    without turns has zeros, an empty audit and the digest of nothing."""
    done = repair(turns)
    digests = digest(done.repaired).select(F.struct("conv_id").alias("key"), "repaired_sha256")
    report = done.report.withColumn("key", F.struct("conv_id")).drop("conv_id")
    every = conversations.select("conv_id").distinct().withColumn("key", F.struct("conv_id"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(report, "key", "left").join(digests, "key", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

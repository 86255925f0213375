"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``replicas`` points on a ring of hash values. A document stands at the hash of its
text, so equal texts stand together, and belongs to the next point clockwise. A shard takes no more
than its bound; what it cannot take goes on clockwise to the next shard with room.

With ``slack`` 0 the bounds are the row count divided by the shards, rounded down or up, so that
counts differ by one at most. When a shard is added, only its new points take arcs from others,
beside what moves through overflow.

The ring is cut into one arc per point. Documents are numbered in ring order by range partitioning,
so that a text with a third of all copies is spread over many tasks, and counted per arc. Only these
counts (shards x replicas at most, whatever the size of the data) reach the driver, which deals
ranges of places to shards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.llm.common import HEX_DIGITS, hash_number
from wardspan.operators import dense_ids
from wardspan.runtime import stage

RING = 16**HEX_DIGITS
BUCKETS = 4096


def ring_points(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, in ring order. A shard's points do not depend on how
    many shards there are."""
    return sorted(
        (int(hashlib.md5(f"shard {s}, point {r}".encode()).hexdigest()[:HEX_DIGITS], 16), s)
        for s in range(shards)
        for r in range(replicas)
    )


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    """How many rows each shard may take."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def deal(
    counts: dict[int, int], points: Sequence[tuple[int, int]], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Ranges (arc, first place, last place, shard, slot of the first), by the rows of each arc.

    Places count from 1 along the ring. Each shard first takes rows of its own arcs; the rest is
    carried clockwise, first come first served, and is placed within two rounds.
    """
    room, taken, ranges, over = list(room), [0] * len(room), [], {}
    place = 1

    def take(arc: int, first: int, rows: int, shard: int) -> int:
        n = min(rows, room[shard])
        if n:
            ranges.append((arc, first, first + n - 1, shard, taken[shard]))
            room[shard] -= n
            taken[shard] += n
        return n

    for arc, (_, shard) in enumerate(points):
        rows = counts.get(arc, 0)
        n = take(arc, place, rows, shard)
        if n < rows:
            over[arc] = (place + n, rows - n)
        place += rows
    carried: deque[tuple[int, int, int]] = deque()
    for step in range(2 * len(points)):
        at = step % len(points)
        if step < len(points) and at in over:
            carried.append((at, *over[at]))
        while carried and room[points[at][1]]:
            arc, first, rows = carried.popleft()
            n = take(arc, first, rows, points[at][1])
            if n < rows:
                carried.appendleft((arc, first + n, rows - n))
    return ranges


def _arc(position: Column, starts: Column, inner: Column, points: int) -> Column:
    """Number of the first ring point at or after ``position``; past the last one comes the first."""
    return ((starts + F.size(F.filter(inner, lambda p: p < position))) % points).cast("int")


def shard(
    docs: DataFrame,
    shards: int = 24,
    replicas: int = 64,
    slack: float = 0.0,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and
    ``grown_shard`` (null: the law is about rows, so it does not follow from an id alone).

    ``keep`` names the columns of ``docs`` to carry through the shuffle, all by default, under any
    names. Columns with the names of the new ones are replaced. ``size`` is the UTF-8 bytes of the text plus 8; a null
    text has none and a checksum of 0. Null texts and empty texts stand at the same place. Rows of
    one text follow by doc_id, nulls last, then by a hash of the other columns; rows alike in all that
    are kept can stand for one another. An empty table gives an empty table. Not lazy: the rows are
    numbered when this is called.
    """
    spark = docs.sparkSession
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    arc, turn, place, row = "arc", "turn", "place", "ring_row"
    points = ring_points(shards, replicas)
    positions = [p for p, _ in points]
    width = RING // BUCKETS
    steps = [bisect_left(positions, b * width) for b in range(BUCKETS + 1)]
    table = spark.createDataFrame(
        [(b, steps[b], positions[steps[b] : steps[b + 1]]) for b in range(BUCKETS)],
        "_bucket int, _start int, _inner array<long>",
    )
    text = F.coalesce("text", F.lit(""))
    position = hash_number(text)
    # The caller's columns travel in one, so that no name of theirs meets one used here.
    placed = docs.select(
        F.struct(F.lit(0).alias("_none"), *kept).alias("doc") if not kept else F.struct(*kept).alias("doc"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        position.alias("_position"),
    ).withColumn("_bucket", F.floor(F.col("_position") / width).cast("int"))
    # BUCKETS rows, whatever the data.
    placed = placed.join(F.broadcast(table), "_bucket").select(
        "doc",
        "size",
        "text_crc32",
        _arc(F.col("_position"), F.col("_start"), F.col("_inner"), len(points)).alias(arc),
        # Counted from the last point, so that places of one arc follow each other.
        F.pmod(F.col("_position") - positions[-1] - 1, F.lit(RING)).alias(turn),
    )
    # Whole rows are written once; only what orders them is sorted and numbered.
    rows = stage(placed.withColumn(row, F.monotonically_increasing_id()), "ring-rows")
    rest = [c for c in kept if c not in ("doc_id", "text") and _can_hash(docs, c)]
    narrow = rows.select(
        row, arc, turn, F.col("doc.doc_id" if "doc_id" in kept else "size").alias("_id"), "text_crc32", "size",
        F.xxhash64(F.lit(0), *[F.col("doc")[c] for c in rest]).alias("_rest"),
    )
    numbered = dense_ids(narrow, [turn, "_id", "text_crc32", "size", "_rest", row], place)
    counts = {r[0]: r[1] for r in numbered.groupBy(arc).count().collect()}
    room = bounds(sum(counts.values()), shards, slack)
    ranges = spark.createDataFrame(
        deal(counts, points, room), "_arc int, _first long, _last long, shard int, _slot long"
    )
    at = F.col(place)
    # At most two ranges for each point and one more for each shard.
    found = numbered.join(
        F.broadcast(ranges), (F.col(arc) == F.col("_arc")) & at.between(F.col("_first"), F.col("_last"))
    )
    found = found.select(row, "shard", (F.col("_slot") + at - F.col("_first")).alias("slot"))
    return rows.join(found, row).select(
        *[F.col("doc")[c].alias(c) for c in kept],
        "size",
        "text_crc32",
        F.lit("bounded" if slack else "rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _can_hash(docs: DataFrame, name: str) -> bool:
    return docs.schema[name].dataType.simpleString().split("<")[0] not in ("map", "variant")

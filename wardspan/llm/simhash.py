"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are collapsed to distinct ones, so exact copies cost nothing further. Their 64 bits are
divided into ``parts`` groups of correlated bits. If the thresholds of the parts sum to
``distance - parts + 1``, two fingerprints within ``distance`` bits are within the threshold of at
least one part (-1: the part is not looked at). A dynamic programme picks the thresholds with the
fewest estimated candidates, from the counts of all part values.

A part with threshold t is probed by every way to blank t of its bits: values within t bits agree on
one of them. Fingerprints with the same probe meet in one group, are verified on all 64 bits, and a
group gives a spanning forest of its links, never all pairs. Groups come sorted in a stream, so a
task holds one group at a time; large groups are cut again by other bits inside the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.llm.components import components
from wardspan.runtime import stage

BITS = 64
CHUNK = 65_536  # shingles whose bits are spread out at a time
FEW = 8  # groups up to this size are compared at once, by distance in the sorted order
MANY = 4096  # larger groups are cut again


def fingerprint(text: str | None, width: int = 4) -> int:
    """Signed 64-bit SimHash of the word shingles of ``text``; 0 if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    flat = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    shingles = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], gaps + 1))[:shingles].tolist()
    ends = np.concatenate((gaps, [len(flat)]))[-shingles:].tolist()
    counts = np.zeros(BITS)
    for at in range(0, shingles, CHUNK):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])),
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.ones(len(bits), np.float32) @ bits.astype(np.float32)
    packed = np.packbits(counts * 2 > shingles, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text: Column, width: int = 4) -> Column:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return hashed(text)


def group_bits(together: np.ndarray, ones: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Divide the bits into ``parts`` groups of like size, correlated bits into one group."""
    rows = max(rows, 1)
    p = ones / rows
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    bound = np.abs((together / rows - np.outer(p, p)) / np.outer(deviation, deviation))
    np.fill_diagonal(bound, 0)
    free, groups = list(range(BITS)), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        group = [max(free, key=lambda b: bound[b, free].sum())]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: bound[b, group].sum()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def candidate_cost(counts: np.ndarray, width: int, threshold: int) -> float:
    """Pairs that meet in a part of ``width`` bits, given how often each value occurs, plus probes."""
    if threshold < 0:
        return 0.0
    cube = counts.reshape((2,) * width)
    probes = list(combinations(range(width), threshold))
    met = sum(float((cube.sum(axis=axes) ** 2).sum()) for axes in probes)
    return met + float(counts.sum()) * len(probes)


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds (-1, 0, 1, ...) of the parts with the least cost whose sum is ``total``.
    ``costs[i][t + 1]`` is the cost of threshold t in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(part, start=-1):
                option = (cost + more, [*chosen, t])
                if spent + t not in step or option < step[spent + t]:
                    step[spent + t] = option
        best = step
    return best[total][1]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """Links that join all of ``fps`` that hang together: arrays of members and whom they join."""
    rest = fps
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            one = frontier.pop()
            near = _popcount(rest ^ one) <= distance
            if near.any():
                found = rest[near]
                yield found, one
                frontier.extend(found)
                rest = rest[~near]


def _links(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    if len(fps) <= MANY:
        yield from _forest(fps, distance)
        return
    # Cut into distance + 1 pieces: linked ones agree on at least one.
    edges = np.linspace(0, BITS, distance + 2).astype(int)
    for low, high in zip(edges, edges[1:]):
        piece = (fps >> np.uint64(low)) & np.uint64((1 << int(high - low)) - 1)
        order = np.argsort(piece, kind="stable")
        cuts = np.flatnonzero(np.diff(piece[order])) + 1
        for group in np.split(fps[order], cuts):
            yield from _forest(group, distance)


def _verify(distance: int):
    """Rows (probe, fp) sorted by probe in; links (a, b) out."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        few = np.repeat(sizes <= FEW, sizes)
        for lag in range(1, FEW):
            if lag >= len(keys):
                break
            same = few[lag:] & (keys[lag:] == keys[:-lag])
            same &= _popcount(fps[lag:] ^ fps[:-lag]) <= distance
            a.append(fps[lag:][same])
            b.append(fps[:-lag][same])
        for start, size in zip(starts[sizes > FEW], sizes[sizes > FEW]):
            for found, one in _links(fps[start : start + size], distance):
                a.append(found)
                b.append(np.full(len(found), one, np.uint64))
        found = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(found, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_fps = [], []  # of the group that may go on in the next batch
        for batch in batches:
            keys = batch.column("probe").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))  # where the last group starts
            if last or (held_keys and held_keys[-1][-1] != keys[0]):
                done_keys = np.concatenate([*held_keys, keys[:last]])
                done_fps = np.concatenate([*held_fps, fps[:last]])
                if len(done_keys) > 1:
                    yield links(done_keys, done_fps)
                held_keys, held_fps = [], []
            held_keys.append(keys[last:])
            held_fps.append(fps[last:])
        if held_keys:
            yield links(np.concatenate(held_keys), np.concatenate(held_fps))

    return run


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for batch in batches:
        fps = batch.column("fp").to_numpy().astype("<i8")
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total += bits.T @ bits
    at, n = np.arange(BITS * BITS), total.ravel().astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])


def _part_value(bits: list[int]) -> Column:
    value = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        value = value.bitwiseOR(F.shiftleft(F.shiftright("fp", b).bitwiseAND(F.lit(1)), k))
    return value


def _probes(groups: list[list[int]], thresholds: list[int]) -> Column:
    """All probes of a fingerprint. Number, blanked bits and value of the part make one long."""
    probes = []
    for part, (bits, t) in enumerate(zip(groups, thresholds)):
        full = (1 << len(bits)) - 1
        for blank in combinations(range(len(bits)), t) if t >= 0 else ():
            mask = sum(1 << b for b in blank)
            lead = (part << 58) | (mask << 29)
            probes.append(_part_value(bits).bitwiseAND(F.lit(full ^ mask)) + F.lit(lead))
    return F.array(*probes)


def link_fingerprints(fps: DataFrame, distance: int = 4, parts: int = 4) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``distance`` bits.

    To the driver come 64 x 64 bit counts and at most 2^16 counts per part, whatever the input.
    """
    if not 4 <= parts <= 2 * distance:
        raise ValueError("parts: from 4 (16 bits each) to twice the distance")
    spread = fps.select("fp").mapInArrow(_bit_counts, "at long, n long").groupBy("at").agg(F.sum("n"))
    together = np.zeros(BITS * BITS)
    for at, n in spread.collect():
        together[at] = n
    together = together.reshape(BITS, BITS)
    rows = fps.count()
    groups = group_bits(together, together.diagonal(), rows, parts)

    pieces = F.array(*[F.struct(F.lit(i).alias("part"), _part_value(g).alias("value")) for i, g in enumerate(groups)])
    counted = fps.select(F.inline(pieces)).groupBy("part", "value").count()
    counts = [np.zeros(1 << len(g)) for g in groups]
    for part, value, n in counted.collect():
        counts[part][value] = n
    # 3 blanked bits are 560 probes; with four parts and more, plans never need as many.
    costs = [[candidate_cost(c, len(g), t) for t in range(-1, 3)] for c, g in zip(counts, groups)]
    thresholds = allocate(costs, distance - parts + 1)
    probes = fps.select(F.explode(_probes(groups, thresholds)).alias("probe"), "fp")
    met = probes.repartition(F.col("probe")).sortWithinPartitions("probe")
    return met.mapInArrow(_verify(distance), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    distance: int = 4,
    parts: int = 4,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    doc_id that can be reached over links of at most ``distance`` bits) and ``representative``, true
    for one row of each component: the smallest doc_id, and any one of its rows if it repeats.

    ``keep`` names the columns of ``docs`` to carry, all by default; columns with the new names are
    replaced. Null and empty texts have fingerprint zero and are linked like any other. A null
    doc_id comes last; a component of null ids only has a null component_id. An empty table gives
    an empty table. Not lazy: links and components are computed when this is called.
    """
    added = ("fingerprint", "component_id", "representative")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(
        F.struct(*kept).alias("doc"),
        F.col("doc_id"),
        fingerprint_column(F.col("text"), width).alias("fp"),
    )
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "simhash-docs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    fps = stage(rows.groupBy("fp").agg(first), "simhash-fps")
    roots = components(link_fingerprints(fps, distance, parts)).withColumnsRenamed({"node": "fp"})
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = stage(rooted.join(heads, "root").select("fp", "head"), "simhash-components")
    return rows.join(named, "fp").select(
        "doc.*",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("representative"),
    )

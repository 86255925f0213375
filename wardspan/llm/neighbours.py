"""Approximate nearest neighbours by collision counting.

Unit vectors are projected on ``projections`` random lines, and each line keeps its values in sorted
order. A query opens a window around its own value on every line; a vector that lies in the windows
of at least ``threshold`` lines is verified by its exact cosine. Windows grow by a constant factor
(virtual rehashing: the same arrays at a coarser grid) until enough verified vectors lie within the
distance the windows stand for, or the windows hold everything. Nothing caps the candidates.

The index lives in blocks of ``block`` vectors, each built in one task. A query first grows its
windows in one block, its own; the distance of its ``k``-th vector there is an upper bound of the
one over all blocks. It then opens windows for that distance once in every other block, so that
blocks without near vectors verify few or none. The best ``k`` of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.runtime import stage

# The radii at which windows are looked at: each the one before times GROWTH, then everything.
NEAREST, GROWTH = 0.25, 1.12
# Half a window, in standard deviations of what vectors at the radius differ by on a line. About nine
# lines in ten then hold such a vector; wide windows tell it from farther ones better than narrow ones.
WIDTH = 1.6


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers and not all of them zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def lines(dim: int, projections: int) -> np.ndarray:
    """Random directions of length 1, the same for every block. Each ``dim`` of them are orthogonal,
    so that together they miss nothing of a vector and counts vary less."""
    rng = np.random.default_rng(dim)
    bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0].T for _ in range(-(-projections // dim))]
    return np.concatenate(bases)[:projections]


class Block:
    """The sorted lines of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, share: float):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.lines = lines(vectors.shape[1], projections)
        values = ((vectors / self.norms[:, None]) @ self.lines.T).T
        self.order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order, axis=1)
        self.threshold = max(1, int(np.ceil(share * projections)))
        # On a line through unit vectors at distance r, values differ by about r / sqrt(dim).
        self.spread = WIDTH / np.sqrt(vectors.shape[1])

    def _windows(self, query: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place in and first place behind the window, by line and radius."""
        at = self.lines @ (query / np.sqrt((query * query).sum()))
        widths = radii * self.spread + 1e-9  # equal vectors may differ in their last digit on a line
        low = np.stack([np.searchsorted(s, a - widths, "left") for s, a in zip(self.sorted, at)])
        return low, np.stack([np.searchsorted(s, a + widths, "right") for s, a in zip(self.sorted, at)])

    def _count(self, slices: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(slices), minlength=len(self.ids))

    def _verify(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        dots = (self.vectors[places] * query).sum(axis=1)  # row by row: equal rows, equal sums
        return dots / (self.norms[places] * np.sqrt((query * query).sum()))

    def grow(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and cosines of the best ``k``, best first, ties to smaller ids, from windows that grow
        until ``k`` lie within their radius; and how many vectors were verified."""
        steps = int(np.ceil(np.log(2 / NEAREST) / np.log(GROWTH))) + 1
        radii = np.append(NEAREST * GROWTH ** np.arange(steps), np.inf)
        low, high = self._windows(query, radii)
        counts = np.zeros(len(self.ids), np.int64)
        seen = self.ids == query_id
        found_ids, found, verified = np.empty(0, self.ids.dtype), np.empty(0), 0
        for step, radius in enumerate(radii):
            if step:
                before, after = (low[:, step], low[:, step - 1]), (high[:, step - 1], high[:, step])
                new = [o[f:t] for side in (before, after) for o, f, t in zip(self.order, *side)]
            else:
                new = [o[f:t] for o, f, t in zip(self.order, low[:, 0], high[:, 0])]
            counts += self._count(new)
            fresh = np.flatnonzero((counts >= self.threshold) & ~seen)
            if len(fresh):
                seen[fresh] = True
                verified += len(fresh)
                found_ids = np.concatenate((found_ids, self.ids[fresh]))
                found = np.concatenate((found, self._verify(query, fresh)))
                found_ids, found = _best(found_ids, found, k)
            # A cosine c is the distance sqrt(2 - 2c) between unit vectors.
            if len(found) >= k and 2 - 2 * found[-1] <= radius * radius:
                break
        return found_ids, found, verified

    def within(self, query_id: int, query: np.ndarray, k: int, radius: float) -> tuple[np.ndarray, np.ndarray, int]:
        """The same from windows for one radius, opened once. They hold most of a line if nothing is
        near, so what lies outside of them is counted."""
        low, high = self._windows(query, np.array([radius]))
        outside = [o[:t] for o, t in zip(self.order, low[:, 0])] + [o[f:] for o, f in zip(self.order, high[:, 0])]
        counts = len(self.lines) - self._count(outside)
        hits = np.flatnonzero((counts >= self.threshold) & (self.ids != query_id))
        return *_best(self.ids[hits], self._verify(query, hits), k), len(hits)


def _best(ids: np.ndarray, cosines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, -cosines))[:k]
    return ids[best], cosines[best]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    projections: int = 128,
    share: float = 0.875,
    block: int = 8192,
    query_block: int = 8192,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` (vec_id, embedding) with the largest cosine to each row of
    ``queries`` (the same columns), but for rows with the query's own vec_id: query_id, rank, vec_id,
    score, verified (vectors of which the query's cosine was computed). Scores are computed in double
    precision from the vectors as given.

    Rows with a null vec_id, or with a vector that is null, empty, zero or not all finite numbers,
    take no part. Rows alike in id and vector count once. Vectors are compared with vectors of the
    same length. An empty side gives an empty table.
    """
    def clean(df: DataFrame) -> DataFrame:
        wide = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
        return wide.filter(F.col("id").isNotNull() & usable(F.col("v"))).distinct()

    index, asked = stage(clean(vectors), "nearest-index"), stage(clean(queries), "nearest-queries")
    blocks = {r["n"]: -(-r["rows"] // block) for r in _sizes(index)}  # one row per vector length
    parts = {r["n"]: -(-r["rows"] // query_block) for r in _sizes(asked)}
    sizes = [(n, blocks[n], parts[n], -(-parts[n] // blocks[n])) for n in sorted(blocks.keys() & parts.keys())]
    table = vectors.sparkSession.createDataFrame(sizes, "n int, blocks int, parts int, own_parts int")

    def placed(df: DataFrame) -> DataFrame:
        home = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("home")
        return df.withColumn("n", F.size("v")).join(F.broadcast(table), "n").select("*", home)

    def part(count: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(1)), F.col(count)).cast("int").alias("part")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def own(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        built = _built(mine, theirs, projections, share)
        rows = []
        for query_id, vector in zip(theirs["id"], theirs["v"]):
            near = built.grow(query_id, np.asarray(vector, np.float64), k) if built else _NONE
            # Fewer than k there: nothing bounds the distance, other blocks verify all they have.
            radius = np.sqrt(max(0.0, 2 - 2 * near[1][-1])) if len(near[1]) == k else np.inf
            rows.append((query_id, vector, radius, *near))
        return pd.DataFrame(rows, columns=["id", "v", "radius", "ids", "scores", "verified"])

    def others(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        built = _built(mine, theirs, projections, share)
        rows = []
        for query_id, vector, radius in zip(theirs["id"], theirs["v"], theirs["radius"]):
            near = built.within(query_id, np.asarray(vector, np.float64), k, radius) if built else _NONE
            rows.append((query_id, *near))
        return pd.DataFrame(rows, columns=["id", "ids", "scores", "verified"])

    cell = ["n", "home", "part"]
    kept, sought = placed(index), placed(asked)
    left = kept.select("n", "home", every("own_parts").alias("part"), "id", "v").groupBy(*cell)
    right = sought.select("n", "home", part("own_parts"), "id", "v").groupBy(*cell)
    near = "ids array<long>, scores array<double>, verified long"
    first = left.cogroup(right).applyInPandas(own, f"id long, v array<double>, radius double, {near}")
    first = stage(first, "nearest-own")
    found = first.select("id", "ids", "scores", "verified")
    if max(blocks.values(), default=0) > 1:
        several = kept.filter("blocks > 1").select("n", "home", every("parts").alias("part"), "id", "v")
        elsewhere = placed(first).filter("blocks > 1").select("n", "home", part("parts"), "id", "v", "radius", every("blocks").alias("block"))
        elsewhere = elsewhere.filter("block != home").drop("home").withColumnRenamed("block", "home")
        found = found.unionByName(
            several.groupBy(*cell).cogroup(elsewhere.groupBy(*cell)).applyInPandas(others, f"id long, {near}")
        )
    # At most k rows for each query and block of vectors; null-free, so structs sort by cosine, then id.
    far = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("far"), x["ids"].alias("vec_id")))
    best = found.groupBy(F.col("id").alias("query_id")).agg(
        F.slice(F.sort_array(F.flatten(F.collect_list(far))), 1, k).alias("best"), F.sum("verified").alias("verified")
    )
    return best.select("query_id", F.posexplode("best").alias("at", "b"), "verified").select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"), "verified"
    )


# What a query finds in a block without vectors.
_NONE = (np.empty(0, np.int64), np.empty(0), 0)


def _built(mine: pd.DataFrame, theirs: pd.DataFrame, projections: int, share: float) -> Block | None:
    return Block(mine["id"].to_numpy(), _matrix(mine["v"]), projections, share) if len(mine) and len(theirs) else None


def _sizes(df: DataFrame) -> Iterator:
    return df.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()

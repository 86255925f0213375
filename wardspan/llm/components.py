"""Connected components of a list of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.runtime import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("hi", "lo").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the smallest node it can reach.

    A step hangs the larger neighbours of each node on its smallest one, then all smaller neighbours
    on the smallest of them; it is repeated until nothing changes, which takes a number of rounds in
    the order of the logarithm of the longest path squared at most. Every round is staged.
    """
    both = F.struct(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = stage(links.filter("a <> b").select(both.alias("e")).select("e.*").distinct(), "links")
    state = _state(edges)
    while state[0]:
        turned = edges.select(F.col("hi").alias("at"), F.col("lo").alias("other")).unionByName(
            edges.select(F.col("lo").alias("at"), F.col("hi").alias("other"))
        )
        least = turned.groupBy("at").agg(F.min("other").alias("least"))
        large = (
            turned.filter("other > at")
            .join(least.select("at", F.least("least", "at").alias("least")), "at")
            .select(F.col("other").alias("hi"), F.col("least").alias("lo"))
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(lowest, "hi").select("hi", "lo", "least")
        pairs = F.explode(
            F.array(
                F.struct(F.col("hi").alias("hi"), F.col("least").alias("lo")),
                F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")),
            )
        )
        edges = stage(small.select(pairs.alias("e")).select("e.*").filter("hi <> lo").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )

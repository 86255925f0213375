"""Merkle manifest of a dataset: content-addressed records, and proofs by descent through them.

Rows are leaves; the leaves of a part (say a language) form a binary tree, and the roots of the parts
another one. A digest is the lower-case hex SHA-256 of its children's hex digests in a row; the last
node of an odd level is alone and becomes the digest of itself. A tree of one leaf is that leaf.

Trees are stored as records from a digest to what lies below it. A record spans ``BITS`` levels: the
nodes of its lowest level are the tops of other records, or leaves, and the ranks of up to 256 of them
differ in one digit only. So a tree of n leaves has log256(n) heights of records, and a leaf is found
from the root by the digits of its rank, most significant first, joining on the digest at hand. What a
digit does not select is collected; reversed, these segments are the proof from the leaf to the root.

Leaves of one lowest record have all digits but the last in common: they travel as one request and
part ways at the end. So what is shuffled on the way is a 256th of the leaves, and the one join as
large as the table is that of requests with their lowest records, one to one but for repeated rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.operators.ids import dense_ids
from wardspan.runtime import broadcast_within, stage

BITS = 8
FAN = 1 << BITS  # nodes in the lowest level of a record
_STEP = "struct<digest:string,left:boolean>"


def leaf_digest(*values: Column) -> Column:
    """Digest of values, each as its UTF-8 byte count, a colon and its text, or ``-`` if null."""

    def coded(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(coded, values)), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` leads to along ``path``, steps of (digest, left) as in a proof."""

    def up(below: Column, step: Column) -> Column:
        other = F.coalesce(step["digest"], F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(other, below)).otherwise(F.concat(below, other)), 256)

    return F.aggregate(path, digest, up)


def path_digest(*paths: Column) -> Column:
    """Digest of all siblings on the paths, in order."""
    return F.sha2(F.concat(*[F.array_join(p["digest"], "") for p in paths]), 256)


def _levels(digests: Column, alone: Column) -> Column:
    """Nodes of ``BITS`` levels above ``digests``, lowest first; of fewer if these are ``alone`` in
    their tree, up to its root."""

    def above(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(last) - 1, F.lit(2)),
            lambda i: F.sha2(F.concat(F.get(last, i), F.coalesce(F.get(last, i + 1), F.lit(""))), 256),
        )
        done = alone & (F.size(last) == 1)
        return F.when(done, levels).otherwise(F.concat(levels, F.array(pairs)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(BITS)), F.array(digests), above)


def _climb(levels: Column, digit: Column) -> Column:
    """Siblings from place ``digit`` of the lowest level up to the top, null where it is alone."""

    def step(level: Column) -> Column:
        place = F.call_function("shiftright", digit, level)
        return F.struct(
            F.get(F.get(levels, level), place.bitwiseXOR(F.lit(1))).alias("digest"),
            (place.bitwiseAND(F.lit(1)) == 1).alias("left"),
        )

    steps = F.transform(F.sequence(F.lit(0), F.size(levels) - 2), step)
    return F.when(F.size(levels) > 1, steps).otherwise(F.array()).cast(f"array<{_STEP}>")


@dataclass
class Forest:
    """Records of trees by height, and the leaves in runs of a lowest record."""

    runs: DataFrame  # tree, n, block, run: array of (rank, digest, row)
    heights: list[DataFrame]  # tree, n, block, levels, digest

    def roots(self) -> DataFrame:
        """(tree, root) of each tree."""
        tops = [h.filter(F.col("n") <= FAN) for h in self.heights]
        union = tops[0]
        for top in tops[1:]:
            union = union.unionByName(top)
        return union.select("tree", F.col("digest").alias("root"))


def build_forest(leaves: DataFrame) -> Forest:
    """Trees over ``leaves`` (tree, n, rank, digest, row): ``n`` is the number of leaves of the tree,
    ``rank`` counts from 0. Every height is written once; there are log256 of the largest n."""
    block = F.shiftright("rank", BITS).alias("block")
    grouped = leaves.groupBy("tree", "n", block).agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest", "row"))).alias("run")  # at most FAN
    )
    runs = stage(grouped, "merkle-runs")
    heights, below = [], runs.select("tree", "n", "block", F.col("run")["digest"].alias("digests"))
    while True:
        levels = _levels(F.col("digests"), F.col("n") <= FAN).alias("levels")
        kept = stage(below.select("tree", "n", "block", levels), "merkle-records")
        kept = kept.withColumn("digest", F.get(F.element_at("levels", -1), F.lit(0)))
        heights.append(kept)
        tops = kept.filter(F.col("n") > FAN)
        if tops.isEmpty():
            return Forest(runs, heights)
        upper = tops.select(
            "tree", F.ceil(F.col("n") / FAN).alias("n"), F.col("block").alias("rank"), "digest"
        )
        below = (
            upper.groupBy("tree", "n", block)
            .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
            .select("tree", "n", "block", F.col("run")["digest"].alias("digests"))
        )


def _records(height: DataFrame) -> DataFrame:
    """What a digest leads to. Equal subtrees, as of repeated rows, are one record."""
    return height.groupBy("digest").agg(F.first("levels").alias("levels"))


def prove(forest: Forest) -> DataFrame:
    """(tree, row, leaf, path) of every leaf: its siblings up to the root of its tree."""
    heights = forest.heights
    height = F.lit(len(heights) - 1)
    for j in reversed(range(len(heights) - 1)):
        height = F.when(F.col("n") <= FAN ** (j + 1), j).otherwise(height)
    asked = forest.runs.select("tree", "n", "block").join(broadcast_within(forest.roots()), "tree")
    asked = asked.select(
        "tree",
        "block",
        height.alias("height"),
        F.col("root").alias("digest"),
        F.array().cast(f"array<array<{_STEP}>>").alias("segments"),
    )
    for j in reversed(range(1, len(heights))):
        records = broadcast_within(_records(heights[j])).withColumn("height", F.lit(j))
        digit = F.shiftright("block", BITS * (j - 1)).bitwiseAND(F.lit(FAN - 1)).cast("int")
        here = F.col("levels").isNotNull()
        asked = asked.join(records, ["digest", "height"], "left").select(
            "tree",
            "block",
            F.when(here, j - 1).otherwise(F.col("height")).alias("height"),
            F.when(here, F.get(F.get("levels", F.lit(0)), digit)).otherwise(F.col("digest")).alias("digest"),
            F.when(here, F.concat("segments", F.array(_climb(F.col("levels"), digit))))
            .otherwise(F.col("segments"))
            .alias("segments"),
        )
    upper = F.flatten(F.reverse("segments")).alias("upper")
    lowest = _records(heights[0]).hint("merge")  # as large as the table: never broadcast
    found = asked.select("tree", "block", "digest", upper).join(lowest, "digest")
    leaves = found.join(forest.runs.select("tree", "block", "run").hint("merge"), ["tree", "block"])
    each = leaves.select("tree", "levels", "upper", F.explode("run").alias("item"))
    digit = F.col("item.rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
    return each.select(
        "tree",
        F.col("item.row").alias("row"),
        F.col("item.digest").alias("leaf"),
        F.concat(_climb(F.col("levels"), digit), "upper").alias("path"),
    )


def prove_rows(rows: DataFrame, leaf: Column, part: Column, order: Column, keep: Sequence[str]) -> DataFrame:
    """One row per row of ``rows``: the columns ``keep`` as struct ``row``, ``leaf``, ``subroot`` (of
    its part), ``root``, and the proof in two arrays of (digest, left): ``path`` up to the subroot and
    ``top_path`` from there to the root.

    The leaves of a part ascend by ``order`` (nulls last) and, for ties, by digest, so that rows
    alike stand side by side and any order among them gives the same tree; each has its own proof.
    Parts ascend by UTF-8 bytes, null first, and a null part is a part. Texts of any length become a
    digest where they are read and go no further. An empty table gives no row. Columns may have any
    names. Ranks are numbered by all tasks, so one part may hold all rows; there may be any number of
    parts, as their roots form a tree in the same way.
    """
    given = rows.select(
        F.struct(F.lit(1).alias("one"), *[F.col(c) for c in keep]).alias("row"),
        leaf.alias("digest"),
        part.alias("part"),
        order.alias("place"),
    )
    placed = dense_ids(given.withColumn("named", F.col("part").isNotNull()), ["named", "part", "place", "digest"], "at")
    # Fields of structs are equal if both are null, so a null part can be joined.
    placed = placed.withColumn("part", F.struct("named", "part"))
    sizes = placed.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = stage(dense_ids(sizes, ["part"], "tree"), "merkle-parts")
    leaves = placed.join(broadcast_within(parts), "part").select(
        "tree", "n", (F.col("at") - F.col("first")).alias("rank"), "digest", "row"
    )
    below = build_forest(leaves)
    total = parts.agg(F.count(F.lit(1))).first()[0]
    tops = below.roots().select(
        F.lit(0).alias("tree"),
        F.lit(total).cast("long").alias("n"),
        (F.col("tree") - 1).alias("rank"),
        F.col("root").alias("digest"),
        F.struct("tree").alias("row"),
    )
    above = build_forest(tops)
    whole = above.roots().select(F.col("tree").alias("all"), "root")
    upper = prove(above).select(
        F.col("row.tree").alias("tree"), F.col("tree").alias("all"), F.col("leaf").alias("subroot"),
        F.col("path").alias("top_path"),
    )
    upper = upper.join(F.broadcast(whole), "all").drop("all")  # one row
    return prove(below).join(broadcast_within(upper), "tree").select(
        F.col("row").dropFields("one").alias("row") if keep else "row",
        "leaf", "subroot", "root", "path", "top_path",
    )


def check_documents(docs: DataFrame) -> DataFrame:
    """Each document's leaf, subroot, root and proof, and what the proof gives for a document that
    was changed after the manifest was made: where 7 divides the CRC-32 of the doc_id, ``n_chars`` is
    one more. A null ``n_chars`` stays, so such a document still verifies. Columns beyond doc_id,
    source, lang, n_chars and text are ignored."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = leaf_digest(*[F.col(c) for c in fields])
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    changed = leaf_digest(*[F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in fields])
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(hit, changed).alias("changed"))
    proved = prove_rows(rows, F.col("leaf"), F.col("lang"), F.col("doc_id"), ["doc_id", "changed"])
    shown = F.coalesce("row.changed", "leaf")
    folded = fold(fold(shown, F.col("path")), F.col("top_path"))
    return proved.select(
        F.col("row.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        path_digest(F.col("path"), F.col("top_path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle manifest beside trees built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wardspan.llm.merkle import check_documents, fold, leaf_digest, path_digest, prove_rows

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf int, rank string, tree int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """Root, and the siblings of each leaf level by level with their side."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            paths[i].append((level[other] if other < len(level) else None, place % 2 == 1))
            at[i] = place // 2
        level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def climb(leaf, path):
    for other, left in path:
        leaf = H(*((other or "", leaf) if left else (leaf, other or "")))
    return leaf


def expected(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append((r[0] is None, r[0] or 0, leaf_of(*r[:5]), r))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: tree([leaf for _, _, leaf, _ in sorted(parts[p], key=lambda x: x[:3])]) for p in names}
    root, tops = tree([trees[p][0] for p in names])
    out = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (_, _, leaf, r), path in zip(sorted(parts[name], key=lambda x: x[:3]), paths):
            hit = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 0
            shown = leaf_of(*r[:3], r[3] + 1, r[4]) if hit and r[3] is not None else leaf
            folded = climb(shown, path + top)
            proof = H(*[d for d, _ in path + top if d])
            out.append((r[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(1,), (1, 2, 3), (700, 255, 256, 257, 1), (66_000, 5)])
def test_manifest(spark, sizes):
    rng = random.Random(len(sizes))
    names = [None, "é", "de", "", "zz"]
    rows = [
        (rng.choice([k, k, None]) if n < 1000 else k, rng.choice(["a", None]), name, rng.choice([k, None]), rng.choice(["", None, "ä" * k if k < 50 else "b"]), 1, "r", 2)
        for name, n in zip(names, sizes) for k in range(n)
    ]
    rows += rows[:3]
    got = check_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_many_parts_and_repeated_rows(spark):
    """More parts than a record holds, and one part of one row repeated: its subtrees are alike."""
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("lang"))
    again = spark.range(1500).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("lang"))
    rows = docs.unionByName(again).withColumn("row", F.lit(1))
    proved = prove_rows(rows, leaf_digest(F.col("doc_id"), F.col("lang")), F.col("lang"), F.col("doc_id"), ["doc_id"])
    folded = fold(fold(F.col("leaf"), F.col("path")), F.col("top_path"))
    out = proved.select("row.doc_id", (folded == F.col("root")).alias("ok"), "root", path_digest(F.col("path")).alias("p")).collect()
    assert len(out) == 2200 and all(r.ok for r in out) and len({r.root for r in out}) == 1


def test_no_rows(spark):
    assert check_documents(spark.createDataFrame([], DOCS)).collect() == []

"""SimHash near-duplicates beside plain Python over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from wardspan.llm import simhash
from wardspan.llm.components import components
from wardspan.llm.simhash import allocate, fingerprint, group_bits, link_fingerprints, near_duplicates


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, distance=4):
    """Smallest index each one can reach, by trying all pairs until nothing changes."""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


TEXTS = [None, "", " \t\n", "One", "one two three", "ONE two\x0bthree  four", "one two three four five",
         "É é Ünïcode Words stay", "a b c d e f g " * 40, "x" * 50_000, "y " * 30_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_chunks_do_not_matter(monkeypatch):
    text = " ".join(str(k * k % 97) for k in range(500))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text) == whole


def test_all_documents(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    base = [[rng.choice(words) for _ in range(60)] for _ in range(12)]
    texts = list(TEXTS)
    for text in base:
        for _ in range(6):
            one = list(text)
            for _ in range(rng.randrange(3)):
                one[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(one))
    texts += texts[:20]
    ids = rng.sample(range(1000), len(texts))
    rows = [(i, t, "de", 1.5) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, fp double").repartition(5)
    got = near_duplicates(docs).collect()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    fps = [plain_fingerprint(texts[k]) for k in order]
    roots = plain_components(fps)
    want = {ids[k]: (f"{fp:016x}", ids[order[r]]) for k, fp, r in zip(order, fps, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert sorted(r.doc_id for r in got if r.representative) == sorted({c for _, c in want.values()})
    assert {(r.row, r.fp) for r in got} == {("de", 1.5)}


def test_links_within_few_bits(spark):
    """Chains and dense balls around few centres, with every threshold plan."""
    rng = random.Random(2)
    fps = set()
    for _ in range(6):
        one = rng.getrandbits(64)
        for _ in range(80):
            fps.add(one)
            step = one
            for b in rng.sample(range(64), rng.randrange(6)):
                step ^= 1 << b
            one = step if rng.random() < 0.5 else one
            fps.add(step)
    fps = sorted(fps)
    roots = plain_components(fps)
    want = {frozenset(f for f, r in zip(fps, roots) if r == root) for root in set(roots)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    for parts in (4, 5, 8):
        found = components(link_fingerprints(frame, 4, parts)).collect()
        groups = {}
        for r in found:
            groups.setdefault(r.root, set()).add(r.node % 2**64)
        alone = set(fps) - {r.node % 2**64 for r in found}
        assert {frozenset(g) for g in groups.values()} | {frozenset([f]) for f in alone} == want


def test_large_groups_are_cut(monkeypatch):
    monkeypatch.setattr(simhash, "MANY", 16)
    rng = random.Random(3)
    fps = np.array(sorted({rng.getrandbits(7) << rng.choice((0, 20, 50)) for _ in range(150)}), np.uint64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(fps), np.int64)), pa.array(fps.view(np.int64))], names=["probe", "fp"]
    )
    parts = [batch.slice(0, 50), batch.slice(50, 1), batch.slice(51)]
    root = {int(f): int(f) for f in fps}
    for out in simhash._verify(4)(iter(parts)):
        for a, b in zip(*(c.to_pylist() for c in out.columns)):
            x, y = root[a % 2**64], root[b % 2**64]
            root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    want = plain_components([int(f) for f in fps])
    assert [root[int(f)] for f in fps] == [int(fps[w]) for w in want]


def test_plan():
    assert sum(allocate([[0, 5, 9, 99], [0, 1, 2, 3], [0, 50, 60, 70], [0, 5, 6, 90]], 1)) == 1
    groups = group_bits(np.eye(64) * 10, np.full(64, 10.0), 20, 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} == {16}


def test_null_ids_repeated_rows_and_no_rows(spark):
    schema = "doc_id long, text string, fingerprint int"
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 1), (3, "q r s t", 1), (3, "q r s t", 1)]
    got = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("3", "3")] * 2 + [("None", "None")] * 2
    assert sum(r.representative for r in got) == 2
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0

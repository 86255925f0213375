"""Fingerprints beside sets of shingles."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wardspan.llm.fingerprints import compare_edits, contained, merge, resemblance, sketch, with_next

DOCS = "doc_id long, text string, sketch string, bucket int, guest string"


def hashes(text):
    """All shingle hashes of a text."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    if not words:
        return []
    return sorted({hashlib.md5(" ".join(words[i : i + 5]).encode()).hexdigest()[:16] for i in range(max(len(words) - 4, 1))})


def kept(text):
    every = hashes(text)
    return [h for h in every if h < "2"] or every[:1]


def share(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def expected(rows):
    rows = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other = kept(text), kept(edited)
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(other),
                    share(own, other), share(own, kept(after)), len(own)))
    return sorted(out, key=str)


def texts(rng, n):
    words = ["Über", "a", "b.c", "naïve", "X", "12", "😀"] + [f"w{i}" for i in range(40)]
    return [rng.choice([None, "", " ", "--", "\0 z"] + [" ".join(rng.choices(words, k=rng.choice([1, 4, 5, 6, 60])))] * 9) for _ in range(n)]


@pytest.mark.parametrize("per_bucket", [None, 1])
def test_edits(spark, per_bucket, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([None, k * k, k * k, 7]), t, "s", 1, "g") for k, t in enumerate(texts(rng, 120))]
    rows += rows[:4] + [(10**12, "z" * 3, "s", 1, "g"), (-5, " ".join(f"v{i % 313}" for i in range(30_000)), "s", 1, "g")]
    if per_bucket:
        from wardspan.llm import fingerprints

        whole = fingerprints._bucket
        monkeypatch.setattr(fingerprints, "_bucket", lambda docs, _: whole(docs, per_bucket))
    got = compare_edits(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(4, "one two", "", 0, "")], DOCS)
    (row,) = compare_edits(one).collect()
    assert tuple(row) == expected([(4, "one two")])[0]
    assert compare_edits(one.filter("false")).collect() == []
    assert with_next(one.filter("false").select("doc_id", "text")).columns[-1] == "next_sketch"
    (null,) = compare_edits(spark.createDataFrame([(None, None, "", 0, "")], DOCS)).collect()
    assert (null.n_chars, null.fingerprint, null.near_edited, null.near_next) == (0, "", 1.0, 1.0)


def test_merge_and_estimates(spark):
    """A sketch of parts is the sketch of the whole, and estimates are near the truth for unequal sizes."""
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    parts = [" ".join(long[a : a + 2000]) for a in range(0, 20_000, 2000)]
    df = spark.createDataFrame([(" ".join(long), parts[3], "two words", "other words")], "whole string, part string, a string, b string")
    s = {c: sketch(F.col(c)) for c in df.columns}
    row = df.select(
        contained(s["part"], s["whole"]).alias("inside"), contained(s["whole"], s["part"]).alias("share"),
        resemblance(s["part"], s["whole"]).alias("like"), contained(s["a"], s["b"]).alias("none"),
        merge(s["a"], s["b"]).alias("short"), (merge(s["part"], s["whole"]) == s["whole"]).alias("absorbed"),
        merge(s["a"], s["part"]).alias("mixed"), s["part"].alias("alone"),
    ).first()
    assert row.inside == 1 and row.none == 0 and row.absorbed and abs(row.share - 0.1) < 0.03 and abs(row.like - 0.1) < 0.03
    low = [h for h in row.mixed if h < "2"]
    assert row.mixed == low and set(row.alone) <= set(low)
    short = kept("two words") + kept("other words")
    assert row.short == ([h for h in sorted(short) if h < "2"] or [min(short)])

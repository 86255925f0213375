"""Chat formatting, mixing, decontamination, line deduplication and sharding beside plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardspan.llm.chat import chat_digest, escape, format_chats, read_turns, unescape
from wardspan.llm.decontamination import decontaminate, mark_contamination
from wardspan.llm import linededup
from wardspan.llm.linededup import dedup_lines, suffix_array
from wardspan.llm.mixing import chance, mix
from wardspan.llm.sharding import RING, bounds, deal, ring_points, shard

DOCS = "doc_id long, text string, source string, size int, row string, law double"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# Chat formatting

NASTY = [r"\### Assistant: </turn> ok", "<turn:user>\n", "<next/>", r"<\\/turn>", "<", "<\\", "", None, "a\n</turn>\nb"]


def test_escapes_are_reversible(spark):
    texts = [a + b for a in NASTY[:7] for b in NASTY[:7]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in got)
    assert not any(re.search("<(turn:|/turn>|next/>)", r.e) for r in got)


@pytest.mark.parametrize("block", [1, 2, 256])
def test_chats(spark, block):
    rng = random.Random(block)
    rows = [
        (c, t, rng.choice(["user", "assistant", "assistant", "a>b%3E<", None]), rng.choice(NASTY), 1)
        for c in (1, 2, None) for t in range(12)
    ]
    rows += [(4, None, "assistant", "late", 1), (4, None, "assistant", "late", 1), (4, -3, "user", None, 1)]
    rng.shuffle(rows)
    chats = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted int"), block=block)
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in chats.select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()}
    want = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert read == want
    for r in chat_digest(chats).collect():
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()


def test_no_chats(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_digest(format_chats(empty)).count() == 0


# Mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Cut off what is too much and share it out again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()) * share, {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        now = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if now[s] > most * sizes[s] + 1e-9]
        if not over:
            return fixed | now
        fixed |= {s: most * sizes[s] for s in over}


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randrange(1, 40)) if rng.random() < 0.9 else None,
             rng.choice(["b", "a", None, "ä", "Z", "tiny"] + ["a"] * 4), 7, "r", 0.5) for i in range(3000)]
    rows = [r for r in rows if r[2] != "tiny"] + [(9000, "one two", "tiny", 7, "r", 0.5), (None, None, "none", 7, "r", 0.5)]
    rows += rows[:5]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = mix(docs).collect()
    assert len(got) == len(rows) and {(r.row, r.law) for r in got} == {("r", 0.5)}
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.copies in (0, 1, 2)
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    want = plain_targets({s: sizes[s] for s in sizes})
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    longest = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= longest / 2 for s in sizes if s != "tiny")
    again = mix(docs.repartition(2)).collect()
    assert sorted((r.doc_id or -1, r.copies) for r in got) == sorted((r.doc_id or -1, r.copies) for r in again)


def test_mixing_takes_by_chance(spark):
    """Within a source, whoever is taken once more has the smaller numbers."""
    docs = spark.createDataFrame([(i, "a b", "x" if i % 3 else "y", 0, "", 0.0) for i in range(300)], DOCS)
    got = mix(docs).withColumn("u", chance()).collect()
    for s in "xy":
        own = sorted((r.u, r.copies) for r in got if r.source == s)
        assert [c for _, c in own] == sorted((c for _, c in own), reverse=True)
    assert mix(docs.limit(0)).count() == 0


# Decontamination


def plain_hits(text, items, n=10):
    def cut(t):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered) if w]

    words, hit, found = cut(text), set(), set()
    for k, item in items:
        own = cut(item)
        for at in range(max(1, len(own) - n + 1) if own else 0):
            window = own[at : at + n]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(k)
    return len(words), len(hit), found - {None}


def test_contamination(spark):
    rng = random.Random(6)
    vocab = ["a", "B", "É", "ß", "x1"]

    def some(n):
        return rng.choice([" ", ", ", "\n", "\0"]).join(rng.choice(vocab) for _ in range(n))

    items = [(k, some(rng.choice([3, 5, 10, 14]))) for k in range(12)] + [(3, some(4)), (None, "É É ß"), (50, None), (51, "--")]
    long = [some(9) + ". " + items[k][1].upper().replace("É", "É") + " -- " + some(7) for k in range(12)]
    texts = [None, "", "...", some(2), *long, *[some(30) for _ in range(10)], "a " * 5000 + items[0][1]]
    rows = [(i, t, "s", 1, "r", 0.1) for i, t in enumerate(texts + texts[4:7])]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1, 500_000):  # shuffled and broadcast
        for r in mark_contamination(docs, bench, broadcast_windows=limit).collect():
            n, hit, found = plain_hits(r.text, items)
            ids = ",".join(sorted(map(str, found)))
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0), r.doc_id
            assert r.items_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    clean = {r[0] for r in rows if not plain_hits(r[1], items)[1]}
    assert {r.doc_id for r in decontaminate(docs, bench).collect()} == clean
    spans = {r.doc_id: r.text for r in decontaminate(docs, bench, remove="spans").collect()}
    for r in rows:
        n, hit, _ = plain_hits(r[1], items)
        assert plain_hits(spans[r[0]], [])[0] == n - hit
        assert hit or spans[r[0]] == r[1]
    nothing = mark_contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert nothing == 0 and mark_contamination(docs.limit(0), bench).count() == 0


# Lines


def plain_dedup(docs, least):
    seen, gone = set(), {}
    for d, text in enumerate(docs):
        lines = [(i, x) for i, x in enumerate((text or "").split("\n")) if x.split()]
        for p in range(len(lines)):
            words, q = 0, p
            while q < len(lines) and words < least:
                words += len(lines[q][1].split())
                q += 1
            if words < least:
                break
            run = tuple(x for _, x in lines[p:q])
            if run in seen:
                gone.setdefault(d, set()).update(i for i, _ in lines[p:q])
            seen.add(run)
    return [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ()))
            for d, t in enumerate(docs)]


@pytest.mark.parametrize("least", [1, 5, 12])
def test_lines(spark, least):
    rng = random.Random(least)
    vocab = [" ".join(rng.choice("pqr") for _ in range(rng.randrange(0, 5))) for _ in range(9)] + ["", " ", "x"]
    texts = [None, "", "x", "x\n" * 40, *["\n".join(rng.choice(vocab) for _ in range(rng.randrange(1, 25))) for _ in range(40)]]
    texts += texts[5:12]
    rows = [(i, t, "s", 1, "r", 0.1) for i, t in enumerate(texts)]
    got = dedup_lines(spark.createDataFrame(rows, DOCS).repartition(3), least).orderBy("doc_id").collect()
    assert [r.text for r in got] == plain_dedup(texts, least)
    assert all(r.n_lines == (len(t.split("\n")) if t is not None else 0) for r, t in zip(got, texts))
    assert {(r.row, r.law) for r in got} == {("r", 0.1)}
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_suffix_array_is_finished(spark, monkeypatch):
    """Runs far longer than ``least`` words are told apart too, copies in blocks of the scan included."""
    monkeypatch.setattr(linededup, "_BLOCK", 4)
    rng = random.Random(3)
    long = [rng.choice("ab") for _ in range(70)]
    docs = [long, [*long, "c"], ["x", *long], ["a"] * 40, ["a"] * 33, [*long[:50], "y"], ["a"], [], ["z", "a"], ["a", "c"], ["a", "w"]]
    places = [(d, p, (False, d), bytes([ord(x)]), 2 if p + 1 < len(doc) else None) for d, doc in enumerate(docs) for p, x in enumerate(doc)]
    schema = "row long, pos long, first struct<n: boolean, d: long>, line binary, length long"
    got = suffix_array(spark.createDataFrame(places, schema).repartition(3), 2).orderBy("at").collect()
    often = Counter(x for doc in docs for x in doc)

    def suffix(place):
        d, p = place
        return [(0, x) if often[x] > 1 else (1, d, q) for q, x in enumerate(docs[d][p:], p)], d, p

    assert [(r["row"], r["pos"]) for r in got] == sorted(((d, p) for d, p, *_ in places), key=suffix)
    assert [r["at"] for r in got] == list(range(1, len(places) + 1))
    texts = ["\n".join(doc) for doc in docs]
    found = dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2).orderBy("doc_id")
    assert [r.text for r in found.collect()] == plain_dedup(texts, 2)


# Sharding


def plain_deal(positions, points, room):
    """One by one: own rows of each arc first, then what is left clockwise, in ring order."""
    room, where, over = list(room), {}, []
    arcs = [[] for _ in points]
    for key in sorted(positions):
        at = next((i for i, (p, _) in enumerate(points) if p >= key[0]), 0)
        arcs[at].append(key)
    for at, keys in enumerate(arcs):
        shard_no = points[at][1]
        keys.sort(key=lambda k: ((k[0] - points[-1][0] - 1) % RING, k[1:]))
        for key in keys:
            if room[shard_no]:
                room[shard_no] -= 1
                where[key] = shard_no
            else:
                over.append((at, key))
    waiting = []
    for step in range(2 * len(points)):
        at = step % len(points)
        if step < len(points):
            waiting += [k for a, k in over if a == at]
        while waiting and room[points[at][1]]:
            room[points[at][1]] -= 1
            where[waiting.pop(0)] = points[at][1]
    return where


def test_ring(spark):
    rng = random.Random(8)
    texts = [None, "", "hot"] + [f"text {k}" for k in range(150)]
    rows = [(i, rng.choice(texts) if rng.random() < 0.6 else "hot", None, i, "r", 0.0) for i in range(700)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = shard(docs, shards=5, replicas=8).collect()
    assert len(got) == len(rows) and {(r.row, r.grown_shard) for r in got} == {("r", None)}
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(5))
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    def position(text):
        return int(hashlib.md5((text or "").encode()).hexdigest()[:13], 16)
    keys = [(position(t), i) for i, t, *_ in rows]
    want = plain_deal(keys, ring_points(5, 8), bounds(len(rows), 5, 0))
    assert {(position(r.text), r.doc_id): r.shard for r in got} == want
    assert all(r.size == len((r.text or "").encode()) + 8 for r in got)


def test_ring_edges(spark):
    assert shard(spark.createDataFrame([], DOCS)).count() == 0
    same = spark.createDataFrame([(None, None, None, None, None, None)] * 30, DOCS)
    got = shard(same).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [1] * 18 + [2] * 6
    assert {r.size for r in got} == {8}
    loose = shard(spark.createDataFrame([(i, str(i), None, 0, "", 0.0) for i in range(400)], DOCS), 4, slack=0.25)
    assert max(Counter(r.shard for r in loose.collect()).values()) <= 125


def test_adding_a_shard_moves_little():
    rng = random.Random(9)
    rows = 24_000
    keys = [rng.randrange(RING) for _ in range(rows)]

    def placed(shards):
        points = ring_points(shards, 64)
        order = sorted(keys, key=lambda k: (k - points[-1][0] - 1) % RING)
        from bisect import bisect_left

        spots = [p for p, _ in points]
        arcs = Counter(bisect_left(spots, k) % len(spots) for k in keys)
        where = {}
        for _, first, last, s, _ in deal(arcs, points, bounds(rows, shards, 0)):
            for at in range(first - 1, last):
                where[order[at]] = s
        return where

    before, after = placed(24), placed(25)
    assert sum(before[k] != after[k] for k in before) < 0.35 * rows

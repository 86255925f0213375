"""Language ID, neighbours, LM scoring, WARC and the pipeline on hand-made tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as driver
from wardspan.llm import langid, warc
from wardspan.llm.common import crc_of_id
from wardspan.llm.lm import huffman, log10_paths, log10_words, score_texts, train, train_paths
from wardspan.llm.neighbours import lines, nearest
from wardspan.llm.queries import op1_language_id, op2_nearest_neighbours
from wardspan.runtime import fresh_folder

SMALL = "/root/testdata/sf0.001"
WORDS = {"x": "ba be bi bo bu da de di".split(), "y": "kra kre kri stro stru gla glo".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


# Language ID


def test_pieces_do_not_matter(monkeypatch):
    text = text_of(random.Random(0), "y", 300)
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "PIECE", 50)
    assert (langid.presence(text) == whole).all()


def test_language_id(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, l, rng.randrange(3, 60)), l) for i in range(80) for l in "xy"] + [(900, None, "x"), (901, "12 ! ", "y"), (902, text_of(rng, "x", 9), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, per_lang=30, landmarks=20)
    odd = [(1, None, 5), (2, "", 5), (3, "42 --", 5), (4, text_of(rng, "y", 30_000), 5), (5, text_of(rng, "x", 40), 5), (5, "É", 5)]
    got = langid.identify(spark.createDataFrame(odd, "doc_id long, text string, score int"), model).collect()
    assert [r.lang_pred for r in got][:5] == ["und", "und", "und", "y", "x"] and got[5].lang_pred in "xy"
    assert all(0 <= r.score <= 1 for r in got) and got[0].score == 0
    kept = langid.reject_unknown(spark.createDataFrame(odd, "doc_id long, text string, found int"), model)
    assert kept.columns == ["doc_id", "text", "found"] and [r.doc_id for r in kept.collect()] == [4, 5, 5]
    empty = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_kernel():
    """Bits are the n-grams of the folded text, and a batch's scores are kernel values times weights."""
    a, b = langid.presence("Ab, c"), langid.presence("aB\n\n c!")
    assert (a == b).all() and 0 < a.sum() <= 5 + 4 + 3 + 2 + 4
    model = langid.solve(np.array([a, langid.presence("zz")]), ["p", "q"], 2, 1e-6)
    assert np.allclose(model.scores(np.array([a])), [[1, 0]], atol=1e-2)


def test_held_out_accuracy(spark):
    got = op1_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    right = got.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


# Neighbours


def plain_nearest(vectors, queries, k):
    out = {}
    for q, x in queries:
        others = [(-float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), i) for i, y in vectors if i != q]
        out[q] = sorted(others)[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    vectors = [(i, (centres[i % 6] + 0.4 * rng.standard_normal(16)).astype(np.float32)) for i in range(600)]
    vectors += [(i, vectors[0][1]) for i in range(600, 700)]
    bad = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] * 16), (904, []), (905, [None] * 16), (None, [1.0] * 16)]
    rows = [(i, [float(x) for x in v]) for i, v in vectors] + bad + [(7, [float(x) for x in vectors[7][1]])]
    rows += [(950, [1.0, 2.0]), (951, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for r in nearest(df, df.filter("vec_id % 50 = 0 OR vec_id = 901"), block=200, query_block=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    wide = [(i, v.astype(np.float64)) for i, v in vectors]
    want = plain_nearest(wide, [w for w in wide if w[0] % 50 == 0], 5)
    assert got.pop(950) == [(1, 951, pytest.approx(0.8))]
    assert got.keys() == want.keys()
    right = sum(len({v for _, v, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert right >= 0.9 * 5 * len(want)
    assert [v for _, v, _ in got[0]] == [600, 601, 602, 603, 604]  # ties to smaller ids
    by_id = dict(wide)
    for q, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        for _, v, s in found:
            assert s == pytest.approx(np.dot(by_id[q], by_id[v]) / np.linalg.norm(by_id[q]) / np.linalg.norm(by_id[v]), abs=1e-12)
    assert nearest(df.limit(0), df).count() == 0


def test_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    vectors = [(r.vec_id, np.array(r.embedding, np.float64)) for r in df.collect()]
    want = plain_nearest(vectors, [v for v in vectors if v[0] % 50 == 0], 5)
    one = op2_nearest_neighbours(spark, sf).collect()
    many = nearest(df, df.filter("vec_id % 50 = 0"), block=600, query_block=16).collect()
    for rows in (one, many):
        got = {(r.query_id, r.vec_id) for r in rows}
        assert sum((q, i) in got for q, found in want.items() for _, i in found) >= 0.95 * 5 * len(want)
        verified = {r.query_id: r.verified for r in rows}
        assert sum(verified.values()) <= 0.2 * len(want) * len(vectors)


def test_lines_are_orthogonal():
    drawn = lines(16, 40)
    assert drawn.shape == (40, 16)
    for at in range(0, 40, 16):
        basis = drawn[at : at + 16]
        assert np.allclose(basis @ basis.T, np.eye(len(basis)))


# LM scoring


def test_scores(spark):
    rng = random.Random(3)
    rows = [(i, text_of(rng, l, 30).title(), l, 1) for i in range(150) for l in "xy"]
    rows += [(1000, None, "x", 1), (1000, None, "x", 1), (1001, " \t\n", None, 1), (1002, "É é\x0bstro", None, 1), (None, text_of(rng, "x", 4000), "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").repartition(3)
    held_out = F.pmod(F.coalesce("doc_id", F.lit(3)), F.lit(10)) == 0
    results = [
        score_texts(d, held_out, keep=["doc_id", "text"], coded=50, frequent=f).collect()
        for d, f in ((docs, 10), (docs.repartition(7, "text"), 10_000))
    ]
    def cut(t):
        return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w] + [""]
    trained = Counter(w for i, t, *_ in rows if (i if i is not None else 3) % 10 for w in cut(t))
    n, v = sum(trained.values()), len(trained)
    for r in results[0]:
        tokens = cut(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in trained for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((trained[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
        assert r.score < 0 and r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / (len(" ".join(tokens[:-1]).encode()) + (len(tokens) > 1) + 1))
    keyed = [sorted((str(r.doc_id), r.text or "", round(r.score, 8), round(r.base_score, 6)) for r in x) for x in results]
    assert keyed[0] == keyed[1]  # both ways to look a word up, and rows dealt in another way
    tests = [r for r in results[0] if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in tests) > sum(r.base_score for r in tests)
    assert score_texts(docs.limit(0), held_out).count() == 0
    nothing = score_texts(docs.limit(5), F.lit(True), keep=["doc_id"]).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing)


def test_order_of_words_counts(spark):
    """Texts that follow a rule from word to word score higher than the same words shuffled."""
    rng = random.Random(8)
    names = [f"w{i}" for i in range(40)]

    def follow(n):
        at, out = rng.randrange(40), []
        for _ in range(n):
            at = (at * 3 + rng.choice([1, 7])) % 40
            out.append(names[at])
        return out

    rows = [(i, follow(60)) for i in range(300)]
    held = [(1000 + i, follow(60)) for i in range(20)]
    mixed = [(2000 + i - 1000, rng.sample(w, len(w))) for i, w in held]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows + held + mixed], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_texts(docs, F.col("doc_id") >= 1000).collect()}
    base = {r.doc_id: r.base_score for r in score_texts(docs, F.col("doc_id") >= 1000).collect()}
    assert all(got[i] > got[i + 1000] + 20 and got[i] > base[i] + 30 for i, _ in held)


def test_paths(spark):
    """What may come next shares out its probability; counts after a context are those of the texts."""
    texts = ["a b c a b", "b c", "", "a é zz"] * 30
    rows = spark.createDataFrame([(t, False) for t in texts], "text string, held_out boolean")
    words = [b"a", b"b", b"c"]
    paths = huffman(words, [60, 120, 90, 90, 60])
    model = train_paths(rows, paths, 420)
    for history in ([], [b"a"], [b"b", b"c"], [b"zz"]):
        before = log10_paths([history], model)[0] if history else 0.0
        after = [log10_paths([[*history, w]], model)[0] for w in (b"q", b"", *words)]
        assert sum(10 ** (x - before) for x in after) == pytest.approx(1, abs=1e-5)
    codes = [paths.starts[i + 1] - paths.starts[i] for i in range(5)]
    bits = sum(codes[paths.ids.get(w, 0)] for t in texts for w in [*t.encode().split(), b""])
    assert model.tables[0].sum() == model.tables[1].sum() == bits
    together, apart = log10_paths([[b"a", b"b"], [b"c"], [b""]], model), [[b"a", b"b"], [b"c"], [b""]]
    assert [log10_paths([t], model)[0] for t in apart] == pytest.approx(list(together), abs=1e-12)
    assert log10_paths([[b"a", b"b"]], model)[0] > log10_paths([[b"b", b"a"]], model)[0]


def test_every_text_and_word_teaches(spark, monkeypatch):
    """The weights are learned from all there is, however much that is said to be; a copy adds nothing."""
    from wardspan.llm import lm

    taught, learned = [], lm._learned

    def noted(rows, *more):
        taught.append(sorted(r[1] for r in rows.collect()))
        return learned(rows, *more)

    monkeypatch.setattr(lm, "_learned", noted)
    texts = [f"a b c{i}" for i in range(300)]
    rows = spark.createDataFrame([(t, False) for t in texts * 2], "text string, held_out boolean")
    train_paths(rows, huffman([b"a", b"b"], [1, 1, 600, 600]), 1_000_000_000)
    train(spark.createDataFrame([(t.split()[-1], 2) for t in texts], "word string, n long"), 1_000_000_000)
    assert taught == [sorted(texts), sorted(t.split()[-1] for t in texts)]
    assert (lm.buckets(0, 10), lm.buckets(501, 10), lm.buckets(1 << 40, 10)) == (16, 51, 128)


def test_long_text_in_pieces(spark, monkeypatch):
    """Contexts go on over the pieces that a long text is worked on in."""
    from wardspan.llm import lm

    rows = spark.createDataFrame([("a b c a b c " * 50, False)], "text string, held_out boolean")
    model = train_paths(rows, huffman([b"a", b"b", b"c"], [1, 1, 100, 100, 100]), 301)
    text = [b"a", b"b", b"c"] * 40 + [b"x", b"a"]
    whole = log10_paths([text], model)[0]
    monkeypatch.setattr(lm, "BATCH", 7)
    assert log10_paths([text], model)[0] == pytest.approx(whole, abs=1e-9)


def test_probabilities_add_up(spark):
    """What may follow a prefix shares out its probability: whatever is asked for, the first bytes
    of all words and the end never come to more than one."""
    words = spark.createDataFrame([("aba", 5), ("abc", 2), ("", 3), ("dé", 1)], "word string, n long")
    model = train(words, 4)

    def p(*words):
        return (10 ** log10_words(list(words), model)).sum()

    letters = [bytes([c]) for c in range(256) if c not in (9, 10, 11, 12, 13, 32)]
    assert p(b"", *letters) < 1 and p(b"", *letters, *[x + y for x in letters[65:100] for y in letters]) < 1
    assert p(b"aba") > p(b"abz") and p(b"") > p(b"q")


# WARC


@pytest.mark.parametrize("block", [7, 700, 1 << 20])
def test_archive(spark, block):
    rng = random.Random(4)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    htmls = [None, "", "é" * 900, fake, f"x{fake * 3}y", "WARC/1.1\r\n", "\r\n\r\n", "same", "same", "same", None] + ["a" * rng.randrange(2000) for _ in range(20)]
    rows = [(i * 3, rng.choice([None, "http://e.x/\r\nWARC/1.1", "u"]), h, 1) for i, h in enumerate(htmls)]
    rows += [(None, "u", "lone", 1), (24, "u", "same", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(2)
    folder = fresh_folder(spark, "test-warc")
    warc.write_archive(pages, folder, records_per_file=6)
    records = warc.read_archive(spark, folder, block)
    got = sorted((tuple(r) for r in warc.page_digests(records).collect()), key=str)
    largest = {}
    for i, _, h, _ in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h, _ in rows:
        data, keep = (h or "").encode(), largest[h or ""]
        kept = i == keep or i is None
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if kept else "revisit", None if kept else keep))
    assert got == sorted(want, key=str)


def test_small_payloads_are_all_responses(spark):
    folder = fresh_folder(spark, "test-warc")
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write_archive(pages, folder, least_bytes=3)
    got = {r.page_id: r.refers_to for r in warc.page_digests(warc.read_archive(spark, folder)).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_broken_and_empty_archives(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = fresh_folder(spark, "test-warc")
    warc.write_archive(pages, folder)
    assert warc.read_archive(spark, folder).count() == 0
    folder = fresh_folder(spark, "test-warc")
    spark.createDataFrame([("WARC/1.1\r\nContent-Length: 50\r\n\r\nabc",)], "v string").write.option("lineSep", "\r\n\r\n").text(folder)
    with pytest.raises(ValueError, match="do not lead"):
        warc.read_archive(spark, folder)


# Pipeline


def test_pipeline(spark):
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = raw
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontamination", "mixing", "sharding"]
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(spark, docs, SMALL)
        if name != "sharding":
            assert docs.columns == raw.columns
            assert docs.exceptAll(raw if name != "mixing" else docs).count() == 0
            assert name == "mixing" or docs.count() <= before.count()
    assert corpus_pipeline.run(spark, SMALL).drop("slot").exceptAll(docs.drop("slot")).count() == 0


def test_registered():
    names = [n for n in driver.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in driver.queries()

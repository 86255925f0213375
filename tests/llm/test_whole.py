"""Long texts, large sets and many copies: where a part of the job could be lost."""

from __future__ import annotations

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from wardspan.llm import langid, warc
from wardspan.llm.common import crc_of_id
from wardspan.llm.decontamination import mark_contamination
from wardspan.llm.mixing import mix
from wardspan.llm.sharding import shard
from wardspan.runtime import fresh_folder

LARGE = "/root/testdata/sf0.1"

# Decontamination


def test_shuffled_windows_are_narrow(spark):
    """Beyond the broadcast, a shuffle moves a row a window; no such row may hold a text's words."""
    words = [f"w{i % 997}x{i % 13}" for i in range(3000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "none of these"), (2, " ".join(words))], "doc_id long, text string")
    items = [(7, " ".join(words[2980:])), (8, " ".join(words[100:112])), (9, " ".join(words[100:109] + ["other"])), (10, "None, of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a set that really is large
    try:
        compare_shuffled(spark, docs, bench)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def compare_shuffled(spark, docs, bench):
    marked = mark_contamination(docs, bench, broadcast_windows=0)
    text = marked._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert moved and not [m for m in moved if re.search(r"\bword_hashes#|\bwords#", m)]
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in marked.collect())
    broadcast = mark_contamination(docs, bench)
    assert got == sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in broadcast.collect())
    assert got == [(1, 3000, 32, 2), (2, 3, 2, 1), (2, 3000, 32, 2)]


# Language ID


def test_megabytes_of_given_languages(spark):
    """Held-out texts joined to megabytes still get their language, with a score like that of one."""
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "text", "lang").filter("lang IS NOT NULL")
    held_out = crc_of_id("doc_id") % 5 == 0
    model = langid.fit(docs.filter(~held_out))
    texts = {}
    for r in docs.orderBy("doc_id").select("lang", "text", held_out.alias("h")).collect():
        texts.setdefault(r.lang, ([], []))[r.h].append(r.text or "")
    rows = []
    for lang, (rest, some) in texts.items():
        rows += [(lang, "\n".join(some + rest)[:3_000_000]), (lang, "\n".join(some)[:100_000])]
    got = langid.identify(spark.createDataFrame(rows, "lang string, text string"), model).collect()
    found = [(r.lang, len(r.text), r.lang_pred, round(r.score, 2)) for r in got]
    assert len(texts) > 2 and all(a == b and score > 0.6 for a, _, b, score in found), found


def test_copies_do_not_hide_a_language(spark):
    """Few texts with many copies each: the draw is among distinct texts. Rare languages and texts
    without letters do not crowd each other out either."""
    texts = [(f"kra stro gla {'blu' * k} nok", "y") for k in range(3)]
    copied = spark.createDataFrame(texts, "text string, lang string").crossJoin(spark.range(3000)).drop("id")
    marks = spark.range(5000).select(F.concat(F.lit("-- "), "id").alias("text"), F.lit("z").alias("lang"))
    one = spark.createDataFrame([("ba be bi bo bu", "z")], "text string, lang string")
    many = spark.range(400).selectExpr("concat('da de di ', repeat('do', id % 40), ' ', repeat('du', id div 40)) text", "concat('l', id % 20) lang")
    docs = copied.unionByName(marks).unionByName(one).unionByName(many)
    model = langid.fit(docs, per_lang=2, most=30, landmarks=20)
    assert model.languages == sorted(["y", "z", *[f"l{i}" for i in range(20)]])
    sample = langid.labelled_sample(copied, 400, 4000).collect()
    assert sorted((r.text, r.lang) for r in sample) == sorted(texts)


def test_long_texts_are_cut_in_one_pass(spark):
    """Windows of all widths across the pieces of a text; a window never meets the words of a whole text."""
    words = [f"w{i % 997}x{i % 13}" for i in range(100_000)]
    places = [0, 57, 63, 64, 70, 127, 128, 5000, 99_990]
    items = [(k, " ".join(words[p : p + 10])) for k, p in enumerate(places)]
    items += [(20, "alpha, beta"), (21, "gamma"), (22, " ".join(words[99_997:])), (23, "nowhere at all")]
    text = " ".join(words)
    docs = spark.createDataFrame([(1, text), (2, "Alpha Beta gamma"), (3, "alpha"), (4, None), (5, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in mark_contamination(docs, bench).collect()}
    hit = set()
    for _, item in items:
        part = item.replace(",", "").split()
        for p in range(len(words) - len(part) + 1):
            if words[p] == part[0] and words[p : p + len(part)] == part:
                hit |= set(range(p, p + len(part)))
    assert got == {1: (100_000, len(hit), 10), 2: (3, 3, 2), 3: (1, 0, 0), 4: (0, 0, 0), 5: (0, 0, 0)}


# Rows that repeat, and columns of any name


def test_a_repeated_row_meets_its_target(spark):
    """Rows alike in id and text are drawn one by one, and columns may have the operators' names."""
    one = spark.range(200).select(F.lit(7).cast("long").alias("doc_id"), F.lit("five words are in here").alias("text"), F.lit("a").alias("source"))
    rest = spark.range(400).selectExpr("id AS doc_id", "concat('t', id, ' two') AS text", "'b' AS source")
    names = ("whole", "cut", "u", "key", "source_key", "doc", "_position", "_start", "_inner", "_bucket", "arc", "at", "first", "rest", "turn", "Size")
    docs = one.unionByName(rest).withColumns({n: F.lit("keep") for n in names})
    for _ in range(2):
        rows = mix(docs, weights=(5, 20)).collect()
        assert len(rows) == 600 and all(r[n] == "keep" for r in rows for n in names if n != "Size")
        for source in "ab":
            some = [r for r in rows if r.source == source]
            assert abs(sum(r.size * r.copies for r in some) - some[0].target) <= 5, source
    placed = shard(docs, shards=7).collect()
    assert len(placed) == 600 and all(r[n] == "keep" for r in placed for n in names if n != "Size")


# WARC


@pytest.mark.parametrize("block", [1000, 1 << 20])
def test_headers_longer_than_blocks(spark, block):
    """A url may be as long as it likes; what looks like a record in a payload is none."""
    false = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n"
    rows = [
        (1, "http://a/" + "u" * 70_000, "one"),
        (2, "http://b/" + "v" * 1_300_000, false + "y" * 2000),
        (3, None, "one"),
        (4, "http://c/", "WARC/1.1\r\n" * 50 + "end"),
        (5, "http://d/" + "w" * 66_000, "é" * 50_000 + "\r\n\r\n" + false * 3),
    ]
    folder = fresh_folder(spark, "long-heads")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    records = warc.read_archive(spark, folder, block)
    got = {r.page_id: tuple(r)[1:] for r in warc.page_digests(records).collect()}
    code = lambda html: base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    want = {k: (len(h.encode()), code(h), "response", None) for k, _, h in rows}
    want[1] = (3, code("one"), "revisit", 3)
    assert got == want
    assert sorted(len(r.url or "") for r in records.collect()) == sorted(len(u or "") for _, u, _ in rows)


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_MOST", 20_000)
    rows = [(k, "u", "z" * (9000 if k == 5 else 10)) for k in range(12)]
    folder = fresh_folder(spark, "small-files")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    sizes = [r.length for r in spark.read.format("binaryFile").load(folder).select("length").collect()]
    assert len(sizes) >= 6 and max(sizes) <= 20_000
    assert warc.read_archive(spark, folder).count() == 12

"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned against token windows.

A window of the benchmark is ``n`` consecutive words of an item, or the whole item if it has fewer.
Documents are cut into pieces of ``PIECE`` places, and these into windows of the same widths, so that
no row of a window carries more than its piece, however long the text is. The hash of a window's first
words is looked up first, as most windows end there; those that begin like one of the benchmark are
looked up as a whole in the broadcast set, and what is found is verified word by word. Only verified
hits are shuffled. A set too large to broadcast is joined by a shuffle that moves one hash and place a
window; the words are fetched for the windows that are found, and verified there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.llm.common import fresh_name, plain_words
from wardspan.runtime import BROADCAST_BYTES, stage

# The words of a text as it stands, upper case included, and what lies between them.
_WORD, _GAP = r"[0-9A-Za-z\P{ASCII}]", r"[\p{ASCII}&&[^0-9A-Za-z]]"

# Windows that may be broadcast, at about 200 bytes each. Beyond, the join is shuffled.
BROADCAST_WINDOWS = 500_000
LEAD = 4  # words that are looked up first
PIECE = 64  # places of a text whose windows are cut from one row


def _window_hash(word_hashes: Column, start: Column, width: int) -> Column:
    # Single elements are read in place; a slice would copy the whole text for each window.
    return F.xxhash64(*[F.get(word_hashes, start + k) for k in range(width)])


def _windows(words: Column, width: int, first: int) -> tuple[Column, Column]:
    """Hashes of the words, and of the ``first`` words of all windows of ``width`` words, given those."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.sequence(F.lit(0), F.size("word_hashes") - width)
    windows = F.transform(starts, lambda i: _window_hash(F.col("word_hashes"), i, first))
    none = F.array().cast("array<bigint>")
    return hashes, F.when(F.size("word_hashes") >= width, windows).otherwise(none)


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct windows of all items: hash, width, words, and the item_ids that have them."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("words")).filter(
        F.size("words") > 0
    )
    width = F.least(F.size("words"), F.lit(n))
    cut = F.transform(
        F.sequence(F.lit(1), F.size("words") - width + 1), lambda i: F.slice("words", i, width)
    )
    return (
        items.select("item_id", F.explode(cut).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
        .select(F.size("window").alias("width"), "window", "items")
    )


def _pieces(words: Column, reach: int) -> Column:
    """``PIECE`` places each, with the words up to ``reach`` beyond. The words are bound to a name in
    the expression, as slicing an array that was written to a row copies all of it."""

    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(PIECE))
        return F.transform(
            starts, lambda s: F.struct(s.alias("start"), F.slice(words, s + 1, PIECE + reach).alias("words"))
        )

    return F.get(F.transform(F.array(words), cut), F.lit(0))


def _broadcast_hits(raw: DataFrame, grams: DataFrame, widths: list[int]) -> DataFrame:
    """Hits of all ``widths``, which are cut in one pass."""
    pieces = raw.select("text_md5", F.explode(_pieces(plain_words(F.col("text")), max(widths) - 1)).alias("p"))
    pieces = pieces.select("text_md5", F.col("p.start").alias("start"), F.col("p.words").alias("words"))
    hashed = pieces.withColumn("word_hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def windows(width: int) -> Column:
        first = min(LEAD, width)
        last = F.least(F.size("word_hashes") - width, F.lit(PIECE - 1))
        cut = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                i.alias("at"), F.lit(width).alias("width"), _window_hash(F.col("word_hashes"), i, first).alias("lead")
            ),
        )
        none = F.array().cast("array<struct<at:int,width:int,lead:bigint>>")
        return F.when(F.size("word_hashes") >= width, cut).otherwise(none)

    def by_width(at: Column, upto) -> Column:
        """Hash of a window of any of the widths."""
        found = F.lit(None).cast("long")
        for width in widths:
            found = F.when(F.col("width") == width, _window_hash(F.col("word_hashes"), at, upto(width))).otherwise(found)
        return found

    zero = F.lit(0)
    leads = grams.select("width", by_width(zero, lambda w: min(LEAD, w)).alias("lead")).distinct()
    grams = grams.select("width", by_width(zero, lambda w: w).alias("hash"), "window", "items")
    cut = windows(widths[0]) if len(widths) == 1 else F.concat(*[windows(w) for w in widths])
    spread = hashed.select("text_md5", "start", "words", "word_hashes", F.explode(cut).alias("w"))
    spread = spread.select("text_md5", "start", "words", "word_hashes", "w.*")
    alike = spread.join(F.broadcast(leads), ["width", "lead"], "left_semi")  # no more than windows
    alike = alike.withColumn("hash", by_width(F.col("at"), lambda w: w))
    real = F.slice("words", F.col("at") + 1, F.col("width")) == F.col("window")
    found = alike.join(F.broadcast(grams), ["width", "hash"]).filter(real)
    return found.select("text_md5", (F.col("start") + F.col("at")).alias("at"), "width", "items")


def _shuffled_hits(raw: DataFrame, texts: DataFrame, grams: DataFrame, width: int) -> DataFrame:
    """Rows that are shuffled have a fixed size a window, or one text each: never a text a window."""
    hashes, cut = _windows(F.col("words"), width, width)
    keys = grams.select(_window_hash(F.col("word_hashes"), F.lit(0), width).alias("hash"))
    spread = texts.select(F.unhex("text_md5").alias("md5"), hashes.alias("word_hashes")).select(
        "md5", F.posexplode(cut).alias("at", "hash")
    )
    places = spread.join(keys, "hash", "left_semi").groupBy("md5").agg(F.collect_set("at").alias("places"))
    places = places.select(F.lower(F.hex("md5")).alias("text_md5"), "places")
    # The words of a copy are cut out where its text arrives, and count once from there on.
    alike = raw.join(places, "text_md5").select(
        "text_md5", "places", plain_words(F.col("text")).alias("words")
    )
    windows = F.transform(
        "places", lambda p: F.struct(p.alias("at"), F.slice("words", p + 1, width).alias("window"))
    )
    alike = alike.select("text_md5", F.explode(windows).alias("w")).select("text_md5", "w.at", "w.window")
    return alike.distinct().join(grams.select("window", "items"), "window")


def find_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """One row per distinct text with hits: ``text_md5``, ``hit_words`` (0-based positions, sorted)
    and ``hit_items`` (item_ids with windows in it). Copies of a text are found as one."""
    windows = stage(benchmark_windows(benchmark, n), "benchmark-windows")
    length = F.octet_length(F.array_join("window", " ")) + 24 * F.size("items")
    sizes = windows.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("bytes")).collect()  # <= n rows
    small = sorted(r["width"] for r in sizes if r["n"] <= broadcast_windows and r["bytes"] <= BROADCAST_BYTES)
    large = sorted({r["width"] for r in sizes} - set(small))
    raw = docs.filter(F.col("text").isNotNull()).select(F.md5("text").alias("text_md5"), "text")
    texts = raw.select("text_md5", plain_words(F.col("text")).alias("words"))
    hashed = windows.withColumn("word_hashes", F.transform("window", lambda w: F.xxhash64(w)))
    found = _broadcast_hits(raw, hashed.filter(F.col("width").isin(small)), small) if small else None
    for width in large:
        hits = _shuffled_hits(raw, texts, hashed.filter(F.col("width") == width), width).select(
            "text_md5", "at", F.lit(width).alias("width"), "items"
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        kind = benchmark.schema["item_id"].dataType.simpleString()
        found = texts.filter("false").selectExpr(
            "text_md5", "0 AS at", "0 AS width", f"cast(array() AS array<{kind}>) AS items"
        )
    spans = F.transform(
        "spans", lambda s: F.sequence(s["at"], s["at"] + s["width"] - 1)
    )
    return (
        found.groupBy("text_md5")
        .agg(F.collect_set(F.struct("at", "width")).alias("spans"), F.collect_set("items").alias("i"))
        .select(
            "text_md5",
            F.sort_array(F.array_distinct(F.flatten(spans))).alias("hit_words"),
            F.array_distinct(F.flatten("i")).alias("hit_items"),
        )
    )


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """``docs`` (text, ...) with ``n_words``, ``hit_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` and ``contaminated``. Columns of these names in ``docs`` are replaced.

    A null text has no words. An item with a null id still contaminates but is not listed; items
    without words have no window. Equal items count one by one, equal windows of one item once.
    Empty tables: no hits, or no rows.
    """
    added = ["n_words", "hit_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.drop(*added)
    hits = find_hits(docs, benchmark, n, broadcast_windows)
    key = fresh_name(docs, "text_md5")
    ids = F.sort_array(F.transform("hit_items", lambda i: i.cast("string")))
    hits = hits.withColumnRenamed("text_md5", key).withColumn("items_sha256", _digest(ids)).withColumn(
        "n_items", F.size("hit_items").cast("long")
    )
    n_words = F.size(plain_words(F.col("text"))).cast("long")
    marked = docs.withColumn("n_words", n_words).withColumn(key, F.md5("text"))
    n_hit = F.coalesce(F.size("hit_words"), F.lit(0)).cast("long")
    return marked.join(hits.drop("hit_items"), key, "left").select(
        *docs.columns,
        "n_words",
        "hit_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", _digest(F.array().cast("array<string>"))).alias("items_sha256"),
        F.col("hit_words").isNotNull().alias("contaminated"),
    )


def _digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ","), 256)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents"
) -> DataFrame:
    """``docs`` without contaminated documents, or with ``remove="spans"`` all documents without
    the words that are hit (each with the gap behind it). Columns and clean texts stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove!r}")
    hits = find_hits(docs, benchmark, n)
    key = fresh_name(docs, "text_md5")
    hits = hits.withColumnRenamed("text_md5", key)
    if remove == "documents":
        return docs.withColumn(key, F.md5("text")).join(hits, key, "left_anti").select(*docs.columns)
    words = fresh_name(docs, "hit_words")
    hits = hits.select(key, F.col("hit_words").alias(words))
    lead = F.regexp_extract("text", f"^{_GAP}*+", 0)
    pieces = F.regexp_extract_all("text", F.lit(f"{_WORD}++{_GAP}*+"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.array_contains(F.col(words), i))
    text = F.when(F.col(words).isNull(), F.col("text")).otherwise(
        F.concat(lead, F.array_join(kept, ""))
    )
    joined = docs.withColumn(key, F.md5("text")).join(hits, key, "left").withColumn("text", text)
    return joined.select(*docs.columns)

"""Document fingerprints: threshold-scaled sketches of word shingles, in Spark expressions alone.

A shingle is five consecutive words; a text of fewer words, but not none, is one shingle. Its hash is
the first 16 hex digits of its MD5, and a sketch keeps every hash below a fixed fraction of their
range, an eighth. So sketches of texts of any two lengths are samples at the same rate: the share of
one that is also in the other estimates how much of its text is contained there, and the sketch of
several texts together is the union of theirs.

A text with shingles but no hash that low keeps its smallest one, so that short texts can be told
apart; ``merge`` drops such a hash again where a lower one joins it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardspan.llm.common import plain_words

SHINGLE = 5  # words
DIGITS = 16  # of a hash
EIGHTHS = 1  # of all hashes that are kept
BUCKETS = 1 << 16  # at most, of the documents in order
CUTS = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _limit(eighths: int) -> str:
    """Hashes are kept if their text is below this one."""
    return f"{eighths * 2:x}"


def sketch(text: Column, eighths: int = EIGHTHS) -> Column:
    """Sorted distinct hashes of ``text`` that are kept; null counts as empty, and is kept empty.

    ``eighths`` is 1 to 7. Words are runs of letters, digits and characters beyond ASCII, with A-Z
    lower-cased.
    """
    if not 1 <= eighths <= 7:
        raise ValueError(f"eighths: 1 to 7, not {eighths}")

    def of_words(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))
        hashes = F.transform(
            starts, lambda i: F.substring(F.md5(F.array_join(F.slice(words, i, SHINGLE), " ")), 1, DIGITS)
        )
        found = _let(hashes, lambda h: _kept(h, eighths))
        return F.when(F.size(words) > 0, found).otherwise(F.array().cast("array<string>"))

    return _let(plain_words(text), of_words)


def _kept(hashes: Column, eighths: int) -> Column:
    low = F.filter(hashes, lambda h: h < _limit(eighths))
    least = F.filter(F.array(F.array_min(hashes)), lambda h: h.isNotNull())
    return F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).otherwise(least)


def merge(left: Column, right: Column, eighths: int = EIGHTHS) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return _let(F.array_union(left, right), lambda h: _kept(h, eighths))


def contained(part: Column, whole: Column) -> Column:
    """Estimated share of the shingles of ``part`` that are also in ``whole``, 0 to 1. Nothing is
    wholly contained in nothing, and not at all in something."""
    share = F.size(F.array_intersect(part, whole)) / F.size(part)
    empty = F.when(F.size(whole) == 0, 1.0).otherwise(0.0)
    return F.when(F.size(part) == 0, empty).otherwise(share)


def resemblance(left: Column, right: Column) -> Column:
    """Estimated share of all shingles of either that both have, 0 to 1."""
    both = F.size(F.array_intersect(left, right))
    all_of = F.size(left) + F.size(right) - both
    return F.when(all_of == 0, 1.0).otherwise(both / all_of)


def _bucket(docs: DataFrame, per_bucket: int) -> Column:
    """A number that does not fall as doc_id grows and has about ``per_bucket`` rows, by quantiles
    of doc_id; null is the first. There are at most ``BUCKETS``."""
    fractions = [k / CUTS for k in range(CUTS + 1)]
    n, cuts = docs.agg(F.count("doc_id"), F.approx_percentile("doc_id", fractions, 10_000)).first()
    if not n:
        return F.lit(-1)
    cuts = sorted(set(cuts))
    fine = min(max(n // (per_bucket * CUTS), 1), BUCKETS // CUTS)
    known = F.array(*[F.lit(c) for c in cuts])

    def inside(at: Column) -> Column:
        low, high = F.get(known, at), F.coalesce(F.get(known, at + 1), F.get(known, at) + 1)
        step = F.floor((F.col("doc_id") - low).cast("double") * fine / (high - low))
        return at * fine + F.greatest(F.lit(0), F.least(step, F.lit(fine - 1)))

    coarse = F.size(F.filter(known, lambda c: c <= F.col("doc_id"))) - 1
    place = _let(F.greatest(coarse, F.lit(0)), inside)
    return F.when(F.col("doc_id").isNull(), -1).otherwise(place).cast("long")


def with_next(docs: DataFrame, per_bucket: int = 2000) -> DataFrame:
    """``docs`` (doc_id, text) with their ``sketch``, and ``next_text`` and ``next_sketch`` of the
    document that follows by doc_id and, for ties, by text; after the last comes the first, null
    doc_ids first.

    Documents are dealt into buckets of neighbouring doc_ids and shuffled once; a window in each finds
    the next one, and the first document of a bucket visits the bucket before as a guest. A window
    sorts and spills; repeated doc_ids share a bucket.
    """
    numbered = docs.select(_bucket(docs, per_bucket).alias("bucket"), "doc_id", "text")
    slim = numbered.select("bucket", "doc_id")
    least = slim.groupBy("bucket").agg(F.min("doc_id").alias("least")).orderBy("bucket").collect()
    if not least:
        alike = docs.select("doc_id", "text", sketch(F.col("text")).alias("sketch"))
        return alike.withColumns({"next_text": F.col("text"), "next_sketch": F.col("sketch")})
    hosts = [(r.bucket, least[i - 1].bucket) for i, r in enumerate(least)]
    firsts = docs.sparkSession.createDataFrame(
        [(b, r.least, h) for (b, h), r in zip(hosts, least)], "bucket long, least long, host long"
    )
    guests = numbered.join(F.broadcast(firsts), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("least")))
    guests = guests.groupBy("host").agg(F.min(F.struct("doc_id", "text")).alias("guest"))
    guests = guests.select(F.col("host").alias("bucket"), "guest.*", F.lit(True).alias("guest"))
    both = numbered.withColumn("guest", F.lit(False)).unionByName(guests)
    both = both.withColumn("sketch", sketch(F.col("text")))  # once a document, before the shuffle
    ahead = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    found = both.withColumns(
        {"next_text": F.lead("text").over(ahead), "next_sketch": F.lead("sketch").over(ahead)}
    )
    return found.filter("NOT guest").select("doc_id", "text", "sketch", "next_text", "next_sketch")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of each text edited, and their likeness.

    An edit replaces the last half of a text, floor(n / 2) code points, by the first as many (or all)
    of the next document's. Likeness is the estimated share of the document's shingles that are in
    the other text. A fingerprint is the sketch's hashes in order, without anything between; that of
    a text without words is empty. Null texts are empty; rows alike get rows alike, as far as their
    next document is the same; one row is its own next document. An empty table gives an empty one.
    Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = with_next(given)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring("next_text", F.lit(1), half),
    )
    cut = found.withColumn("n_chars", F.length("text").cast("long")).select(
        "doc_id", "n_chars", "sketch", "next_sketch",
        _let(edited, lambda e: F.struct(F.sha2(e, 256).alias("sha256"), sketch(e).alias("sketch"))).alias("edited"),
    )
    own, other = F.col("sketch"), F.col("edited.sketch")
    return cut.select(
        "doc_id",
        "n_chars",
        F.col("edited.sha256").alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"),
        F.array_join(other, "").alias("edited_fingerprint"),
        contained(own, other).alias("near_edited"),
        contained(own, F.col("next_sketch")).alias("near_next"),
        F.size(own).cast("long").alias("n_hashes"),
    )

"""Line deduplication with a suffix array over line sequences, built by distributed prefix doubling.

A text is the sequence of its lines that hold a word. The end of a text sorts before every line, then
come lines that occur more than once by their hash, then those that occur once by their place. The
rank of a place is the first place in the array that a suffix with its prefix may have. In each round
places of one rank are told apart by the rank of the place 2^k lines on, until every suffix has a rank
of its own or equals the others of its rank to the end of its text. So the array is finished, however
long the longest repeated run is; equal suffixes lie in the order of their places. Texts in which
every place has its last rank take no part in the rounds that follow.

A run counts from ``min_words`` words on. The shortest such run from a place has at most that many
lines. Neighbours in the array whose common prefix covers it form one interval; the prefixes are
compared by the ranks of two overlapping powers of two, kept from the round that has them. In each
interval the first place stays and the runs from all others are later copies. A longer repeated run
is the union of such runs, so deleting their lines deletes it as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardspan.llm.common import count_words
from wardspan.operators import Like, dense_ids
from wardspan.operators.ranges import RANGE, cut_ranges
from wardspan.runtime import stage

_BLOCK = 1 << 12  # places of the array that are scanned together
_ONCE = 1 << 62  # stands for the rank of a line that occurs once
_BEFORE = (Window.unboundedPreceding, -1)


def _running(groups: DataFrame, order: list[str], label: str) -> DataFrame:
    """``groups`` with their range and ``below``, the sum of ``n`` over the groups before in ``order``
    (a total order without NULLs): summed in ranges, to which the sums of the ranges before are added."""
    ranges = cut_ranges([Like(groups.select(*order))], order)
    along = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(*_BEFORE)
    summed = ranges.deal(groups).withColumn("below", F.coalesce(F.sum("n").over(along), F.lit(0)))
    summed = stage(summed, label)
    of_range = summed.groupBy(RANGE).agg(F.sum("n").alias("_n"))  # one row a range
    before = F.coalesce(F.sum("_n").over(Window.orderBy(RANGE).rowsBetween(*_BEFORE)), F.lit(0))
    shift = F.broadcast(of_range.select(RANGE, before.alias("_before")))
    return summed.join(shift, RANGE).withColumn("below", F.col("below") + F.col("_before")).drop("_before")


def _by_line(lines: DataFrame) -> DataFrame:
    """Places with the rank of their line. One that occurs once has none and is closed: it got its place."""
    repeated = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = stage(repeated.withColumn("hash", F.hex("line")), "lines-repeated")
    ranks = _running(repeated, ["hash"], "lines-order").select("line", (F.col("below") + 1).alias("rank"))
    unknown = F.lit(None).cast("long")
    return lines.join(ranks, "line", "left").drop("line").withColumns(
        {"open": F.col("rank").isNotNull(), "closed": F.col("rank").isNull(), "head": unknown, "tail": unknown}
    )


def _doubled(places: DataFrame, k: int, named: bool) -> DataFrame:
    """Places ranked by 2^k lines, ranked by twice as many, in the texts that have an open place. With
    ``named`` the runs of 2^k lines and more, but less than twice as many, get a name: the ranks of
    their first and last 2^k lines. None is given where a line occurs once."""
    text, size = Window.partitionBy("row"), 1 << k
    along = text.orderBy("pos")
    rank = F.coalesce("rank", F.lit(_ONCE))
    later = F.coalesce(F.lead(rank, size).over(along), F.lit(0))  # 0: the text has ended
    paired = places.withColumns({"going": F.max("open").over(text), "b": later})
    if named:
        next_ranks = F.collect_list(rank).over(along.rowsBetween(0, size - 1))
        last = F.get(next_ranks, (F.col("length") - size).cast("int"))
        here = F.col("open") & (F.col("length") >= size) & (F.col("length") < 2 * size) & (last < _ONCE)
        paired = paired.withColumns(
            {"head": F.when(here, F.col("rank")).otherwise(F.col("head")), "tail": F.when(here, last).otherwise(F.col("tail"))}
        )
    # A line that occurs once tells a place from all others. Closed places get keys that match nothing.
    once = F.col("b") == _ONCE
    alone = -1 - F.pmod(F.xxhash64("row", "pos"), F.lit(1 << 40))
    keys = ["a", "b", "in_row", "at_pos"]
    paired = paired.filter("going").drop("going").withColumns(
        {
            "a": F.when(F.col("open"), F.col("rank")).otherwise(alone),
            "in_row": F.when(once, F.col("row")).otherwise(0),
            "at_pos": F.when(once, F.col("pos")).otherwise(0),
        }
    )
    paired = stage(paired, "lines-pairs")
    groups = stage(paired.filter("open").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "lines-groups")
    sums = _running(groups, keys, "lines-order")
    # Where a rank's groups begin; only ranks that lie on a cut begin in another range.
    begins = sums.groupBy("a").agg(F.min("below").alias("low"), F.min(RANGE).alias("from"), F.max(RANGE).alias("to"))
    begins = F.broadcast(begins.filter(F.col("from") < F.col("to")).select("a", "low"))
    low = F.coalesce("low", F.min("below").over(Window.partitionBy(RANGE, "a")))
    found = sums.join(begins, "a", "left").withColumn("next", F.col("a") + F.col("below") - low)
    still = F.coalesce((F.col("n") > 1) & (F.col("b") > 0), F.lit(False))
    return paired.join(found.select(*keys, "next", "n"), keys, "left").select(
        "row", "pos", "first", "length", "head", "tail",
        F.coalesce("next", "rank").alias("rank"),
        still.alias("open"),
        (F.col("open") & ~still).alias("closed"),
    )


def suffix_array(lines: DataFrame, min_words: int) -> DataFrame:
    """The suffix array of ``lines`` (row, pos, first, length, line): every place with ``at``, its number
    in the array from 1, and the name (``head``, ``tail``) of its run where no line of it occurs once."""
    places = stage(_by_line(lines), "lines-r0")
    rounds = [places]
    while not places.filter("open").isEmpty():
        k = len(rounds) - 1
        places = stage(_doubled(places, k, 1 << k <= min_words), f"lines-r{k + 1}")
        rounds.append(places)
    closed = [r.filter("closed").drop("open", "closed") for r in rounds]
    ranked = reduce(DataFrame.unionByName, closed).withColumn("rank", F.coalesce("rank", F.lit(_ONCE)))
    order = ["rank", "row", "pos"]
    return dense_ids(ranked, order, "at", [Like(ranked.select(*order))])


def _intervals(array: DataFrame) -> DataFrame:
    """Named places with the ``interval`` of neighbours whose common prefix covers their run, told by
    its first ``at``. The array is scanned in blocks; the last place of each is shown to the next one,
    and an interval is carried on by one row for each block."""
    block, last = F.floor(F.col("at") / _BLOCK), F.col("at") % _BLOCK == _BLOCK - 1
    named = array.filter("tail IS NOT NULL").withColumn("in_block", block)
    shown = named.filter(last).withColumn("in_block", block + 1)
    along = Window.partitionBy("in_block").orderBy("at")
    name = F.struct("length", "head", "tail")
    same = (F.lag("at").over(along) == F.col("at") - 1) & (F.lag(name).over(along) == name)
    begun = F.when((F.col("in_block") == block) & ~F.coalesce(same, F.lit(False)), F.col("at"))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = (
        named.unionByName(shown)
        .withColumn("begun", begun)
        .withColumn("interval", F.last("begun", ignorenulls=True).over(upto))
        .filter(F.col("in_block") == block)
    )
    scanned = stage(scanned.select("row", "pos", "first", "length", "in_block", "interval"), "lines-runs")
    carried = F.max("_interval").over(Window.orderBy("in_block").rowsBetween(*_BEFORE))
    blocks = scanned.groupBy("in_block").agg(F.max("interval").alias("_interval"))
    blocks = F.broadcast(blocks.select("in_block", carried.alias("_interval")))
    return scanned.join(blocks, "in_block").withColumn("interval", F.coalesce("interval", "_interval")).drop("_interval", "in_block")


def repeated_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Places (row, pos) where a run of at least ``min_words`` words starts that occurs before, and
    the run's number of lines. ``lines``: row, pos (0, 1, ...), words, line (its hash), first (sorts
    documents)."""
    along = Window.partitionBy("row").orderBy("pos").rowsBetween(*_BEFORE)
    sized = lines.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    # Every line has a word, so the lines that start within the next min_words words are the run.
    ahead = Window.partitionBy("row").orderBy("before").rangeBetween(0, min_words - 1)
    run = F.when(
        F.max(F.col("before") + F.col("words")).over(ahead) >= F.col("before") + min_words,
        F.count(F.lit(1)).over(ahead),
    )
    sized = sized.withColumn("length", run).select("row", "pos", "first", "line", "length")
    runs = _intervals(suffix_array(sized, min_words))
    place = F.struct("first", "row", "pos")
    heads = runs.groupBy("interval").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n"))
    heads = heads.filter("n > 1").drop("n")
    return runs.join(heads, "interval").filter(place != F.col("kept")).select("row", "pos", "length")


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` (doc_id, text, ...) without lines that belong to a later copy of a repeated run of
    at least ``min_words`` words, with ``n_lines``, ``n_deleted`` and ``deleted_words``. Columns of
    these names in ``docs`` are replaced.

    Earlier means: a smaller doc_id (nulls last), then the order of the rows, then the place in the
    text. Lines are compared as they are, without what ends them; lines without a word belong to no
    run and stay. A run that overlaps its own earlier copy goes as far as the later copy reaches. A
    null text stays null and has no lines. An empty table gives an empty table.
    """
    added = ["n_lines", "n_deleted", "deleted_words"]
    docs = docs.drop(*added)
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "lines-docs")
    pieces = F.transform(
        F.split("doc.text", "\n"),
        lambda line, i: F.struct(i.alias("i"), count_words(line).alias("words"), F.unhex(F.md5(line)).alias("line")),
    )
    worded = F.filter(pieces, lambda p: p["words"] > 0)
    first = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id")).alias("first")
    lines = stage(
        rows.select("row", first, F.posexplode(worded).alias("pos", "p")).select(
            "row", F.col("pos").cast("long").alias("pos"), "first", "p.*"
        ),
        "lines",
    )
    runs = repeated_runs(lines.drop("i"), min_words)
    reached = runs.groupBy("row", "pos").agg(F.max("length").alias("length"))
    covered = reached.select("row", F.explode(F.sequence("pos", F.col("pos") + F.col("length") - 1)).alias("pos"))
    gone = covered.distinct().join(lines, ["row", "pos"]).groupBy("row").agg(
        F.sort_array(F.collect_list("i")).alias("gone"), F.sum("words").alias("deleted_words")
    )
    gone = stage(gone, "lines-gone")
    # The numbers of the lines that stay, then the lines: every step is linear in the text.
    text = F.col("doc.text")
    every = F.sequence(F.lit(0), F.size(F.split(text, "\n")) - 1)
    cut = F.split(text, "\n")
    left = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get(F.col("cut"), i))
    # What goes grows with the texts, so it is never broadcast, whatever it measures here.
    joined = rows.join(gone.hint("merge"), "row", "left").withColumn("cut", cut)
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n"))
    columns = [kept.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return joined.select(
        *columns,
        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce("deleted_words", F.lit(0)).cast("long").alias("deleted_words"),
    )

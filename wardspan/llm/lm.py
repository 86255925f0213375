"""Language-model scoring by online logistic context mixing along whole texts.

A text is a sequence of words and one end. Every word is coded in bits, and every bit is predicted
by several tables, each of which looks up how often the bit was 0 and 1 after its context. Their
predictions are mixed in the logistic domain with weights that a gate selects, learned online, and
refined by an adaptive map from the mixed probability to what was observed.

Two coders share the work. The words that are frequent in training, the end and an escape are the
leaves of a Huffman tree; the bits of a path are predicted from the tree's own counts, from the word
before and from the two words before (by their ranks if frequent, else by their last bytes), so a
probability depends on the order of the text's words. After an escape the word is spelled: a word is
its UTF-8 bytes and a space, a byte is five bits, or five and eight for a rare one, predicted from
the last 1, 2, 3 or 5 bytes of the word and from all of it so far. What follows an escape does not
depend on the words around it, so it is computed once per distinct word; hashed tables cannot hold a
whole vocabulary, so it is mixed with the word's share among the escaped training words.

Bits are counted over all training texts and words, in tables whose size follows from the number of
training words and distinct words, up to a bound. The weights and the adaptive map, a few thousand
numbers, are learned from all training texts and words, each different one once, in buckets and in an
order that their hash gives, with one occurrence of the word at hand taken out of the counts. So scores do not depend on how rows are
dealt to tasks. Texts get the scores of frequent words from a table of fixed size that travels with
the tasks, and those of all other words by a join.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.runtime import stage

ORDERS = (1, 2, 3, 5)  # and the whole word so far
PREDICTORS = len(ORDERS) + 1
WORD_BITS = (16, 19)  # least and most slots of a table of the speller, as a power of two
PATH_BITS = (16, 20)  # the same for a table of the paths
PAGE = 4096  # slots that travel in one row
GATES = (PREDICTORS + 1) * 6
NODES = 32 + 256  # bits already known of a byte
STEPS = 33  # of the adaptive map, over the logistic domain from -LIMIT to LIMIT
LIMIT = 8.0
PRIOR = np.float32(0.4)
END = ""  # stands for the end of a text, as no word is empty
LEARN = 0.3  # rate of the mixers
WORDS_A_TASK, TOKENS_A_TASK = 1_000_000, 16_000_000  # for one set of tables
TASKS = 8  # at least
BUCKETS = (16, 128)  # least and most that learn side by side
BUCKET_WORDS, BUCKET_TOKENS = 100_000, 1_000_000  # that one of them should hold
CODED = 16_384  # frequent words that have a path
OWN_CONTEXT = 4096  # of them that are contexts by rank; the others by their last two bytes
ENDINGS = 1024  # classes of last bytes
FREQUENT = 250_000  # words whose scores travel with the tasks, about 20 MB
HELD = 600_000  # distinct words that a task counts before it passes them on
BATCH = 16_384  # tokens whose paths are predicted at a time

# Five-bit codes: letters, what ends a word or text, the commonest marks; 31 announces a whole byte.
_CODES = np.full(256, 31, np.uint64)
for _code, _byte in enumerate(b"abcdefghijklmnopqrstuvwxyz \n.,\xc3"):
    _CODES[_byte] = _code


@dataclass
class Model:
    stretched: np.ndarray  # PREDICTORS x SLOTS: logistic predictions
    known: np.ndarray  # PREDICTORS x SLOTS: whether the slot has been seen
    weights: np.ndarray  # GATES x (PREDICTORS + 1)
    refined: np.ndarray  # NODES x STEPS


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def _words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words with what ends them, the word each belongs to, its place in the word."""
    coded = [w + b" " if w else b"\n" for w in words]
    sizes = np.array([len(c) for c in coded])
    data = np.frombuffer(b"".join(coded), np.uint8)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(coded)), sizes)
    return data, owner, np.arange(len(data)) - starts[owner]


def contexts(data: np.ndarray, owner: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """A hash of each predictor's context before each byte."""
    found, rolled = [], np.zeros(len(data), np.uint64)
    for back in range(1, max(ORDERS) + 1):
        before = np.zeros(len(data), np.uint64)
        before[back:] = data[:-back]
        before[place < back] = 0
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(1)
        if back in ORDERS:
            found.append(rolled * np.uint64(0xD6E8FEB86659FD93))
    powers = np.cumprod(np.full(int(place.max(initial=0)) + 1, 0x100000001B3, np.uint64))
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
    before = np.cumsum(terms) - terms  # wraps around, which differences do not mind
    prefix = before - before[np.flatnonzero(place == 0)][owner] + place.astype(np.uint64)
    return [*found, prefix * np.uint64(0xA0761D6478BD642F)]


def _events(data: np.ndarray) -> Iterator[tuple[int, slice | np.ndarray, np.ndarray, np.ndarray]]:
    """Bit by bit: number for the gate, which bytes have that bit, what is known of them, the bit."""
    lead = _CODES[data] | np.uint64(32)
    for j in range(5):
        bit = (lead >> np.uint64(4 - j)) & np.uint64(1)
        yield j, slice(None), lead >> np.uint64(5 - j), bit.astype(np.int64)
    rare = np.flatnonzero(lead == 63)
    if len(rare):
        whole = data[rare].astype(np.uint64) | np.uint64(256)
        for j in range(8):
            bit = (whole >> np.uint64(7 - j)) & np.uint64(1)
            yield 5, rare, (whole >> np.uint64(8 - j)) + np.uint64(32), bit.astype(np.int64)


def _slots(context: np.ndarray, before: np.ndarray, slots: int) -> np.ndarray:
    mixed = (context ^ (before * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def table_slots(wanted: int, bits: tuple[int, int]) -> int:
    """A power of two that holds ``wanted``, between the bounds."""
    return 1 << min(max(int(wanted).bit_length(), bits[0]), bits[1])


def _batches(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[list[bytes], np.ndarray, pa.RecordBatch]]:
    """Words, counts and whole rows, about ``size`` bytes of words at a time."""

    def cut(rows: pa.RecordBatch):
        words = rows.column("word").cast(pa.binary()).to_pylist()
        ends = np.cumsum([len(w) + 1 for w in words])
        start = 0
        while start < len(words):
            goal = (ends[start - 1] if start else 0) + size
            stop = min(len(words), int(np.searchsorted(ends, goal)) + 1)
            part = rows.slice(start, stop - start)
            yield words[start:stop], part.column("n").to_numpy().astype(np.float64), part
            start = stop

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.nbytes
        if held >= size:
            yield from cut(pa.concat_batches(waiting))
            waiting, held = [], 0
    if waiting:
        yield from cut(pa.concat_batches(waiting))


def _pages(tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pages of the tables that hold something, some at a time."""
    pages = tables.reshape(-1, 2 * PAGE)
    full = np.flatnonzero(pages.any(axis=1))
    for at in range(0, len(full), 64):
        some = full[at : at + 64]
        blobs = pa.array([pages[p].astype(np.float32).tobytes() for p in some], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some), blobs], names=["page", "data"])


def _add_pages(key: tuple, pages: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(d, np.float32).astype(np.float64) for d in pages["data"])
    return pd.DataFrame({"page": [key[0]], "data": [total.astype(np.float32).tobytes()]})


def _gather(pages: DataFrame, predictors: int, slots: int) -> np.ndarray:
    """The tables of all tasks added up, predictors x slots x 2; of fixed size on the driver."""
    tables = np.zeros((predictors * slots // PAGE, 2 * PAGE), np.float32)
    for page, data in pages.groupBy("page").applyInPandas(_add_pages, "page long, data binary").toLocalIterator():
        tables[page] = np.frombuffer(bytes(data), np.float32)
    return tables.reshape(predictors, slots, 2)


def _count_bits(slots: int):
    """Bit counts of all training words of a task, in pages of the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((PREDICTORS, 2 * slots))
        for words, counts, _ in _batches(batches, 1 << 21):
            data, owner, place = _words(words)
            hashes, weight = contexts(data, owner, place), counts[owner]
            for _, rows, before, bit in _events(data):
                for table, context in zip(tables, hashes):
                    at = _slots(context[rows], before, slots) * 2 + bit
                    table += np.bincount(at, weight[rows], 2 * slots)
        yield from _pages(tables)

    return run


def _step(x: np.ndarray) -> np.ndarray:
    """Where the adaptive map is looked up for a mixed prediction in the logistic domain."""
    return np.rint((np.clip(x, -LIMIT, LIMIT) + LIMIT) * ((STEPS - 1) / (2 * LIMIT))).astype(np.int64)


class Mixer:
    """Weights by gate, learned online, and what was observed for the adaptive map."""

    def __init__(self, gates: int, inputs: int, maps: int, start: float):
        self.weights, self.seen = np.full((gates, inputs), start), np.zeros(gates)
        self.observed = np.zeros((2, maps * STEPS))

    def learn(self, gates, inputs, maps, bit, weight) -> None:
        x = np.einsum("ij,ij->i", inputs, self.weights[gates])
        error = (bit - squash(x)) * weight
        here = np.bincount(gates, weight, len(self.seen))
        # Small steps for gates with few events in this batch, and smaller ones with time.
        rate = LEARN / (here + 50 + 0.02 * self.seen)
        for k in range(inputs.shape[1]):
            self.weights[:, k] += rate * np.bincount(gates, error * inputs[:, k], len(self.seen))
        self.seen += here
        at = maps * STEPS + _step(x)
        for value in (0, 1):
            self.observed[value] += np.bincount(at, weight * (bit == value), self.observed.shape[1])

    def state(self, bucket: int) -> pa.RecordBatch:
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (self.weights, self.seen, self.observed)]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), *blobs], names=["bucket", "weights", "seen", "map"]
        )


def buckets(rows: int, each: int) -> int:
    """How many buckets learn side by side, between the bounds."""
    return min(max(-(-rows // each), BUCKETS[0]), BUCKETS[1])


def _learned(taught: DataFrame, side_by_side: int, run: Callable, gates: int, inputs: int, maps: int, start: float):
    """Weights averaged over the buckets by what each has seen, and the adaptive map of all.

    ``taught`` (order, ...) is dealt into buckets by ``order`` and sorted in each, so that neither
    depends on where the rows lay."""
    dealt = taught.withColumn("bucket", F.pmod("order", F.lit(side_by_side))).repartition(side_by_side, "bucket")
    states = dealt.sortWithinPartitions("bucket", *taught.columns).mapInArrow(
        run, "bucket long, weights binary, seen binary, map binary"
    )
    total, sums = np.full((gates, 1), 1e-9), np.full((gates, inputs), 1e-9 * start)
    centres = squash((np.arange(STEPS) / (STEPS - 1) * 2 - 1) * LIMIT)
    observed = np.stack([np.tile(1 - centres, maps), np.tile(centres, maps)]) * 4  # as if seen so often
    for row in sorted(states.collect(), key=lambda r: r.bucket):  # a row a bucket
        seen = np.frombuffer(bytes(row.seen), np.float64)[:, None]
        sums += seen * np.frombuffer(bytes(row.weights), np.float64).reshape(sums.shape)
        total += seen
        observed += np.frombuffer(bytes(row.map), np.float64).reshape(observed.shape)
    refined = (observed[1] / observed.sum(axis=0)).reshape(maps, STEPS)
    return (sums / total).astype(np.float32), np.clip(refined, 1e-6, 1 - 1e-6)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(buckets)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield int(buckets[a]), batch.slice(a, b - a)


def _learn(tables: np.ndarray):
    """Train the speller's weights online over the words of each bucket."""
    slots = tables.shape[1]

    def learn(mixer: Mixer, words: list[bytes], counts: np.ndarray) -> None:
        data, owner, place = _words(words)
        hashes, weights_of = contexts(data, owner, place), counts[owner]
        for number, rows, before, bit in _events(data):
            inputs = np.full((len(bit), PREDICTORS + 1), 0.3, np.float32)
            known, each = np.zeros(len(bit), np.int64), np.arange(len(bit))
            for k, context in enumerate(hashes):
                pair = tables[k][_slots(context[rows], before, slots)]
                pair[each, bit] -= 1  # float counts may have lost a one
                pair = np.maximum(pair, 0)
                known += pair.sum(axis=1) > 0
                inputs[:, k] = np.log((pair[:, 1] + PRIOR) / (pair[:, 0] + PRIOR))
            mixer.learn(known * 6 + number, inputs, before.astype(np.int64), bit, weights_of[rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[list, list] = ([], [])
        mixer, now = None, None

        def flush(least: int) -> None:
            while len(waiting[0]) > least:
                learn(mixer, waiting[0][:2000], np.array(waiting[1][:2000], np.float64))
                del waiting[0][:2000], waiting[1][:2000]

        for bucket, rows in _by_bucket(batches):
            if bucket != now:
                if mixer is not None:
                    flush(0)
                    yield mixer.state(now)
                mixer, now = Mixer(GATES, PREDICTORS + 1, NODES, 1 / 3), bucket
            waiting[0].extend(rows.column("word").cast(pa.binary()).to_pylist())
            waiting[1].extend(rows.column("n").to_pylist())
            flush(2000)
        if mixer is not None:
            flush(0)
            yield mixer.state(now)

    return run


def log10_words(words: list[bytes], model: Model) -> np.ndarray:
    """log10 probability of each word (with what ends it)."""
    data, owner, place = _words(words)
    total = np.zeros(len(words))
    hashes = contexts(data, owner, place)
    for number, rows, before, bit in _events(data):
        inputs = np.full((len(bit), PREDICTORS + 1), 0.3, np.float32)
        known = np.zeros(len(bit), np.int64)
        for k, context in enumerate(hashes):
            slots = _slots(context[rows], before, model.known.shape[1])
            inputs[:, k] = model.stretched[k].take(slots)
            known += model.known[k].take(slots)
        x = np.einsum("ij,ij->i", inputs, model.weights.take(known * 6 + number, axis=0))
        p = (squash(x) + model.refined.take(before.astype(np.int64) * STEPS + _step(x))) / 2
        total += np.bincount(owner[rows], np.log(np.abs(p - 1 + bit)), len(words))
    return total / np.log(10)


def train(vocabulary: DataFrame, words: int) -> Model:
    """The speller of the training words (word, n), of which ``words`` are distinct. Tables are
    built by tasks, added up page by page, and reach the driver once."""
    slots = table_slots(2 * words, WORD_BITS)
    known = vocabulary.filter("n > 0").select("word", "n")
    pages = known.coalesce(max(TASKS, words // WORDS_A_TASK)).mapInArrow(_count_bits(slots), "page long, data binary")
    tables = _gather(pages, PREDICTORS, slots)
    order = F.xxhash64("word").alias("order")
    taught, count = known.select(order, "word", "n"), buckets(words, BUCKET_WORDS)
    weights, refined = _learned(taught, count, _learn(tables), GATES, PREDICTORS + 1, NODES, 1 / 3)
    stretched = np.log((tables[..., 1] + PRIOR) / (tables[..., 0] + PRIOR))
    return Model(stretched.astype(np.float16), tables.sum(axis=2) > 0, weights, refined)


def _score_words(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _, rows in _batches(batches, 1 << 16):
            yield rows.append_column("log_bits", pa.array(log10_words(words, model)))

    return run


def mixture_weight(scored: DataFrame, escaped: int) -> float:
    """The weight of word shares next to the speller that fits the escaped training words (word,
    rare, log_bits) best, of 19 in equal steps, if each occurrence is held against the others."""
    bits = F.pow(F.lit(10.0), "log_bits")
    share = (F.col("rare") - 1) / max(escaped - 1, 1)
    tried = [k / 20 for k in range(1, 20)]
    gains = [F.round(F.sum(F.col("rare") * F.log10(bits * (1 - w) + share * w)), 3) for w in tried]
    sums = scored.filter("rare > 0").agg(*[g.alias(f"g{i}") for i, g in enumerate(gains)]).first()
    return max(zip(sums, tried))[1] if sums[0] is not None else 0.0


def _tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; bytes are folded and split by the rules of ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) summed over the texts of a task, in several parts if there are many words; n is 0
    for words of held-out texts."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        for held_out, words in enumerate(counts):
            n = [0] * len(words) if held_out else words.values()
            columns = [pa.array(words.keys(), pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
            whole = pa.RecordBatch.from_arrays(columns, names=["word", "n"])
            for at in range(0, len(words), 10_000):
                yield whole.slice(at, 10_000)
            words.clear()

    for batch in batches:
        for text, held_out in zip(batch.column("text"), batch.column("held_out").to_pylist()):
            words = counts[held_out]
            words.update(_tokens(text.as_py()))
            words[b""] += 1
            if sum(map(len, counts)) > HELD:
                yield from out()
    yield from out()


@dataclass
class Paths:
    """A Huffman tree over the escape (0), the end (1) and the frequent words (2 and up)."""

    ids: dict[bytes, int]
    starts: np.ndarray  # of each leaf's path in the next two
    nodes: np.ndarray
    bits: np.ndarray
    share: np.ndarray  # nodes: how often the bit is 1
    logit: np.ndarray  # nodes: the same in the logistic domain
    depth: np.ndarray  # nodes: four classes


def huffman(words: list[bytes], counts: list[int]) -> Paths:
    """``counts`` holds the escape's, the end's and then those of ``words``; every leaf counts one more."""
    weights = [c + 1 for c in counts]
    heap = [(w, i, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    leaves = len(weights)
    while len(heap) > 1:
        low, high = heapq.heappop(heap), heapq.heappop(heap)
        made = leaves + len(children)
        children.append((low[2], high[2]))
        heapq.heappush(heap, (low[0] + high[0], made, made))
        weights.append(low[0] + high[0])
    found: list[tuple] = [()] * (leaves + len(children))
    for at in range(len(children) - 1, -1, -1):  # parents before children
        for bit, child in enumerate(children[at]):
            found[child] = (*found[leaves + at], (at, bit))
    paths = found[:leaves]
    flat = np.array([step for path in paths for step in path], np.int64).reshape(-1, 2)
    share = np.array([weights[b] / (weights[a] + weights[b]) for a, b in children])
    depths = np.array([len(found[leaves + at]) for at in range(len(children))])
    return Paths(
        {b"": 1} | {w: i + 2 for i, w in enumerate(words)},
        np.concatenate([[0], np.cumsum([len(p) for p in paths])]),
        flat[:, 0],
        flat[:, 1],
        share.astype(np.float32),
        np.log(share / (1 - share)).astype(np.float32),
        np.searchsorted([1, 4, 8], depths, side="right"),
    )


PATH_GATES = 4 * 4 * 4  # what is known of either context, and the depth


@dataclass
class PathModel:
    paths: Paths
    tables: np.ndarray  # 2 x slots x 2
    weights: np.ndarray
    refined: np.ndarray


def _coded(
    texts: Iterator[list[bytes]], paths: Paths, found: list[np.ndarray] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number of the text, leaves and hashes of both contexts, a text in pieces of a BATCH. The
    leaves of each text's tokens may have been ``found`` before."""
    for number, tokens in enumerate(texts):
        before = np.array([ENDINGS + 1, ENDINGS + 1], np.uint64)  # the start of a text
        for at in range(0, len(tokens), BATCH):
            part = tokens[at : at + BATCH]
            if found is None:
                ids = np.fromiter(map(paths.ids.get, part, repeat(0)), np.int64, len(part))
            else:
                ids = found[number][at : at + BATCH]
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part))) + 2 * np.arange(1, len(part) + 1)
            data = np.frombuffer(b"  " + b"  ".join(part), np.uint8).astype(np.int64)
            own = (data[ends - 1] * 37 + data[ends - 2]) % ENDINGS  # of the last two bytes
            own = np.where((ids > 0) & (ids < OWN_CONTEXT), ids + ENDINGS + 1, own).astype(np.uint64)
            own = np.concatenate([before, own])
            last = (own[1:-1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            both = (last ^ (own[:-2] + np.uint64(7))) * np.uint64(0xD6E8FEB86659FD93)
            yield number, ids, last, both
            before = own[-2:]


def _steps(ids: np.ndarray, paths: Paths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which token each bit belongs to, its node, and the bit."""
    sizes = paths.starts[ids + 1] - paths.starts[ids]
    owner = np.repeat(np.arange(len(ids)), sizes)
    at = np.arange(len(owner)) + np.repeat(paths.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
    return owner, paths.nodes.take(at), paths.bits.take(at)


def _joined(pieces: Iterator[tuple], size: int) -> Iterator[list[np.ndarray]]:
    """Pieces of texts put together until they have ``size`` tokens."""
    waiting, held = [], 0
    for number, ids, *contexts_ in pieces:
        waiting.append((np.full(len(ids), number), ids, *contexts_))
        held += len(ids)
        if held >= size:
            yield [np.concatenate(x) for x in zip(*waiting)]
            waiting, held = [], 0
    if waiting:
        yield [np.concatenate(x) for x in zip(*waiting)]


def _count_paths(paths: Paths, slots: int):
    """Bit counts after both contexts, of all training texts of a task, in pages of the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, one = np.zeros((2, 2 * slots), np.int64), np.int64(1)
        texts = ([*_tokens(t.as_py()), b""] for batch in batches for t in batch.column("text"))
        for _, ids, *hashes in _joined(_coded(texts, paths), BATCH):
            owner, nodes, bits = _steps(ids, paths)
            nodes = nodes.astype(np.uint64)
            for table, context in zip(tables, hashes):
                np.add.at(table, _slots(context.take(owner), nodes, slots) * 2 + bits, one)
        yield from _pages(tables)

    return run


def _inputs(pairs: list[np.ndarray], nodes: np.ndarray, paths: Paths) -> tuple[np.ndarray, np.ndarray]:
    """Logistic predictions and gates. A context that has seen little leans on the tree's counts."""
    inputs = np.empty((len(nodes), 4), np.float32)
    inputs[:, 0] = paths.logit.take(nodes)
    inputs[:, 3] = 0.3
    share, gates = paths.share.take(nodes), paths.depth.take(nodes)
    for k, pair in enumerate(pairs):
        inputs[:, k + 1] = np.log((pair[:, 1] + share) / (pair[:, 0] + (1 - share)))
        seen = pair[:, 0] + pair[:, 1]
        gates = gates * 4 + (seen > 0.5) + (seen > 3.5) + (seen > 24.5)
    return inputs, gates


def _learn_paths(paths: Paths, tables: np.ndarray):
    """Train the weights online along the texts of each bucket."""
    slots = tables.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, now = None, None
        for bucket, rows in _by_bucket(batches):
            if bucket != now:
                if mixer is not None:
                    yield mixer.state(now)
                mixer, now = Mixer(PATH_GATES, 4, PATH_GATES, 1 / 3), bucket
            for text in rows.column("text"):  # one by one, wherever a batch of rows ends
                for _, ids, *hashes in _coded(iter([[*_tokens(text.as_py()), b""]]), paths):
                    owner, nodes, bits = _steps(ids, paths)
                    known, each = nodes.astype(np.uint64), np.arange(len(bits))
                    pairs = [t[_slots(c[owner], known, slots)] for t, c in zip(tables, hashes)]
                    for pair in pairs:
                        pair[each, bits] -= 1
                        np.maximum(pair, 0, out=pair)
                    inputs, gates = _inputs(pairs, nodes, paths)
                    mixer.learn(gates, inputs, gates, bits, np.ones(len(bits)))
        if mixer is not None:
            yield mixer.state(now)

    return run


def train_paths(rows: DataFrame, paths: Paths, tokens: int) -> PathModel:
    """The model of the paths, from the training rows (text, held_out) with ``tokens`` tokens."""
    slots = table_slots(tokens, PATH_BITS)
    texts = rows.filter(~F.col("held_out")).select("text")
    pages = texts.coalesce(max(TASKS, tokens // TOKENS_A_TASK)).mapInArrow(
        _count_paths(paths, slots), "page long, data binary"
    )
    tables = _gather(pages, 2, slots)
    order = F.xxhash64("text").alias("order")
    taught = texts.filter("text IS NOT NULL").select(order, "text").distinct()
    count = buckets(tokens, BUCKET_TOKENS)
    weights, refined = _learned(taught, count, _learn_paths(paths, tables), PATH_GATES, 4, PATH_GATES, 1 / 3)
    return PathModel(paths, tables, weights, refined)


def log10_paths(texts: list[list[bytes]], model: PathModel, found: list[np.ndarray] | None = None) -> np.ndarray:
    """log10 probability of the paths of each text's tokens, each after the words before it."""
    total, slots = np.zeros(len(texts)), model.tables.shape[1]
    for number, ids, *hashes in _joined(_coded(iter(texts), model.paths, found), BATCH):
        owner, nodes, bits = _steps(ids, model.paths)
        known = nodes.astype(np.uint64)
        pairs = [t.take(_slots(c.take(owner), known, slots), axis=0) for t, c in zip(model.tables, hashes)]
        inputs, gates = _inputs(pairs, nodes, model.paths)
        x = np.einsum("ij,ij->i", inputs, model.weights.take(gates, axis=0))
        p = (squash(x) + model.refined.take(gates * STEPS + _step(x))) / 2
        # Bit by bit, so that a sum does not depend on the texts beside it.
        total += np.bincount(number.take(owner), np.log(np.abs(p - 1 + bits)), len(texts))
    return total / np.log(10)


def _add_up(words: list[bytes], seen: np.ndarray, base: np.ndarray, spelled: np.ndarray, model: PathModel) -> Callable:
    """Sums over the frequent words of each text, and the other words as rows of their own."""
    at = {w: i for i, w in enumerate(words)}
    leaf = np.array([*(model.paths.ids.get(w, 0) for w in words), 0], np.int64)  # the last one is for -1
    names = ["doc", "held_out", "row", "word", "times", "n_tokens", "n_known", "bytes", "base", "paths", "spelled"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                yield from some(whole.slice(start, 200))

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums, others, rows, times = [], [], [], []
        texts = [[*_tokens(text.as_py()), b""] for text in batch.column("text")]
        found = [np.fromiter(map(at.get, tokens, repeat(-1)), np.int64, len(tokens)) for tokens in texts]
        logs = log10_paths(texts, model, [leaf[places] for places in found]).tolist()
        for tokens, places, log, row in zip(texts, found, logs, batch.column("row").to_pylist()):
            size = sum(map(len, tokens)) + len(tokens)
            if (places < 0).any():
                rest = Counter(tokens[i] for i in np.flatnonzero(places < 0))
                others += rest.keys()
                times += rest.values()
                rows += [row] * len(rest)
                places = places[places >= 0]
            known = int(np.count_nonzero(seen[places]))
            sums.append((len(tokens), known, size, float(base[places].sum()), log, float(spelled[places].sum())))
        totals = [pa.array(x) for x in zip(*sums)]
        n, kind = len(sums), batch.schema.field("doc").type
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("held_out"), batch.column("row"), pa.nulls(n, pa.string()),
             pa.nulls(n, pa.int64()), *totals], names=names,
        )
        m = len(others)
        spread = pa.RecordBatch.from_arrays(
            [pa.nulls(m, kind), pa.nulls(m, pa.bool_()), pa.array(rows, pa.int64()),
             pa.array(others, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()),
             *[pa.nulls(m, pa.int64()) for _ in range(3)], *[pa.nulls(m, pa.float64()) for _ in range(3)]],
            names=names,
        )
        for start in range(0, m, 50_000):
            yield spread.slice(start, 50_000)

    return run


def score_texts(
    docs: DataFrame,
    held_out: Column,
    keep: list[str] | None = None,
    coded: int = CODED,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``docs`` (text, ...) with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` and ``bits_per_byte`` (of the words and what ends them).

    ``held_out`` must not be null; those rows teach nothing. ``score`` is the model's log10
    probability of the text as tokens in their order, ``base_score`` that of smoothed word counts.
    ``keep`` names the columns of ``docs`` to carry, all by default; columns with the new names are
    replaced. ``coded`` words have a path, the others are spelled after an escape. A null text is
    empty: its one token is the end. Rows alike are scored alike, and scores (rounded to six
    digits) do not depend on partitions. An empty table gives an empty table. If all rows are held
    out, N and V are 0 and the model knows nothing.
    """
    added = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.struct(*kept).alias("doc"), F.col("text").alias("text"), held_out.alias("held_out"))
    counted = rows.select("text", "held_out").mapInArrow(_count_words, "word string, n long")
    vocabulary = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    v, n = vocabulary.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = vocabulary.filter(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    usual = vocabulary.filter((F.col("word") != END) & (F.col("n") > 0)).orderBy(F.desc("n"), "word").limit(coded)
    tops = usual.toArrow()  # at most ``coded`` rows
    leaves, counts = tops.column("word").cast(pa.binary()).to_pylist(), tops.column("n").to_pylist()
    escaped = n - ends - sum(counts)
    # Whatever was seen once might as well not have been: that is how often new words come.
    new = sum(c == 1 for c in counts)
    model = train_paths(rows, huffman(leaves, [escaped + new, ends, *counts]), n)

    has_path = F.col("word") == END
    if counts:  # those before the last coded word, in the order they were taken
        last, word = counts[-1], leaves[-1].decode()
        has_path = has_path | (F.col("n") > last) | ((F.col("n") == last) & (F.col("word") <= word))
    rare = F.when(has_path, 0).otherwise(F.col("n")).cast("long").alias("rare")
    spelling = vocabulary.select("word", F.col("n").alias("all"), rare)
    spelling = spelling.withColumn("n", F.when((F.col("all") > 0) & (F.col("rare") == 0), 1).otherwise(F.col("rare")))
    speller = train(spelling.filter(F.col("word") != END), v)
    bits = spelling.mapInArrow(_score_words(speller), "word string, all long, rare long, n long, log_bits double")
    scored = stage(bits, "lm-bits")
    weight = mixture_weight(scored, escaped)
    base = F.log10((F.col("all") + 0.1) / (n + 0.1 * (v + 1)))
    # The logarithm holds where the power is zero.
    spelled = F.greatest(
        F.log10(F.greatest(F.pow(F.lit(10.0), "log_bits") * (1 - weight) + F.col("rare") / max(escaped, 1) * weight, F.lit(1e-300))),
        F.col("log_bits") + float(np.log10(1 - weight)),
    )
    known = (F.col("all") > 0) & (F.col("rare") == 0)
    spelled = F.when(known | (F.col("word") == END), 0.0).otherwise(spelled)
    scored = stage(scored.select("word", F.col("all").alias("n"), base.alias("base"), spelled.alias("spelled")), "lm-scored")

    held = max(frequent, coded + 1)  # the end and all words with a path are among them
    has_leaf = F.col("word") == END  # which few long texts have seldom
    top = scored.orderBy(has_leaf.desc(), F.desc("n"), "word").limit(held).toArrow()
    table = (top.column("word").cast(pa.binary()).to_pylist(), *[top.column(c).to_numpy() for c in ("n", "base", "spelled")])
    doc = rows.select("doc").schema["doc"].dataType.simpleString()
    numbered = rows.select("doc", "text", "held_out", F.monotonically_increasing_id().alias("row"))
    parts = stage(
        numbered.mapInArrow(
            _add_up(*table, model),
            f"doc {doc}, held_out boolean, row long, word string, times long, n_tokens long, n_known long, "
            "bytes long, base double, paths double, spelled double",
        ),
        "lm-parts",
    )
    rest = parts.filter("word IS NOT NULL").select("row", "word", "times").join(
        scored.withColumnRenamed("base", "base_of").withColumnRenamed("spelled", "spelled_of"), "word"
    )
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("base_of")).alias("more_base"),
        F.sum(F.col("times") * F.col("spelled_of")).alias("more_spelled"),
    )
    joined = parts.filter("word IS NULL").drop("word", "times").join(rest, "row", "left")

    def whole(of: Column, more: str, nothing: float) -> Column:
        return of + F.coalesce(more, F.lit(nothing))

    score = F.round(F.col("paths") + whole(F.col("spelled"), "more_spelled", 0.0), 6)
    return joined.select(
        "doc.*",
        "held_out",
        "n_tokens",
        whole(F.col("n_known"), "more_known", 0).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        whole(F.col("base"), "more_base", 0.0).alias("base_score"),
        score.alias("score"),
        (-score / float(np.log10(2)) / F.col("bytes")).alias("bits_per_byte"),
    )

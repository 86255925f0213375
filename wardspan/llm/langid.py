"""Language identification by a string kernel.

The blended-spectrum presence kernel of two texts counts the byte n-grams of 1 to 4 bytes that both
hold, divided by the geometric mean of what each holds. N-grams are hashed to ``DIM`` places, so a
text is a row of bits. A long text would fill them all, in any language: it is cut into spans of
``SPAN`` bytes, and its kernel value is the sum over all its spans. Kernel ridge regression, one language against the rest, is solved in the
space that ``landmarks`` training texts span (Nystroem). Scoring a batch is two matrix products:
batch x landmarks, then landmarks x languages.

The classifier is fitted on a bounded sample of labelled texts (``per_lang`` each and ``most`` in
all); rows of places, not texts, are brought to the driver. Every text is scored as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.llm.common import fresh_name

DIM = 4096
SIZES = (1, 2, 3, 4)
SPAN = 2048  # bytes of a text that share one row of bits
BATCH = 128
PIECE = 1 << 20  # bytes of a text that are hashed at a time
UNKNOWN = "und"
# Letters of ASCII in lower case and all bytes beyond it; the rest becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _folded(text: str | None) -> bytes:
    folded = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())
    return b" " + folded + b" " if folded else b""


def _places(folded: bytes) -> np.ndarray:
    found = np.zeros(DIM, bool)
    data = np.frombuffer(folded, np.uint8)
    for start in range(0, len(data), PIECE):
        piece = data[start : start + PIECE + SIZES[-1] - 1].astype(np.uint32)
        code = np.zeros(len(piece), np.uint32)
        for size in SIZES:
            if len(piece) < size:
                break
            code = code[: len(piece) - size + 1] * np.uint32(257) + piece[size - 1 :] + np.uint32(1)
            found[(code * np.uint32(2654435761)) >> np.uint32(32 - 12)] = True
    return found


def presence(text: str | None) -> np.ndarray:
    """Which hashed n-grams the folded text holds, as DIM booleans."""
    return _places(_folded(text))


def spectrum(text: str | None) -> np.ndarray:
    """The text's row in the kernel's space, of length 1: the sum over its spans, all of about the
    same size, of their bits divided by the root of how many are set."""
    folded = _folded(text)
    row, spans = np.zeros(DIM, np.float32), max(1, round(len(folded) / SPAN))
    ends = [len(folded) * i // spans for i in range(spans + 1)]
    for start, end in zip(ends, ends[1:]):
        bits = _places(folded[start : end + SIZES[-1] - 1])  # n-grams that begin in the span
        row += bits / np.float32(np.sqrt(max(np.count_nonzero(bits), 1)))
    return row / max(np.float32(np.linalg.norm(row)), np.float32(1e-9))


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # landmarks x DIM, rows of length 1
    weights: np.ndarray  # landmarks x languages

    def scores(self, texts: np.ndarray) -> np.ndarray:
        """Regression values of texts' rows, of any length, a column per language."""
        rows = texts.astype(np.float32)
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        return rows @ self.landmarks.T @ self.weights


def solve(texts: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> Model:
    """Kernel ridge regression on all rows, restricted to evenly chosen landmarks.

    Languages have equal weight in the fit however many rows they have.
    """
    languages = sorted(set(labels))
    rows = texts.astype(np.float64)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    chosen, turn = [], 0
    of = {lang: [i for i, x in enumerate(labels) if x == lang] for lang in languages}
    while len(chosen) < min(landmarks, len(labels)):
        chosen += [of[lang][turn] for lang in languages if turn < len(of[lang])]
        turn += 1
    marks = rows[chosen[:landmarks]]
    cross, own = rows @ marks.T, marks @ marks.T
    weight = np.array([1 / len(of[lang]) for lang in labels])[:, None]
    goal = np.array([[float(x == lang) for lang in languages] for x in labels])
    left = cross.T @ (cross * weight) + ridge * own + 1e-9 * np.eye(len(marks))
    solved = np.linalg.solve(left, cross.T @ (goal * weight))
    return Model(languages, marks.astype(np.float32), solved.astype(np.float32))


def labelled_sample(docs: DataFrame, per_lang: int, most: int) -> DataFrame:
    """``per_lang`` distinct texts of each language, or all if there are fewer, chosen by a hash of
    the text, each once: text, lang. Languages take turns up to ``most`` texts, so each of up to ``most`` has one."""
    key = F.xxhash64(F.lit("sample"), "text")
    distinct = docs.select("lang", key.alias("_key")).distinct()
    ample = per_lang + 10 * per_lang**0.5 + 20  # drawn, so that hardly ever fewer than wanted are
    counts = distinct.groupBy("lang").agg(F.least(F.lit(1.0), ample / F.count(F.lit(1))).alias("_share"))
    counts = counts.orderBy(F.desc("_share"), "lang").limit(most)  # one row per language
    chance = F.pmod(F.col("_key"), F.lit(1 << 52)) / (1 << 52)
    drawn = distinct.join(counts, "lang").filter(chance < F.col("_share"))  # a bounded part of each
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(chance, "_key"))
    drawn = drawn.select("lang", "_key", turn.alias("_turn")).filter(F.col("_turn") <= per_lang)
    drawn = drawn.orderBy("_turn", "lang").limit(most)
    texts = docs.withColumn("_key", key).join(F.broadcast(drawn.drop("_turn")), ["lang", "_key"])
    return texts.groupBy("lang", "_key").agg(F.first("text").alias("text")).select("text", "lang")


def fit(
    docs: DataFrame,
    per_lang: int = 400,
    most: int = 4000,
    landmarks: int = 192,
    ridge: float = 1e-3,
) -> Model:
    """Fit on the rows of ``docs`` (text, lang) that have a language and letters: ``per_lang``
    texts of each, ``most`` in all. Copies count once, and a text of the sample is made a row of
    places once; only these rows are brought to the driver."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spectra = pa.array([spectrum(t).tobytes() for t in texts], pa.binary())
            letters = pa.array([has_letter(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [spectra, letters, batch.column("lang")], names=["spectrum", "letters", "lang"]
            )

    # Texts without letters are no part of the sample; what is a letter to Python alone decides.
    known = docs.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    packed = labelled_sample(known, per_lang, most).mapInArrow(
        pack, "spectrum binary, letters boolean, lang string"
    )
    rows = sorted(set(tuple(r) for r in packed.filter("letters").select("lang", "spectrum").collect()))
    if not rows:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros((0, 0), np.float32))
    order = np.random.default_rng(0).permutation(len(rows))
    spectra = np.array([np.frombuffer(bytes(rows[i][1]), np.float32) for i in order])
    return solve(spectra, [rows[i][0] for i in order], landmarks, ridge)


def predict(text: Column, model: Model) -> Column:
    """A struct (lang, score) for each text. The score is the language's share of the positive
    regression values, 0 for ``und``."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    @F.pandas_udf(kind)
    def scored(texts: pd.Series) -> pd.DataFrame:
        langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
        for at in range(0, len(rows), BATCH):
            some = rows[at : at + BATCH]
            values = np.maximum(model.scores(np.array([spectrum(texts.iloc[i]) for i in some])), 1e-6)
            best = values.argmax(axis=1)
            langs[some] = np.array(model.languages, object)[best]
            scores[some] = values[np.arange(len(some)), best] / values.sum(axis=1)
        return pd.DataFrame({"lang": langs, "score": np.clip(scores, 0, 1)})

    return scored(text)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with ``lang_pred`` and ``score``; columns of these names are replaced.

    A text that is null or has no letter, or any text if nothing was learned, is ``und`` with score
    0. All spans of a long text count alike. Repeated rows are scored alike.
    """
    docs = docs.drop("lang_pred", "score")
    found = fresh_name(docs, "found")
    scored = docs.withColumn(found, predict(F.col("text"), model))
    return scored.select(
        *docs.columns, F.col(f"{found}.lang").alias("lang_pred"), F.col(f"{found}.score").alias("score")
    )


def reject_unknown(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those of no language; columns stay as they are."""
    found = fresh_name(docs, "found")
    scored = docs.withColumn(found, predict(F.col("text"), model))
    return scored.filter(F.col(f"{found}.lang") != UNKNOWN).select(*docs.columns)

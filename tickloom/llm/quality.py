"""Text quality by ordinal regression: one set of hashed-text weights, ordered thresholds between grades.

P(grade <= k) = sigmoid(threshold[k] - weight . x). x is the mean of what a text's words hash to: the word,
its shape (runs of capitals, small letters, digits, and each other character), whether it repeats the
word before it; and a few hashed properties of the whole text. From the fitted model come the expected
grade and the probability of a grade of at least ``target``, by which documents are selected.

The model is fitted on at most ``max_rows`` rated rows, those with the smallest hash of their id, by one task
as sparse vectors. Scoring is one narrow Arrow function; the weights it carries have
a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

DIM = 1 << 18


@dataclass
class OrdinalModel:
    grades: np.ndarray  # the grades seen, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # one less than grades, ascending

    def cumulative(self, margin: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each row and each grade, the last of which is 1."""
        inner = 1 / (1 + np.exp(np.clip(margin[:, None] - self.thresholds[None, :], -60, 60)))
        return np.hstack([inner, np.ones((len(margin), 1))])

    def expected(self, margin: np.ndarray) -> np.ndarray:
        return np.diff(self.cumulative(margin), axis=1, prepend=0) @ self.grades

    def tail(self, margin: np.ndarray, target: int) -> np.ndarray:
        """P(grade >= target)."""
        below = np.flatnonzero(self.grades < target)
        return 1 - self.cumulative(margin)[:, below[-1]] if len(below) else np.ones(len(margin))


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode()) % DIM


def _shape(words: pa.Array) -> pa.Array:
    for pattern, by in (("[0-9]+", "9"), (r"\p{Lu}+", "X"), (r"[\p{L}]*[\p{Ll}\p{Lo}\p{Lm}]", "x")):
        words = pc.replace_substring_regex(words, pattern, by)
    return words


def token_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots of words, shapes and repetitions, n x 3; offsets of texts; slots of text properties, texts x 2)."""
    words, offsets = common.split_words(texts)
    coded = words.dictionary_encode()
    distinct, code = coded.dictionary, coded.indices.to_numpy()
    word_slot = np.fromiter((xxhash.xxh32_intdigest(w) % DIM for w in pc.cast(distinct, pa.large_binary()).to_pylist()),
                            np.int64, len(distinct))
    shapes = _shape(distinct).dictionary_encode()
    shape_slot = np.array([_slot("shape " + s) for s in shapes.dictionary.to_pylist()], np.int64)
    again = np.zeros(len(code), bool)
    again[1:] = code[1:] == code[:-1]
    starts = offsets[:-1][offsets[:-1] < len(code)]
    again[starts] = False
    slots = np.stack([word_slot[code], shape_slot[shapes.indices.to_numpy()][code],
                      np.where(again, _slot("repeats"), _slot("new"))], axis=1) if len(code) else np.empty((0, 3), np.int64)
    n = np.diff(offsets)
    repeats = np.concatenate([[0], np.cumsum(again)])
    share = (repeats[offsets[1:]] - repeats[offsets[:-1]]) / np.maximum(n, 1)
    size = np.array([_slot(f"size {k}") for k in range(65)])[np.ceil(np.log2(n + 1)).astype(int)]
    rate = np.array([_slot(f"repeated {k}") for k in range(11)])[np.floor(10 * share).astype(int)]
    return slots, offsets, np.stack([size, rate], axis=1)


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    slots, offsets, whole = token_slots(texts)
    total = np.concatenate([[0], np.cumsum(weights[slots].sum(axis=1, dtype=np.float64))])
    n = np.maximum(np.diff(offsets), 1)
    return (total[offsets[1:]] - total[offsets[:-1]]) / n + weights[whole].sum(axis=1, dtype=np.float64)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        slots, offsets, whole = token_slots(batch.column("text"))
        rows = []
        for i, grade in enumerate(batch.column("grade").to_pylist()):
            part = slots[offsets[i]:offsets[i + 1]].ravel()
            at, count = np.unique(part, return_counts=True)
            value = count / max(len(part) // 3, 1)
            rows.append({"grade": grade, "at": np.concatenate([at, whole[i]]).astype(np.int32),
                         "value": np.concatenate([value, np.ones(2)]).astype(np.float32)})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("grade", pa.int32()), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))]))


def fit_ordinal(grade: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray, steps: int = 300,
                rate: float = 0.5, decay: float = 1e-6) -> OrdinalModel:
    """Fit weights and ordered thresholds by Adam on the mean log-likelihood of all rows.

    The sparse entry k says that row ``rows[k]`` has ``value[k]`` in slot ``at[k]``. A threshold is the one
    before it plus the exponential of a free number, so the order always holds.
    """
    grades = np.unique(grade)
    level = np.searchsorted(grades, grade)
    n, cuts = len(grade), len(grades) - 1
    share = np.clip(np.cumsum(np.bincount(level, minlength=cuts + 1))[:-1] / n, 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    used, at = np.unique(at, return_inverse=True)
    w = np.zeros(len(used))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(free), np.zeros_like(free)]
    if not cuts:
        return OrdinalModel(grades, np.zeros(DIM, np.float32), np.empty(0))
    for step in range(1, steps + 1):
        theta = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        margin = np.bincount(rows, value * w[at], minlength=n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            up, low = (1 / (1 + np.exp(margin - edge[level + 1]))), (1 / (1 + np.exp(margin - edge[level])))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p / n, low * (1 - low) / p / n
        g_w = np.bincount(at, value * (d_up - d_low)[rows], minlength=len(w)) + decay * w
        g_theta = np.bincount(level, -d_up, minlength=cuts + 1)[:cuts] + np.bincount(level, d_low, minlength=cuts + 1)[1:]
        g_free = np.concatenate([[g_theta.sum()], [g_theta[k:].sum() * np.exp(free[k]) for k in range(1, cuts)]])
        for k, (x, g) in enumerate(((w, g_w), (free, g_free))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    weights = np.zeros(DIM, np.float32)
    weights[used] = w
    theta = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return OrdinalModel(grades, weights, theta)


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          grade_col: str = "quality", max_rows: int = 4000) -> OrdinalModel | None:
    """The model of at most ``max_rows`` rated documents; None if no document is rated.

    Null grades and ids are no ratings; a document rated twice counts twice. Grades are integers in any
    number; a single grade gives a model that always answers it.
    """
    rated = ratings.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"))
    rated = rated.dropna().orderBy(F.xxhash64("id"), "id", "grade").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(rated, "id").select("text", "grade")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = list(batches)
        if not known:
            return
        table = pa.Table.from_batches(known)
        size = pc.list_value_length(table["at"]).to_numpy()
        flat = [pa.concat_arrays([part.flatten() for part in table[c].chunks]).to_numpy() for c in ("at", "value")]
        model = fit_ordinal(table["grade"].to_numpy(), np.repeat(np.arange(len(size)), size), flat[0], flat[1].astype(float))
        yield pa.RecordBatch.from_pylist([{"grades": model.grades.tolist(), "weights": model.weights.tobytes(), "thresholds": model.thresholds.tolist()}],
                                         schema=pa.schema([("grades", pa.list_(pa.int32())), ("weights", pa.binary()), ("thresholds", pa.list_(pa.float64()))]))

    vectors = rows.mapInArrow(_vectors, "grade int, at array<int>, value array<float>").repartition(1)
    fitted = vectors.mapInArrow(learn, "grades array<int>, weights binary, thresholds array<double>").first()
    if not fitted:
        return None
    return OrdinalModel(np.array(fitted.grades, np.int32), np.frombuffer(fitted.weights, np.float32), np.array(fitted.thresholds, float))


def quality_score(text: Column, model: OrdinalModel | None, target: int) -> Column:
    """struct(expected_grade, tail_probability) of a text; null without a model.

    A null text is rated as an empty one.
    """
    kind = "struct<expected_grade: double, tail_probability: double>"
    if model is None:
        return F.lit(None).cast(kind)

    def score(texts: pa.Array) -> pa.Array:
        margin = common.in_slices(lambda part: margins(part, model.weights), texts)
        return pa.StructArray.from_arrays(
            [pa.array(model.expected(margin)), pa.array(model.tail(margin, target))],
            names=["expected_grade", "tail_probability"])

    return F.arrow_udf(score, kind)(text)


def rate(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text",
         target: int = 1, min_tail: float = 0.5) -> DataFrame:
    """(id, expected_grade, tail_probability, kept) of each row; all are kept without a model."""
    rated = docs.select(F.col(id_col), quality_score(F.col(text_col), model, target).alias("rated"))
    kept = F.coalesce(F.col("rated.tail_probability") >= min_tail, F.lit(True))
    return rated.select(id_col, "rated.expected_grade", "rated.tail_probability", kept.alias("kept"))


def keep_good(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", target: int = 1,
              min_tail: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is likely enough of grade ``target`` or better."""
    if model is None:
        return docs
    score, = common.fresh(docs, "rated")
    rated = docs.withColumn(score, quality_score(F.col(text_col), model, target))
    return rated.where(F.col(f"{score}.tail_probability") >= min_tail).drop(score)

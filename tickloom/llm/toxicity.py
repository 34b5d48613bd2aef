"""Toxic text by a support vector machine with a gapped subsequence kernel.

The kernel of two words counts the character triples, in order but with gaps, that they share: a triple
that spans d characters has the weight ``DECAY ** d``, up to a span of ``SPAN``. So ``idxiot`` and
``i.d.i.o.t`` stay close to ``idiot``. Word borders count as characters. Runs of single characters
(``i d i o t``) are read as one more word. A word is divided by the norm that its length gives.

Labels are of whole documents, so the machine learns from their words as bags: a toxic document
has at least one toxic word, a clean one has none. The Nyström method maps words by their kernel with a
few hundred landmark words; a linear machine with squared hinge loss is trained there, and in every
round the toxic documents' witnesses and the hardest clean words are chosen anew. The margin of a text
is that of its worst word, made a probability by Platt's scaling.

The machine is a weighted sum of kernels with the landmarks, hence a linear function of a word's triples;
it is folded into one weight per triple, which scores a word without visiting the landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tickloom.llm import common

SPAN, DECAY, TABLE = 5, 0.7, 1 << 20
GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]
BEGIN, END = 2, 3


@dataclass
class ToxicModel:
    weights: np.ndarray  # of each hashed triple
    bias: float
    slope: float  # of Platt's scaling
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def char_matrix(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points with borders) of words of similar length, zero where a word has ended."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    band = np.maximum(np.ceil(np.log2(np.maximum(size, 1))).astype(int), 3)
    for b in np.unique(band):
        places = np.flatnonzero(band == b)
        for at in range(0, len(places), max((1 << 19) >> b, 1)):
            part = places[at:at + max((1 << 19) >> b, 1)]
            chars = np.zeros((len(part), (1 << b) + 2), np.uint32)
            text = np.array([words[i] for i in part], dtype=f"U{1 << b}")
            chars[:, 1:-1] = text.view(np.uint32).reshape(len(part), 1 << b)
            chars[:, 0] = BEGIN
            chars[np.arange(len(part)), size[part] + 1] = END
            yield part, chars


def triples(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(hashed triples, where they are inside the word, weight) for each pair of gaps."""
    c = chars.astype(np.uint64)
    for a, b in GAPS:
        n = c.shape[1] - a - b
        if n <= 0:
            continue
        last = c[:, a + b:]
        mixed = (c[:, :n] * np.uint64(0x9E3779B97F4A7C15) + c[:, a:a + n]) * np.uint64(0xC2B2AE3D27D4EB4F) + last
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        yield (mixed >> np.uint64(44)).astype(np.int64), last > 0, DECAY ** (a + b + 1)


def length_norm(n: np.ndarray) -> np.ndarray:
    """The norm of a word of n characters whose triples all differ."""
    total = np.zeros(len(n))
    for a, b in GAPS:
        total += np.maximum(n + 2 - a - b, 0) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(np.maximum(total, 1e-9))


def word_margins(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(words))
    for places, chars in char_matrix(words):
        total = np.zeros(len(places))
        for at, inside, weight in triples(chars):
            total += weight * (weights[at] * inside).sum(axis=1)
        out[places] = total / length_norm((chars > 0).sum(axis=1) - 2) + bias
    return out


def units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, word of each unit, text of each unit), letters only and in lower case.

    Units are the words of a text, and each run of three or more single letters joined.
    """
    words, offsets = common.split_words(texts)
    coded = words.dictionary_encode()
    plain = pc.utf8_lower(pc.replace_substring_regex(coded.dictionary, r"[^\p{L}\p{M}]+", "")).dictionary_encode()
    coded = pa.DictionaryArray.from_arrays(plain.indices.take(coded.indices), plain.dictionary)
    code, text = coded.indices.to_numpy(), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    distinct = coded.dictionary.to_pylist()
    single = (pc.utf8_length(coded.dictionary).to_numpy() == 1)[code] if len(code) else np.empty(0, bool)
    key = np.where(single, text, -1)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    joined, owner = [], []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a >= 3 and single[a]:
            joined.append("".join(distinct[k] for k in code[a:b].tolist()))
            owner.append(text[a])
    code = np.concatenate([code, np.arange(len(joined)) + len(distinct)])
    return distinct + joined, code, np.concatenate([text, np.array(owner, int)])


def text_margins(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The greatest margin of a text's units; that of no evidence at all, the bias, if it has none."""
    words, code, text = units(texts)
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, text, word_margins(words, weights, bias)[code])
    return np.where(np.isfinite(worst), worst, min(bias, -1.0))


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse (word, triple, value) of the normalised words."""
    rows, cols, values = [], [], []
    for places, chars in char_matrix(words):
        norm = length_norm((chars > 0).sum(axis=1) - 2)
        for at, inside, weight in triples(chars):
            i, j = np.nonzero(inside)
            rows.append(places[i])
            cols.append(at[i, j])
            values.append(weight / norm[i])
    if not rows:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of every word with every landmark."""
    rows, cols, values = _features(landmarks)
    used, cols = np.unique(cols, return_inverse=True)
    dense = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(dense, (cols, rows), values)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for at in range(0, len(words), 2000):
        r, c, v = _features(words[at:at + 2000])
        place = np.searchsorted(used, c)
        place[(place == len(used)) | (used[np.minimum(place, len(used) - 1)] != c)] = len(used)
        order = np.argsort(r, kind="stable")
        r, place, v = r[order], place[order], v[order]
        for k in range(0, len(r), 1 << 15):  # few entries of few landmarks at a time
            part = slice(k, k + (1 << 15))
            begin = np.flatnonzero(np.diff(r[part], prepend=-1))
            out[at + r[part][begin]] += np.add.reduceat(dense[place[part]] * v[part, None].astype(np.float32), begin, axis=0)
    return out


def linear_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine by Newton steps on the active rows."""
    z = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(float)
    w = np.zeros(z.shape[1])
    ridge = np.ones(len(w))
    ridge[-1] = 1e-3
    for _ in range(steps):
        active = y * (z @ w) < 1
        za, c = z[active], cost * weight[active]
        new = np.linalg.solve(np.diag(ridge) + za.T @ (za * c[:, None]), za.T @ (c * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], w[-1]


def spread(word: str, rng: np.random.Generator) -> str:
    """``word`` with a letter inserted somewhere inside, as an example of how insults are hidden."""
    at = int(rng.integers(1, max(len(word), 2)))
    return word[:at] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + word[at:]


def fit(texts: list[str], toxic: np.ndarray, landmarks: int = 256, rounds: int = 4, max_words: int = 8000,
        seed: int = 7) -> ToxicModel | None:
    """The machine of labelled texts; None if only one label occurs."""
    toxic = np.asarray(toxic) > 0
    if toxic.all() or not toxic.any():
        return None
    words, code, text = units(pa.array(texts, pa.large_string()))
    text, code = np.divmod(np.unique(text * len(words) + code), len(words))
    size = np.fromiter(map(len, words), int, len(words))
    keep = (size >= 2)[code]
    text, code = text[keep], code[keep]
    clean_df = np.bincount(code[~toxic[text]], minlength=len(words))
    toxic_df = np.bincount(code[toxic[text]], minlength=len(words))
    # First guess: triples that the two kinds of text differ in, averaged over a word.
    score = np.zeros(len(words))
    clean_n, toxic_n = np.zeros(TABLE), np.zeros(TABLE)
    for places, chars in char_matrix(words):
        for at, inside, _ in triples(chars):
            clean_n += np.bincount(at.ravel(), (inside * clean_df[places][:, None]).ravel(), minlength=TABLE)
            toxic_n += np.bincount(at.ravel(), (inside * toxic_df[places][:, None]).ravel(), minlength=TABLE)
    odds = np.log((toxic_n + 0.5) / (toxic_n.sum() + 0.5)) - np.log((clean_n + 0.5) / (clean_n.sum() + 0.5))
    score = word_margins(words, odds.astype(np.float32), 0.0)
    score += np.log((toxic_df + 0.2) / (clean_df + 0.2))
    score[clean_df > 0] = -np.inf

    rng = np.random.default_rng(seed)
    clean_words = np.flatnonzero(clean_df > 0)
    negatives = rng.permutation(clean_words)[: max_words // 2]

    def witnesses(by: np.ndarray) -> np.ndarray:
        """For every toxic text its most toxic words."""
        mine = toxic[text] & np.isfinite(by[code])
        t, c = text[mine], code[mine]
        order = np.lexsort((c, -by[c], t))
        t, c = t[order], c[order]
        rank = np.arange(len(t)) - np.searchsorted(t, t)
        return np.unique(c[rank < 2])

    found, model = witnesses(score), None
    for _ in range(rounds):
        top = found[np.argsort(-toxic_df[found], kind="stable")][: landmarks // 2]
        chosen = np.concatenate([top, negatives[: landmarks - len(top)]])
        marks = [words[i] for i in chosen]
        gram = kernel(marks, marks).astype(float)
        value, vector = np.linalg.eigh(gram)
        good = value > 1e-6 * value[-1]
        root = vector[:, good] / np.sqrt(value[good])
        insults = [words[i] for i in found]
        insults += [spread(w, rng) for w in insults]
        x = kernel(insults + [words[i] for i in negatives], marks) @ root
        y = np.concatenate([np.ones(len(insults)), -np.ones(len(negatives))])
        share = np.where(y > 0, 1 / max(len(insults), 1), 1 / max(len(negatives), 1)) * 500
        w, bias = linear_machine(x, y, share)
        alpha = root @ w
        r, c, v = _features(marks)
        weights = np.bincount(c, v * alpha[r], minlength=TABLE).astype(np.float32)
        model = weights, float(bias)
        margin = word_margins(words, *model)
        hard = clean_words[np.argsort(-margin[clean_words], kind="stable")][: max_words // 4]
        negatives = np.unique(np.concatenate([negatives[: max_words // 2], hard]))
        negatives = rng.permutation(negatives)
        by = margin.copy()
        by[clean_df > 0] = -np.inf
        found = witnesses(by)
        found = found[margin[found] > min(0.0, np.median(margin[found]))]
    worst = np.full(len(texts), min(model[1], -1.0))
    np.maximum.at(worst, text, word_margins(words, *model)[code])
    slope, shift = _platt(worst, toxic)
    return ToxicModel(*model, slope, shift)


def _platt(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the labels, each kind having equal weight in all."""
    up, down = label.sum(), (~label).sum()
    target = np.where(label, (up + 1) / (up + 2), 1 / (down + 2))
    weight = np.where(label, 0.5 / up, 0.5 / down)
    z, p = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(steps):
        f = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
        gradient = z.T @ (weight * (f - target)) + 1e-4 * p
        p = p - np.linalg.solve((z * (weight * np.maximum(f * (1 - f), 1e-6))[:, None]).T @ z + 1e-4 * np.eye(2), gradient)
    return float(max(p[0], 1e-3)), float(p[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = 1000) -> ToxicModel | None:
    """The machine of at most ``max_rows`` labelled documents of each kind; None unless both kinds occur.

    The documents with the smallest hash of their id are taken; null labels and ids are no labels. One task fits
    the machine, since the driver's memory is scarcer; the driver receives the machine only.
    """
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).alias("toxic")).dropna()
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("toxic").orderBy(*order).limit(max_rows).union(
        known.where("NOT toxic").orderBy(*order).limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = list(batches)
        if not known:
            return
        table = pa.Table.from_batches(known).sort_by([("id", "ascending"), ("text", "ascending")])
        model = fit(table["text"].to_pylist(), table["toxic"].to_numpy())
        if model is not None:
            yield pa.RecordBatch.from_pylist([{"weights": model.weights.tobytes(), "bias": model.bias, "slope": model.slope, "shift": model.shift}])

    fitted = rows.select("id", "text", "toxic").repartition(1).mapInArrow(learn, "weights binary, bias double, slope double, shift double").first()
    return ToxicModel(np.frombuffer(fitted.weights, np.float32), fitted.bias, fitted.slope, fitted.shift) if fitted else None


def toxicity(text: Column, model: ToxicModel | None) -> Column:
    """The probability that a text is toxic; a null text counts as empty. 0 without a model."""
    if model is None:
        return F.lit(0.0)

    def score(texts: pa.Array) -> pa.Array:
        margin = common.in_slices(lambda part: text_margins(part, model.weights, model.bias), texts)
        return pa.array(model.probability(margin))

    return F.arrow_udf(score, DoubleType())(text)


def keep_clean(docs: DataFrame, model: ToxicModel | None, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``limit``."""
    score, = common.fresh(docs, "toxicity")
    return docs.withColumn(score, toxicity(F.col(text_col), model)).where(F.col(score) < limit).drop(score)

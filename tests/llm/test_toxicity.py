import llm_helpers  # noqa: F401
import numpy as np
import pytest
import pyarrow as pa

from tickloom.llm import toxicity

PLAIN = ("river mill child summer garden window letter morning village bridge music yellow table silver winter paper orange "
         "stone evening market forest kitchen doctor pencil basket ladder candle mirror button pocket").split()
BAD = ["scoundrel", "blockhead", "numbskull", "vermin"]


def labelled(n=300, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [str(w) for w in rng.choice(PLAIN, 30)]
        toxic = int(i % 3 == 0)
        if toxic:
            for bad in rng.choice(BAD, 2):
                words[rng.integers(30)] = str(bad)
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = labelled()
    return toxicity.fit([t for _, t, _ in rows], np.array([x for *_, x in rows]))


def score(model, *texts):
    return model.probability(toxicity.text_margins(pa.array(texts, pa.large_string()), model.weights, model.bias))


def test_held_out_texts(model):
    rows = labelled(200, seed=9)
    predicted = score(model, *[t for _, t, _ in rows]) >= 0.5
    assert np.mean(predicted == np.array([x > 0 for *_, x in rows])) > 0.97


def test_gaps_and_inserted_characters(model):
    hidden = ["You scouundrel", "what a n.u.m.b.s.k.u.l.l", "BLOCK-HEAD!", "v e r m i n", "blockxhead", "numbskulls", "(vermin)"]
    assert (score(model, *hidden) >= 0.5).all()
    assert (score(model, *PLAIN, "a b c d", "the kitchen window") < 0.5).all()


def test_folded_weights_equal_the_kernel_machine():
    words, marks = ["idiot", "idxiot", "garden", "a", "longer-word-here"], ["idiot", "garden", "market"]
    alpha = np.array([1.5, -0.5, 0.25])
    r, c, v = toxicity._features(marks)
    weights = np.bincount(c, v * alpha[r], minlength=toxicity.TABLE)
    assert np.allclose(toxicity.word_margins(words, weights, 0.1), toxicity.kernel(words, marks) @ alpha + 0.1, atol=1e-5)


def test_kernel_against_brute_force():
    def features(word):
        chars, out = [2, *map(ord, word), 3], {}
        for i in range(len(chars)):
            for j in range(i + 1, len(chars)):
                for k in range(j + 1, min(i + toxicity.SPAN, len(chars))):
                    key = (chars[i], chars[j], chars[k])
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        norm = toxicity.length_norm(np.array([len(word)]))[0]
        return {u: x / norm for u, x in out.items()}

    words = ["idiot", "idxiot", "moron", "mormon", "x", "aaaa"]
    want = [[sum(x * features(b).get(u, 0) for u, x in features(a).items()) for b in words] for a in words]
    assert np.allclose(toxicity.kernel(words, words), want, atol=1e-3)


def test_odd_rows(spark, model):
    odd = spark.createDataFrame(
        [(1, None, 5.0), (2, "", 5.0), (2, "", 5.0), (None, "vermin " + "river " * 60_000, 5.0), (4, "!!! ...", 5.0), (5, "x" * 200_000, 5.0)],
        "doc_id long, text string, toxicity double")
    got = odd.select("doc_id", toxicity.toxicity(toxicity.F.col("text"), model).alias("s")).collect()
    by = {r.doc_id: r.s for r in got}
    assert by[None] >= 0.5 and all(0 <= s < 0.5 for i, s in by.items() if i is not None) and by[1] == by[2]
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == 5
    assert toxicity.keep_clean(odd.limit(0), model).count() == 0


def test_training_on_tables(spark):
    rows = labelled(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert score(model, "such vermin")[0] >= 0.5 > score(model, "such a garden")[0]
    assert toxicity.train(docs, labels.where("toxic = 0")) is None and toxicity.train(docs.limit(0), labels) is None
    assert toxicity.keep_clean(docs, None).count() == 120


def test_the_machine_is_not_fitted_in_the_driver(spark, monkeypatch):
    rows, fitted, fit = labelled(120), [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: fitted.append(a) or fit(*a))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert not fitted and (model.weights == fit([t for _, t, _ in rows], np.array([x for *_, x in rows])).weights).all()

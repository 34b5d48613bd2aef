import llm_helpers  # noqa: F401
import numpy as np
import pyarrow as pa

from tickloom.llm import quality

GOOD = "The river runs past the old mill and the children play there every summer day"
WORDS = GOOD.split()


def graded(n=240, seed=1):
    """Texts of grade 0 to 3: the more shouting words, the lower the grade."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        grade = int(rng.integers(4))
        words = [str(w) for w in rng.choice(WORDS, 40)]
        loud = rng.choice(40, [36, 22, 9, 0][grade], replace=False)
        for k in loud:
            words[k] = words[k].upper() + "!!"
        out.append((i, " ".join(words), grade))
    return out


def tables(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, quality int")


def test_four_grades(spark):
    rows = graded()
    docs, ratings = tables(spark, rows)
    model = quality.train(docs, ratings.where("doc_id % 4 <> 0"))
    assert list(model.grades) == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.rate(docs, model, target=2).collect()}
    held = [(got[i], g) for i, _, g in rows if i % 4 == 0]
    assert np.mean([abs(r.expected_grade - g) for r, g in held]) < 0.4
    assert np.mean([r.kept == (g >= 2) for r, g in held]) > 0.9
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 3 for r in got.values())


def test_probabilities_add_up():
    model = quality.OrdinalModel(np.array([0, 1, 3]), np.zeros(quality.DIM, np.float32), np.array([-1.0, 0.5]))
    m = np.array([-2.0, 0.0, 3.0])
    c = model.cumulative(m)
    p = np.diff(c, axis=1, prepend=0)
    assert np.allclose(p.sum(axis=1), 1) and np.allclose(model.expected(m), p @ [0, 1, 3])
    assert np.allclose(model.tail(m, 1), 1 - c[:, 0]) and np.allclose(model.tail(m, 2), model.tail(m, 3))
    assert (model.tail(m, 0) == 1).all()


def test_odd_rows(spark):
    docs, ratings = tables(spark, graded(60))
    model = quality.train(docs, ratings)
    odd = spark.createDataFrame(
        [(1, None, "n", 1.0), (2, "", None, 2.0), (2, "", None, 2.0), (None, "word " * 50_000, "x", 3.0), (3, " \n\t ", "y", 4.0)],
        "doc_id long, text string, rated string, expected_grade double")
    got = quality.rate(odd, model).collect()
    assert len(got) == 5 and all(r.tail_probability is not None for r in got)
    assert len({r.tail_probability for r in got if r.doc_id in (1, 2, 3)}) == 1  # null, empty and blank alike
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.rate(odd.limit(0), model).count() == 0


def test_no_ratings_keep_everything(spark):
    docs, ratings = tables(spark, graded(10))
    for none in (ratings.limit(0), ratings.selectExpr("doc_id", "cast(null as int) quality")):
        model = quality.train(docs, none)
        assert model is None and quality.keep_good(docs, model).count() == 10
        row = quality.rate(docs, model).first()
        assert row.kept and row.expected_grade is None and row.tail_probability is None


def test_a_single_grade(spark):
    docs, ratings = tables(spark, graded(10))
    model = quality.train(docs, ratings.selectExpr("doc_id", "2 quality"))
    assert {r.expected_grade for r in quality.rate(docs, model, target=2).collect()} == {2.0}
    assert quality.keep_good(docs, model, target=3).count() == 0


def test_training_does_not_depend_on_the_order(spark):
    docs, ratings = tables(spark, graded(80))
    a, b = (quality.train(d, r, max_rows=50) for d, r in ((docs, ratings), (docs.repartition(5), ratings.orderBy("quality"))))
    text = pa.array([GOOD, GOOD.upper()], pa.large_string())
    assert np.allclose(quality.margins(text, a.weights), quality.margins(text, b.weights), atol=0.2)


def test_the_weights_are_not_fitted_in_the_driver(spark, monkeypatch):
    fitted, fit = [], quality.fit_ordinal
    monkeypatch.setattr(quality, "fit_ordinal", lambda *a: fitted.append(a) or fit(*a))
    model = quality.train(*tables(spark, graded(60)))
    assert not fitted and model.weights.any() and model.weights.dtype == np.float32 and len(model.thresholds) == len(model.grades) - 1

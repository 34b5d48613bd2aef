import math

import llm_helpers  # noqa: F401
import numpy as np
import pytest

from tickloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, cell int"


def brute(rows, every=50, k=5):
    data = [(i, np.array([math.floor(256 * float(np.float32(x))) for x in v], dtype=object)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in data:
        if q % every == 0:
            best = sorted(((-int(v.dot(w)), i) for i, w in data if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def search(spark, rows, every=50, **how):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    vectors = topk.integer_vectors(df)
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where(f"id % {every} = 0"), **how).collect())


def clustered(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    x = centres[rng.integers(6, size=n)] + 0.2 * rng.standard_normal((n, dim))
    return [(i, [float(a) for a in v]) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("how", [{}, {"max_centres": 3, "sample_rows": 20, "block_rows": 40, "query_rows": 2}])
def test_against_brute_force(spark, how):
    rows = clustered(400)
    assert search(spark, rows, every=20, **how) == brute(rows, every=20)


def test_ties_nulls_and_frequent_vectors(spark):
    rows = [(i, [0.5, 0.25]) for i in range(120)] + [(200, [0.5, 0.25]), (150, [1.0, 1.0]), (300, [-0.001, 0.0]), (151, None), (152, []),
            (153, [None, 1.0]), (154, [float("nan"), 1.0]), (155, [float("inf"), 1.0]), (250, [0.0, 0.0]), (None, [9.0, 9.0])]
    assert search(spark, rows, block_rows=16) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [float(3e5 + i), float(-2e5 - 7 * i), 1.0]) for i in range(60)]
    assert search(spark, rows, every=10) == brute(rows, every=10)


def test_few_candidates_and_empty_tables(spark):
    assert search(spark, [(0, [1.0]), (7, [2.0])]) == brute([(0, [1.0]), (7, [2.0])])
    assert search(spark, [(0, [1.0])]) == [] and search(spark, []) == [] and search(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [0.25, 1.0])]
    assert search(spark, rows) == [(0, 1, 1, 256 * 128), (0, 2, 1, 256 * 128), (0, 3, 2, 256 * 64)]


def test_node_bounds_hold():
    rng = np.random.default_rng(3)
    q, d = rng.standard_normal((200, 5)) * 50, rng.standard_normal((900, 5)) * 50
    a, b = topk.CoverTree(q, leaf=16), topk.CoverTree(d, leaf=32)
    for tree, x in ((a, q), (b, d)):
        for node, mine in enumerate(tree.points):
            assert np.linalg.norm(x[mine] - tree.centre[node], axis=1).max() <= tree.radius[node] + 1e-9
    for node in range(0, len(a.points), 3):
        top = topk.bounds(a, node, b, list(range(len(b.points))))
        for other, mine in enumerate(b.points):
            assert (q[a.points[node]] @ d[mine].T).max() <= top[other] + 1e-9

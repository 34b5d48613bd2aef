import llm_helpers  # noqa: F401
import numpy as np
import pytest

from tickloom.llm import neardup

SCHEMA = "vec_id long, embedding array<float>, label int, node long, sim float"


def brute(rows, threshold=0.93):
    good = [(i, np.array(v, dtype=float), lab) for i, v, lab in rows
            if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {}, {i: i for i, *_ in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    x = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    hit = (x @ x.T >= threshold) & np.equal.outer([g[2] for g in good], [g[2] for g in good])
    np.fill_diagonal(hit, False)
    for a, b in zip(*np.nonzero(hit), strict=True):
        ra, rb = root(good[a][0]), root(good[b][0])
        parent[max(ra, rb)] = min(ra, rb)
    for k, (i, *_) in enumerate(good):
        links[i] = (int(hit[k].sum()), root(i))
    return {i: links.get(i, (0, i)) for i, *_ in rows}


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], SCHEMA).repartition(3)
    got = neardup.near_duplicates(df, **how)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    out = got.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return out


def groups(seed=1, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for size, noise in ((90, 0.12), (40, 0.1), (5, 0.05), (2, 0.05), (2, 0.02), (1, 0)):
        centre = rng.standard_normal(dim)
        out += [centre / np.linalg.norm(centre) + noise * rng.standard_normal(dim) / np.sqrt(dim) * 4 ** 0.5 for _ in range(size)]
    out += list(rng.standard_normal((150, dim)))
    out += [out[0]] * 25 + [2 * np.array(out[95])]
    order = rng.permutation(len(out))
    return [(int(i), [float(x) for x in np.float32(out[k])], int(k) % 7 == 3 and 1 or 0) for i, k in enumerate(order)]


@pytest.mark.parametrize("how", [{}, {"k": 4, "orders": 3, "block_rows": 16}])
def test_against_brute_force(spark, how):
    rows, want = groups(), None
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows, **how)}
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0),
            (8, [float("nan"), 1.0], 0), (9, [None, 1.0], 0), (10, [float("inf"), 1.0], 0), (11, [-0.0, 1.0], 0), (12, [0.0, 1.0], 0), (None, [1.0, 0.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)}
    assert got == brute(rows) and got[11] == (1, 11) and got[1] == (1, 1) and got[None] == (0, None)


def test_repeated_rows_and_empty_tables(spark):
    out = found(spark, [(4, [1.0, 2.0], 0)] * 3)
    assert [(r.n_links, r.component_id) for r in out] == [(2, 4)] * 3
    assert found(spark, []) == [] and len(found(spark, [(1, None, 0)])) == 1


def test_recall_is_measured(spark):
    rows = groups()
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], SCHEMA)
    _, nodes = neardup.distinct_vectors(df, "vec_id", "embedding", "label")
    nothing = spark.createDataFrame([], "node long, links long, weight long")
    assert neardup.audit(nodes, nothing, 0.93, 400) == 0.0
    assert neardup.audit(nodes, nothing, 0.99999, 400) in (0.0, 1.0)


def small_groups(seed=4, dim=16):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dim)
    out = [centre + 0.05 * rng.standard_normal(dim) for _ in range(150)]
    for _ in range(60):
        centre = rng.standard_normal(dim)
        out += [centre + 0.05 * rng.standard_normal(dim) for _ in range(2)]
    return [(int(i), [float(x) for x in np.float32(out[k])], 0) for i, k in enumerate(rng.permutation(len(out)))]


@pytest.mark.parametrize("how", [{}, {"exact_rows": 0}])
def test_a_poor_search_loses_nothing(spark, how):
    rows = small_groups()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows, k=1, orders=1, max_searches=1, **how)}
    assert got == brute(rows)


def test_searched_labels_keep_what_was_found(spark):
    rows = small_groups()
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows, exact_rows=0, min_recall=0.9, min_seen=10)}
    want = brute(rows)
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.9 * len(want)


def test_small_groups_and_few_links_prove_nothing(spark):
    judged = [(k, 0, 1000, 1000) for k in range(100)] + [(200 + k, 0, 1, k % 2) for k in range(10)]
    judged += [(300 + k, 1, 4, 4) for k in range(5)] + [(400 + k, 2, 4, 4) for k in range(40)] + [(500, 3, 0, 0)]
    df = spark.createDataFrame(judged, "node long, label int, true long, found long")
    left = neardup.unproven(df, df.select("label").distinct(), 0.97, 30)
    assert sorted(r.label for r in left.collect()) == [0, 1, 3]


def test_small_labels_are_searched_too(spark, monkeypatch):
    joins, compared = [], []
    local_join, grown = neardup.local_join, neardup.grown
    monkeypatch.setattr(neardup, "local_join", lambda *a: joins.append(1) or local_join(*a))
    monkeypatch.setattr(neardup, "grown", lambda nodes, part_of, saturated, *a: compared.append(saturated.count()) or grown(nodes, part_of, saturated, *a))
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(16))], i % 2) for i in range(300)]
    rows += [(300 + i, [x * 1.01 + 0.001 for x in rows[i][1]], i % 2) for i in range(10)]  # few have links, label by label
    got = {r.vec_id: (r.n_links, r.component_id) for r in found(spark, rows)}
    assert got == brute(rows) and joins and compared[-1] == 0


def test_few_links_are_audited_further(spark):
    rows = small_groups()
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], SCHEMA)
    _, nodes = neardup.distinct_vectors(df, "vec_id", "embedding", "label")
    nothing = spark.createDataFrame([], "node long, links long, weight long")
    linked = nodes.where("node < 3")  # no links among them, and all were asked
    assert neardup.lacking(linked, nothing, 0.99999, 1, 100, 16, 0.97, 30).count() == 0
    assert [r.label for r in neardup.lacking(nodes, nothing, 0.93, 1, 10_000, 16, 0.97, 30).collect()] == [0]

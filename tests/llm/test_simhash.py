import random
import re

import numpy as np
import pytest
import xxhash

import llm_helpers  # noqa: F401

from tickloom.llm import components, simhash


def brute_fingerprint(text, width=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) and hashes)


def brute_components(fps, max_bits=3):
    ids, parent = sorted(fps), {i: i for i in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= max_bits and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40, 300]))) for _ in range(25)]
    out = base + [t.upper() for t in base[:5]] + base[:5]
    for t in base:
        parts = t.split()
        if len(parts) > 100:
            for _ in range(6):
                parts[rng.randrange(len(parts))] = rng.choice(words)
                out.append("  ".join(parts) + "\n")
    return out + ["", None, " \t\r\n", "É é x", "long " * 30_000]


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select(
        "doc_id", simhash.hex_fingerprint(simhash.F.col("fingerprint")).alias("f"), "component_id").collect()
    fps = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(fps)
    assert sorted((r.doc_id, r.f, r.component_id) for r in got) == sorted((i, f"{fps[i]:016x}", want[i]) for i in fps)


def near(seed, n, flips):
    rng = random.Random(seed)
    centre, out = rng.getrandbits(64), set()
    while len(out) < n:
        v = centre
        for b in rng.sample(range(64), rng.randint(0, flips)):
            v ^= 1 << b
        out.add(v)
    return out


@pytest.mark.parametrize("max_cell", [4096, 16])
def test_links_of_dense_cells(spark, max_cell):
    values = sorted(near(1, 150, 4) | near(2, 60, 9) | {random.Random(k).getrandbits(64) for k in range(100)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), max_cell=max_cell)
    parts = {r.node: r.component for r in components.connected_components(links).collect()}
    want = brute_components(dict(enumerate(values)))
    group = {}
    for i, v in enumerate(signed):
        group.setdefault(want[i], set()).add(parts.get(v, v))
    assert all(len(g) == 1 for g in group.values())
    assert len({next(iter(g)) for g in group.values()}) == len(group)


def test_lower_bound_never_exceeds_the_distance(spark):
    rng = np.random.default_rng(5)
    a, b = (rng.integers(-2**63, 2**63 - 1, 300) for _ in range(2))
    b[:100] = a[:100] ^ (1 << rng.integers(0, 62, 100))
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")
    F = simhash.F
    low = F.bit_count(simhash.popcounts(F.col("a")).bitwiseXOR(simhash.popcounts(F.col("b"))))
    for r in df.select("a", "b", low.alias("low"), F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("bits")).collect():
        fields = [abs(((r.a >> k) & 3).bit_count() - ((r.b >> k) & 3).bit_count()) for k in range(0, 64, 2)]
        assert r.low == sum(fields) <= r.bits


def test_empty_repeated_and_null_ids(spark):
    schema = "doc_id long, text string, fingerprint string, component string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(5, "a b c d", "x", "y"), (5, "a b c d", "x", "y"), (None, "a b c d", "x", "y"), (None, "q r s", "x", "y")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]


def test_keep_one(spark):
    rows = [(3, "a b c d", "n"), (2, "A B C D", "n"), (2, "A B C D", "n"), (None, "a b c d", "n"), (None, "z z z", "n"), (9, None, "n"), (8, "", "n")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, name string"))
    assert kept.columns == ["doc_id", "text", "name"]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [(2, "A B C D", "n"), (None, "z z z", "n"), (8, "", "n")]))


def test_components_against_brute_force(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 460)] + [
        (500, k) for k in range(501, 560)] + [(600, 600), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in list(parent)}
    assert len(got) == len(parent)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

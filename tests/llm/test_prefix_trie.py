import hashlib
import random
import zlib

import pytest
from llm_helpers import rows_of

from tickloom.llm import prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string, name string, node string"


def built(spark, rows, shared=False):
    turns = prefix_trie.numbered(prefix_trie.named_turns(spark.createDataFrame(rows, TURNS).repartition(3)))
    convs = turns.select("conv").distinct()
    turns, convs = prefix_trie.with_shared_openings(turns) if shared else (turns, convs)
    trie = prefix_trie.build(turns, convs)
    digests = prefix_trie.member_digests(trie.ends)
    ends = {(r.conv_id, r.depth): r.ends_sha256 for r in digests.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return sorted((*r, ends.get((r.conv_id, r.depth), empty)) for r in trie.nodes.collect())


def brute(rows, shared=False):
    convs = {}
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    if shared:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: convs.get(c - c % 20, [])[:h[c]] + own[h[c]:] for c, own in convs.items()}
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(members[p]) - 1) * len([w for w in p[-1][1].replace("\n", " ").split(" ") if w]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def talks(seed, convs=60, kinds=2, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"][:kinds]), rng.choice(["yes", "no no\nno", "it is"][:kinds]), "x", "y"))
    return rows


@pytest.mark.parametrize("seed, shared", [(1, False), (2, True), (3, False)])
def test_against_brute_force(spark, seed, shared):
    rows = talks(seed, longest=[0, 9, 6, 17][seed])
    assert built(spark, rows, shared) == brute(rows, shared)


def test_one_long_conversation_and_one_turn(spark):
    rows = [(7, i, "user", f"word {i % 3} of it", "", "") for i in range(70)] + [(8, i, "user", f"word {i % 3} of it", "", "") for i in range(33)]
    assert built(spark, rows) == brute(rows)
    rows = [(3, 0, "user", "one", "", "")]
    assert built(spark, rows) == brute(rows)


def test_nulls_repeats_and_nothing(spark):
    assert built(spark, []) == []
    rows = [(1, None, "user", "first", "", ""), (1, 0, None, "a b", "", ""), (2, None, "user", "first", "", ""), (2, 0, "", "a b", "", ""),
            (None, 0, "user", "x", "", ""), (3, 5, "user", None, "", ""), (4, 5, "user", "", "", ""), (5, 1, "user", "c", "", ""), (5, 2, "user", "c", "", "")]
    assert built(spark, rows) == brute(rows)
    twice = built(spark, [(1, 0, "user", "same", "", "")] * 3)
    assert [(r[1], r[3]) for r in twice] == [(0, 1), (1, 1), (2, 1), (3, 1)]


def test_conversations_without_turns_end_at_the_root(spark):
    empty = spark.createDataFrame([], "conv long, pos long, name binary, words long")
    trie = prefix_trie.build(empty, spark.createDataFrame([(5,), (3,)], "conv long"))
    assert rows_of(trie.nodes) == [(3, 0, None, 2, 0, 1, 0)] and rows_of(trie.ends) == [(3, 0, 3), (3, 0, 5)]


def test_a_node_where_most_conversations_end(spark):
    rows = [(c, 0, "user", "hello", "", "") for c in range(3000)] + [(c, 1, "user", "more", "", "") for c in range(20)]
    got = {r[1]: r for r in built(spark, rows)}
    ids = ",".join(str(c) for c in range(20, 3000))
    assert got[1] == (0, 1, 0, 3000, 1, 1, 2999 + 19, hashlib.sha256(ids.encode()).hexdigest())
    many = prefix_trie.member_digests(spark.range(3000).selectExpr("0L conv_id", "1L depth", "id member"))
    assert rows_of(many) == [(0, 1, hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest())]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = queries.op12_prefix_trie(spark, folder)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert got.columns == names and sorted(tuple(r) for r in got.collect()) == brute(rows, shared=True)

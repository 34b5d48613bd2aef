"""Exact top-k by inner product with cover trees of queries and data, searched together.

A cover tree's node has a centre and a radius that covers all its points. For a query node (centre a,
radius r) and a data node (centre b, radius s) no inner product exceeds
``a.b + |a| s + |b| r + r s``; the pair is pruned if that is below the worst k-th score known for the
queries of the node. The root level is shared: its centres are chosen on a bounded sample, every row
and every query is dealt to the nearest one, and the bound removes whole pairs of blocks before
anything is shuffled. What remains meets block by block, each with trees of its own below the root.

Blocks have bounded numbers of rows, so a frequent vector or a dense region fills more blocks, not larger
ones. Scores are integers and exact; bounds are widened by a relative 1e-9 against rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import common

SLACK = 1e-9
FOUND = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector has components, none of them null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component; unusable vectors and null ids take no part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def farthest_first(x: np.ndarray, most: int) -> np.ndarray:
    """Indices of centres, each the point farthest from those before it; fewer if all points are covered."""
    chosen = [0]
    gap = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < most and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest centre, distance to it) of each row."""
    gap = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2) if len(x) * len(centres) < 1 << 14 else (
        (x ** 2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(axis=1)[None, :])
    at = gap.argmin(axis=1)
    return at, np.sqrt(((x - centres[at]) ** 2).sum(axis=1))


class CoverTree:
    """Nodes by number: centre, its norm, covering radius, children, and the points of a leaf."""

    def __init__(self, x: np.ndarray, leaf: int, fan: int = 8):
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        self._add(x, np.arange(len(x)), leaf, fan)
        self.centres = np.array(self.centre)
        self.norms = np.linalg.norm(self.centres, axis=1)
        self.radii = np.array(self.radius)

    def _add(self, x: np.ndarray, mine: np.ndarray, leaf: int, fan: int) -> int:
        node, part = len(self.centre), x[mine]
        centre = part[((part - part.mean(axis=0)) ** 2).sum(axis=1).argmin()]
        self.centre.append(centre)
        self.radius.append(float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
        self.children.append([])
        self.points.append(mine)
        if len(mine) > leaf and self.radius[node] > 0:
            at, _ = nearest(part, part[farthest_first(part, fan)])
            for k in np.unique(at):
                self.children[node].append(self._add(x, mine[at == k], leaf, fan))
        return node


def bounds(q: CoverTree, a: int, d: CoverTree, nodes: list[int]) -> np.ndarray:
    """The greatest inner product possible between query node a and each of the data nodes."""
    s, r = d.radii[nodes], q.radii[a]
    top = d.centres[nodes] @ q.centres[a] + q.norms[a] * s + d.norms[nodes] * r + r * s
    return top + SLACK * (q.norms[a] + r) * (d.norms[nodes] + s)


def dual_search(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, data: np.ndarray, data_ids: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, data id, score) of each query's k best rows, except those of its own id.

    ``floors`` has a score for each query that its k-th best is known to reach; rows below are left out.
    """
    safe = float(np.abs(queries).max()) * float(np.abs(data).max()) * data.shape[1] < 2 ** 53
    qf, df = queries.astype(float), data.astype(float)
    exact_q, exact_d = (qf, df) if safe else (queries.astype(np.int64), data.astype(np.int64))
    low = np.iinfo(np.int64).min
    best = np.full((len(queries), k), low)
    ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    q, d = CoverTree(qf, leaf=64), CoverTree(df, leaf=128)
    floors = floors.astype(float)

    def worst(a: int) -> float:
        mine = q.points[a]
        return float(np.maximum(floors[mine], best[mine, -1].astype(float)).min())

    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        if bounds(q, a, d, [b])[0] < worst(a):
            continue
        if not q.children[a] and not d.children[b]:
            mine, theirs = q.points[a], d.points[b]
            score = np.rint(exact_q[mine] @ exact_d[theirs].T).astype(np.int64) if safe else exact_q[mine] @ exact_d[theirs].T
            score[query_ids[mine][:, None] == data_ids[theirs][None, :]] = low
            both = np.hstack([best[mine], score])
            who = np.hstack([ids[mine], np.broadcast_to(data_ids[theirs], score.shape)])
            who[both == low] = np.iinfo(np.int64).max
            order = np.lexsort((who, -both.astype(np.float64) if safe else ~both), axis=1)[:, :k]
            best[mine], ids[mine] = np.take_along_axis(both, order, 1), np.take_along_axis(who, order, 1)
        elif d.children[b] and (not q.children[a] or d.radii[b] >= q.radii[a]):
            kids = d.children[b]
            stack += [(a, kids[i]) for i in np.argsort(bounds(q, a, d, kids))]  # the best is taken next
        else:
            stack += [(c, b) for c in q.children[a]]
    who, place = np.nonzero((best > low) & (best.astype(float) >= floors[:, None]))
    return who, ids[who, place], best[who, place]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, max_centres: int = 32, sample_rows: int = 4096,
          block_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each query, ties to the smaller id.

    Both inputs are ``integer_vectors``. A query's own id is no candidate; of a query id given more than once
    the least vector is asked; rows of ``vectors`` with one id are all candidates. The most frequent
    dimension (the smallest, if tied) is searched, vectors of others take no part. Fewer candidates than
    k give fewer rows; no vectors or no queries give none. ``sample_rows`` bounds the sample that the
    root level and the first scores come from; every row is indexed and searched.
    """
    spark = vectors.sparkSession
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if dims is None:
        return nothing
    n_dim = dims[0]
    vectors = vectors.where(F.size("v") == n_dim)
    queries = queries.where(F.size("v") == n_dim).groupBy("id").agg(F.min("v").alias("v"))
    sample = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).toArrow().combine_chunks()
    known_ids, known = sample["id"].to_numpy(), matrix(sample["v"].combine_chunks())
    centres = known[farthest_first(known.astype(float), max_centres)].astype(float)
    coarse = centres[:8]

    def deal(batches: Iterator[pa.RecordBatch], is_query: bool) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000)):
            x = matrix(batch.column("v"))
            cell, gap = nearest(x.astype(float), coarse if is_query else centres)
            floors = np.full(len(x), np.iinfo(np.int64).min)
            if is_query and len(known) > k:  # the sample's k-th best score: any query reaches it
                for at in range(0, len(x), 256):
                    part = slice(at, at + 256)
                    score = x[part].astype(float) @ known.T.astype(float)
                    score[batch.column("id").to_numpy()[part][:, None] == known_ids[None, :]] = -np.inf
                    kth = np.sort(score, axis=1)[:, -k]
                    floors[part] = np.where(np.isfinite(kth), np.floor(kth - SLACK * np.abs(kth)), floors[part])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(gap), pa.array(floors)],
                names=["id", "v", "cell", "gap", "floor"])

    dealt = "id long, v array<long>, cell int, gap double, floor long"
    data = common.written(vectors.mapInArrow(lambda b: deal(b, False), dealt))
    asked = common.written(queries.mapInArrow(lambda b: deal(b, True), dealt))

    def nodes(rows: DataFrame) -> list:
        return rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius"), F.min("floor").alias("floor")).collect()

    data_nodes, query_nodes = nodes(data), nodes(asked)  # as many as there are centres
    pairs = []
    for a in query_nodes:
        centre, r = coarse[a["cell"]], a["radius"]
        for b in data_nodes:
            other, s = centres[b["cell"]], b["radius"]
            norms = np.linalg.norm(centre), np.linalg.norm(other)
            top = centre @ other + norms[0] * s + norms[1] * r + r * s
            if top + SLACK * (norms[0] + r) * (norms[1] + s) >= a["floor"]:
                pairs.append((a["cell"], b["cell"], -(-a["n"] // query_rows), -(-b["n"] // block_rows)))
    if not pairs:
        return nothing
    # A row per pair of root nodes, with the number of blocks of either; at most 8 * max_centres.
    table = F.broadcast(spark.createDataFrame(pairs, "q_cell int, d_cell int, q_blocks int, d_blocks int"))

    def own_block(blocks: str) -> Column:
        return F.pmod(F.xxhash64("id", "v"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    key = ["q_cell", "d_cell", "q_block", "d_block"]
    left = asked.withColumnRenamed("cell", "q_cell").join(table, "q_cell").select(
        "id", "v", "floor", "q_cell", "d_cell", own_block("q_blocks").alias("q_block"), every("d_blocks").alias("d_block"))
    right = data.withColumnRenamed("cell", "d_cell").join(table, "d_cell").select(
        "id", "v", "q_cell", "d_cell", own_block("d_blocks").alias("d_block"), every("q_blocks").alias("q_block"))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)] * 3
        if len(mine) and len(theirs):
            mine, theirs = mine.combine_chunks(), theirs.combine_chunks()
            ids = mine["id"].to_numpy()
            who, vec, score = dual_search(matrix(mine["v"].combine_chunks()), ids, mine["floor"].to_numpy(),
                                          matrix(theirs["v"].combine_chunks()), theirs["id"].to_numpy(), k)
            found = [ids[who], vec, score]
        return pa.table(found, names=["query_id", "vec_id", "score"])

    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

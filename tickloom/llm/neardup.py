"""Near-duplicate embeddings by NN-descent inside each label.

Every distinct vector keeps a list of its nearest neighbours. The lists start from neighbours along
several random orders and are refined by local joins: two neighbours of one vector may be neighbours of
each other. Rounds go on until few lists change. Pairs at the threshold or above, verified in double
precision, are links. Labels of every size are searched so.

A list that is full of links is saturated: there may be more. The lists of its component then grow to the
whole component, which is compared block by block, so that every member's links are counted; blocks
have a bounded number of rows and give counts and merged sets, never pairs. Last, the recall is
measured for some vectors of each label against all vectors of the label, for each size of group by itself, and
for ten times as many where too few of them have links. Labels whose recall is below ``min_recall`` are
searched again with more orders and longer lists; what lacks it after the last search is checked as a whole.

Exactly equal vectors of one label are one vector with a multiplicity, so copies cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import common
from tickloom.llm.components import connected_components
from tickloom.llm.simhash import merge
from tickloom.llm.topk import matrix, usable

EDGE = "u long, v long, sim float"
MARGIN = 0.01  # what half precision may be off by
BLOCK = 128  # rows along a random order that are compared with each other and the next block


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _halves(x: np.ndarray) -> pa.Array:
    """Unit vectors in half precision, packed."""
    return pa.array([row.tobytes() for row in unit(x).astype(np.float16)], pa.binary())


def _floats(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float16).reshape(len(column), -1).astype(np.float32) if len(column) else np.empty((0, 0), np.float32)


def distinct_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(members, nodes): (id, node) of usable rows; (node, label, v, copies) of distinct vectors.

    A node is named by the smallest id of its copies. Ids that are null, vectors that are null, empty, zero
    or hold a null or not finite component, and null labels take no part.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
    rows = rows.where(fit).where(F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + 0.0))  # no negative zeros
    rows = rows.withColumn("same", F.sha2(F.concat_ws(",", F.col("v").cast("array<string>"), F.col("label").cast("string")), 256))
    nodes = common.written(rows.groupBy("same").agg(
        F.min("id").alias("node"), F.any_value("label").alias("label"), F.any_value("v").alias("v"), F.count("*").alias("copies")))
    members = rows.select("id", "same").join(nodes.select("same", "node"), "same").select("id", "node")
    return members, nodes.drop("same")


def best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours of each node."""
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return edges.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def along_orders(nodes: DataFrame, orders: int, k: int, seed: int) -> DataFrame:
    """Edges between near neighbours in random orders: sorted by the signs of random projections."""
    n = common.shuffle_partitions(nodes.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000)):
            x = unit(matrix(batch.column("v")))
            half = _halves(x)
            for order in range(orders):
                planes = np.random.default_rng((seed, order, x.shape[1])).standard_normal((x.shape[1], 24))
                sign = (x @ planes > 0) @ (1 << np.arange(24))[::-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("label"), half, pa.array(np.full(len(x), order, np.int32)), pa.array(sign)],
                    names=["node", "label", "half", "tree", "code"])

    kind = nodes.schema["label"].dataType.simpleString()
    coded = nodes.select("node", "label", "v").mapInArrow(code, f"node long, label {kind}, half binary, tree int, code long")
    place = ["tree", "label", "code", "node"]  # with the node, a frequent code is spread over partitions
    coded = coded.repartitionByRange(n, *place).sortWithinPartitions(*place)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            table = table.combine_chunks()
            node, x = table["node"].to_numpy(), _floats(table["half"].combine_chunks())
            group = table["label"].to_numpy() if pa.types.is_integer(table["label"].type) else np.unique(
                np.array(table["label"].to_pylist(), dtype=object).astype(str), return_inverse=True)[1]
            group = group.astype(np.int64) * 1024 + table["tree"].to_numpy()
            for at in range(0, len(node), BLOCK):
                a, b = slice(at, at + BLOCK), slice(at, at + 2 * BLOCK)
                sim = x[a] @ x[b].T
                sim[(group[a][:, None] != group[b][None, :]) | (node[a][:, None] == node[b][None, :])] = -2
                top = np.argpartition(-sim, min(k, sim.shape[1] - 1), axis=1)[:, :k]
                value = np.take_along_axis(sim, top, 1)
                i, j = np.nonzero(value > -2)
                u, v, s = node[a][i], node[b][top[i, j]], value[i, j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([u, v])), pa.array(np.concatenate([v, u])), pa.array(np.concatenate([s, s]), pa.float32())],
                    names=["u", "v", "sim"])
            kept = table.slice(max(len(table) - BLOCK, 0))

    return coded.mapInArrow(compare, EDGE)


def local_join(edges: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Edges between neighbours, and neighbours' neighbours, that improve one of the two lists."""
    n = common.shuffle_partitions(nodes.sparkSession)
    both = edges.union(best(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim"), k))
    around = both.select(F.col("u").alias("centre"), F.col("v").alias("node")).union(
        edges.select(F.col("u").alias("centre"), F.col("u").alias("node"))).distinct()
    worst = edges.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    halves = nodes.select("node", "v").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([b.column("node"), _halves(matrix(b.column("v")))], names=["node", "half"])
                         for b in batches if b.num_rows), "node long, half binary")
    known = halves.join(worst.withColumnRenamed("u", "node"), "node")
    groups = around.join(known, "node").repartition(n, "centre").sortWithinPartitions("centre", "node")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*kept, batch]).combine_chunks()
            centre = table["centre"].to_numpy()
            done = int(np.searchsorted(centre, centre[-1]))  # the last group may go on
            yield from _pairs(table.slice(0, done))
            kept = table.slice(done).to_batches()
        if kept:
            yield from _pairs(pa.Table.from_batches(kept))

    return groups.mapInArrow(join, EDGE).groupBy("u", "v").agg(F.max("sim").alias("sim"))


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    table = table.combine_chunks()
    centre, node = table["centre"].to_numpy(), table["node"].to_numpy()
    worst, x = table["worst"].to_numpy(), _floats(table["half"].combine_chunks())
    begin = np.flatnonzero(np.diff(centre, prepend=centre[0] - 1))
    size = np.diff(np.append(begin, len(centre)))
    for m in np.unique(size):
        runs = begin[size == m]
        for at in range(0, len(runs), max((1 << 20) // (m * m + m * x.shape[1]), 1)):
            rows = runs[at:at + max((1 << 20) // (m * m + m * x.shape[1]), 1), None] + np.arange(m)
            part = x[rows]
            sim = np.matmul(part, part.transpose(0, 2, 1))
            better = sim > worst[rows][:, :, None]
            better[:, np.arange(m), np.arange(m)] = False
            g, i, j = np.nonzero(better)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows[g, i]]), pa.array(node[rows[g, j]]), pa.array(sim[g, i, j], pa.float32())], names=["u", "v", "sim"])


def verified(edges: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(u, v), u < v: the pairs whose cosine in double precision reaches the threshold."""
    pairs = edges.where(F.col("sim") >= threshold - MARGIN).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    a = nodes.select(F.col("node").alias("u"), F.col("v").alias("x"))
    b = nodes.select(F.col("node").alias("v"), F.col("v").alias("y"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 5000) for b in batches for at in range(0, b.num_rows, 5000)):
            cos = (unit(matrix(batch.column("x"))) * unit(matrix(batch.column("y")))).sum(axis=1)
            yield batch.select(["u", "v"]).filter(pa.array(cos >= threshold))

    return pairs.join(a, "u").join(b, "v").select("u", "v", "x", "y").mapInArrow(check, "u long, v long")


def grown(nodes: DataFrame, part_of: DataFrame, saturated: DataFrame, threshold: float, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(counts, sets) of the components that hold a saturated node, each compared as a whole.

    counts: (node, links, weight), the number of linked nodes and of their copies. sets: (a, b), merged nodes.
    """
    wide = part_of.join(saturated.join(part_of, "node").select("component").distinct(), "component", "left_semi")
    sized = wide.join(common.written(wide.groupBy("component").agg(F.count("*").alias("n"))), "component")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = sized.join(nodes, "node").select(
        "component", "node", "v", "copies", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    keyed = placed.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own, node, copies = (table[c].to_numpy() for c in ("own", "node", "copies"))
        x, low, high = unit(matrix(table["v"].combine_chunks())), key[1].as_py(), key[2].as_py()
        links, weight, label = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), np.arange(len(node))
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        for at in range(0, len(left), 256):
            mine = left[at:at + 256]
            hit = x[mine] @ x[right].T >= threshold
            hit[mine[:, None] == right[None, :]] = False
            links[mine] += hit.sum(axis=1)
            weight[mine] += hit @ copies[right]
            if low != high:
                links[right] += hit.sum(axis=0)
                weight[right] += copies[mine] @ hit
            i, j = np.nonzero(hit)
            merge(label, mine[i], right[j])
        return pa.table([node, links, weight, node[label]], names=["node", "links", "weight", "root"])

    found = common.written(keyed.groupBy("component", "low", "high").applyInArrow(
        compare, "node long, links long, weight long, root long"))
    return found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("weight").alias("weight")), found.select(
        F.col("node").alias("a"), F.col("root").alias("b"))


def audited(nodes: DataFrame, links: DataFrame, threshold: float, rows: int, block_rows: int = 2048) -> DataFrame:
    """(node, label, true, found): the number of true and of found links of about ``rows`` vectors of each label.

    They are chosen by hash and compared with all of their label, block by block.
    """
    sizes = common.written(nodes.groupBy("label").agg(F.count("*").alias("n")))
    sized = nodes.select("node", "label", "v").join(sizes, "label")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    every = sized.select("node", "label", "v", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    asked = common.written(sized.where(F.pmod(F.xxhash64(F.lit(1), "node"), F.ceil(F.col("n") / rows)) == 0).select(
        "node", "label", "v", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")))

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([right["node"], pa.array(np.zeros(len(right), np.int64))], names=["node", "true"])
        left, right = left.combine_chunks(), right.combine_chunks()
        known, total = unit(matrix(right["v"].combine_chunks())), np.zeros(len(right), np.int64)
        x, node, ids = unit(matrix(left["v"].combine_chunks())), left["node"].to_numpy(), right["node"].to_numpy()
        for at in range(0, len(node), 2000):
            total += ((x[at:at + 2000] @ known.T >= threshold) & (node[at:at + 2000, None] != ids[None, :])).sum(axis=0)
        return pa.table([ids, total], names=["node", "true"])

    counted = every.groupBy("label", "block").cogroup(asked.groupBy("label", "block")).applyInArrow(count, "node long, true long")
    true = counted.groupBy("node").agg(F.sum("true").alias("true"))
    return true.join(nodes.select("node", "label"), "node").join(links, "node", "left").select(
        "node", "label", "true", F.least("true", F.coalesce("links", F.lit(0))).alias("found"))


def audit(nodes: DataFrame, links: DataFrame, threshold: float, rows: int) -> float:
    """The mean share of the true links that were found, over the audited vectors that have any; 1 if none has."""
    share = audited(nodes, links, threshold, rows).where(F.col("true") > 0).agg(F.avg(F.col("found") / F.col("true"))).first()[0]
    return 1.0 if share is None else share


def unproven(judged: DataFrame, labels: DataFrame, min_recall: float, min_seen: int) -> DataFrame:
    """The labels whose audited vectors do not show the recall.

    Every size of group counts by itself, so large ones do not outweigh small ones, and at least
    ``min_seen`` vectors with links must have been seen.
    """
    linked = judged.where(F.col("true") > 0).withColumn("size", F.floor(F.log2("true")))
    sizes = linked.groupBy("label", "size").agg(F.count("*").alias("seen"), F.avg(F.col("found") / F.col("true")).alias("recall"))
    proven = sizes.groupBy("label").agg(F.sum("seen").alias("seen"), F.min("recall").alias("recall")).where(
        (F.col("seen") >= min_seen) & (F.col("recall") >= min_recall))
    return labels.join(proven, "label", "left_anti")


def poor(judged: DataFrame, min_recall: float) -> DataFrame:
    """The labels of which some size of group shows too low a recall."""
    linked = judged.where(F.col("true") > 0).groupBy("label", F.floor(F.log2("true")).alias("size"))
    return linked.agg(F.avg(F.col("found") / F.col("true")).alias("recall")).where(F.col("recall") < min_recall).select("label").distinct()


def lacking(nodes: DataFrame, links: DataFrame, threshold: float, rows: int, most_rows: int, block_rows: int,
            min_recall: float, min_seen: int) -> DataFrame:
    """The labels of ``nodes`` whose audited vectors lack recall.

    Where fewer than ``min_seen`` of them have links, ten times as many are audited, until all of the label are, or
    about ``most_rows``; what was seen then decides.
    """
    kind = nodes.schema["label"].dataType.simpleString()
    open_labels = common.written(nodes.groupBy("label").agg(F.count("*").alias("n")))
    out = nodes.sparkSession.createDataFrame([], f"label {kind}")
    while True:
        asked = nodes.join(open_labels, "label", "left_semi").select(*nodes.columns)
        judged = common.written(audited(asked, links, threshold, rows, block_rows))
        bad = common.written(poor(judged, min_recall))
        out = out.union(bad)
        few = unproven(judged, open_labels, min_recall, min_seen).join(bad, "label", "left_anti")
        open_labels = common.written(few.where(F.col("n") > rows).select("label", "n"))
        if rows >= most_rows or not open_labels.count():
            return out
        rows = min(10 * rows, most_rows)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", k: int = 12, orders: int = 6, min_change: float = 0.01, block_rows: int = 2048,
                    audit_rows: int = 200, min_recall: float = 0.97, max_searches: int = 3, exact_rows: int = 0,
                    min_seen: int = 30, most_audit_rows: int = 20_000) -> DataFrame:
    """(id, n_links, component_id, kept) of each row.

    Vectors link if their labels are equal and their cosine reaches ``threshold``. ``n_links`` counts the
    other rows linked, copies of the row's own vector among them; ``component_id`` is the smallest id
    reachable, ``kept`` whether it is the row's own. Rows whose vector takes no part have no links and
    their own id. Vectors of one label must have one dimension. Repeated ids are rows of their own.

    All labels are searched, those that lack recall up to ``max_searches`` times; the ones that still do are
    checked as a whole. ``audit_rows`` of each label, up to ``most_audit_rows`` where few have links, only bound
    what recall is measured on. Labels of at most ``exact_rows`` distinct vectors are compared as a whole
    without a search, for callers who ask for it.
    """
    members, nodes = distinct_vectors(vectors, id_col, vector_col, label_col)
    sizes = common.written(nodes.groupBy("label").agg(F.count("*").alias("n")))
    whole, large = sizes.where(F.col("n") <= exact_rows).select("label"), sizes.where(F.col("n") > exact_rows).select("label")
    spark = nodes.sparkSession
    pairs = spark.createDataFrame([], "u long, v long")
    links = spark.createDataFrame([], "node long, links long, weight long")
    sets = spark.createDataFrame([], "a long, b long")
    if large.count():
        searched = common.written(nodes.join(large, "label", "left_semi").select(*nodes.columns))
        left, edges = large, spark.createDataFrame([], EDGE)
        for search in range(max_searches):
            size, trees = k << search, orders << search
            again = common.written(searched.join(left, "label", "left_semi").select(*nodes.columns))
            n_nodes = again.count()
            known = edges.join(again.select(F.col("node").alias("u")), "u", "left_semi")  # what was found stays
            started = along_orders(again, trees, size, search).union(known.select("u", "v", "sim"))
            edges = common.written(best(started.groupBy("u", "v").agg(F.max("sim").alias("sim")), size))
            while True:
                found = local_join(edges, again, size)
                new = common.written(best(edges.union(found).groupBy("u", "v").agg(F.max("sim").alias("sim")), size))
                changed = new.join(edges, ["u", "v"], "left_anti").count()
                edges = new
                if changed <= min_change * size * n_nodes:
                    break
            pairs = common.written(pairs.union(verified(edges, again, threshold)).distinct())
            first = common.written(connected_components(pairs, "u", "v").join(again.select("node"), "node", "left_semi"))
            full = edges.where(F.col("sim") >= threshold - MARGIN).groupBy("u").agg(F.count("*").alias("n")).where(
                F.col("n") >= size).select(F.col("u").alias("node"))
            counts, grown_sets = grown(again, first, full, threshold, block_rows)
            sets = sets.union(grown_sets)
            copies = again.select("node", "copies")
            both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            plain = both.join(copies.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(
                F.count("*").alias("links"), F.sum("copies").alias("weight"))
            before = links.join(copies, "node", "left_anti")  # of the labels that are settled
            links = common.written(before.union(plain.join(counts, "node", "left_anti").union(counts)))
            left = common.written(lacking(again, links, threshold, audit_rows, most_audit_rows, block_rows, min_recall, min_seen))
            if not left.count():
                break
        whole = whole.union(left)
    compared = common.written(nodes.select("node", "label").join(whole, "label", "left_semi").select("node", F.col("label").alias("component")))
    counts, joined = grown(nodes, compared, compared.select("node"), threshold, block_rows)
    links = links.join(compared, "node", "left_anti").union(counts)
    sets = sets.union(joined)
    parts = connected_components(pairs.select(F.col("u").alias("a"), F.col("v").alias("b")).union(sets))
    known = nodes.join(links, "node", "left").join(parts, "node", "left").select(
        "node", (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    used = members.join(known, "node").select("id", "n_links", "component_id")
    fit = used.select(F.col("id").alias(id_col), "n_links", "component_id")
    return _with_rest(vectors, fit, id_col, vector_col, label_col).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _with_rest(vectors: DataFrame, fit: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``fit`` and the rows whose vectors take no part."""
    v = F.col(vector_col).cast("array<double>")
    takes_part = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rest = vectors.where(~F.coalesce(takes_part, F.lit(False))).select(
        F.col(id_col).cast("long").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    return fit.union(rest)

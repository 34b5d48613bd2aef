"""The trie of all conversation prefixes, built by halving depths as in a van Emde Boas layout.

Turns are named by digests where they are read; texts are never shuffled. The sequence of depths is cut in half,
its halves in half, and so on; all parts of one size, which the recursion would treat one by one, are one
Spark job, so there are as many rounds as the longest conversation has binary digits:

* up: aligned runs of 2, 4, 8, ... turns get a name from the names of their halves;
* down: the prefix before a cut gives, with the name of the run up to the cut, the prefix at the cut, first for the
  cut in the middle, at last for every depth. Equal prefixes have equal names, which makes the nodes. A node is
  from then on its smallest conversation and its depth;
* up again: subtree totals are known inside the upper and the lower part of each cut; the lower forests' totals are
  grafted on their roots and on the roots' ancestors in the upper part, which are as many as the part is deep.

No row is ever keyed by conversation alone in an aggregate, so a conversation or a prefix that has most of the
rows is combined before the shuffle, or in joins whose large partitions adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common
from tickloom.operators import numbering

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 512  # ids that are joined to one string before a digest is made


@dataclass(frozen=True)
class Trie:
    """``nodes``: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens), one row per distinct
    prefix. ``ends``: (conv_id, depth, member), the node at which each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def named_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """(conv, at, name, words): each turn's digest and number of words. Null roles and texts are empty.

    Rows without a conversation are left out: they belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("at"),
        _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def numbered(named: DataFrame) -> DataFrame:
    """(conv, pos, name, words): the place of each turn, from 0, in the order of ``at``, null first.

    Turns of one place are put in the order of their names; repeated rows stay. A conversation's turns are
    numbered in parallel.
    """
    rows = named.withColumn("row", F.monotonically_increasing_id())
    global_order = numbering.number_rows(rows, ["conv", F.col("at").asc_nulls_first(), "name", "row"], "place")
    placed = common.written(global_order.select("conv", "place", "name", "words"))
    firsts = placed.groupBy("conv").agg(F.min("place").alias("first"))
    return common.written(placed.join(firsts, "conv").select("conv", (F.col("place") - F.col("first")).alias("pos"), "name", "words"))


def _prefix_names(turns: DataFrame, convs: DataFrame, rounds: int) -> DataFrame:
    """(conv, depth, name) of every prefix of every conversation, the empty one included."""
    runs = [turns.select("conv", F.col("pos").alias("i"), "name")]
    for _ in range(rounds - 1):
        left, right = (F.max(F.when(F.col("i") % 2 == side, F.col("name"))) for side in (0, 1))
        halves = runs[-1].groupBy("conv", F.shiftright("i", 1).alias("i")).agg(left.alias("left"), right.alias("right"))
        whole = halves.where("left IS NOT NULL AND right IS NOT NULL")
        runs.append(common.written(whole.select("conv", "i", _digest(F.col("left"), F.col("right")).alias("name"))))
    prefixes = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.sha2(F.lit("").cast("binary"), 256)).alias("name"))
    for k in reversed(range(rounds)):
        run = runs[k].select("conv", F.shiftleft("i", k).alias("depth"), F.col("name").alias("run"))
        cut = prefixes.join(run, ["conv", "depth"]).select("conv", (F.col("depth") + (1 << k)).alias("depth"), _digest(F.col("name"), F.col("run")).alias("name"))
        prefixes = common.written(prefixes.unionByName(cut))
    return prefixes


def build(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of conversations ``convs`` (conv, without repeats or nulls) with ``turns`` (conv, pos, name, words).

    Places of a conversation's turns are 0, 1, ... A conversation may have no turns: it ends at the root.
    Without conversations there is no node, not even the root. ``saved_tokens`` adds up, over a node's subtree, each node's
    words of the last turn times the number of conversations beyond the first that share it.
    """
    turns, convs = common.written(turns.select("conv", "pos", "name", "words")), common.written(convs.select("conv"))
    deepest = turns.agg(F.max("pos")).first()[0]
    rounds = 0 if deepest is None else (int(deepest) + 1).bit_length()
    prefixes = _prefix_names(turns, convs, rounds)
    groups = common.written(prefixes.groupBy("name", "depth").agg(F.min("conv").alias("node"), F.count("*").alias("n_convs")))
    # Where a conversation's prefix of each depth is a node: (conv, depth, node).
    where = common.written(prefixes.join(groups.select("name", "depth", "node"), ["name", "depth"]).select("conv", "depth", "node"))
    words = turns.select(F.col("conv").alias("node"), (F.col("pos") + 1).alias("depth"), "words")
    above = where.select(F.col("conv").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = groups.select("node", "depth", "n_convs").join(words, ["node", "depth"], "left").join(above, ["node", "depth"], "left")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = common.written(nodes.join(children, ["node", "depth"], "left").select(
        "node", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))).alias("saved_tokens"),
    ))
    totals = _graft(nodes.select("node", "depth", "parent", "n_leaves", "saved_tokens"), where, rounds)
    top = totals.where("depth = 1").groupBy(F.col("parent").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    root = totals.where("depth = 0").join(top, "node", "left").select(
        "node", "depth", F.coalesce("l", "n_leaves").alias("n_leaves"), F.coalesce("s", "saved_tokens").alias("saved_tokens"))
    totals = totals.where("depth > 0").select("node", "depth", "n_leaves", "saved_tokens").unionByName(root)
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, ["node", "depth"]).select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    lengths = where.groupBy("conv").agg(F.max("depth").alias("depth"))
    ends = where.join(lengths, ["conv", "depth"]).select(F.col("node").alias("conv_id"), "depth", F.col("conv").alias("member"))
    return Trie(out, ends)


def _graft(own: DataFrame, where: DataFrame, rounds: int) -> DataFrame:
    """``own`` (node, depth, parent, n_leaves, saved_tokens) with sums over subtrees, but for the root at depth 0.

    Before the round of size s, values are sums over the part of the subtree that lies in the same s depths,
    1 to s, s + 1 to 2 s, and so on; after it, in the same 2 s depths.
    """
    totals = own
    for k in range(rounds):
        s = 1 << k
        # Each root of a lower forest, a node in the depth just above a cut, with its forest's totals.
        roots = totals.where(f"depth > 0 AND (depth - 1) % {2 * s} = {s}").groupBy(
            F.col("parent").alias("conv"), (F.col("depth") - 1).alias("cut")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        upward = roots.withColumn("depth", F.explode(F.sequence(F.col("cut") - (s - 1), F.col("cut")))).drop("cut")
        grafts = upward.join(where, ["conv", "depth"]).select("node", "depth", F.lit(None).cast("long").alias("parent"), "n_leaves", "saved_tokens")
        totals = common.written(totals.unionByName(grafts).groupBy("node", "depth").agg(
            F.max("parent").alias("parent"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    return totals


def member_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end: their ids in ascending order, joined by commas.

    The ids are sorted and joined to short strings in parallel; a digest is sequential by nature, so one task goes over
    a node's strings, without holding them.
    """
    ends = common.written(ends.select("conv_id", "depth", "member"))
    spark = ends.sparkSession
    parts = max(common.shuffle_partitions(spark), -(-ends.count() // numbering.ROWS_PER_PARTITION))
    order = ["conv_id", "depth", "member"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held, key = [], [], None
            for conv, depth, member in zip(*(batch.column(c).to_pylist() for c in order), strict=True):
                if held and ((conv, depth) != key or len(held) == CHUNK):
                    rows.append((*key, held[0], ",".join(map(str, held))))
                    held = []
                key = conv, depth
                held.append(member)
            if held:
                rows.append((*key, held[0], ",".join(map(str, held))))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [
                pa.array([], kind) for kind in kinds], names=["conv_id", "depth", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
                if (conv, depth) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (conv, depth), hashlib.sha256()
                state.update(ids.encode())
            yield made(done)
        if key is not None:
            yield made([(*key, state.hexdigest())])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": c, "depth": d, "ends_sha256": x} for c, d, x in rows], schema=pa.schema([
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]))

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    strings = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(join, "conv_id long, depth long, first long, ids string")
    dealt = strings.repartition(parts, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def with_shared_openings(turns: DataFrame, period: int = 20, openings: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of conversations rebuilt to share openings, from ``numbered`` turns.

    Conversation c starts with the first h turns of conversation c - c % ``period`` (all it has, none if there is no such
    conversation) and goes on with its own turns after its first h; h is the checksum of c's decimal digits modulo ``openings``.
    """
    lengths = common.written(turns.groupBy("conv").agg(F.count("*").alias("n")))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % openings
    plans = lengths.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % period).alias("base"))
    plans = common.written(plans.join(lengths.select(F.col("conv").alias("base"), "n"), "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("given")))
    own = turns.join(plans.select("conv", "h", "given"), "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "name", "words")
    first = turns.where(F.col("pos") < openings - 1).select(F.col("conv").alias("base"), "pos", "name", "words")
    given = first.join(plans.select("conv", "base", "h"), "base").where("pos < h").select("conv", "pos", "name", "words")
    return own.unionByName(given), lengths.select("conv")

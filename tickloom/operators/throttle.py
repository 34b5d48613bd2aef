"""Per-symbol throttle: pass a tick only if ``seconds`` went by since the last passed one.

Whether a tick passes depends on the last tick that passed, so the rule is sequential per symbol.
It still runs in even pieces, however many rows one symbol has and however long the interval is. Rows are
range-sorted by (symbol, time, id) and cut into partitions; only the first symbol of a partition can continue
from the one before.

For that symbol, pass one works out for every tick that could be passed first which tick is then passed last in the
partition: a step function, whose rows are entries. Each entry is sent on, by one as-of join, to the entry of a
later partition that the walk comes to next. Neighbouring partitions are then composed, level by level: an entry of
the left one that leads into the right one is sent on to where that leads. With the known first tick, a walk down
the levels finds in which partitions, and from which tick, the walk goes on: one entry for a partition at most. Pass two
streams every partition once from there. The outcome is exactly that of one sequential walk.

Entries are as many as the distinct times within one interval of a partition's first tick, so they can be nearly all
ticks; they lie in tables and joins like other rows, never together in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.asof import asof_join
from tickloom.operators.numbering import range_sorted
from tickloom.schema import local_table
from tickloom.sources.tables import cut_lineage

# Entries of all partitions that are walked one after the other at once; more are composed in tables.
FEW_ENTRIES = 1 << 16

# Earlier than every tick: the first tick of a symbol always passes.
_START = -(2**62)
_NEVER = 2**62


def last_passed(times: np.ndarray, step: int) -> np.ndarray:
    """For each tick of a sorted array: the tick passed last if this one is passed."""
    following = np.searchsorted(times, times + step, side="left")
    end = len(times)
    jump = np.where(following < end, following, np.arange(end))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return times[jump]
        jump = further


def entry_steps(times: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of a run of one symbol: (passes from at most, time passed last).

    Entered with "pass from r on", the run passes last the value of the first row with r <= limit;
    beyond the last limit it passes nothing. A cut leaves r at most one interval past the first
    tick, so ticks after that cannot be entered first.
    """
    times = np.unique(times)
    final = last_passed(times, step)
    reach = min(np.searchsorted(times, times[0] + step, side="left") + 1, len(times))
    limit, final = times[:reach], final[:reach]
    last_of_step = np.append(final[1:] != final[:-1], True)
    return limit[last_of_step], final[last_of_step]


def passed(times: np.ndarray, since: int, step: int) -> tuple[list[int], int]:
    """Places of the ticks that pass in a sorted run, and the time from which the next may pass.

    From a tick that passes, all pass up to the next gap shorter than the step.
    """
    keep: list[int] = []
    short = np.flatnonzero(np.diff(times) < step)
    at, end = int(np.searchsorted(times, since, side="left")), len(times)
    while at < end:
        k = int(np.searchsorted(short, at))
        last = int(short[k]) if k < len(short) else end - 1
        keep.extend(range(at, last + 1))
        since = int(times[last]) + step
        at = last + 1
        at += int(np.searchsorted(times[at:], since, side="left"))
    return keep, since


def symbol_runs(symbols: pa.Array) -> list[tuple[str, int, int]]:
    """(symbol, from, to) of the runs of equal symbols in a sorted column."""
    coded = symbols.dictionary_encode(null_encoding="encode")
    codes = coded.indices.to_numpy()
    cuts = np.flatnonzero(codes[1:] != codes[:-1]) + 1
    bounds = zip(np.append(0, cuts).tolist(), np.append(cuts, len(codes)).tolist())
    return [(coded.dictionary[int(codes[lo])].as_py(), lo, hi) for lo, hi in bounds]


def throttle(
    trades: DataFrame,
    seconds: float,
    symbol: str = "symbol",
    when: str = "event_time",
    ident: str = "id",
    partitions: int | None = None,
) -> DataFrame:
    """The passed rows. Ticks of a symbol are taken in the order (time, id)."""
    step = int(round(seconds * 1_000_000))
    if step <= 0:
        raise ValueError("the interval must be positive")
    rows = range_sorted(
        trades.withColumn("_us", F.unix_micros(F.col(when))), [symbol, "_us", ident], partitions
    )
    columns = trades.columns

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only the runs at the two ends of the partition are held; runs between them are complete.
        part = first = last = None
        head: list[np.ndarray] = []
        tail: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column("_us").to_numpy()
            runs = symbol_runs(batch.column(symbol))
            if part is None:
                part, first, last = batch.column("_part")[0].as_py(), runs[0][0], runs[0][0]
            for name, lo, hi in runs:
                if name != last:
                    tail, last = [], name
                (head if last == first else tail).append(times[lo:hi])
        if part is None:
            return
        begin = int(head[0][0])
        if last == first:
            limit, final = entry_steps(np.concatenate(head), step)
        else:
            final = last_passed(np.unique(np.concatenate(tail)), step)[:1]
            limit = np.array([_NEVER])
        n = len(limit)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * n, pa.int32()),
                pa.array([first] * n, pa.string()),
                pa.array([last] * n, pa.string()),
                pa.array([begin] * n, pa.int64()),
                pa.array(np.append(_START, limit[:-1]), pa.int64()),
                pa.array(limit, pa.int64()),
                pa.array(final, pa.int64()),
            ],
            names=["_part", "_first", "_last", "_begin", "_above", "_limit", "_final"],
        )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, since, fresh = None, _START, True
        for batch in batches:
            if not batch.num_rows:
                continue
            times = batch.column("_us").to_numpy()
            keep: list[int] = []
            for name, lo, hi in symbol_runs(batch.column(symbol)):
                if fresh:
                    current, since, fresh = name, batch.column("_from")[0].as_py(), False
                elif name != current:
                    current, since = name, _START
                places, since = passed(times[lo:hi], since, step)
                keep.extend(lo + i for i in places)
            yield batch.select(columns).take(pa.array(keep, pa.int64()))

    entries = rows.select(symbol, "_us", "_part").mapInArrow(
        summarise, "_part int, _first string, _last string, _begin bigint, _above bigint, _limit bigint, _final bigint"
    )
    # One row per partition: the broadcast is bounded by the number of partitions.
    entered = rows.join(F.broadcast(entry_times(cut_lineage(entries), step)), "_part").select(*columns, "_us", "_from")
    return entered.mapInArrow(pick, trades.schema)


def entry_times(entries: DataFrame, step: int) -> DataFrame:
    """(_part, _from): the time from which each partition may pass its first tick.

    ``entries`` are the step functions: entered with "pass from r on", partition ``_part``, whose first tick is ``_begin``, passes
    ``_final`` last if ``_above`` < r <= ``_limit``. A partition that ends with another symbol than it began with
    has one row, for its last symbol, which starts afresh. Up to ``FEW_ENTRIES`` rows are walked as they are.
    """
    few = entries.limit(FEW_ENTRIES + 1).toArrow()
    if len(few) <= FEW_ENTRIES:
        return _walked_at_once(entries.sparkSession, few, step)
    chained, parts = _chains(entries)
    longest = parts.agg(F.max("idx")).first()[0] or 0
    walked = chained.where("idx = 0").select("chain", "idx", "limit", "final")
    if longest:
        levels = _composed(chained, parts, step, int(longest).bit_length())
        walked = _walked_down(walked, levels).join(chained.select("chain", "idx", "limit", "final"), ["chain", "idx", "limit"])
    # What a partition of the chain may pass is after the last tick passed in those before it.
    places = parts.where("chain_in IS NOT NULL").select("_part", F.col("chain_in").alias("chain"), F.col("idx_in").alias("idx"))
    places = places.unionByName(parts.where("idx = 0").select(F.lit(None).cast("int").alias("_part"), "chain", "idx"))
    before = Window.partitionBy("chain").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    since = places.join(walked.select("chain", "idx", "final"), ["chain", "idx"], "left").withColumn("_from", F.max("final").over(before) + step)
    since = since.where("_part IS NOT NULL").select("_part", "_from")
    return parts.select("_part").join(since, "_part", "left").select("_part", F.coalesce("_from", F.lit(_START)).alias("_from"))


def _walked_at_once(spark: SparkSession, entries: pa.Table, step: int) -> DataFrame:
    """What ``entry_times`` gives, of a bounded number of entries."""
    rows = entries.sort_by([("_part", "ascending"), ("_limit", "ascending")])
    part = rows["_part"].to_numpy()
    limits, finals = rows["_limit"].to_numpy(), rows["_final"].to_numpy()
    bounds = [*np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)] if len(part) else [0]
    carried, since, out = None, _START, []
    for lo, hi in zip(bounds, bounds[1:]):
        first, last = rows["_first"][lo].as_py(), rows["_last"][lo].as_py()
        since = since if out and first == carried else _START
        out.append((int(part[lo]), since))
        at = lo if first != last else lo + int(np.searchsorted(limits[lo:hi], since))
        since = int(finals[at]) + step if at < hi else since
        carried = last
    ddl = "_part int, _from bigint"
    return local_table(spark, out, ddl) if out else spark.createDataFrame([], ddl)


def _chains(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries by chain, one row for each partition). A chain is the partitions that one symbol runs through.

    It is numbered by the partition where the symbol begins, or begins last, and its partitions by ``idx`` from 0. A
    partition that a symbol enters and leaves to another has its place at the end of the one chain (``chain_in``,
    ``idx_in``) and at the start of the next.
    """
    parts = entries.groupBy("_part").agg(*[F.min(c).alias(c) for c in ("_first", "_last", "_begin")])
    order = Window.orderBy("_part")  # one row for each partition
    goes_on = (F.col("rank") > 0) & F.col("_first").eqNullSafe(F.col("before"))
    parts = parts.select("*", (F.row_number().over(order) - 1).alias("rank"), F.lag("_last").over(order).alias("before")).withColumn("goes_on", goes_on)
    begins = ~(F.col("_first").eqNullSafe(F.col("_last")) & F.col("goes_on"))
    parts = parts.withColumn("chain", F.max(F.when(begins, F.col("rank"))).over(order))
    parts = parts.withColumn("chain_in", F.when(F.col("goes_on"), F.lag("chain").over(order)))
    parts = cut_lineage(parts.select("_part", "chain", (F.col("rank") - F.col("chain")).alias("idx"), "chain_in",
                                     (F.col("rank") - F.col("chain_in")).alias("idx_in"), "_begin"))
    rows = entries.select("_part", "_above", "_limit", "_final").join(F.broadcast(parts.select("_part", "chain", "idx")), "_part")
    # A chain is begun with its first tick, whatever else its first partition could be entered with.
    rows = rows.where((F.col("idx") > 0) | (F.col("_above") == _START))
    return rows.select("chain", "idx", F.col("_above").alias("above"), F.col("_limit").alias("limit"), F.col("_final").alias("final")), parts


def _composed(chained: DataFrame, parts: DataFrame, step: int, levels: int) -> list[DataFrame]:
    """For each level the entries (chain, idx, limit, to_idx, to_limit) with the entry that the walk comes to behind the entry's
    node, which is 2 ** level neighbouring partitions.

    Of a node, only entries that a walk from before it can come to are kept: within one interval of its first tick.
    """
    left = chained.withColumn("since", F.col("final") + step)
    right = chained.where("idx > 0").select("chain", F.col("limit").alias("at"), F.col("idx").alias("to_idx"), F.col("limit").alias("to_limit"))
    now = asof_join(left, right, ["chain"], "since", "at", ["to_idx", "to_limit"], ident=["idx", "limit"], forward=True)
    names = ["chain", "idx", "above", "limit", "to_idx", "to_limit"]
    made = [cut_lineage(now.select(*names))]
    for level in range(levels - 1):
        node, to_node = F.shiftright("idx", level), F.shiftright("to_idx", level)
        inward = (node % 2 == 0) & (to_node == node + 1)
        on = made[-1].select("chain", F.col("idx").alias("to_idx"), F.col("limit").alias("to_limit"), F.col("to_idx").alias("on_idx"), F.col("to_limit").alias("on_limit"))
        # A chain's partitions are few; where each node begins is broadcast by their number.
        begin = parts.select("chain", "idx", "_begin").where(f"idx % {2 << level} = 0").select("chain", F.shiftright("idx", level + 1).alias("node"), "_begin")
        kept = made[-1].withColumn("node", F.shiftright("idx", level + 1)).join(F.broadcast(begin), ["chain", "node"])
        kept = kept.where(F.col("above") < F.col("_begin") + step).withColumn("inward", F.coalesce(inward, F.lit(False)))
        sent = kept.where("inward").join(on, ["chain", "to_idx", "to_limit"]).select(
            "chain", "idx", "above", "limit", F.col("on_idx").alias("to_idx"), F.col("on_limit").alias("to_limit"))
        made.append(cut_lineage(sent.unionByName(kept.where("NOT inward").select(*names))))
    return made


def _walked_down(starts: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(chain, idx, limit) of all entries that the walks from ``starts`` come to; one for a partition at most."""
    found = starts.select("chain", "idx", "limit")
    for level in reversed(range(len(levels))):
        node, to_node = F.shiftright("idx", level), F.shiftright("to_idx", level)
        table = levels[level].where((node % 2 == 0) & (to_node == node + 1))
        # As many as there are partitions at most.
        following = table.join(F.broadcast(found), ["chain", "idx", "limit"], "left_semi")
        found = found.unionByName(following.select("chain", F.col("to_idx").alias("idx"), F.col("to_limit").alias("limit")))
        found = cut_lineage(found)
    return found

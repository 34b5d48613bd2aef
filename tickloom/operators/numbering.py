"""Global row numbers and exact order statistics without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schema import local_table
from tickloom.sources import tables

# monotonically_increasing_id keeps the partition above this bit and the row's place below it.
_PLACE_BITS = 33

# Rows one task sorts and walks; large enough to be worth a task, small enough for its memory.
ROWS_PER_PARTITION = 4_000_000


def range_sorted(rows: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Rows in global order, cut into even partitions, with ``_part`` and ``_place``.

    Range bounds come from a sample of the whole order, so the rows of one hot value are spread
    over as many partitions as they need provided the order ends in a unique column. The result
    is checkpointed: bounds are drawn once and every later pass sees the same partitions, also
    after the loss of an executor. Unless ``partitions`` is given, their number grows with the rows,
    which are counted first: adaptive execution does not resize a range shuffle of fixed width.
    """
    order = list(order)
    n = partitions or max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        rows.count() // ROWS_PER_PARTITION + 1,
    )
    placed = (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    mask = (1 << _PLACE_BITS) - 1
    return tables.cut_lineage(
        placed.withColumns(
            {
                "_part": F.shiftright("_mid", _PLACE_BITS).cast("int"),
                "_place": F.col("_mid").bitwiseAND(F.lit(mask)),
            }
        ).drop("_mid")
    )


def number_rows(
    rows: DataFrame, order: Sequence[str | Column], name: str = "trade_id", partitions: int | None = None
) -> DataFrame:
    """Same numbers as ROW_NUMBER() OVER (ORDER BY ...), computed in parallel.

    One range shuffle; then a running total over one row per partition, which is all that the
    unpartitioned window and the broadcast ever hold.
    """
    placed = range_sorted(rows, order, partitions)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_place") + 1).drop("_part", "_place", "_start")


def exact_quantile(rows: DataFrame, value: str, q: float, few: int = 100_000) -> DataFrame:
    """One row ``quantile``: the interpolated q-quantile of ``value`` over all rows that have one.

    A sketch gives two values that very likely enclose the wanted ranks; a second pass counts exactly what lies below and
    between them. The bracket is narrowed in the same way until at most ``few`` rows are in it, or one value; only these
    are sorted. A bracket that misses the ranks is widened on that side to where the last one ended. Nothing
    is shuffled but sketches and counts.
    """
    spark = rows.sparkSession
    v = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    ends = v.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not ends["n"]:
        return spark.createDataFrame([], "quantile double")
    pos = (ends["n"] - 1) * q
    first, last = math.floor(pos), math.ceil(pos)  # the wanted ranks, from 0

    def answer(a: float, b: float) -> DataFrame:
        return local_table(spark, [(a + (b - a) * (pos - first),)], "quantile double")

    # The wanted ranks lie in low..high, which hold ``inside`` rows and have ``below`` rows before them.
    low, high, below, inside = ends["low"], ends["high"], 0, ends["n"]
    while inside > few and low != high:
        bracket = v.where((F.col("v") >= low) & (F.col("v") <= high))
        slack = 4 / _SKETCH
        wanted = [min(max(p, 0.0), 1.0) for p in ((first - below) / inside - slack, (last - below) / inside + slack)]
        lo, hi = bracket.agg(F.percentile_approx("v", wanted, _SKETCH).alias("p")).first()["p"]
        counts = bracket.agg(F.count_if(F.col("v") < lo).alias("before"), F.count_if(F.col("v") <= hi).alias("upto")).first()
        before, upto = below + counts["before"], below + counts["upto"]
        if first < before:  # the sketch erred by more than it promises
            lo, before = low, below
        if last >= upto:
            hi, upto = high, below + inside
        if (lo, hi) != (low, high):
            low, high, below, inside = lo, hi, before, upto - before
            continue
        # Both ends are values that very many rows have: look between them.
        x, mid = F.col("v"), (F.col("v") > low) & (F.col("v") < high)
        r = bracket.agg(F.count_if(x == low).alias("lows"), F.count_if(mid).alias("n"), F.min(F.when(mid, x)).alias("least"), F.max(F.when(mid, x)).alias("most")).first()
        starts = below + r["lows"], below + r["lows"] + r["n"]  # of the values between, and of ``high``
        if starts[0] <= first and last < starts[1]:
            low, high, below, inside = r["least"], r["most"], starts[0], r["n"]
            continue
        pick = (lambda rank, other: low if rank < starts[0] else high if rank >= starts[1] else other)
        return answer(pick(first, r["most"]), pick(last, r["least"]))
    if low == high:
        return answer(low, high)
    near = v.where((F.col("v") >= low) & (F.col("v") <= high)).sort("v").collect()  # ``few`` rows at most
    return answer(near[first - below]["v"], near[last - below]["v"])


# What the sketch of a bracket promises: ranks within one part in so many.
_SKETCH = 10_000

"""As-of join: each row with the nearest row of a second table at or before its time, or at or after it.

Both tables are sorted together by key and time, in even range partitions. A row's partner is the last row of
the other side that the sorted order has shown for its key; what a partition must know of those before it is one
row, so a key that holds most of the rows is spread over many tasks and nothing is joined by key alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.numbering import range_sorted


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str],
              ident: Sequence[str], forward: bool = False, partitions: int | None = None) -> DataFrame:
    """``left`` with the columns ``take`` of its partner in ``right``, null where it has none.

    The partner has equal ``by`` columns (nulls are equal) and the greatest ``right_on`` not above ``left_on``, or, with
    ``forward``, the least not below it. ``right`` holds a key and time once. ``ident`` are columns that tell rows of
    ``left`` apart, so that many rows of one key and time can be spread. Rows whose time is null have no partner; names
    in ``take`` must not occur in ``left``.
    """
    fields = left.schema.fieldNames()
    clash = set(take) & set(fields)
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    kind = left.schema[left_on].dataType
    keys = [f"_by{i}" for i in range(len(by))]
    columns = [F.struct(*fields).alias("_row"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_found")]
    mine = left.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(left_on).alias("_at"), F.lit(1).alias("_side"), *columns)
    theirs = right.where(F.col(right_on).isNotNull()).select(
        *[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(right_on).cast(kind).alias("_at"), F.lit(0).alias("_side"),
        F.lit(None).cast(mine.schema["_row"].dataType).alias("_row"), F.struct(*take).alias("_found"))
    at = F.col("_at").desc_nulls_first() if forward else F.col("_at").asc_nulls_first()
    placed = range_sorted(mine.unionByName(theirs), [*keys, at, "_side", *[F.col(f"_row.{c}") for c in ident]], partitions)
    shown = F.when(F.col("_side") == 0, F.col("_place"))
    last = placed.groupBy("_part").agg(F.max_by(F.struct(*keys, "_found"), shown).alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition is all that goes through the window and the broadcast.
    carried = last.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_last"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_last.{k}"))
    start = F.when(F.col("_last").isNotNull() & same, F.col("_last._found"))
    ready = placed.join(F.broadcast(carried), "_part").select(*keys, "_side", "_row", "_found", start.alias("_start"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # keys and partner of the last row of the other side
        for batch in batches:
            if not batch.num_rows:
                continue
            run, place = _runs(batch, keys), np.arange(batch.num_rows)
            theirs, found = batch.column("_side").to_numpy() == 0, batch.column("_found")
            newest = np.maximum.accumulate(np.where(theirs, place, -1))
            begins = np.maximum.accumulate(np.where(np.append(True, run[1:] != run[:-1]), place, 0))
            # Only the batch's first run can go on with what came before it.
            first = [batch.column(k)[0].as_py() for k in keys]
            lead = held[1] if held is not None and held[0] == first else batch.column("_start").slice(0, 1)
            choice = np.where(newest >= begins, newest + 1, 0)
            partner = pa.concat_arrays([lead, found]).take(pa.array(choice, mask=(choice == 0) & (run > 0)))
            if theirs.any():
                at = int(newest[-1])
                held = [batch.column(k)[at].as_py() for k in keys], found.slice(at, 1)
            mine = pa.array(np.flatnonzero(~theirs))
            yield pa.RecordBatch.from_arrays(
                [*batch.column("_row").take(mine).flatten(), *partner.take(mine).flatten()], names=[*fields, *take])

    schema = left.select(*fields).schema
    out = type(schema)([*schema.fields, *right.select(*take).schema.fields])
    for f in out.fields:
        f.nullable = True
    return ready.mapInArrow(fill, out)


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """The number of the run of equal keys that each row of a sorted batch is in."""
    change = np.zeros(batch.num_rows, bool)
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(change)

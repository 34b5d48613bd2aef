"""Summaries kept up to date by a stream, complete at any lateness.

The measures are additive, so a micro-batch is summed up by itself and stored as one slice; readers add
the slices up. There is no state and no watermark: a row counts whenever it comes. Slices that no replay
can change any more are folded into one while the stream runs, which keeps their number small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.numeric import round_half_up
from tickloom.plans.marts import cube_measures
from tickloom.streaming import levels
from tickloom.streaming.slices import drop_slices, folded, read_slices, write_slice

KEYS = ("bucket_start", "symbol")
FLOW_DDL = "symbol string, n bigint, sum_value double, sum_volume double, bucket_start timestamp"
CUBE_DDL = ("symbol string, n bigint, sum_volume double, sum_value double, sum_price double, max_price double, "
            "min_price double, bucket_start timestamp")


def flow_measures() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum(F.col("price") * F.col("volume")).alias("sum_value"),
        F.sum("volume").alias("sum_volume"),
    ]


def bucketed(trades: DataFrame, width: str, measures: Sequence[Column]) -> DataFrame:
    """Tumbling windows over event time of a table or of one micro-batch."""
    windowed = trades.groupBy(F.window("event_time", width).alias("_w"), "symbol")
    return windowed.agg(*measures).withColumn("bucket_start", F.col("_w.start")).drop("_w")


def added_up(slices: DataFrame) -> DataFrame:
    """One row per bucket and symbol: ``min_`` and ``max_`` measures by extreme, all others by sum."""
    names = [c for c in slices.columns if c not in (*KEYS, "batch_id")]
    how = {"min": F.min, "max": F.max}
    return slices.groupBy(*KEYS).agg(*[how.get(c[:3], F.sum)(c).alias(c) for c in names])


def rollup_stream(trades: DataFrame, path: str, checkpoint: str, width: str, measures: Sequence[Column], **trigger) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_slice(bucketed(batch, width, measures), f"{path}/slices", batch_id)

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def hourly_stream(trades: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The hour cube as a live table."""
    return rollup_stream(trades, path, checkpoint, "1 hour", cube_measures(), **trigger)


def five_minute_stream(trades: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Five-minute flow as a live table: behind VWAP, density and the sliding view."""
    return rollup_stream(trades, path, checkpoint, "5 minutes", flow_measures(), **trigger)


def _slices(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return folded(spark, read_slices(spark, f"{path}/slices", schema), f"{path}/folds")


def read_rollup(spark: SparkSession, path: str, schema: str = FLOW_DDL) -> DataFrame:
    return added_up(_slices(spark, path, schema))


def fold_rollup(spark: SparkSession, path: str, schema: str = FLOW_DDL) -> int | None:
    """Add up the slices since the last fold but the newest, which may be replayed; the stream may run meanwhile.

    They become a run, with those before that are not much larger (see ``levels``). Slices that the fold before this one
    covers are deleted, so a reader that began with that one still finds what it needs. Returns the number of the
    last slice folded.
    """
    rows, before = read_slices(spark, f"{path}/slices", schema), levels.newest(spark, f"{path}/folds")
    newest = rows.agg(F.max("batch_id")).first()[0]
    if newest is None or newest - 1 <= (-1 if before is None else before):
        return before
    fresh = rows.where((F.col("batch_id") > (-1 if before is None else before)) & (F.col("batch_id") < newest))
    levels.add(added_up(fresh).select(*fresh.drop("batch_id").columns), f"{path}/folds", newest - 1, combine=added_up)
    if before is not None:
        drop_slices(spark, f"{path}/slices", before)
    return newest - 1


def read_hour_cube(spark: SparkSession, path: str) -> DataFrame:
    """The live table in the shape of ``plans.marts.hour_cube``; every report runs on it."""
    at = F.col("bucket_start")
    rows = read_rollup(spark, path, CUBE_DDL)
    return rows.withColumns({"full_date": F.to_date(at), "hour": F.hour(at)}).drop("bucket_start")


def vwap(flow: DataFrame) -> DataFrame:
    return flow.select(
        "bucket_start", "symbol",
        round_half_up(F.try_divide(F.col("sum_value"), F.col("sum_volume")), 4).alias("vwap"),
    )


def density(flow: DataFrame) -> DataFrame:
    return flow.select("bucket_start", "symbol", F.col("n").alias("trade_count"))

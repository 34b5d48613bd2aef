"""Open, high, low, close per symbol and bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock


def candles(trades: DataFrame, seconds: int = 300, ident: str | Sequence[str] = "id") -> DataFrame:
    """Candles; the first and last trade of a bucket are found by (event_time, id);
    ``ident`` may be several columns.

    Combined per task before the shuffle, so a hot symbol costs one row per task and bucket. The
    bucket comes first in the key because it sorts by its number, the symbols share a prefix.
    """
    order = clock.moment_key(trades, "event_time", ident)
    price = F.col("price")
    return (
        trades.groupBy(clock.bucket(F.col("event_time"), seconds).alias("bucket_start"), "symbol")
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum("volume").alias("volume"),
            F.count("*").alias("trades"),
        )
        .select("symbol", "bucket_start", "open", "high", "low", "close", "volume", "trades")
    )

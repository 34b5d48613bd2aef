"""Views over the last hour, or the current day, of the cleaned table.

``as_of`` is the moment of reading (None = now); ``names`` maps a symbol to its asset name. Views are not
sorted: readers that need an order put it on the few rows they get. The time
looked at is the processing time. It says nothing about the event days that a table is partitioned by, so
all of them are read, unless ``max_past`` says how many seconds a trade can be older than its processing, or
the rows come from ``ingest.read_recent`` or ``spans.read_between``, which choose files by processing time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions import clock, symbols
from tickloom.functions.numeric import round_half_up
from tickloom.sources.tables import prune_days

HOUR = 3600


def _recent(trades: DataFrame, as_of, seconds: int, when: str, max_past: int | None) -> DataFrame:
    rows = trades.where(clock.within(F.col(when), as_of, seconds))
    if max_past is None:
        return rows
    # Expressions of the moment of reading, so that a registered view moves on with the clock. A
    # day of slack on either side covers the zone of the partition columns.
    now = clock.as_instant(as_of)
    first = now - F.expr(f"INTERVAL {seconds + max_past + 86400} SECONDS")
    last = now + F.expr(f"INTERVAL {schema.MAX_FUTURE_SECONDS + 86400} SECONDS")
    return prune_days(rows, first, last)


def last_hour(trades: DataFrame, as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return _recent(trades, as_of, HOUR, when, max_past)


def same_day(trades: DataFrame, as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    """Rows of the UTC day of ``as_of``, up to it."""
    now = clock.as_instant(as_of)
    recent = _recent(trades, as_of, 86400, when, max_past)
    day = F.floor(F.unix_seconds(F.col(when)) / 86400)
    return recent.where(day == F.floor(F.unix_seconds(now) / 86400))


def _asset(names: Mapping[str, str]):
    return symbols.asset_name(F.col("symbol"), names).alias("asset_name")


def _value():
    return F.col("price") * F.col("volume")


def money_flow(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return last_hour(trades, as_of, when, max_past).groupBy(_asset(names)).agg(
        round_half_up(F.sum(_value()), 2).alias("total_usd")
    )


def price_range(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return last_hour(trades, as_of, when, max_past).groupBy(_asset(names)).agg(
        round_half_up(F.min("price"), 4).alias("lowest_price"),
        round_half_up(F.max("price"), 4).alias("highest_price"),
    )


def trade_count(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return last_hour(trades, as_of, when, max_past).groupBy(_asset(names)).agg(F.count("*").alias("trade_count"))


def minute_flow(trades: DataFrame, as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return last_hour(trades, as_of, when, max_past).groupBy(clock.bucket(F.col(when), 60).alias("minute")).agg(
        F.count("*").alias("trade_count"), round_half_up(F.sum(_value()), 2).alias("total_usd")
    )


def vwap_5m(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    rows = last_hour(trades, as_of, when, max_past)
    return rows.groupBy(clock.bucket(F.col(when), 300).alias("bucket_start"), _asset(names)).agg(
        round_half_up(F.try_divide(F.sum(_value()), F.sum("volume")), 4).alias("vwap")
    )


def density_5m(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    rows = last_hour(trades, as_of, when, max_past)
    return rows.groupBy(clock.bucket(F.col(when), 300).alias("bucket_start"), _asset(names)).agg(
        F.count("*").alias("trade_count")
    )


def whale_today(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at", max_past: int | None = None) -> DataFrame:
    return same_day(trades, as_of, when, max_past).groupBy(_asset(names)).agg(
        round_half_up(F.max(_value()), 2).alias("largest_order_usd")
    )


def five_minute_flow(trades: DataFrame, when: str = "event_time", seconds: int = 300) -> DataFrame:
    """Additive measures per bucket and symbol: the table behind the sliding view."""
    return trades.groupBy(clock.bucket(F.col(when), seconds).alias("bucket_start"), "symbol").agg(
        F.count("*").alias("n"), F.sum(_value()).alias("sum_value"), F.sum("volume").alias("sum_volume")
    )


def sliding_flow(buckets: DataFrame, seconds: int = HOUR, slide: int = 300) -> DataFrame:
    """Flow of every window of ``seconds`` that starts on a multiple of ``slide``.

    Only the buckets are repeated for the windows they belong to, never the trades.
    """
    offsets = F.explode(F.array(*[F.lit(-o) for o in range(0, seconds, slide)]))
    spread = buckets.select("*", offsets.alias("_off"))
    start = F.timestamp_seconds(F.unix_seconds("bucket_start") + F.col("_off"))
    return spread.groupBy(start.alias("window_start"), "symbol").agg(
        F.sum("n").alias("trade_count"),
        round_half_up(F.sum("sum_value"), 2).alias("total_usd"),
        round_half_up(F.try_divide(F.sum("sum_value"), F.sum("sum_volume")), 4).alias("vwap"),
    )

"""Parse raw messages, give every refused row one reason, keep the rest.

The steps are narrow: no shuffle, whatever the size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions import clock, numeric, symbols

# Reasons, in the order they are tested.
REASONS = (
    "malformed_json",
    "missing_fields",
    "invalid_time",
    "invalid_format",
    "not_in_whitelist",
    "invalid_values",
    "clock_drift",
)


def parse_trades(
    messages: DataFrame,
    value: str = "value",
    source_tz: str = "UTC",
    strict_time: bool = False,
) -> DataFrame:
    """Add event_time, symbol, price, volume and parse_error to a DataFrame of JSON messages.

    ``parse_error`` is NULL or one of the first four reasons; no row is lost and none raises.
    """
    text = F.col(value).cast("string")
    parsed = F.from_json(
        text, schema.TRADE_TEXT, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    rows = messages.withColumn("_m", parsed).withColumn("_time", symbols.strip(F.col("_m.time")))
    fields = {k: F.col(f"_m.{k}") for k in schema.REQUIRED_KEYS}
    event_time = clock.parse_instant(F.col("_time"), source_tz, strict_time)
    price = numeric.to_number(fields["price"])
    volume = numeric.to_number(fields["volume"])
    missing = fields["time"].isNull()
    for k in schema.REQUIRED_KEYS[1:]:
        missing = missing | fields[k].isNull()
    rows = rows.withColumns(
        {
            "event_time": event_time,
            "symbol": fields["symbol"],
            "price": price,
            "volume": volume,
            "_missing": missing,
        }
    )
    error = (
        F.when(F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull(), "malformed_json")
        .when(F.col("_missing"), "missing_fields")
        .when(F.col("event_time").isNull(), "invalid_time")
        .when(F.col("price").isNull() | F.col("volume").isNull(), "invalid_format")
    )
    return rows.withColumn("parse_error", error).drop("_m", "_time", "_missing")


def _checks(listed: Column, as_of, max_future: int, max_past: int) -> list[tuple[str, Column]]:
    """(reason, condition an accepted row meets), in the order they are tested.

    Plain comparisons of columns with literals, so that Spark can push them into a Parquet scan.
    Whole seconds count: both drift limits are inclusive to the second.
    """
    now = F.unix_seconds(clock.as_instant(as_of))
    t, price, volume = F.col("event_time"), F.col("price"), F.col("volume")
    present = t.isNotNull() & F.col("symbol").isNotNull() & price.isNotNull() & volume.isNotNull()
    near = (t >= F.timestamp_seconds(now - max_past)) & (t < F.timestamp_seconds(now + max_future + 1))
    return [
        ("missing_fields", present),
        ("not_in_whitelist", listed),
        ("invalid_values", numeric.positive_finite(price) & numeric.positive_finite(volume)),
        ("clock_drift", near),
    ]


def _normalised(trades: DataFrame) -> DataFrame:
    return trades.withColumn("symbol", symbols.normalise(F.col("symbol")))


def classify(
    trades: DataFrame,
    allowed: Sequence[str] | DataFrame = schema.DEFAULT_SYMBOLS,
    as_of=None,
    max_future: int = schema.MAX_FUTURE_SECONDS,
    max_past: int = schema.MAX_PAST_SECONDS,
) -> DataFrame:
    """Normalise the symbol and add ``reject_reason``, NULL for an accepted row.

    ``allowed`` is a list, or a DataFrame with a ``symbol`` column when the list is a table.
    Works on parsed messages and on typed trades alike, batch or stream.
    """
    rows = _normalised(trades)
    if isinstance(allowed, DataFrame):
        known = allowed.select(symbols.normalise(F.col("symbol")).alias("_known")).distinct()
        rows = rows.join(known, rows["symbol"] == known["_known"], "left")
        listed = F.col("_known").isNotNull()
    else:
        listed = F.col("symbol").isin([s.strip(" \t\r\n\f\x0b").upper() for s in allowed])
    reason = F.coalesce(
        *[F.when(~ok, name) for name, ok in _checks(listed, as_of, max_future, max_past)]
    )
    if "parse_error" in rows.columns:
        reason = F.coalesce(F.col("parse_error"), reason)
    # A filter on the reason must not be pushed down: it would repeat the parsing of the message
    # in every one of its terms. Nothing is pushed through a generated column.
    columns = [c for c in rows.columns if c not in ("parse_error", "_known")]
    return rows.select(*columns, F.explode(F.array(reason)).alias("reject_reason"))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull())


def clean_trades(
    trades: DataFrame,
    allowed: Sequence[str] | DataFrame = schema.DEFAULT_SYMBOLS,
    as_of=None,
    max_future: int = schema.MAX_FUTURE_SECONDS,
    max_past: int = schema.MAX_PAST_SECONDS,
) -> DataFrame:
    """Only the rows that ``classify`` accepts: for typed trades as plain filters that reach the scan."""
    if "parse_error" in trades.columns:
        return accepted(classify(trades, allowed, as_of, max_future, max_past))
    rows = _normalised(trades)
    if isinstance(allowed, DataFrame):
        rows = rows.join(allowed.select(symbols.normalise(F.col("symbol")).alias("symbol")).distinct(), "symbol", "left_semi")
        listed = F.lit(True)
    else:
        listed = F.col("symbol").isin([s.strip(" \t\r\n\f\x0b").upper() for s in allowed])
    for reason, ok in _checks(listed, as_of, max_future, max_past):
        # A NULL fails every other comparison anyway.
        if reason != "missing_fields":
            rows = rows.where(ok)
    return rows.select(*trades.columns)


def drop_exact_copies(trades: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per (event_time, symbol, price, volume): the one with the smallest id.

    Grouping with ``min`` combines copies before the shuffle, so one much-repeated trade
    reaches its reducer as one row per task.
    """
    keys = ["event_time", "symbol", "price", "volume"]
    return trades.groupBy(*keys).agg(F.min(id_col).alias(id_col)).select(id_col, *keys)


def route_payloads(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``route``: ``trade`` for a JSON object with all four keys, else ``other``."""
    wanted = F.array(*[F.lit(k) for k in schema.REQUIRED_KEYS])
    keys = F.json_object_keys(F.col(value).cast("string"))
    complete = F.size(F.array_except(wanted, keys)) == 0
    return messages.withColumn("route", F.when(complete, "trade").otherwise("other"))


def add_day_columns(trades: DataFrame, when: str = "event_time") -> DataFrame:
    """year, month and day of the trade, the partition columns of every lake table."""
    t = F.col(when)
    return trades.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t)})


def enrich(trades: DataFrame, names: dict[str, str], processed_at=None) -> DataFrame:
    """Add asset_name and processed_at (an instant) to accepted trades."""
    out = trades.withColumn("asset_name", symbols.asset_name(F.col("symbol"), names))
    if "processed_at" in out.columns:
        return out
    return out.withColumn("processed_at", clock.as_instant(processed_at))


def display_time(when: Column, tz: str = "Asia/Ho_Chi_Minh") -> Column:
    """Instant to local wall-clock text, for display only."""
    ntz = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.to_utc_timestamp(when, F.current_timezone()).cast("timestamp_ntz"))
    return F.date_format(ntz, "yyyy-MM-dd HH:mm:ss")

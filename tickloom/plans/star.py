"""Star schema: derived date and time dimensions and the trade fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock, symbols
from tickloom.operators.numbering import number_rows


def dim_date(trades: DataFrame) -> DataFrame:
    """One row per trading day. Distinct on the day alone, attributes afterwards."""
    d = F.col("full_date")
    days = trades.select(F.to_date("event_time").alias("full_date")).distinct()
    return days.select(
        clock.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        clock.day_name(F.dayofweek(d)).alias("day_name"),
    )


def dim_date_ext(trades: DataFrame) -> DataFrame:
    return dim_date(trades).withColumn("is_weekend", F.col("day_of_week").isin(1, 7))


def dim_time(trades: DataFrame) -> DataFrame:
    """One row per second of the day with a trade, at most 86,400."""
    k = F.col("time_key")
    keys = trades.select(clock.time_key(F.col("event_time")).alias("time_key")).distinct()
    return keys.select(
        k,
        F.expr("int(time_key div 10000)").alias("hour"),
        F.expr("int(time_key div 100 % 100)").alias("minute"),
        F.expr("int(time_key % 100)").alias("second"),
    )


def dim_time_ext(trades: DataFrame) -> DataFrame:
    return dim_time(trades).withColumns(
        {
            "period": clock.day_period(F.col("hour")),
            "trading_session": clock.trading_session(F.col("hour")),
        }
    )


def observed_symbols(trades: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Rows of the symbol dimension that have trades."""
    return dim_symbol.join(trades.select("symbol").distinct(), "symbol", "left_semi")


def observed_exchanges(trades: DataFrame, dim_exchange: DataFrame) -> DataFrame:
    """Rows of the exchange dimension that have trades."""
    seen = trades.select("symbol").distinct().select(
        symbols.exchange_name(F.col("symbol")).alias("exchange_name")
    )
    return dim_exchange.join(seen, "exchange_name", "left_semi")


def instruments(dim_symbol: DataFrame, dim_exchange: DataFrame) -> DataFrame:
    """Symbol and exchange attributes in one look-up row per symbol.

    Joined here, where both sides are dimensions, so that each trade needs one look-up only.
    """
    exchange = dim_exchange.drop("quote_currency")
    named = dim_symbol.withColumn("exchange_name", symbols.exchange_name(F.col("symbol")))
    return named.join(exchange, "exchange_name", "left")


def fact_trades(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, ident: str = "id") -> DataFrame:
    """Fact rows with the stable source id as ``trade_id``; unknown symbols drop out.

    The dimension is joined without a hint: Spark broadcasts it below its size threshold and
    otherwise joins by shuffle.
    """
    keys = instruments(dim_symbol, dim_exchange).select("symbol", "symbol_key", "exchange_key")
    t = F.col("event_time")
    return trades.join(keys, "symbol").select(
        F.col(ident).alias("trade_id"),
        clock.date_key(t).alias("date_key"),
        clock.time_key(t).alias("time_key"),
        "symbol_key",
        "exchange_key",
        "price",
        "volume",
        trade_value().alias("trade_value"),
        t.alias("trade_time"),
    )


def numbered_fact(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, ident: str = "id",
                  partitions: int | None = None) -> DataFrame:
    """Fact rows whose ``trade_id`` is the row number in (time, id) order, computed in parallel."""
    fact = fact_trades(trades, dim_symbol, dim_exchange, ident).withColumnRenamed("trade_id", "source_id")
    return number_rows(fact, ["trade_time", "source_id"], "trade_id", partitions)


def trade_value():
    return F.round(F.col("price") * F.col("volume"), 6)

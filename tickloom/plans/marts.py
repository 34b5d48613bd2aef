"""Summaries and dashboard reports.

Every summary is a second, small aggregation over ``hour_cube``: one row per symbol, day and hour.
Trades are scanned once and combined per task, so the shuffle carries a few rows per task whatever
the skew. The cube can come straight from trades or from the table that the stream keeps up to date
(``streaming.rollup``), in which case a report never touches the trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.functions.numeric import percent_spread, round_half_up
from tickloom.plans import star


def hour_cube(trades: DataFrame) -> DataFrame:
    """Additive measures per symbol, full_date and hour."""
    t = F.col("event_time")
    return trades.groupBy(
        "symbol", F.to_date(t).alias("full_date"), F.hour(t).alias("hour")
    ).agg(*cube_measures())


def cube_measures() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum("volume").alias("sum_volume"),
        F.sum(star.trade_value()).alias("sum_value"),
        F.sum("price").alias("sum_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
    ]


def _fold(cube: DataFrame, *keys) -> DataFrame:
    return cube.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("sum_volume").alias("sum_volume"),
        F.sum("sum_value").alias("sum_value"),
        F.sum("sum_price").alias("sum_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
    )


def _avg(digits: int) -> Column:
    return round_half_up(F.col("sum_price") / F.col("n"), digits)


def _total(name: str, digits: int) -> Column:
    return round_half_up(F.col(name), digits)


def hourly_summary(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    return cube.join(dim_symbol, "symbol").select(
        clock.date_key(F.col("full_date")).alias("date_key"),
        "hour",
        "symbol_key",
        "asset_name",
        F.col("n").alias("total_trades_count"),
        _total("sum_volume", 4).alias("total_hourly_volume"),
        _total("sum_value", 2).alias("total_hourly_value_usd"),
        _total("max_price", 2).alias("high_price"),
        _total("min_price", 2).alias("low_price"),
        _avg(2).alias("avg_price"),
    )


def daily_summary(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    return _fold(cube, "symbol", "full_date").join(dim_symbol, "symbol").select(
        clock.date_key(F.col("full_date")).alias("date_key"),
        "symbol_key",
        "asset_name",
        F.col("n").alias("total_trades_count"),
        _total("sum_volume", 4).alias("total_daily_volume"),
        _total("sum_value", 2).alias("total_daily_value_usd"),
        _total("max_price", 2).alias("high_price"),
        _total("min_price", 2).alias("low_price"),
        _avg(2).alias("avg_price"),
        round_half_up(percent_spread(F.col("max_price"), F.col("min_price")), 2).alias("price_volatility_pct"),
    )


def _full_date(key: str = "date_key") -> Column:
    return F.to_date(F.col(key).cast("string"), "yyyyMMdd")


def price_by_hour(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Line chart: average price per hour, in time order."""
    h = hourly_summary(cube, dim_symbol)
    return h.select(
        _full_date().alias("full_date"),
        "hour",
        "asset_name",
        "avg_price",
        "high_price",
        "low_price",
        F.col("total_trades_count").alias("trade_count"),
    ).orderBy("full_date", "hour", "asset_name")


def top_volatility(cube: DataFrame, dim_symbol: DataFrame, k: int | None = None) -> DataFrame:
    """Days and assets by price volatility, strongest first; all of them unless ``k`` is given."""
    out = daily_summary(cube, dim_symbol).select(
        _full_date().alias("full_date"),
        "asset_name",
        "price_volatility_pct",
        "total_daily_volume",
        "total_daily_value_usd",
    ).orderBy(F.desc_nulls_last("price_volatility_pct"), "full_date", "asset_name")
    return out.limit(k) if k else out


def asset_share(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Pie chart: trades, value and volume per asset and tier."""
    per_symbol = _fold(cube, "symbol").join(dim_symbol, "symbol")
    return _fold(per_symbol, "asset_name", "market_cap_tier").select(
        "asset_name",
        "market_cap_tier",
        F.col("n").alias("trade_count"),
        _total("sum_value", 2).alias("total_value_usd"),
        _total("sum_volume", 4).alias("total_volume"),
    )


def heatmap(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Trades by day of the week and hour."""
    known = cube.join(dim_symbol, "symbol", "left_semi")
    return _fold(known, F.dayofweek("full_date").alias("weekday"), "hour").select(
        clock.day_name(F.col("weekday")).alias("day_name"),
        "hour",
        F.col("n").alias("trade_count"),
        _avg(2).alias("avg_price"),
        _total("sum_value", 2).alias("total_value"),
    ).orderBy("day_name", "hour")


def session_volume(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Volume and value by trading session and pair."""
    by_session = _fold(cube, "symbol", clock.trading_session(F.col("hour")).alias("trading_session"))
    return _fold(by_session.join(dim_symbol, "symbol"), "trading_session", "symbol_code").select(
        "trading_session",
        "symbol_code",
        _total("sum_volume", 4).alias("total_volume"),
        _total("sum_value", 2).alias("total_usd_value"),
    )


def daily_range(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Low, high and average price per day and asset."""
    per_day = _fold(cube, "symbol", "full_date").join(dim_symbol, "symbol")
    return _fold(per_day, "full_date", "asset_name").select(
        "full_date",
        "asset_name",
        F.col("min_price").alias("low"),
        F.col("max_price").alias("high"),
        _avg(6).alias("avg_price"),
    )


def hourly_by_pair(cube: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """Average price and total value per hour and pair."""
    named = cube.join(dim_symbol, "symbol")
    return _fold(named, "full_date", "hour", "symbol_code").select(
        "full_date",
        "hour",
        "symbol_code",
        _avg(6).alias("avg_price"),
        _total("sum_value", 2).alias("total_value"),
    )


def latest_price(trades: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """The newest trades of every symbol; trades that share the newest time are all kept.

    A ranking window would sort all rows of a hot symbol in one task. Instead the newest time per
    symbol is combined per task and joined back; it has no more rows than the dimension.
    """
    names = dim_symbol.select("symbol", "asset_name", "base_currency")
    newest = trades.groupBy("symbol").agg(F.max("event_time").alias("event_time"))
    lookup = newest.join(names, "symbol")
    return trades.join(lookup, ["symbol", "event_time"]).select(
        "asset_name",
        "base_currency",
        F.col("price").alias("latest_price"),
        F.col("volume").alias("latest_volume"),
        star.trade_value().alias("latest_trade_value"),
        F.col("event_time").alias("last_updated"),
    )


def whales(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, k: int = 50, ident: str = "id") -> DataFrame:
    """The ``k`` trades of greatest value, ties by id. Each task keeps k rows only."""
    look = star.instruments(dim_symbol, dim_exchange).where(F.col("exchange_key").isNotNull())
    rows = trades.join(look.select("symbol", "asset_name", "exchange_name"), "symbol")
    return rows.select(
        ident,
        F.col("event_time").alias("trade_time"),
        "asset_name",
        "exchange_name",
        "price",
        "volume",
        star.trade_value().alias("value_usd"),
    ).orderBy(F.desc("value_usd"), ident).limit(k)


def trade_listing(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, ident: str = "id") -> DataFrame:
    """Fact rows with asset and exchange, newest first: a parallel range sort of all rows."""
    look = star.instruments(dim_symbol, dim_exchange).where(F.col("exchange_key").isNotNull())
    rows = trades.join(look.select("symbol", "asset_name", "exchange_name"), "symbol")
    return rows.select(
        F.col(ident).alias("trade_id"),
        F.col("event_time").alias("trade_time"),
        "asset_name",
        "exchange_name",
        "price",
        "volume",
        star.trade_value().alias("trade_value"),
    ).orderBy(F.desc("trade_time"), F.desc("trade_id"))


def star_sample(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, k: int = 20, ident: str = "id") -> DataFrame:
    """The latest ``k`` trades with the attributes of all four dimensions.

    Date and time attributes are functions of the trade time, so the two derived dimensions are
    not joined. ``trade_id`` is the row number among all fact rows, also those without an exchange, in
    (time, id) order: the number of fact rows that are not newer. All are counted in one pass by how
    many of the ``k`` rows they are not newer than.
    """
    look = star.instruments(dim_symbol, dim_exchange)
    known = trades.join(look.select("symbol"), "symbol", "left_semi")
    joined = trades.join(
        look.where(F.col("exchange_key").isNotNull()).select(
            "symbol", "asset_name", "base_currency", "market_cap_tier", "exchange_name"
        ),
        "symbol",
    )
    top = joined.orderBy(F.desc("event_time"), F.desc(ident)).limit(k)
    own = F.struct("event_time", ident)
    edges = top.agg(F.collect_list(own)).scalar()  # k values


    def reached(rows: DataFrame) -> DataFrame:
        # A subquery cannot stand inside a function of array elements, so it is made a column first.
        listed = rows.withColumn("edges", F.explode(F.array(edges)))
        return listed.withColumn("reach", F.size(F.filter("edges", lambda e: e >= own))).drop("edges")

    counts = reached(known).groupBy("reach").agg(F.count("*").alias("n")).where("reach > 0")
    # At most k rows from here on.
    behind = counts.select("reach", F.sum("n").over(Window.orderBy(F.desc("reach"))).alias("trade_id"))
    listed = reached(top).join(behind, "reach")
    t = F.col("event_time")
    return listed.select(
        "trade_id",
        t.alias("trade_time"),
        F.to_date(t).alias("full_date"),
        clock.day_name(F.dayofweek(t)).alias("day_name"),
        F.hour(t).alias("hour"),
        F.minute(t).alias("minute"),
        "asset_name",
        "base_currency",
        "market_cap_tier",
        "exchange_name",
        "price",
        "volume",
        star.trade_value().alias("trade_value"),
    )


def object_counts(trades: DataFrame, cube: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame) -> DataFrame:
    """Row counts of the seven objects of the star schema.

    The cube is folded by day and symbol, then by day, then to one row, which counts four objects
    in one pass; only the time dimension needs the trades again.
    """
    marked = cube.join(dim_symbol.select("symbol", F.lit(1).alias("known")), "symbol", "left")
    known = F.col("known").isNotNull()
    per_symbol = marked.groupBy("full_date", "symbol", "known").agg(
        F.count("*").alias("hours"), F.sum("n").alias("n")
    )
    per_day = per_symbol.groupBy("full_date").agg(
        F.count_if(known).alias("symbols"),
        F.sum(F.when(known, F.col("hours"))).alias("hours"),
        F.sum(F.when(known, F.col("n"))).alias("n"),
    )
    totals = per_day.agg(
        F.count("*").alias("dim_date"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_trades"),
        F.coalesce(F.sum("hours"), F.lit(0)).alias("hourly_summary"),
        F.coalesce(F.sum("symbols"), F.lit(0)).alias("daily_summary"),
    )
    unpivoted = totals.unpivot([], totals.columns, "object_name", "rows")

    def count(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("object_name"), "rows")

    return (
        count("dim_exchange", dim_exchange)
        .unionByName(count("dim_symbol", dim_symbol))
        .unionByName(count("dim_time", star.dim_time(trades)))
        .unionByName(unpivoted)
    )

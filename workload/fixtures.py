"""Trades, messages and streams that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators import cleaning
from tickloom.sources.streams import read_file_stream

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# `error` events are the symbol that is not on the list.
ALLOWED = ("BINANCE:CLICKUSDT", "BINANCE:PURCHASEUSDT", "BINANCE:SIGNUPUSDT", "BINANCE:VIEWUSDT")
NAMES = {
    "BINANCE:CLICKUSDT": "Click",
    "BINANCE:PURCHASEUSDT": "Purchase",
    "BINANCE:SIGNUPUSDT": "Signup",
    "BINANCE:VIEWUSDT": "View",
}
SYMBOL_ROWS = (
    (1, "BINANCE:CLICKUSDT", "CLICKUSDT", "CLICK", "USDT", "Click", "Cryptocurrency", "Large-cap"),
    (2, "BINANCE:PURCHASEUSDT", "PURCHASEUSDT", "PURCHASE", "USDT", "Purchase", "Cryptocurrency", "Large-cap"),
    (3, "BINANCE:SIGNUPUSDT", "SIGNUPUSDT", "SIGNUP", "USDT", "Signup", "Cryptocurrency", "Mid-cap"),
    (4, "BINANCE:VIEWUSDT", "VIEWUSDT", "VIEW", "USDT", "View", "Cryptocurrency", "Large-cap"),
)

# Reading at this moment the 30-day limit admits every event of the tables.
WHOLE = "2024-01-31 00:00:00"
# Reading at this moment, ten days back and one ahead, exercises both drift limits.
DRIFT = {"as_of": "2024-01-20 00:00:00", "max_past": 864000, "max_future": 86400}
LAST_HOUR = "2024-01-15 12:00:00"
ARRIVAL = "2024-02-01 00:00:00"


def as_trades(events: DataFrame) -> DataFrame:
    # props is always {"k": n}. Filters repeat the expression, and cutting text is far cheaper
    # to repeat than reading JSON.
    k = F.substring_index(F.substring_index("props", ": ", -1), "}", 1)
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("BINANCE:"), F.upper("event_type"), F.lit("USDT")).alias("symbol"),
        F.col("value").alias("price"),
        k.cast("double").alias("volume"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(events(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_trades(trades(spark, sf_dir), allowed=ALLOWED, as_of=WHOLE)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_file_stream(
        spark, sf_dir, EVENTS_DDL, max_bytes=1 << 28, pathGlobFilter="events.parquet"
    )


def trade_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(event_stream(spark, sf_dir))


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_trades(trade_stream(spark, sf_dir), allowed=ALLOWED, as_of=WHOLE)


def messages(trade_rows: DataFrame) -> DataFrame:
    """(id, value): one JSON message per trade, spoiled in one of six ways by its volume 1 to 6."""
    k = F.col("volume").cast("int")
    fine = F.to_json(
        F.struct(
            F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("time"), "symbol", "price", "volume"
        )
    )
    value = (
        F.when(k == 1, F.concat(F.lit("not json "), F.col("symbol")))
        .when(k == 2, F.regexp_replace(fine, r',"volume":.*', "}"))
        .when(k == 3, F.regexp_replace(fine, r'"time":"[^"]*"', '"time":"garbage"'))
        .when(k == 4, F.regexp_replace(fine, r'"price":[^,]*', '"price":"abc"'))
        .when(k == 5, F.regexp_replace(fine, r'"symbol":"([^"]*)"', r'"symbol":"\\t$1 "'))
        .when(k == 6, F.regexp_replace(fine, r'"price":([^,]*)', r'"price":"$1"'))
        .otherwise(fine)
    )
    return trade_rows.select("id", value.cast("binary").alias("value"))


def line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades: many symbols, day resolution, many ties; (id, part, symbol) is unique."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("part"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("double").alias("volume"),
    )


def dim_symbol(spark: SparkSession) -> DataFrame:
    return schema.dim_symbol(spark, SYMBOL_ROWS)


def dim_exchange(spark: SparkSession) -> DataFrame:
    return schema.dim_exchange(spark)

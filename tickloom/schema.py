"""Fixed schemas, default settings and dimension seeds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The symbols tracked by default.
DEFAULT_SYMBOLS = (
    "BINANCE:BTCUSDT",
    "BINANCE:ETHUSDT",
    "BINANCE:BNBUSDT",
    "BINANCE:SOLUSDT",
)

# Default clock-drift limits in seconds (24 hours, 30 days).
MAX_FUTURE_SECONDS = 86400
MAX_PAST_SECONDS = 2592000

# Fixed value: new rows needed before a model is trained again.
RETRAIN_ROWS = 100000

# Thresholds of the two-feature risk rule.
RISK_PRICE = 50000.0
RISK_VOLUME = 10.0

REQUIRED_KEYS = ("time", "symbol", "price", "volume")

# Every field is read as text first; numbers and times are cast afterwards, so a
# number sent as a string is accepted and a bad one gets a reason instead of a NULL.
TRADE_TEXT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

PROVIDER_ENVELOPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("s", T.StringType()),
                        T.StructField("p", T.DoubleType()),
                        T.StructField("v", T.DoubleType()),
                        T.StructField("t", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

PUSH_ENVELOPE = T.StructType(
    [
        T.StructField(
            "message",
            T.StructType(
                [
                    T.StructField("data", T.StringType()),
                    T.StructField("publishTime", T.StringType()),
                ]
            ),
        ),
        T.StructField("data", T.StringType()),
    ]
)

LAKE_RECORD = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)

LOG_RECORD = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType(), False),
        T.StructField("asset_name", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)

DIM_SYMBOL_DDL = (
    "symbol_key INT, symbol STRING, symbol_code STRING, base_currency STRING, "
    "quote_currency STRING, asset_name STRING, asset_type STRING, market_cap_tier STRING"
)

DIM_EXCHANGE_DDL = (
    "exchange_key INT, exchange_name STRING, exchange_fullname STRING, "
    "country STRING, exchange_type STRING, quote_currency STRING"
)

# Rows of the two seeded dimensions.
DIM_SYMBOL_SEED = (
    (1, "BINANCE:BTCUSDT", "BTCUSDT", "BTC", "USDT", "Bitcoin", "Cryptocurrency", "Large-cap"),
    (2, "BINANCE:ETHUSDT", "ETHUSDT", "ETH", "USDT", "Ethereum", "Cryptocurrency", "Large-cap"),
    (3, "BINANCE:BNBUSDT", "BNBUSDT", "BNB", "USDT", "BNB", "Cryptocurrency", "Mid-cap"),
    (4, "BINANCE:SOLUSDT", "SOLUSDT", "SOL", "USDT", "Solana", "Cryptocurrency", "Large-cap"),
)
DIM_EXCHANGE_SEED = (
    (1, "BINANCE", "Binance Exchange", "Malta", "CEX", "USDT"),
)


def local_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """Rows as a local relation, whose size Spark knows and so broadcasts by itself.

    From plain Python rows Spark makes an RDD of unknown size, and shuffles the trades to join it.
    """
    names = [column.split()[0] for column in ddl.split(", ")]
    columns = {name: pa.array(values) for name, values in zip(names, zip(*rows))}
    return spark.createDataFrame(pa.table(columns), ddl)


def dim_symbol(spark: SparkSession, rows=DIM_SYMBOL_SEED) -> DataFrame:
    return local_table(spark, rows, DIM_SYMBOL_DDL)


def dim_exchange(spark: SparkSession, rows=DIM_EXCHANGE_SEED) -> DataFrame:
    return local_table(spark, rows, DIM_EXCHANGE_DDL)


def parse_symbol_list(text: str) -> list[str]:
    """Comma-separated setting to a list; blanks are dropped."""
    return [s.strip() for s in text.split(",") if s.strip()]

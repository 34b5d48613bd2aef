"""Message shapes: provider envelope, push envelope, CSV replay, logs, old lake records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions import clock
from tickloom.functions.symbols import strip


def unpack_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per trade of a ``{"type":"trade","data":[{s,p,v,t}]}`` message.

    Other columns of the message stay. ``position`` is the place of the trade in its message;
    the event time is cut to whole seconds, as messages downstream carry it.
    """
    text = F.col(value).cast("string")
    rest = [c for c in messages.columns if c != value]
    opened = messages.select(*rest, F.from_json(text, schema.PROVIDER_ENVELOPE).alias("_e"))
    trades = opened.where(F.col("_e.type") == "trade").select(
        *rest, F.posexplode("_e.data").alias("position", "_t")
    )
    return trades.select(
        *rest,
        "position",
        F.date_trunc("second", F.timestamp_millis(F.col("_t.t"))).alias("event_time"),
        F.col("_t.s").alias("symbol"),
        F.col("_t.p").alias("price"),
        F.col("_t.v").alias("volume"),
    )


def decode_push(pushes: DataFrame, value: str = "value", arrived_at=None) -> DataFrame:
    """Open a push envelope: base64 payload to ``payload`` and publish time to ``processed_at``.

    The payload is looked for in ``message.data``, then in a top-level ``data``. Broken base64 gives
    a NULL payload, which the parser then reports as malformed. Without a readable publish time
    the arrival time stands in.
    """
    rest = [c for c in pushes.columns if c != value]
    opened = pushes.select(
        *rest, F.from_json(F.col(value).cast("string"), schema.PUSH_ENVELOPE).alias("_p")
    )
    given = F.nullif(F.col("_p.message.data"), F.lit(""))
    encoded = F.coalesce(given, F.col("_p.data"))
    published = clock.parse_instant(strip(F.col("_p.message.publishTime")))
    return opened.select(
        *rest,
        F.try_to_binary(encoded, F.lit("base64")).cast("string").alias("payload"),
        F.coalesce(published, clock.as_instant(arrived_at)).alias("processed_at"),
    )


def csv_messages(rows: DataFrame, value: str = "value") -> DataFrame:
    """Every row as one JSON message of all its columns."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias(value))


def read_csv_replay(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """CSV files with a header, all values text, as JSON messages.

    ``columns`` (DDL) spares the header look-up; a leading byte-order mark is dropped by the reader.
    """
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(columns)
    return csv_messages(reader.csv(path))


def parse_logs(messages: DataFrame, value: str = "value") -> DataFrame:
    """Typed log rows; a broken message gives NULLs, an unreadable time a NULL time."""
    rest = [c for c in messages.columns if c != value]
    opened = messages.select(
        *rest, F.from_json(F.col(value).cast("string"), schema.LOG_RECORD).alias("_l")
    )
    return opened.select(
        *rest,
        clock.parse_instant(strip(F.col("_l.timestamp"))).alias("logged_at"),
        F.col("_l.level").alias("level"),
        F.col("_l.component").alias("component"),
        F.col("_l.message").alias("message"),
    )


def parse_lake_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """Records of the older JSON lake, whose time is epoch milliseconds as a double."""
    rest = [c for c in messages.columns if c != value]
    opened = messages.select(
        *rest, F.from_json(F.col(value).cast("string"), schema.LAKE_RECORD).alias("_r")
    )
    return opened.select(
        *rest,
        F.timestamp_millis(F.col("_r.timestamp").cast("bigint")).alias("event_time"),
        F.col("_r.symbol").alias("symbol"),
        F.col("_r.price").alias("price"),
        F.col("_r.volume").alias("volume"),
    )


def forward_rows(messages: DataFrame, value: str = "value", origin: str = "tick-bridge") -> DataFrame:
    """Rows for a message sink: key, value and the attributes ``symbol`` and ``origin`` as headers.

    Messages that are not JSON objects cannot be forwarded and are left out; see ``unforwardable``.
    """
    text = F.col(value).cast("string")
    symbol = F.coalesce(F.get_json_object(text, "$.symbol"), F.lit("UNKNOWN"))
    return messages.where(F.json_object_keys(text).isNotNull()).select(
        symbol.alias("key"),
        text.alias("value"),
        F.array(
            F.struct(F.lit("symbol").alias("key"), symbol.cast("binary").alias("value")),
            F.struct(F.lit("origin").alias("key"), F.lit(origin).cast("binary").alias("value")),
        ).alias("headers"),
    )


def unforwardable(messages: DataFrame, value: str = "value") -> DataFrame:
    return messages.where(F.json_object_keys(F.col(value).cast("string")).isNull())

"""Bind trades to the version of a dimension that was valid at their time, late in the stream.

A version holds from ``valid_from`` until the next one of its symbol. Each micro-batch reads the versions as they are
at that moment and joins them by sorted merge (``operators.asof``), which neither needs the dimension to be small nor a
symbol to be rare. A version that becomes known after trades of its time were written is caught up with by ``rebind``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickloom.operators.asof import asof_join
from tickloom.sources.tables import cut_lineage
from tickloom.streaming.slices import read_slices, write_slice

VERSIONS_DDL = "symbol string, valid_from timestamp, symbol_key int, asset_name string"
TAKEN = ("symbol_key", "asset_name")


def bound_fields(fields: StructType, versions_ddl: str = VERSIONS_DDL, take: Sequence[str] = TAKEN) -> StructType:
    """The schema of bound trades."""
    there = StructType.fromDDL(versions_ddl)
    return StructType([*fields.fields, *(there[c] for c in take)])


def bind(trades: DataFrame, versions: DataFrame, take: Sequence[str] = TAKEN, ident: Sequence[str] = ("id",)) -> DataFrame:
    """Trades with the columns ``take`` of the version valid at ``event_time``; null before the first one.

    Of versions with one symbol and time, the one whose columns sort last counts.
    """
    held = versions.groupBy("symbol", "valid_from").agg(F.max(F.struct(*take)).alias("_v")).select("symbol", "valid_from", "_v.*")
    return asof_join(trades, held, ["symbol"], "event_time", "valid_from", list(take), list(ident))


def bind_stream(trades: DataFrame, versions_path: str, path: str, checkpoint: str, versions_ddl: str = VERSIONS_DDL, take: Sequence[str] = TAKEN,
                ident: Sequence[str] = ("id",), **trigger) -> StreamingQuery:
    """Write bound trades by batch; a replayed batch replaces its own slice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = batch.sparkSession.read.schema(versions_ddl).parquet(versions_path)
        write_slice(bind(batch, versions, take, ident), path, batch_id)

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def rebind(spark: SparkSession, path: str, fields: StructType, versions: DataFrame, changed: DataFrame, take: Sequence[str] = TAKEN,
           ident: Sequence[str] = ("id",)) -> list[int]:
    """Bind anew the slices that hold trades of ``changed`` versions (symbol, valid_from); returns their batch ids.

    ``fields`` is the schema of the unbound trades, ``versions`` all versions as they are now. Other slices are read for two columns only.
    """
    since = changed.groupBy("symbol").agg(F.min("valid_from").alias("_since"))
    slices = read_slices(spark, path, "symbol string, event_time timestamp")
    touched = slices.join(since, "symbol").where(F.col("event_time") >= F.col("_since")).select("batch_id").distinct().collect()
    found = sorted(r["batch_id"] for r in touched)
    for batch_id in found:
        stored = spark.read.schema(fields).parquet(f"{path}/batch_id={batch_id}")
        write_slice(cut_lineage(bind(stored, versions, take, ident)), path, batch_id)
    return found

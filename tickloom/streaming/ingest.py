"""From messages to tables: one checkpointed query, one read of the source, several sinks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickloom.functions import clock
from tickloom.operators import cleaning
from tickloom.schema import local_table
from tickloom.sources import messages as shapes
from tickloom.sources import spans
from tickloom.sources.tables import by_day
from tickloom.streaming import levels
from tickloom.streaming.slices import committed, drop_slices, folded, read_slices, write_slice

DAYS = ("year", "month", "day")
SILVER_DDL = ("event_time timestamp, symbol string, asset_name string, price double, volume double, "
              "processed_at timestamp, year int, month int, day int")
LEDGER_DDL = "sink string, status string, rows bigint, error string"


def trade_stream(messages: DataFrame, value: str = "value", source_tz: str = "UTC", strict_time: bool = False, **limits) -> DataFrame:
    """Messages to classified trades with day columns; see ``classify`` for ``limits``."""
    parsed = cleaning.parse_trades(messages, value, source_tz, strict_time)
    return cleaning.add_day_columns(cleaning.classify(parsed, **limits))


def append_table(trades: DataFrame, table: str, checkpoint: str, path: str | None = None, partition_by=DAYS, **trigger) -> StreamingQuery:
    """Append a stream to a table partitioned by day. Narrow: each task writes what it read."""
    writer = trades.writeStream.outputMode("append").partitionBy(*partition_by)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def append_files(trades: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by=DAYS, **trigger) -> StreamingQuery:
    """Append a stream to files: Parquet every 15 seconds, JSON every 5, or as ``trigger`` says."""
    writer = trades.writeStream.format(fmt).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not trigger:
        trigger = {"processingTime": "5 seconds" if fmt == "json" else "15 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str, value: str = "value", origin: str = "tick-bridge", **trigger) -> StreamingQuery:
    """Forward messages to another topic with their headers; needs Spark's Kafka package."""
    writer = shapes.forward_rows(messages, value, origin).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer = writer.option("includeHeaders", "true").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def fan_out(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    names: Mapping[str, str],
    value: str = "value",
    source_tz: str = "UTC",
    lake_path: str | None = None,
    keep=(),
    limits: Mapping | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Write accepted trades, rejects, a JSON lake and a ledger of counts from one query.

    ``spans`` keeps, for each batch and event day, the least and greatest processing time, by which last-hour views choose
    what they read. ``silver`` and ``rejects`` are primary: their failure fails the batch, which is then replayed.
    ``lake`` is secondary: its failure goes to the ledger and the stream goes on. Every sink is
    written per batch id, so a replay overwrites. A batch is cached because it is written more
    than once; should an executor be lost, its part is computed again from the source.
    """
    lake = lake_path or f"{root}/lake"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = trade_stream(batch, value, source_tz, **(limits or {}))
        rows = cleaning.enrich(rows, dict(names))
        rows = rows.persist()
        try:
            # At most one row per reason and event day comes to the driver.
            at = F.unix_micros("processed_at")
            counted = rows.groupBy("reject_reason", *DAYS).agg(F.count("*").alias("n"), F.min(at).alias("least"), F.max(at).alias("greatest")).collect()
            counts = Counter()
            for r in counted:
                counts[r["reject_reason"]] += r["n"]
            good = cleaning.accepted(rows)
            columns = [*keep, "event_time", "symbol", "asset_name", "price", "volume", "processed_at", *DAYS]
            silver = good.select(*columns)
            # Not cached in this shape: a cached plan would keep a hot day in one partition.
            write_slice(by_day(silver), f"{root}/silver", batch_id, partition_by=DAYS)
            bad = cleaning.rejected(rows).select(*keep, F.col(value).cast("string").alias("value"), "reject_reason")
            write_slice(bad, f"{root}/rejects", batch_id, partition_by=["reject_reason"])
            kept_spans = [(*(r[d] for d in DAYS), r["n"], r["least"], r["greatest"]) for r in counted if r["reject_reason"] is None]
            write_slice(spans.table(batch.sparkSession, kept_spans, DAYS), f"{root}/spans", batch_id)
            accepted = counts.pop(None, 0)
            entries = [("silver", "ok", accepted, ""), ("rejects", "ok", sum(counts.values()), "")]
            try:
                # Taken from the files just written, which are split by day and size already.
                stored = batch.sparkSession.read.schema(silver.schema).parquet(f"{root}/silver/batch_id={batch_id}")
                write_slice(stored, lake, batch_id, fmt="json", partition_by=DAYS)
                entries.append(("lake", "ok", accepted, ""))
            except Exception as failure:
                entries.append(("lake", "failed", 0, str(failure)))
            ledger = local_table(batch.sparkSession, entries, LEDGER_DDL)
            write_slice(ledger.coalesce(1), f"{root}/ledger", batch_id)
        finally:
            rows.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_slices(spark, f"{root}/ledger", LEDGER_DDL)


def _silver_slices(spark: SparkSession, root: str, keep: str, columns: str) -> DataFrame:
    rows = read_slices(spark, f"{root}/silver", ", ".join(x for x in (keep, columns) if x))
    return committed(rows, read_ledger(spark, root))


def read_silver(spark: SparkSession, root: str, keep: str = "", columns: str = SILVER_DDL) -> DataFrame:
    """Trades of all finished batches: the compacted runs and the slices after them.

    ``keep`` is the schema text of further columns that ``fan_out`` was told to keep.
    """
    return folded(spark, _silver_slices(spark, root, keep, columns), f"{root}/compacted", DAYS)


def read_recent(spark: SparkSession, root: str, as_of=None, seconds: int = 3600, keep: str = "", columns: str = SILVER_DDL) -> DataFrame:
    """What ``read_silver`` gives of trades processed in the ``seconds`` up to ``as_of`` (None: now).

    Only the runs, slices and event days are listed and read whose span of processing times reaches into that time.
    """
    high = clock.epoch_micros(as_of)
    between = high - seconds * 1_000_000, high
    upto = levels.newest(spark, f"{root}/compacted")
    listed = committed(read_slices(spark, f"{root}/spans", spans.ddl(DAYS)), read_ledger(spark, root))
    listed = listed.where((F.col("batch_id") > (-1 if upto is None else upto)) & (F.col("least") <= between[1]) & (F.col("greatest") >= between[0]))
    found = listed.select("batch_id", *DAYS).collect()  # the batches since the last compaction, by day
    fields = StructType.fromDDL(", ".join(x for x in (keep, columns, "batch_id int") if x))
    folders = [f"{root}/silver/batch_id={r['batch_id']}/" + "/".join(f"{d}={r[d]}" for d in DAYS) for r in found]
    rows = spark.createDataFrame([], fields)
    if folders:
        rows = spark.read.schema(fields).option("basePath", f"{root}/silver").parquet(*folders).select(*fields.names)
    rows = folded(spark, rows, f"{root}/compacted", DAYS, between)
    return rows.where(F.unix_micros("processed_at").between(*between))


def compact_silver(spark: SparkSession, root: str, keep: str = "") -> int | None:
    """Compact the finished batches that were not, but for the newest; returns the last one covered.

    Rows are written anew only for days that occur in these batches, and of these days only what is not much larger
    than the new rows (see ``levels``). A batch still being written, or replayed later, is not covered, so
    ``read_silver`` counts no row twice. Slices that the compaction before covered are deleted, but for those whose
    lake slice is still to be repaired.
    """
    ledger = read_ledger(spark, root)
    newest = ledger.where("sink = 'silver' AND status = 'ok'").agg(F.max("batch_id")).first()[0]
    before = levels.newest(spark, f"{root}/compacted")
    if newest is None or newest - 1 <= (-1 if before is None else before):
        return before
    rows = _silver_slices(spark, root, keep, SILVER_DDL)
    fresh = rows.where((F.col("batch_id") > (-1 if before is None else before)) & (F.col("batch_id") < newest)).drop("batch_id")
    levels.add(fresh, f"{root}/compacted", newest - 1, DAYS, span="processed_at",
               arrange=lambda r: by_day(r).sortWithinPartitions(*DAYS, "processed_at", "event_time"))
    if before is not None:
        broken = [r[0] for r in ledger.where("sink = 'lake' AND status <> 'ok'").select("batch_id").distinct().collect()]
        drop_slices(spark, f"{root}/silver", before, broken)
        drop_slices(spark, f"{root}/spans", before)
    return newest - 1


def repair_lake(spark: SparkSession, root: str, lake_path: str | None = None, keep: str = "") -> list[int]:
    """Write the lake slices that have failed anew from ``silver``; returns their batch ids.

    A batch's ledger is rewritten only after its slice is whole.
    """
    ledger = read_ledger(spark, root)
    failed = [r[0] for r in ledger.where("sink = 'lake' AND status <> 'ok'").select("batch_id").distinct().collect()]
    columns = ", ".join(x for x in (keep, SILVER_DDL) if x)
    for batch_id in failed:
        stored = spark.read.schema(columns).parquet(f"{root}/silver/batch_id={batch_id}")
        write_slice(stored, lake_path or f"{root}/lake", batch_id, fmt="json", partition_by=DAYS)
        rows = [(r["sink"], r["status"], r["rows"], r["error"]) for r in ledger.where(F.col("batch_id") == batch_id).collect()]
        accepted = next(n for sink, _, n, _ in rows if sink == "silver")
        rows = [("lake", "ok", accepted, "") if r[0] == "lake" else r for r in rows]
        write_slice(local_table(spark, rows, LEDGER_DDL).coalesce(1), f"{root}/ledger", batch_id)
    return failed

"""Stateful stream operators: deduplication, throttle, lateness."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, StructField, StructType

from tickloom.operators import keyfilter
from tickloom.operators.throttle import passed, throttle
from tickloom.sources.tables import delete_folder
from tickloom.streaming import levels
from tickloom.streaming.slices import write_slice

FULL_KEY = ("event_time", "symbol", "price", "volume")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of queries started inside is on local disk with changelog checkpoints, not on the heap.

    Needed by ``throttle_stream``. The session's settings are put back at the end.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


DEDUP_DIRS = ("day", "batch_id")


def _hashed(rows: DataFrame, keys: Sequence[str], bucket_seconds: int) -> DataFrame:
    """With the day and the time bucket that a row is stored under, and a hash of its keys in which nulls count too."""
    parts = [F.coalesce(F.hex(F.col(k).cast("string").cast("binary")), F.lit("-")) for k in keys]
    day, second = F.to_date("event_time"), F.unix_seconds("event_time")
    # A day and bucket of their own for rows without a time, which no folder name can carry.
    return rows.withColumns({
        "day": F.coalesce(day, F.lit("1970-01-01").cast("date")),
        "bucket": F.coalesce((F.pmod(second, F.lit(86400)) / bucket_seconds).cast("int"), F.lit(-1)),
        "_hash": F.xxhash64(F.concat_ws("|", *parts)),
    })


def dedup_batches(trades: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = FULL_KEY, bucket_seconds: int = 3600, **trigger) -> StreamingQuery:
    """One row per key at any lateness, written to ``path`` by event day and batch. ``event_time`` is a key.

    A batch drops its own copies and then those whose key is stored already. For each time bucket of a slice a Bloom
    filter of its keys is kept; a batch reads the filters of its own buckets, and then only the slices, and of these the
    buckets, that may hold one of its keys, which are none where no copies come. Rows of a slice are sorted by bucket, so
    the others are skipped by the files' statistics. An original that comes late is kept. A replayed batch looks at
    earlier batches only and replaces its own files.
    """
    keys = list(keys)
    if "event_time" not in keys:
        raise ValueError("event_time must be among the keys: copies are looked for in their own time bucket only")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = _hashed(batch.dropDuplicates(keys), keys, bucket_seconds).persist()
        try:
            rows_kept = rows
            if batch_id:
                stored = seen_slices(spark, path, rows, batch_id)
                if stored is not None:
                    same = [rows[k].eqNullSafe(stored[k]) for k in ("day", "bucket", "_hash", *keys)]
                    rows_kept = rows.join(stored.select("day", "bucket", "_hash", *keys), same, "left_anti")
            out = rows_kept.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "day").sortWithinPartitions("day", "bucket")
            _replace_slices(spark, f"{path}/rows", batch_id)
            out.write.mode("append").partitionBy(*DEDUP_DIRS).parquet(f"{path}/rows")
            written = spark.read.schema(_stored(rows.schema)).parquet(f"{path}/rows").where(F.col("batch_id") == batch_id)
            filters = keyfilter.filters(written, ["day", "bucket"], "_hash").withColumn("batch_id", F.lit(batch_id))
            _replace_slices(spark, f"{path}/filters", batch_id)
            filters.write.mode("append").partitionBy(*DEDUP_DIRS).parquet(f"{path}/filters")
        finally:
            rows.unpersist()

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _stored(fields: StructType) -> StructType:
    return StructType([*(f for f in fields if f.name != "batch_id"), StructField("batch_id", IntegerType())])


def _replace_slices(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete what an earlier try of the batch has left."""
    for folder in levels.found(spark, f"{path}/day=*/batch_id={batch_id}"):
        delete_folder(spark, folder)


def seen_slices(spark: SparkSession, path: str, rows: DataFrame, batch_id: int) -> DataFrame | None:
    """The stored rows of the slices before ``batch_id`` that may hold a key of ``rows``; None if there are none."""
    days = [str(r["day"]) for r in rows.select("day").distinct().collect()]  # as many as the calendar has
    there = {f.rsplit("/", 1)[-1].removeprefix("day=") for f in levels.found(spark, f"{path}/filters/day=*")}
    folders = [f"{path}/filters/day={d}" for d in days if d in there]
    if not folders:
        return None
    fields = StructType([StructField("bucket", IntegerType()), *keyfilter.FIELDS.fields, StructField("day", DateType()), StructField("batch_id", IntegerType())])
    kept = spark.read.schema(fields).option("basePath", f"{path}/filters").parquet(*folders).where(F.col("batch_id") < batch_id)
    hit = keyfilter.hits(rows, kept, ["day", "bucket"], "_hash", ["batch_id"]).distinct()
    found = hit.groupBy("day", "batch_id").agg(F.collect_set("bucket").alias("buckets")).collect()  # slices, not rows
    if not found:
        return None
    slices = [f"{path}/rows/day={r['day']}/batch_id={r['batch_id']}" for r in found]
    stored = spark.read.schema(_stored(rows.schema)).option("basePath", f"{path}/rows").parquet(*slices)
    return stored.where(F.col("bucket").isin(sorted({b for r in found for b in r["buckets"]})))


def read_deduplicated(spark: SparkSession, path: str, trades: DataFrame) -> DataFrame:
    """What ``dedup_batches`` has kept, in the columns of ``trades``."""
    return spark.read.schema(trades.schema).parquet(f"{path}/rows").select(*trades.columns)


class _Throttle(StatefulProcessor):
    """Keeps the time of the last passed tick of a symbol, as epoch microseconds."""

    def __init__(self, step: int, ident: str, columns: list[str], late: str | None):
        self.step, self.ident, self.columns, self.late = step, ident, columns, late

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", StructType([StructField("us", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(rows)).sort_values(["event_time", self.ident])
        since = self.last.get()[0] + self.step if self.last.exists() else -(2**62)
        times = ticks["event_time"].to_numpy()
        places, after = passed(times, since, self.step)
        if places:
            self.last.update((after - self.step,))
        if self.late is not None:
            ticks[self.late] = times < since - self.step
            places = [*range(int(ticks[self.late].sum())), *places]  # sorted by time: the late ones come first
        yield ticks.iloc[places][self.columns]

    def close(self) -> None:
        pass


def throttle_stream(trades: DataFrame, seconds: float, ident: str = "id", late: str | None = None) -> DataFrame:
    """The throttle on a stream: state is one number per symbol.

    A task holds one symbol's ticks of one micro-batch, which the source's admission limit
    bounds. Ticks older than the last passed one come too late to be judged: they are dropped, or, if ``late`` names a
    column, are put out too and marked by it, so that they can be counted and kept.
    """
    step = int(round(seconds * 1_000_000))
    rows = trades.withColumn("event_time", F.unix_micros("event_time"))
    made = StructType([*rows.schema.fields, *([StructField(late, BooleanType())] if late else [])])
    out = rows.groupBy("symbol").transformWithStateInPandas(
        _Throttle(step, ident, made.names, late), made, outputMode="Append", timeMode="None"
    )
    return out.withColumn("event_time", F.timestamp_micros("event_time")).select(*made.names)


def throttle_batches(trades: DataFrame, path: str, checkpoint: str, seconds: float, ident: str = "id", **trigger) -> StreamingQuery:
    """The throttle for large micro-batches, such as a catch-up run in which one symbol is hot.

    A tick before the end of the wait that its symbol carries over cannot pass. Once those are
    gone, the first tick left passes, so the batch operator finishes the work in even pieces.
    Slices of passed rows and of the carried times are written per batch id: a replayed batch
    starts from the times of the batch before it and overwrites its own.

    A tick older than the last one passed comes too late to be judged; it is kept under ``late``.
    ``account`` has the counts of every batch: rows = passed + waiting + late.
    """
    wait = F.expr(f"INTERVAL {int(round(seconds * 1_000_000)) / 1_000_000:.6f} SECONDS")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, carried, late = batch, None, batch.limit(0)
        if batch_id:
            carried = spark.read.schema(_CARRIED).parquet(f"{path}/carried/batch_id={batch_id - 1}")
            held = batch.join(carried, "symbol", "left")
            late = held.where(F.col("event_time") < F.col("last")).select(*batch.columns)
            rows = held.where(F.col("last").isNull() | (F.col("event_time") >= F.col("last") + wait)).drop("last")
        write_slice(late, f"{path}/late", batch_id)
        write_slice(throttle(rows.select(*batch.columns), seconds, ident=ident), f"{path}/passed", batch_id)
        stored = spark.read.schema(batch.schema).parquet(f"{path}/passed/batch_id={batch_id}")
        counted = [
            side.agg(F.count("*").alias("n")).withColumn("what", F.lit(what))
            for what, side in (("rows", batch), ("passed", stored),
                               ("late", spark.read.schema(batch.schema).parquet(f"{path}/late/batch_id={batch_id}")))
        ]
        sides = counted[0].unionByName(counted[1]).unionByName(counted[2])
        n = {w: F.sum(F.when(F.col("what") == w, F.col("n"))) for w in ("rows", "passed", "late")}
        account = sides.agg(n["rows"].alias("rows"), n["passed"].alias("passed"), n["late"].alias("late"))
        account = account.withColumn("waiting", F.col("rows") - F.col("passed") - F.col("late"))
        write_slice(account.coalesce(1), f"{path}/account", batch_id)
        last = stored.select("symbol", F.col("event_time").alias("last"))
        last = last if carried is None else last.unionByName(carried)
        write_slice(last.groupBy("symbol").agg(F.max("last").alias("last")), f"{path}/carried", batch_id)

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


_CARRIED = "symbol string, last timestamp"
ACCOUNT_DDL = "rows bigint, passed bigint, late bigint, waiting bigint"


LATENESS_DDL = "rows bigint, late_rows bigint, newest timestamp, watermark timestamp, high timestamp"


def lateness_stream(trades: DataFrame, path: str, checkpoint: str, delay_seconds: int = 3600, **trigger) -> StreamingQuery:
    """Per batch: rows, rows behind the watermark, newest time and the watermark they were held against.

    The engine's own counter counts partly aggregated rows; this counts raw ones. The watermark
    of a batch is the newest time of all earlier batches minus the delay. That time is carried from
    batch to batch as ``high``, so only the slice before is read, and a replay gets the same answer.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id:
            before = spark.read.schema(LATENESS_DDL).parquet(f"{path}/batch_id={batch_id - 1}")
            newest = before.agg(F.max(F.unix_micros("high"))).first()[0]
        mark = F.timestamp_micros(F.lit(None if newest is None else newest - delay_seconds * 1_000_000).cast("bigint"))
        t = F.col("event_time")
        out = batch.agg(
            F.count("*").alias("rows"),
            F.count_if(t < mark).alias("late_rows"),
            F.max(t).alias("newest"),
        ).withColumn("watermark", mark)
        known = F.timestamp_micros(F.lit(newest).cast("bigint"))
        out = out.withColumn("high", F.greatest("newest", known))
        write_slice(out, path, batch_id)

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def dropped_by_watermark(query: StreamingQuery) -> DataFrame:
    """(batch_id, rows_dropped) as the engine reports them for the batches it still remembers."""
    spark = SparkSession.active()
    rows = [
        Row(batch_id=p["batchId"], rows_dropped=sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"]))
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id bigint, rows_dropped bigint")

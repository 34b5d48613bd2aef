"""Windows that are closed once, with corrections for rows that come later.

The low watermark is the least, over the source's partitions, of the newest event time each has brought, less a delay:
a partition that lags behind holds windows open, whatever the others have sent. A window is closed in the batch in which the low
watermark passes its end; its rows are then put out as ``final``, once. Rows that come for a window behind the watermark
are counted all the same, and the window's keys that they touch are put out again as ``correction``, with whole totals, so a
consumer replaces what it has by the row of the greatest ``batch_id``.

    <path>/slices/batch_id=N     additive measures of the batch, as in ``rollup``
    <path>/marks/batch_id=N      newest time by source partition, and the low watermark
    <path>/closed/batch_id=N     what the batch has put out
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.streaming import rollup
from tickloom.streaming.slices import read_slices, write_slice

MARKS_DDL = "source string, newest bigint, low bigint"
CLOSED_DDL = rollup.FLOW_DDL + ", kind string"


def closing_stream(trades: DataFrame, path: str, checkpoint: str, source: str, width_seconds: int = 300, delay_seconds: int = 3600,
                   expected: int = 1, **trigger) -> StreamingQuery:
    """Five-minute flow by symbol, each window put out once it is closed; a replayed batch replaces its own slices.

    ``source`` tells the source's partitions apart, for instance topic and partition; as long as fewer than ``expected`` of
    them have been seen, nothing is closed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            write_slice(rollup.bucketed(batch, f"{width_seconds} seconds", rollup.flow_measures()), f"{path}/slices", batch_id)
            seen = batch.groupBy(F.col(source).cast("string").alias("source")).agg(F.max(F.unix_micros("event_time")).alias("newest")).where("newest IS NOT NULL")
            low_before = None
            if batch_id:
                before = spark.read.schema(MARKS_DDL).parquet(f"{path}/marks/batch_id={batch_id - 1}")
                low_before = before.agg(F.max("low")).first()[0]
                seen = seen.unionByName(before.select("source", "newest"))
            newest = seen.groupBy("source").agg(F.max("newest").alias("newest"))  # one row for each partition of the source
            ends = newest.agg(F.count("*").alias("n"), F.min("newest").alias("least")).first()
            low = None if ends["n"] < expected or ends["least"] is None else ends["least"] - delay_seconds * 1_000_000
            # A partition that is seen for the first time may lie behind: what is closed stays closed.
            low = max((x for x in (low, low_before) if x is not None), default=None)
            write_slice(newest.withColumn("low", F.lit(low).cast("bigint")).coalesce(1), f"{path}/marks", batch_id)
        finally:
            batch.unpersist()
        write_slice(_put_out(spark, path, batch_id, width_seconds, low_before, low), f"{path}/closed", batch_id)

    writer = trades.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _put_out(spark: SparkSession, path: str, batch_id: int, width: int, low_before: int | None, low: int | None) -> DataFrame:
    """Windows that the batch closes, and keys of closed ones that it adds to, with all rows up to it."""
    end = F.unix_micros("bucket_start") + width * 1_000_000
    rows = rollup._slices(spark, path, rollup.FLOW_DDL).where(F.col("batch_id") <= batch_id)
    mine = spark.read.schema(rollup.FLOW_DDL).parquet(f"{path}/slices/batch_id={batch_id}")
    never = F.lit(-(2**62))
    before, now = (never if x is None else F.lit(x) for x in (low_before, low))
    # Both conditions are on the windows' start, so only the files of those windows are read.
    closed = rollup.added_up(rows.where((end > before) & (end <= now))).withColumn("kind", F.lit("final"))
    late = mine.where(end <= before).select(*rollup.KEYS).distinct()
    again = rollup.added_up(rows.where(end <= before).join(late, list(rollup.KEYS), "left_semi")).withColumn("kind", F.lit("correction"))
    names = [c.split()[0] for c in CLOSED_DDL.split(", ")]
    return closed.select(*names).unionByName(again.select(*names))


def read_emitted(spark: SparkSession, path: str) -> DataFrame:
    """All that was put out, with the ``batch_id`` that did."""
    return read_slices(spark, f"{path}/closed", CLOSED_DDL)


def read_closed(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every window and symbol that was put out, and how often it was."""
    rows = read_emitted(spark, path)
    names = [c for c in rows.columns if c not in rollup.KEYS]
    newest = rows.groupBy(*rollup.KEYS).agg(F.max(F.struct("batch_id", *[c for c in names if c != "batch_id"])).alias("r"), F.count("*").alias("times"))
    return newest.select(*rollup.KEYS, *[F.col(f"r.{c}").alias(c) for c in names], "times")

"""Read and maintain lake tables partitioned by year, month and day."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom import schema
from tickloom.functions import clock


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Only where that is unset and Spark runs in one process, as in tests, a temporary folder is made and
    set. Executors on other machines would not see it, so on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickloom-")
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{os.urandom(8).hex()}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the cluster's checkpoint folder."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: computed once, where a checkpoint computes it twice."""
    path = f"{shared_dir(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prune_days(trades: DataFrame, start, end) -> DataFrame:
    """Keep whole days from ``start`` to ``end`` by the partition columns alone.

    A filter on event_time never prunes folders; this one does. Rows inside the two days stay, so
    the caller still filters on the exact time. Without the partition columns nothing is dropped.
    """
    if not {"year", "month", "day"} <= set(trades.columns):
        return trades
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    first, last = (clock.date_key(F.to_date(clock.as_instant(x))) for x in (start, end))
    return trades.where(key.between(first, last))


def read_range(trades: DataFrame, start, end) -> DataFrame:
    """start <= event_time < end, pruned to the partitions that can hold such rows.

    A day of slack on either side covers tables written in another zone.
    """
    lo, hi = clock.as_instant(start), clock.as_instant(end)
    day = F.expr("INTERVAL 1 DAY")
    t = F.col("event_time")
    return prune_days(trades, lo - day, hi + day).where((t >= lo) & (t < hi))


def ensure_table(spark: SparkSession, name: str, columns: StructType = schema.SILVER, path: str | None = None,
                 partitions=("year", "month", "day")) -> None:
    """Create the partitioned Parquet table unless it exists."""
    if spark.catalog.tableExists(name):
        return
    # Parquet keeps no NOT NULL promise, so required columns are enforced on write.
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}){where}"
    )


def enforce_required(rows: DataFrame, columns: StructType = schema.SILVER) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column, rows that lack one)."""
    ok = F.lit(True)
    for f in columns.fields:
        if not f.nullable:
            ok = ok & F.col(f.name).isNotNull()
    return rows.where(ok), rows.where(~ok)


def insert_rows(rows: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Append the complete rows to a table; returns the refused ones.

    A table that is not there, or was dropped meanwhile, is created and the insert tried once more.
    """
    spark = rows.sparkSession
    good, bad = enforce_required(rows)

    def insert() -> None:
        by_day(good).select(*spark.table(name).columns).write.insertInto(name)

    try:
        insert()
    except AnalysisException as failure:
        if failure.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        ensure_table(spark, name, path=path)
        insert()
    return bad


def by_day(trades: DataFrame) -> DataFrame:
    """Bring the rows of a day together so that it is written as few files.

    ``rebalance`` lets adaptive execution split a day that holds most of the rows and merge
    days that hold few, so no task is given more than the advisory partition size. Write the
    result directly: in a cache, or in a stream's own plan, nothing is split.
    """
    return trades.hint("rebalance", "year", "month", "day")


def reset_table(spark: SparkSession, name: str, data_path: str | None = None, checkpoint: str | None = None) -> None:
    """Drop a table together with its files and the checkpoint of the stream that fed it.

    Dropping one without the other would either replay rows twice or skip them for good.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in (data_path, checkpoint):
        if path:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on; refuses a file system's root."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if target.isRoot():
        raise ValueError(f"refusing to delete {path}")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def compact(rows: DataFrame, target: str, start=None, end=None) -> None:
    """Write a folder of many small files anew as few files per day; the source is left alone.

    With ``start`` and ``end`` only those days are read and written.
    """
    days = ["year", "month", "day"]
    if start and end:
        rows = prune_days(rows, start, end)
    keep = [c for c in rows.columns if c not in (*days, "batch_id")]
    out = by_day(rows.select(*keep, *days))
    out.sortWithinPartitions(*days, "event_time").write.mode("overwrite").partitionBy(*days).parquet(target)

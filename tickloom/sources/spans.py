"""Spans of a time column by folder, for tables that are partitioned by another one.

A table partitioned by event day says nothing about processing times. Beside the table, in a folder that Spark's
readers pass over, each writer puts one row for each day it wrote: the least and greatest time. A reader of a
range of times lists and reads only the days whose span reaches into it, whatever the events' own days are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions import clock
from tickloom.schema import local_table

DAYS = ("year", "month", "day")


def ddl(days: Sequence[str] = DAYS) -> str:
    return ", ".join([*(f"{d} int" for d in days), "rows bigint", "least bigint", "greatest bigint"])


def table(spark: SparkSession, rows: Sequence[tuple], days: Sequence[str] = DAYS) -> DataFrame:
    """(days..., rows, least, greatest) as one small file."""
    made = local_table(spark, rows, ddl(days)) if rows else spark.createDataFrame([], ddl(days))
    return made.coalesce(1)


def measured(rows: DataFrame, when: str, days: Sequence[str] = DAYS) -> DataFrame:
    """The span of ``when`` on each day; combined per task before the shuffle."""
    at = F.unix_micros(when)
    return rows.groupBy(*days).agg(F.count("*").alias("rows"), F.min(at).alias("least"), F.max(at).alias("greatest"))


def append(rows: DataFrame, path: str, when: str, partition_by: Sequence[str] = DAYS) -> None:
    """Append ``rows`` to the table at ``path`` and their spans beside it.

    The spans are written first. Should the rows not follow, a day is read for nothing; were it the other way
    round, rows could be missed.
    """
    measured(rows, when, partition_by).coalesce(1).write.mode("append").parquet(f"{path}/_spans_{when}")
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_between(spark: SparkSession, path: str, fields: StructType, when: str, low, high, partition_by: Sequence[str] = DAYS) -> DataFrame:
    """Rows with low <= ``when`` <= high, from the days that can hold such rows; a null time is in no range."""
    lo, hi = clock.epoch_micros(low), clock.epoch_micros(high)
    spans = spark.read.schema(ddl(partition_by)).parquet(f"{path}/_spans_{when}")
    found = spans.where((F.col("least") <= hi) & (F.col("greatest") >= lo)).select(*partition_by).distinct().collect()  # days
    folders = [path + "/" + "/".join(f"{d}={r[d]}" for d in partition_by) for r in found]
    there = spark.createDataFrame([], fields)
    if folders:
        there = spark.read.schema(fields).option("basePath", path).parquet(*folders).select(*fields.names)
    return there.where((F.col(when) >= clock.as_instant(low)) & (F.col(when) <= clock.as_instant(high)))

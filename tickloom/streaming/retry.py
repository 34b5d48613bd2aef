"""Forward messages with retries: a refused one is tried again some batches later, and given up after a number of attempts.

Each batch writes what became of every message it tried as one slice: the attempt, the error if there was one, and
the batch in which it is due again, which is ``backoff`` to the power of the attempt later. A batch looks for due messages in
the slices of that many batches only. A message is delivered, waiting or dead by its latest attempt.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

STATE = [StructField("attempt", IntegerType()), StructField("error", StringType()), StructField("due_batch", IntegerType())]


def _stored(spark: SparkSession, path: str, fields: StructType) -> DataFrame:
    folders = [StructField("batch_id", IntegerType()), StructField("round", IntegerType())]
    return spark.read.schema(StructType([*fields.fields, *STATE, *folders])).parquet(f"{path}/outcome")


def _try(messages: DataFrame, send: Callable[[DataFrame], DataFrame], attempts: int, backoff: int, batch_id: int) -> DataFrame:
    """What becomes of messages with their ``attempt``."""
    sent = send(messages)
    again = F.col("error").isNotNull() & (F.col("attempt") < attempts)
    due = F.lit(batch_id) + F.pow(F.lit(backoff), F.col("attempt")).cast("int")
    return sent.select(*messages.columns, "error", F.when(again, due).alias("due_batch"))


def _waiting(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that are to be tried again and were not yet."""
    tried = rows.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("attempt").alias("_attempt"))
    same = [rows[k].eqNullSafe(tried[f"_{k}"]) for k in key] + [tried["_attempt"] == rows["attempt"] + 1]
    return rows.where("due_batch IS NOT NULL").join(tried, same, "left_anti")


def forward_stream(messages: DataFrame, send: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: Sequence[str] = ("id",), attempts: int = 3,
                   backoff: int = 2, **trigger) -> StreamingQuery:
    """Send every message once it comes, and refused ones again.

    ``send`` gets messages with ``attempt`` (from 1) and returns them with ``error``, null where they were taken. Its outcome is
    written before it is used, so a message is sent once in each attempt; only a batch that is replayed sends anew. ``key``
    tells messages apart.
    """
    fields, reach = messages.schema, backoff ** max(attempts - 1, 0)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("attempt", F.lit(1))
        if batch_id:
            recent = _stored(spark, path, fields).where(F.col("batch_id").between(batch_id - reach, batch_id - 1))
            due = _waiting(recent, key).where(F.col("due_batch") == batch_id)
            rows = rows.unionByName(due.select(*fields.names, (F.col("attempt") + 1).alias("attempt")))
        _try(rows, send, attempts, backoff, batch_id).write.mode("overwrite").parquet(f"{path}/outcome/batch_id={batch_id}/round=0")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(spark: SparkSession, send: Callable[[DataFrame], DataFrame], path: str, fields: StructType, key: Sequence[str] = ("id",), attempts: int = 3,
          backoff: int = 2) -> int:
    """Try waiting messages until none is left, where no further batch comes by itself; returns the number of rounds.

    The stream is stopped meanwhile. It may go on later: what was tried here is not due any more.
    """
    last = _stored(spark, path, fields).agg(F.max("batch_id")).first()[0]
    if last is None:
        return 0
    reach = backoff ** max(attempts - 1, 0)
    rounds = _stored(spark, path, fields).where(F.col("batch_id") == last).agg(F.max("round")).first()[0]
    for number in range(1, attempts + 1):
        recent = _stored(spark, path, fields).where(F.col("batch_id") >= last - reach)
        rows = _waiting(recent, key).select(*fields.names, (F.col("attempt") + 1).alias("attempt"))
        if rows.isEmpty():
            return number - 1
        _try(rows, send, attempts, backoff, last).write.mode("overwrite").parquet(f"{path}/outcome/batch_id={last}/round={rounds + number}")
    return attempts


def outcomes(spark: SparkSession, path: str, fields: StructType, key: Sequence[str] = ("id",)) -> DataFrame:
    """Every message once with ``status`` (delivered, waiting, dead), ``attempt`` and the last ``error``."""
    newest = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("attempt")))  # a message has few attempts
    rows = _stored(spark, path, fields).withColumn("_n", newest).where("_n = 1")
    status = F.when(F.col("error").isNull(), "delivered").when(F.col("due_batch").isNull(), "dead").otherwise("waiting")
    return rows.select(*fields.names, status.alias("status"), "attempt", "error")

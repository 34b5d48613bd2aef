"""Where messages come from: a broker topic or files, as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | None = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    include_headers: bool = False,
) -> dict[str, str]:
    """Options of Spark's ``kafka`` format.

    ``starting_offsets=None`` leaves Spark's own default. ``max_offsets_per_trigger`` bounds a
    micro-batch; ``min_partitions`` splits large topic partitions into more tasks.
    """
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if include_headers:
        opts["includeHeaders"] = "true"
    return opts


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topic as a stream of (id, value); needs Spark's Kafka package on the class path."""
    return with_offset_id(spark.readStream.format("kafka").options(**options).load())


def with_offset_id(records: DataFrame) -> DataFrame:
    """A stable BIGINT id from partition and offset: it survives replays and late rows."""
    ident = F.shiftleft(F.col("partition").cast("bigint"), 48).bitwiseOR(F.col("offset"))
    return records.select(ident.alias("id"), "value", F.col("timestamp").alias("processed_at"))


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options,
) -> DataFrame:
    """Files that arrive in a folder, as a stream; ``max_files`` or ``max_bytes`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)

"""Tables written one micro-batch at a time.

A batch overwrites its own folder ``batch_id=N``, so a batch that Spark replays after a failure
replaces what it wrote before and nothing is stored twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickloom.sources.tables import delete_folder
from tickloom.streaming import levels


def write_slice(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    rows.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(f"{path}/batch_id={batch_id}")


def read_slices(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "parquet") -> DataFrame:
    """All slices below ``path`` with their ``batch_id``; an empty sink gives no rows."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if "batch_id" not in fields.names:
        fields = StructType([*fields.fields, StructField("batch_id", IntegerType())])
    return spark.read.format(fmt).schema(fields).load(path)


def folded(spark: SparkSession, slices: DataFrame, path: str, days: Sequence[str] = (), between: tuple[int, int] | None = None) -> DataFrame:
    """``slices`` with those that compacted runs below ``path`` cover replaced by these.

    Their rows have the number of the last batch covered as ``batch_id``. ``between`` leaves out runs outside of it.
    """
    names = [c for c in slices.columns if c != "batch_id"]
    last, base = levels.read(spark, path, StructType([slices.schema[c] for c in names]), days, between)
    if last is None:
        return slices
    later = slices.where(F.col("batch_id") > last)
    return base.select(*names, F.lit(last).cast("int").alias("batch_id")).unionByName(later.select(*names, "batch_id"))


def drop_slices(spark: SparkSession, path: str, upto: int, but: Sequence[int] = ()) -> None:
    """Delete the slices of all batches up to ``upto``, except some."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    for number in (int(f.getPath().getName().removeprefix("batch_id=")) for f in found or []):
        if number <= upto and number not in but:
            delete_folder(spark, f"{path}/batch_id={number}")


def committed(rows: DataFrame, ledger: DataFrame, sink: str = "silver") -> DataFrame:
    """Only rows of batches the ledger calls done, so a batch in the middle of its write is not seen."""
    done = ledger.where((F.col("sink") == sink) & (F.col("status") == "ok")).select("batch_id").distinct()
    return rows.join(done, "batch_id", "left_semi")

"""Retrain gate, risk rule, model scoring and prompt context."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.schema import local_table

MARKER_DDL = "model string, row_count bigint, trained_at timestamp"

DEFAULT_PROMPT = (
    "Recent trades, newest first, one JSON record each:\n%s\n"
    "Describe in at most three sentences what stands out in them, and how sure you are."
)


def risk_label(price: Column, volume: Column, max_price: float = schema.RISK_PRICE, max_volume: float = schema.RISK_VOLUME) -> Column:
    """warning / safe by two thresholds; a missing value is unknown, not an error."""
    return (
        F.when(price.isNull() | volume.isNull(), "unknown")
        .when((price > max_price) & (volume > max_volume), "warning")
        .otherwise("safe")
    )


def score(
    trades: DataFrame,
    model: Callable[[pd.DataFrame], pd.Series] | None = None,
    max_price: float = schema.RISK_PRICE,
    max_volume: float = schema.RISK_VOLUME,
) -> DataFrame:
    """Add ``prediction``: a model applied to batches of (price, volume), or the rule without one.

    Narrow on batch and stream alike. Rows for which the model gives NULL fall back to the rule.
    """
    rule = risk_label(F.col("price"), F.col("volume"), max_price, max_volume)
    if model is None:
        return trades.withColumn("prediction", rule)

    @F.pandas_udf("string")
    def predict(price: pd.Series, volume: pd.Series) -> pd.Series:
        return model(pd.DataFrame({"price": price, "volume": volume})).astype(object)

    return trades.withColumn("prediction", F.coalesce(predict("price", "volume"), rule))


def retrain_gate(trades: DataFrame, markers: DataFrame, model: str, threshold: int = schema.RETRAIN_ROWS) -> DataFrame:
    """One row: rows now, rows at the last training, the difference and whether to train.

    ``trades`` may be any rows; counting a whole Parquet table this way opens every file but decodes no column. With
    ``count_from_footers`` only footers are read, with ``count_from_ledger`` no file of the table at all.
    """
    return gate(trades.agg(F.count("*").alias("row_count")), markers, model, threshold)


def gate(current: DataFrame, markers: DataFrame, model: str, threshold: int) -> DataFrame:
    """The newest marker counts. A table with fewer rows than it was reset, so all its rows are new."""
    trained = F.unix_micros("trained_at") if "trained_at" in markers.columns else F.lit(None).cast("bigint")
    newest = F.max_by("row_count", F.coalesce(trained, F.lit(-(2**62))))
    last = markers.where(F.col("model") == model).agg(F.coalesce(newest, F.lit(0)).alias("rows"))
    now = current.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    sides = now.withColumn("side", F.lit("now")).unionByName(last.withColumn("side", F.lit("last")))
    pick = {s: F.max(F.when(F.col("side") == s, F.col("rows"))) for s in ("now", "last")}
    both = sides.agg(pick["now"].alias("rows_now"), pick["last"].alias("marked")).withColumn(
        "rows_at_training", F.when(F.col("rows_now") < F.col("marked"), 0).otherwise(F.col("marked")))
    return both.select(
        F.lit(model).alias("model"),
        "rows_now",
        "rows_at_training",
        (F.col("rows_now") - F.col("rows_at_training")).alias("new_rows"),
        (F.col("rows_now") - F.col("rows_at_training") >= threshold).alias("should_train"),
    )


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """The count of a Parquet table, pushed into the scan, so that it reads the row counts in the files' footers only.

    Only the newer reader does that, and only if told so; the table is read in a session of its own, and the caller's
    settings stay as they are.
    """
    own = spark.newSession()
    sources = own.conf.get("spark.sql.sources.useV1SourceList")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources.split(",") if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count("*").alias("row_count"))


def count_from_footers(spark: SparkSession, path: str) -> DataFrame:
    """row_count of a Parquet table, partitioned or not; counted when called."""
    return local_table(spark, [(footer_count(spark, path).first()[0],)], "row_count bigint")


def count_from_ledger(ledger: DataFrame, sink: str = "silver") -> DataFrame:
    """row_count from the per-batch counts of the fan-out stream."""
    return ledger.where((F.col("sink") == sink) & (F.col("status") == "ok")).select(
        F.col("rows").alias("row_count")
    )


def mark_trained(spark: SparkSession, path: str, model: str, row_count: int) -> None:
    """Add a marker; called after a training that succeeded, never before."""
    spark.range(1).select(
        F.lit(model).alias("model"),
        F.lit(row_count).cast("bigint").alias("row_count"),
        F.current_timestamp().alias("trained_at"),
    ).write.mode("append").parquet(path)


def retrain_if_due(trades: DataFrame, markers_path: str, model: str, train: Callable[[], object], threshold: int = schema.RETRAIN_ROWS) -> bool:
    """Run ``train`` when enough rows came in; a failed training leaves the marker as it was."""
    spark = trades.sparkSession
    try:
        markers = spark.read.schema(MARKER_DDL).parquet(markers_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        markers = spark.createDataFrame([], MARKER_DDL)
    row = retrain_gate(trades, markers, model, threshold).first()
    if not row["should_train"]:
        return False
    train()
    mark_trained(spark, markers_path, model, row["rows_now"])
    return True


def market_context(trades: DataFrame, k: int = 5, template: str = DEFAULT_PROMPT, ident: str = "id", flagged: DataFrame | None = None) -> DataFrame:
    """One row: the latest ``k`` ticks as JSON records and the prompt built around them.

    ``flagged`` (ids) adds an is_anomaly field; it is joined to the k rows, not to the table.
    """
    fields = ["symbol", "price", "volume", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp")]
    top = trades.select(ident, "event_time", "symbol", "price", "volume").orderBy(
        F.desc("event_time"), F.desc(ident)
    ).limit(k)
    if flagged is not None:
        marks = flagged.select(ident).join(F.broadcast(top.select(ident)), ident, "left_semi")
        marks = marks.distinct().withColumn("is_anomaly", F.lit(True))
        top = top.join(marks, ident, "left").fillna(False, ["is_anomaly"])
        fields.append("is_anomaly")
    ordered = top.agg(
        F.sort_array(F.collect_list(F.struct("event_time", ident, F.struct(*fields).alias("tick"))), asc=False).alias("r")
    )
    context = F.to_json(F.col("r.tick"))
    return ordered.select(context.alias("context")).select(
        "context", F.format_string(template, F.col("context")).alias("prompt")
    )

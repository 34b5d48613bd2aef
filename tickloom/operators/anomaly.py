"""Anomaly flags: K-Means distance, and a per-symbol z-score baseline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock
from tickloom.operators.numbering import exact_quantile
from tickloom.sources.tables import written


def recent(trades: DataFrame, as_of=None, seconds: int = 86400) -> DataFrame:
    return trades.where(clock.within(F.col("event_time"), as_of, seconds))


def anomaly_fit(training: DataFrame, k: int = 4, seed: int = 42) -> PipelineModel:
    """K-Means on standardised price, volume and one-hot symbol. The training rows are computed once and read by every stage."""
    stages = [
        StringIndexer(inputCol="symbol", outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_index", outputCol="_symbol", dropLast=False),
        VectorAssembler(inputCols=["price", "volume", "_symbol"], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=False, withStd=True),
        KMeans(featuresCol="_features", predictionCol="centroid_id", k=k, seed=seed),
    ]
    return Pipeline(stages=stages).fit(written(training.select("symbol", "price", "volume")))


def centroids(model: PipelineModel, trades: DataFrame) -> DataFrame:
    """Model table: centre and number of rows of ``trades`` per cluster."""
    spark = trades.sparkSession
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.stages[-1].clusterCenters())]
    table = spark.createDataFrame(rows, "centroid_id int, centre array<double>")
    sizes = model.transform(trades).groupBy("centroid_id").agg(F.count("*").alias("members"))
    return table.join(sizes, "centroid_id", "left").fillna(0, ["members"])


def with_distance(model: PipelineModel, trades: DataFrame) -> DataFrame:
    """Add centroid_id and the distance to that centre, with built-in array functions."""
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    own = F.element_at(
        F.array(*[F.array(*[F.lit(x) for x in c]) for c in centres]), F.col("centroid_id") + 1
    )
    scored = model.transform(trades)
    squares = F.zip_with(vector_to_array("_features"), own, lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
    return scored.withColumn("distance", distance).drop("_index", "_symbol", "_raw", "_features")


def anomaly_threshold(model: PipelineModel, training: DataFrame, contamination: float = 0.02) -> float:
    """Exact (1 - contamination) quantile of the training distances."""
    scored = written(with_distance(model, training).select("distance"))  # read by every pass of the quantile
    return exact_quantile(scored, "distance", 1 - contamination).first()["quantile"]


def anomalies(model: PipelineModel, trades: DataFrame, threshold: float) -> DataFrame:
    """Flagged trades, newest first."""
    scored = with_distance(model, trades).withColumn("is_anomaly", F.col("distance") > threshold)
    return written(scored.where("is_anomaly")).orderBy(F.desc("event_time"))  # a sort reads its input twice


def anomaly_zscore(training: DataFrame, trades: DataFrame, limit: float = 3.0) -> DataFrame:
    """Trades whose price or volume is more than ``limit`` deviations off the symbol's mean.

    The statistics are one row per symbol; how they are joined is left to Spark, which knows their size at run time.
    """
    stats = training.groupBy("symbol").agg(
        F.avg("price").alias("_mp"),
        F.stddev_samp("price").alias("_sp"),
        F.avg("volume").alias("_mv"),
        F.stddev_samp("volume").alias("_sv"),
    )
    z_price = F.abs(F.try_divide(F.col("price") - F.col("_mp"), F.col("_sp")))
    z_volume = F.abs(F.try_divide(F.col("volume") - F.col("_mv"), F.col("_sv")))
    scored = trades.join(stats, "symbol").withColumn(
        "score", F.greatest(F.coalesce(z_price, F.lit(0.0)), F.coalesce(z_volume, F.lit(0.0)))
    )
    return scored.where(F.col("score") > limit).drop("_mp", "_sp", "_mv", "_sv")

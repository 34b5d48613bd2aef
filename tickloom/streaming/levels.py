"""Compacted runs of a table that grows by micro-batches: a log-structured merge, by day.

Every step takes the batches since the step before and writes one run for each day that occurs in them. A day's older
runs are merged into it only while they are not larger than ``FANOUT`` times what is merged already, so a row is
written anew about as often as its day has doubled, a day without new rows is left alone, and a day has few
runs. A manifest, written last, names the runs that count. What a step replaces is deleted by the step after it, so
readers that began with the manifest before still find their files.

    <path>/manifest/upto=N      which runs hold all rows of the batches up to N
    <path>/step=N/<day>         the runs written by the step that reached batch N

Only one process may compact a table at a time; reading and the stream go on meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tickloom.schema import local_table
from tickloom.sources.tables import delete_folder

FANOUT = 2


def found(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that a pattern names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    listed = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath().toString() for f in listed or []]


def manifests(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all finished manifests, ascending."""
    done = found(spark, f"{path}/manifest/upto=*/_SUCCESS")
    return sorted(int(f.split("/")[-2].removeprefix("upto=")) for f in done)


def newest(spark: SparkSession, path: str) -> int | None:
    """The last batch that compacted runs cover."""
    return max(manifests(spark, path), default=None)


def _ddl(days: Sequence[str]) -> str:
    return ", ".join([*(f"{d} int" for d in days), "step int", "rows bigint", "least bigint", "greatest bigint"])


def runs(spark: SparkSession, path: str, upto: int, days: Sequence[str]) -> list[Row]:
    """(days..., step, rows, least, greatest) of each run of a manifest: as many as there are days, times the logarithm of a
    day's size. ``least`` and ``greatest`` are microseconds, null if no column was named whose span is kept."""
    return spark.read.schema(_ddl(days)).parquet(f"{path}/manifest/upto={upto}").collect()


def _folder(path: str, run: Row, days: Sequence[str]) -> str:
    return "/".join([f"{path}/step={run['step']}", *(f"{d}={run[d]}" for d in days)])


def _read(spark: SparkSession, path: str, chosen: Sequence[Row], fields: StructType, days: Sequence[str]) -> DataFrame:
    """The rows of some runs; only their folders are listed."""
    names = fields.names
    if not chosen:
        return spark.createDataFrame([], fields)
    whole = StructType([*fields.fields, StructField("step", IntegerType())])
    folders = [_folder(path, run, days) for run in chosen]
    return spark.read.schema(whole).option("basePath", path).parquet(*folders).select(*names)


def read(spark: SparkSession, path: str, fields: StructType, days: Sequence[str] = (),
         between: tuple[int, int] | None = None) -> tuple[int | None, DataFrame]:
    """(last batch covered, its rows) by the newest manifest.

    ``between`` leaves out runs whose span, in microseconds, lies outside.
    """
    upto = newest(spark, path)
    chosen = [] if upto is None else runs(spark, path, upto, days)
    if between:
        chosen = [r for r in chosen if r["least"] is None or (r["least"] <= between[1] and r["greatest"] >= between[0])]
    return upto, _read(spark, path, chosen, fields, days)


def add(fresh: DataFrame, path: str, upto: int, days: Sequence[str] = (), combine: Callable[[DataFrame], DataFrame] | None = None,
        arrange: Callable[[DataFrame], DataFrame] | None = None, span: str | None = None) -> int:
    """Take in ``fresh``, the rows of the batches after the newest manifest up to ``upto``; returns how many rows were written.

    ``combine`` adds up rows that are merged (all columns stay); ``arrange`` puts rows in place before they are written.
    Of the timestamp column ``span`` each run's least and greatest value is kept in the manifest.
    """
    spark, days = fresh.sparkSession, list(days)
    before = newest(spark, path)
    old = [] if before is None else runs(spark, path, before, days)
    counted = fresh.groupBy(*days).agg(F.count("*").alias("n")).collect()  # one row per day
    new = {tuple(r[d] for d in days): r["n"] for r in counted if r["n"]}
    merged, kept = [], []
    for key in {tuple(r[d] for d in days) for r in old}:
        size = new.get(key)
        for run in sorted((r for r in old if tuple(r[d] for d in days) == key), key=lambda r: -r["step"]):
            if size is not None and run["rows"] <= FANOUT * size:
                merged.append(run)
                size += run["rows"]
            else:
                size = None  # runs before this one are larger
                kept.append(run)
    written, made = 0, []
    if new:
        rows = fresh.unionByName(_read(spark, path, merged, fresh.schema, days))
        rows = combine(rows) if combine else rows
        rows = arrange(rows) if arrange else rows
        rows.select(*fresh.columns).write.mode("overwrite").partitionBy(*days).parquet(f"{path}/step={upto}")
        stored = spark.read.schema(fresh.schema).parquet(f"{path}/step={upto}")
        ends = [f(F.unix_micros(span) if span else F.lit(None).cast("bigint")).alias(name) for f, name in ((F.min, "least"), (F.max, "greatest"))]
        made = [(*(r[d] for d in days), upto, r["n"], r["least"], r["greatest"])
                for r in stored.groupBy(*days).agg(F.count("*").alias("n"), *ends).collect() if r["n"]]
        written = sum(r[len(days) + 1] for r in made)
    listed = [(*(r[d] for d in days), r["step"], r["rows"], r["least"], r["greatest"]) for r in kept] + made
    ddl = _ddl(days)
    manifest = local_table(spark, listed, ddl) if listed else spark.createDataFrame([], ddl)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/upto={upto}")
    clean(spark, path, days)
    return written


def clean(spark: SparkSession, path: str, days: Sequence[str] = ()) -> None:
    """Delete what neither of the two newest manifests names: runs, left-overs of a failed step, older manifests."""
    known = manifests(spark, path)
    used = {_folder("", run, days) for upto in known[-2:] for run in runs(spark, path, upto, days)}
    # A step's folder goes as a whole, or day by day where some of its days are still in use.
    for folder in found(spark, f"{path}/step=*"):
        name = "/" + folder.rsplit("/", 1)[-1]
        if int(name.removeprefix("/step=")) > (known[-1] if known else -1):
            continue
        if not any(u == name or u.startswith(name + "/") for u in used):
            delete_folder(spark, folder)
        elif days:
            for day in found(spark, "/".join([folder, *(f"{d}=*" for d in days)])):
                if "/" + "/".join(day.split("/")[-len(days) - 1:]) not in used:
                    delete_folder(spark, day)
    for upto in known[:-2]:
        delete_folder(spark, f"{path}/manifest/upto={upto}")

"""K-Means over numbers and a category, without writing the category out as columns.

The model is that of standardised numbers beside a standardised one-hot category. A centre's part for the category is
the share of each value among its members, so the distance of a row to it is that of the numbers plus an offset that depends on the
row's category value and the centre only. Each round joins the offsets, one array of k numbers for each
value, and sums up members by centre and value: rows are combined per task, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.tables import cut_lineage, written

SAMPLE_ROWS = 2000  # rows, those of the smallest hashes of their id, among which the first centres are chosen


@dataclass(frozen=True)
class Model:
    """``centres``: (standardised numbers) of each cluster; ``offsets``: (category, weight, offsets) for each category value.

    ``scales`` are the numbers' deviations; a value's ``weight`` is the inverse variance of its one-hot column. ``members`` counts the rows
    of each cluster in the last round; ``settled`` says whether that round changed nothing.
    """

    numbers: tuple[str, ...]
    category: str
    scales: tuple[float, ...]
    centres: np.ndarray
    members: tuple[int, ...]
    offsets: DataFrame
    settled: bool


def _squares(model_numbers: Sequence[str], scales: Sequence[float], centres: np.ndarray) -> list[Column]:
    """The squared distance to each centre; needs the joined ``_offsets``."""
    out = []
    for c, centre in enumerate(centres):
        d = F.element_at("_offsets", c + 1)
        for name, scale, x in zip(model_numbers, scales, centre, strict=True):
            z = F.col(name) / scale - F.lit(float(x))
            d = d + z * z
        out.append(d)
    return out


def _assigned(rows: DataFrame, offsets: DataFrame, category: str, squares: list[Column]) -> DataFrame:
    """``rows`` with ``centroid_id`` and ``_square``; the lower number of equally near ones."""
    joined = rows.join(offsets.select(F.col(category).alias("_value"), F.col("offsets").alias("_offsets")), F.col(category).eqNullSafe(F.col("_value")))
    best = F.array_min(F.array(*[F.struct(s.alias("s"), F.lit(c).alias("c")) for c, s in enumerate(squares)]))
    return joined.withColumn("_best", best).withColumns({"centroid_id": F.col("_best.c"), "_square": F.col("_best.s")}).drop("_best", "_value", "_offsets")


def _offsets(weights: DataFrame, sums: DataFrame | None, category: str, k: int, members: Sequence[int], first: Sequence | None = None) -> DataFrame:
    """(category, weight, offsets): what each centre adds to the distance of a row of each value."""
    value = F.col(category)
    if first is not None:  # a centre is one row of the sample
        shares = [F.when(value.eqNullSafe(F.lit(v)), 1.0).otherwise(0.0) for v in first]
        table = weights.select(category, "weight", F.array(*shares).alias("shares"))
    else:
        counted = sums.groupBy(category).agg(*[F.sum(F.when(F.col("centroid_id") == c, F.col("n")).otherwise(0)).alias(f"_n{c}") for c in range(k)])
        shares = [F.col(f"_n{c}") / max(members[c], 1) for c in range(k)]
        counted = counted.select(F.col(category).alias("_value"), F.array(*shares).alias("shares"))
        table = weights.join(counted, value.eqNullSafe(F.col("_value")), "left").select(
            category, "weight", F.coalesce("shares", F.array(*[F.lit(0.0)] * k)).alias("shares"))
    lengths = table.agg(*[F.sum(F.pow(F.element_at("shares", c + 1), 2) * F.col("weight")).alias(f"k{c}") for c in range(k)]).first()
    own = [F.lit(float(lengths[f"k{c}"] or 0.0)) + F.col("weight") * (1 - 2 * F.element_at("shares", c + 1)) for c in range(k)]
    return cut_lineage(table.select(category, "weight", F.array(*own).alias("offsets")))


def fit(training: DataFrame, numbers: Sequence[str] = ("price", "volume"), category: str = "symbol", ident: str = "id", k: int = 4, rounds: int = 40,
        seed: int = 42) -> Model:
    """Lloyd's rounds until no centre moves, or ``rounds`` of them. Rows with a null number take no part; there must be one row.

    The training rows are computed once; rounds read the columns kept.
    """
    numbers = list(numbers)
    rows = written(training.dropna(subset=numbers).select(ident, category, *[F.col(c).cast("double").alias(c) for c in numbers]))
    found = rows.agg(F.count("*").alias("n"), *[F.stddev_samp(c).alias(c) for c in numbers]).first()
    if not found["n"]:
        raise ValueError("no rows to learn from")
    n, scales = found["n"], tuple(float(found[c] or 0.0) or 1.0 for c in numbers)
    share = F.count("*") / n
    weights = cut_lineage(rows.groupBy(category).agg((F.try_divide(F.lit(max(n - 1, 1)) / n, share * (1 - share))).alias("weight")).fillna(0.0, ["weight"]))
    # The first centres, far from each other, are rows of a bounded sample.
    drawn = rows.join(weights.withColumnRenamed(category, "_value"), F.col(category).eqNullSafe(F.col("_value"))).orderBy(F.xxhash64(ident, F.lit(seed)), ident)
    sample = drawn.limit(SAMPLE_ROWS).select(category, "weight", *numbers).collect()
    points = np.array([[r[c] / s for c, s in zip(numbers, scales, strict=True)] for r in sample])
    values, w = [r[category] for r in sample], np.array([r["weight"] for r in sample])
    rng, chosen = np.random.default_rng(seed), [0]
    far = np.full(len(sample), np.inf)
    while len(chosen) < k:
        at = chosen[-1]
        other = np.array([v != values[at] for v in values])
        far = np.minimum(far, ((points - points[at]) ** 2).sum(axis=1) + np.where(other, w + w[at], 0.0))
        chosen.append(int(rng.choice(len(sample), p=far / far.sum())) if far.sum() > 0 else 0)
    centres, members, settled = points[chosen], (0,) * k, False
    offsets = _offsets(weights, None, category, k, members, [values[i] for i in chosen])
    before = None
    for _ in range(rounds):
        assigned = _assigned(rows, offsets, category, _squares(numbers, scales, centres))
        sums = cut_lineage(assigned.groupBy("centroid_id", category).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in numbers]))
        whole = {r["centroid_id"]: r for r in sums.groupBy("centroid_id").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in numbers]).collect()}
        members = tuple(int(whole[c]["n"]) if c in whole else 0 for c in range(k))
        moved = np.array([[whole[c][x] / s / members[c] for x, s in zip(numbers, scales, strict=True)] if members[c] else centres[c] for c in range(k)])
        settled = before == members and bool(np.allclose(moved, centres, rtol=1e-12, atol=1e-12))
        centres, before = moved, members
        if settled:
            break
        offsets = _offsets(weights, sums, category, k, members)
    return Model(tuple(numbers), category, scales, centres, members, offsets, settled)


def with_distance(model: Model, rows: DataFrame) -> DataFrame:
    """Rows with ``centroid_id`` and the ``distance`` to that centre; values of the category that the model does not know are left out."""
    out = _assigned(rows, model.offsets, model.category, _squares(model.numbers, model.scales, model.centres))
    return out.withColumn("distance", F.sqrt(F.greatest("_square", F.lit(0.0)))).drop("_square")

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of
from tickloom.operators.numbering import exact_quantile, number_rows, range_sorted


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one time."""
    rows = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(1000))).alias("t")
    )
    return rows.repartition(5)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_same_numbers_as_one_big_window(hot, partitions):
    got = number_rows(hot, ["t", "id"], "n", partitions)
    want = hot.withColumn("n", F.row_number().over(Window.orderBy("t", "id")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_hot_value_is_spread(hot):
    sizes = range_sorted(hot, ["t", "id"], 16).groupBy("_part").count().collect()
    assert max(r["count"] for r in sizes) < 3 * 5000 / 16


def test_partitions_grow_with_the_rows(hot, monkeypatch):
    from tickloom.operators import numbering

    monkeypatch.setattr(numbering, "ROWS_PER_PARTITION", 100)
    assert range_sorted(hot, ["t", "id"]).rdd.getNumPartitions() > 40


def test_no_single_task_sort_of_the_rows(hot):
    plan = plan_of(number_rows(hot, ["t", "id"], "n"))
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("q", [0.0, 0.5, 0.98])
def test_quantile(hot, q):
    values = np.array([r["t"] for r in hot.collect()], float)
    for few in (1, 50, 100_000):
        assert exact_quantile(hot, "t", q, few).first()[0] == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("few", [1, 20])
def test_quantile_of_many_values_narrows_and_of_nothing(spark, monkeypatch, few):
    monkeypatch.setattr("tickloom.operators.numbering._SKETCH", 50)
    rows = spark.range(7000).selectExpr("if(id % 100 = 3, null, pow(hash(id) % 10007, 3)) x")
    values = np.array([r["x"] for r in rows.collect() if r["x"] is not None])
    for q in (0.0, 0.013, 0.5, 0.98, 1.0):
        assert exact_quantile(rows, "x", q, few).first()[0] == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert exact_quantile(rows.where("x is null"), "x", 0.5).count() == 0


def test_quantile_between_two_values_that_most_rows_have(spark, monkeypatch):
    monkeypatch.setattr("tickloom.operators.numbering._SKETCH", 10)
    rows = spark.range(3000).selectExpr("double(case when id < 1400 then 1 when id < 1600 then 2 + id / 1000.0 else 9 end) x")
    values = np.array([r["x"] for r in rows.collect()])
    for rank in (0, 1399, 1399.5, 1400, 1477.25, 1599, 1599.5, 1600, 2999):
        assert exact_quantile(rows, "x", rank / 2999, 5).first()[0] == pytest.approx(np.quantile(values, rank / 2999))

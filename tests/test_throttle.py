import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tickloom.operators import asof
from tickloom.operators import throttle as module
from tickloom.operators.throttle import entry_steps, passed, throttle


def walk(times, step, since=-(10**18)):
    out = []
    for t in times:
        if t >= since:
            out.append(t)
            since = t + step
    return out


@given(st.lists(st.integers(0, 300), min_size=1, max_size=80), st.integers(1, 60), st.integers(0, 60))
@settings(max_examples=300, deadline=None)
def test_step_function_equals_walk(times, step, wait):
    """Entered anywhere up to one interval past its first tick, a run ends as the walk ends."""
    times = np.array(sorted(times))
    since = int(times[0]) + min(wait, step)
    limit, final = entry_steps(times, step)
    hit = np.searchsorted(limit, since, side="left")
    want = walk(times.tolist(), step, since)
    if want:
        assert final[hit] == want[-1]
    else:
        assert hit == len(limit) or since > times[-1]


@given(st.lists(st.integers(0, 300), max_size=80), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_passed_equals_walk(times, step):
    times = np.array(sorted(times), dtype=np.int64)
    places, _ = passed(times, -1, step)
    assert times[places].tolist() == walk(times.tolist(), step)


def _reference(rows, seconds):
    last, keep = {}, set()
    for ident, t, symbol, *_ in sorted(rows, key=lambda r: (str(r[2]), r[1], r[0])):
        if symbol not in last or t >= last[symbol] + seconds:
            keep.add(ident)
            last[symbol] = t
    return keep


@pytest.mark.parametrize("few", [0, 1 << 16])
@pytest.mark.parametrize("partitions, seconds", [(1, 13), (5, 1), (5, 100000), (40, 13), (40, 200)])
def test_equals_sequential_walk(spark, monkeypatch, partitions, seconds, few):
    """One symbol has most of the rows and spans many partitions; many ticks share a second."""
    monkeypatch.setattr(module, "FEW_ENTRIES", few)
    rng = np.random.default_rng(partitions * 1000 + seconds)
    rows = []
    for i in range(3000):
        symbol = "HOT" if rng.random() < 0.7 else f"S{rng.integers(30)}"
        rows.append((i, int(rng.integers(0, 900)), symbol, 1.0, 1.0))
    df = spark.createDataFrame(rows, "id bigint, s int, symbol string, price double, volume double")
    df = df.selectExpr("id", "timestamp_seconds(s) event_time", "symbol", "price", "volume")
    got = throttle(df, seconds, partitions=partitions)
    assert got.columns == df.columns
    assert {r["id"] for r in got.collect()} == _reference(rows, seconds)


def test_more_partitions_than_rows_and_no_rows(spark, make_trades):
    trades = make_trades([(1, "2026-01-01", "A", 1.0, 1.0), (2, "2026-01-01 00:00:01", "A", 1.0, 1.0)])
    assert {r["id"] for r in throttle(trades, 1, partitions=20).collect()} == {1, 2}
    assert {r["id"] for r in throttle(trades, 2, partitions=20).collect()} == {1}
    assert throttle(trades.where("id > 5"), 2).count() == 0


def test_interval_must_be_positive(make_trades):
    with pytest.raises(ValueError):
        throttle(make_trades([]), 0)


def test_a_long_interval_leaves_no_task_with_all_rows(spark, monkeypatch):
    """The interval is far longer than the time that a partition spans, so nearly every tick is an entry."""
    held = []

    def counted(df):
        out = cut(df)
        rows = out.groupBy(F.spark_partition_id()).count().collect()
        held.append(([r["count"] for r in rows], df.columns))
        return out

    cut = module.cut_lineage
    monkeypatch.setattr(module, "FEW_ENTRIES", 0)
    monkeypatch.setattr(module, "cut_lineage", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rows = spark.range(6000).selectExpr("id", "timestamp_seconds(id * 3 + id % 2) event_time", "'HOT' symbol", "1d price", "1d volume")
        got = throttle(rows, 2000, partitions=32)
        times = sorted(r[0] for r in got.select(F.unix_seconds("event_time")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert times == walk([i * 3 + i % 2 for i in range(6000)], 2000)
    large = [sizes for sizes, _ in held if sum(sizes) > 1000]
    assert large and max(max(sizes) for sizes in large) < 600


ASOF = "id bigint, k string, t bigint"


@pytest.mark.parametrize("forward, partitions", [(False, 1), (False, 7), (True, 7), (True, 40)])
def test_asof_join_against_brute_force(spark, forward, partitions):
    rng = np.random.default_rng(partitions)
    left = [(i, None if i % 50 == 0 else "HOT" if i % 3 else f"k{i % 9}", None if i % 41 == 0 else int(rng.integers(0, 400))) for i in range(900)]
    right = sorted({(None if i % 30 == 0 else "HOT" if i % 2 else f"k{i % 11}", int(rng.integers(0, 400))) for i in range(200)}, key=repr)
    table = spark.createDataFrame([(*r, f"{r[0]} at {r[1]}") for r in right], "name string, since bigint, note string")
    got = asof.asof_join(spark.createDataFrame(left, ASOF), table.withColumnRenamed("name", "k"), ["k"], "t", "since", ["since", "note"], ["id"], forward, partitions)
    want = []
    for i, k, t in left:
        fits = [s for name, s in right if t is not None and name == k and (s >= t if forward else s <= t)]
        best = (min if forward else max)(fits, default=None)
        want.append((i, k, t, best, None if best is None else f"{k} at {best}"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_asof_join_of_nothing_and_of_clashing_names(spark):
    left, none = spark.createDataFrame([(1, "a", 5)], ASOF), spark.createDataFrame([], "k string, at bigint, x double")
    assert [tuple(r) for r in asof.asof_join(left, none, ["k"], "t", "at", ["x"], ["id"]).collect()] == [(1, "a", 5, None)]
    assert asof.asof_join(left.limit(0), none, ["k"], "t", "at", ["x"], ["id"]).count() == 0
    with pytest.raises(ValueError):
        asof.asof_join(left, none.withColumnRenamed("x", "t2").withColumnRenamed("at", "t"), ["k"], "t", "t", ["t"], ["id"])

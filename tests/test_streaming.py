import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators import cleaning, keyfilter, throttle as batch
from tickloom.operators.scoring import count_from_ledger, gate
from tickloom.plans import marts
from tickloom.sources import spans, tables
from tickloom.sources.streams import read_file_stream
from tickloom.streaming import closing, dimension, ingest, levels, retry, rollup, slices, stateful

BTC, ETH, BNB, SOL = schema.DEFAULT_SYMBOLS
AS_OF = "2026-03-27 00:00:00"
NOW = {"availableNow": True}
DDL = "id bigint, event_time timestamp, symbol string, price double, volume double"


@pytest.fixture(scope="module")
def trades(spark):
    """Two days of ticks in time order, most of them of one symbol."""
    return spark.range(600).selectExpr(
        "id", "timestamp_seconds(1774396800 + id * 240) as event_time",
        f"case when id % 5 < 3 then '{BTC}' when id % 5 = 3 then '{ETH}' else 'BINANCE:DOGEUSDT' end as symbol",
        "cast(1 + id % 17 as double) as price", "cast(id % 7 as double) as volume",
    ).cache()


@pytest.fixture
def inbox(trades, tmp_path):
    """A folder with the trades in four files, in time order."""
    path = str(tmp_path / "inbox")
    for n in range(4):
        trades.where(F.col("id").between(n * 150, n * 150 + 149)).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, inbox, files=1):
    return read_file_stream(spark, inbox, DDL, max_files=files)


def _messages(rows):
    body = F.to_json(F.struct(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("time"), "symbol", "price", "volume"))
    return rows.select("id", F.when(F.col("id") % 100 == 7, "oops").otherwise(body).cast("binary").alias("value"))


def _batches(query):
    return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]


def test_ingest_to_table_in_several_batches(spark, inbox, trades, tmp_path):
    rows = cleaning.accepted(ingest.trade_stream(_messages(_stream(spark, inbox)), as_of=AS_OF)).drop("value")
    query = ingest.append_table(rows, "ingest_table", str(tmp_path / "cp"), str(tmp_path / "t"), **NOW)
    query.awaitTermination()
    assert len(_batches(query)) == 4
    want = trades.where(f"symbol in ('{BTC}', '{ETH}') and volume > 0 and id % 100 != 7")
    got = spark.table("ingest_table")
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert set(got.columns) == {"id", "event_time", "symbol", "price", "volume", "year", "month", "day"}
    assert os.path.isdir(tmp_path / "t" / "year=2026" / "month=3" / "day=25")


def test_file_sinks(spark, inbox, tmp_path):
    rows = cleaning.add_day_columns(_stream(spark, inbox, 4))
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        ingest.append_files(rows, path, path + "_cp", fmt=fmt, **NOW).awaitTermination()
        assert spark.read.schema(rows.schema).format(fmt).load(path).count() == 600


def test_a_timed_trigger_goes_on_until_stopped(spark, inbox, trades, tmp_path):
    rows = cleaning.add_day_columns(_stream(spark, inbox))
    query = ingest.append_files(rows, str(tmp_path / "t"), str(tmp_path / "cp"), processingTime="1 second")
    try:
        query.processAllAvailable()
        trades.where("id < 7").coalesce(1).write.mode("append").parquet(inbox)
        query.processAllAvailable()
        assert query.isActive and query.exception() is None
    finally:
        query.stop()
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "t")).count() == 607


def _run_fan_out(spark, inbox, root, checkpoint, **kw):
    query = ingest.fan_out(
        _messages(_stream(spark, inbox)), root, checkpoint, {BTC: "Bitcoin"}, keep=["id"],
        limits={"as_of": AS_OF}, trigger=NOW, **kw,
    )
    query.awaitTermination()
    return query


REJECTS_DDL = "id bigint, value string, reject_reason string"


def _ids(rows):
    return sorted(r["id"] for r in rows.select("id").collect())


def test_fan_out_keeps_every_row_and_replays_without_copies(spark, inbox, tmp_path):
    root = str(tmp_path / "out")
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp"))
    silver = slices.read_slices(spark, f"{root}/silver", "id bigint, " + ingest.SILVER_DDL)
    rejects = slices.read_slices(spark, f"{root}/rejects", REJECTS_DDL)
    ids = _ids(silver)
    assert sorted(ids + _ids(rejects)) == list(range(600))
    assert {r["reject_reason"] for r in rejects.select("reject_reason").distinct().collect()} == {
        "malformed_json", "not_in_whitelist", "invalid_values"
    }
    names = {r["symbol"]: r["asset_name"] for r in silver.select("symbol", "asset_name").distinct().collect()}
    assert names == {BTC: "Bitcoin", ETH: ETH}
    ledger = ingest.read_ledger(spark, root)
    totals = {r["sink"]: r["n"] for r in ledger.groupBy("sink").agg(F.sum("rows").alias("n")).collect()}
    assert totals == {"silver": len(ids), "rejects": 600 - len(ids), "lake": len(ids)}
    # A stream that lost its checkpoint delivers the same batches once more.
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp_lost"))
    assert _ids(slices.read_slices(spark, f"{root}/silver", "id bigint, " + ingest.SILVER_DDL)) == ids
    assert _ids(ingest.read_silver(spark, root, "id bigint")) == ids
    markers = spark.createDataFrame([("m", 100)], "model string, row_count bigint")
    row = gate(count_from_ledger(ingest.read_ledger(spark, root)), markers, "m", len(ids) - 100).first()
    assert row["should_train"] and row["new_rows"] == len(ids) - 100


def test_failure_of_the_second_sink_is_recorded_and_of_the_first_is_raised(spark, inbox, tmp_path):
    (tmp_path / "blocked").write_text("a file where a folder should be")
    root = str(tmp_path / "out")
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp"), lake_path=str(tmp_path / "blocked"))
    ledger = ingest.read_ledger(spark, root)
    assert {(r["sink"], r["status"]) for r in ledger.collect()} == {("silver", "ok"), ("rejects", "ok"), ("lake", "failed")}
    assert all(r["error"] for r in ledger.where("sink = 'lake'").collect())
    with pytest.raises(Exception):
        _run_fan_out(spark, inbox, str(tmp_path / "blocked"), str(tmp_path / "cp2"))


def test_compaction(spark, inbox, tmp_path):
    root = str(tmp_path / "out")
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp"))
    before = ingest.read_silver(spark, root, "id bigint")
    files, ids = len(before.inputFiles()), _ids(before)
    last = ingest.compact_silver(spark, root, "id bigint")
    assert last == before.agg(F.max("batch_id")).first()[0] - 1 and ingest.compact_silver(spark, root, "id bigint") == last
    after = ingest.read_silver(spark, root, "id bigint")
    assert _ids(after) == ids
    assert len(spark.read.parquet(f"{root}/compacted/step={last}").inputFiles()) < files / 2
    # A slice without an entry in the ledger is still being written.
    slices.write_slice(before.drop("batch_id").limit(5), f"{root}/silver", 99, partition_by=ingest.DAYS)
    assert _ids(ingest.read_silver(spark, root, "id bigint")) == ids and ingest.compact_silver(spark, root, "id bigint") == last
    tables.compact(before, f"{root}/one_day", "2026-03-25", "2026-03-25")
    one = spark.read.parquet(f"{root}/one_day")
    assert {r["day"] for r in one.select("day").distinct().collect()} == {25}


def _size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_compaction_rewrites_new_rows_and_their_days_only(spark, tmp_path):
    """Ten days arrive one by one, then trickles to the first day: what is written follows what is new."""
    root, n = str(tmp_path / "runs"), {}
    all_rows = spark.range(0).selectExpr("id", "0 year", "0 month", "0 day")
    day = lambda k, rows, first: spark.range(first, first + rows).selectExpr("id", "2026 year", "3 month", f"{k} day")
    steps = [day(k, 400, k * 1000) for k in range(1, 11)] + [day(1, 10, 20_000 + 10 * k) for k in range(12)]
    for step, fresh in enumerate(steps):
        n[step] = levels.add(fresh, root, step, ingest.DAYS)
        all_rows = all_rows.unionByName(fresh)
        upto, got = levels.read(spark, root, fresh.schema, ingest.DAYS)
        assert upto == step and got.count() == all_rows.count() and _ids(got) == _ids(all_rows)
    assert [n[k] for k in range(10)] == [400] * 10
    # A trickle never takes up the 400 rows of its day, and each of its rows is written a few times.
    assert max(n[k] for k in range(10, 22)) <= 130 and sum(n[k] for k in range(10, 22)) < 12 * 60
    manifest = levels.runs(spark, root, 21, ingest.DAYS)
    assert sum(r["rows"] for r in manifest) == 4120 and len([r for r in manifest if r["day"] == 1]) <= 4
    # Day 2 is where its own step has put it; steps whose runs were merged away are gone.
    assert os.path.exists(f"{root}/step=1/year=2026/month=3/day=2")
    used = {r["step"] for upto in (20, 21) for r in levels.runs(spark, root, upto, ingest.DAYS)}
    assert {int(d.removeprefix("step=")) for d in os.listdir(root) if d.startswith("step=")} == used
    assert sorted(d for d in os.listdir(f"{root}/manifest") if d.startswith("upto=")) == ["upto=20", "upto=21"]


def test_compaction_survives_a_failed_step_and_keeps_disk_constant(spark, inbox, tmp_path):
    root = str(tmp_path / "out")
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp"))
    ids = _ids(ingest.read_silver(spark, root, "id bigint"))
    ledger = ingest.read_ledger(spark, root)
    # A step that wrote its runs and died before the manifest: what it wrote does not count, and is replaced.
    spark.range(5).selectExpr("id", "2026 year", "3 month", "1 day").write.partitionBy(*ingest.DAYS).parquet(f"{root}/compacted/step=2")
    assert _ids(ingest.read_silver(spark, root, "id bigint")) == ids
    last = ingest.compact_silver(spark, root, "id bigint")
    assert _ids(ingest.read_silver(spark, root, "id bigint")) == ids
    sizes = []
    for n in range(4):  # the same batch again and again under new numbers
        batch = spark.read.schema("id bigint, " + ingest.SILVER_DDL).parquet(f"{root}/silver/batch_id={last + 1}") if n == 0 else batch
        batch = batch.cache()
        slices.write_slice(batch, f"{root}/silver", last + 2 + n, partition_by=ingest.DAYS)
        rows = [(r["sink"], r["status"], r["rows"], r["error"]) for r in ledger.where(F.col("batch_id") == last + 1).collect()]
        slices.write_slice(schema.local_table(spark, rows, ingest.LEDGER_DDL), f"{root}/ledger", last + 2 + n)
        assert ingest.compact_silver(spark, root, "id bigint") == last + 1 + n
        sizes.append((_size(f"{root}/silver"), _size(f"{root}/compacted")))
    rows = ingest.read_silver(spark, root, "id bigint")
    assert rows.count() == len(ids) + 4 * batch.count()
    assert sorted(int(d.removeprefix("batch_id=")) for d in os.listdir(f"{root}/silver") if d.startswith("batch_id=")) == [last + 4, last + 5]
    assert max(c for _, c in sizes) < 3 * _size(f"{root}/silver") + 2 * sizes[0][1]


def _folders(rows):
    return {"/".join(f.split("/")[-5:-1]) for f in rows.inputFiles()}


def test_last_hour_reads_the_slices_of_that_hour(spark, trades, tmp_path):
    """Four batches processed an hour apart; two are compacted. Event days say nothing about it."""
    root = str(tmp_path / "out")
    rows = cleaning.add_day_columns(trades.where(f"symbol = '{BTC}'"))
    at = lambda n: F.lit(f"2026-05-01 {10 + n}:15:00").cast("timestamp")
    for n in range(4):
        part = rows.where(F.col("id") % 4 == n).withColumns({"asset_name": F.lit("Bitcoin"), "processed_at": at(n)})
        slices.write_slice(part.select("id", *[c.split()[0] for c in ingest.SILVER_DDL.split(", ")]), f"{root}/silver", n, partition_by=ingest.DAYS)
        slices.write_slice(spans.measured(part, "processed_at").select(*ingest.DAYS, "rows", "least", "greatest"), f"{root}/spans", n)
        slices.write_slice(schema.local_table(spark, [("silver", "ok", part.count(), "")], ingest.LEDGER_DDL), f"{root}/ledger", n)
        if n == 2:
            assert ingest.compact_silver(spark, root, "id bigint") == 1
    want = {n: _ids(rows.where(F.col("id") % 4 == n)) for n in range(4)}
    for n in range(4):
        got = ingest.read_recent(spark, root, f"2026-05-01 {10 + n}:30:00", 1800, "id bigint")
        assert _ids(got) == want[n]
        assert {f.split("/")[0] for f in _folders(got)} == ({"step=1"} if n < 2 else {f"batch_id={n}"})
    both = ingest.read_recent(spark, root, "2026-05-01 13:15:00", 7200, "id bigint")
    assert _ids(both) == sorted(want[1] + want[2] + want[3])
    none = ingest.read_recent(spark, root, "2026-05-02 13:15:00", 3600, "id bigint")
    assert none.count() == 0 and not none.inputFiles()


def test_spans_choose_days(spark, trades, tmp_path):
    path = str(tmp_path / "t")
    rows = cleaning.add_day_columns(trades.withColumn("processed_at", F.expr("event_time + interval 45 days")))
    for half in ("id < 300", "id >= 300"):
        spans.append(rows.where(half), path, "processed_at")
    got = spans.read_between(spark, path, rows.schema, "processed_at", "2026-05-10 01:00:00", "2026-05-10 02:00:00")
    want = rows.where("processed_at between timestamp '2026-05-10 01:00:00' and timestamp '2026-05-10 02:00:00'")
    assert _ids(got) == _ids(want) and len(_ids(got)) == 16
    assert {f.split("/")[-1] for f in _folders(got)} == {"day=26"}
    assert spark.read.schema(rows.schema).parquet(path).count() == 600
    assert spans.read_between(spark, path, rows.schema, "processed_at", "2027-01-01", "2027-01-02").count() == 0


def test_repair_of_the_second_sink(spark, inbox, tmp_path):
    blocked, root = tmp_path / "lake", str(tmp_path / "out")
    blocked.write_text("a file where a folder should be")
    _run_fan_out(spark, inbox, root, str(tmp_path / "cp"), lake_path=str(blocked))
    blocked.unlink()
    failed = ingest.repair_lake(spark, root, str(blocked), "id bigint")
    assert failed and ingest.repair_lake(spark, root, str(blocked), "id bigint") == []
    lake = slices.read_slices(spark, str(blocked), "id bigint", "json")
    assert _ids(lake) == _ids(ingest.read_silver(spark, root, "id bigint"))
    assert {r["status"] for r in ingest.read_ledger(spark, root).collect()} == {"ok"}


def test_hourly_table_equals_batch(spark, inbox, trades, tmp_path):
    path, cp = str(tmp_path / "hours"), str(tmp_path / "cp")
    query = rollup.hourly_stream(_stream(spark, inbox), path, cp, **NOW)
    query.awaitTermination()
    assert len(_batches(query)) == 4
    dim = schema.dim_symbol(spark)
    got = marts.hourly_summary(rollup.read_hour_cube(spark, path), dim)
    want = marts.hourly_summary(marts.hour_cube(trades), dim)
    assert sorted(got.collect()) == sorted(want.collect())
    # Folded, the table goes on where it was.
    assert [rollup.fold_rollup(spark, path, rollup.CUBE_DDL) for _ in range(2)] == [2, 2]
    more = trades.where("id < 10").withColumn("event_time", F.expr("event_time + interval 2 days"))
    more.coalesce(1).write.mode("append").parquet(inbox)
    rollup.hourly_stream(_stream(spark, inbox), path, cp, **NOW).awaitTermination()
    want = marts.hourly_summary(marts.hour_cube(trades.unionByName(more)), dim)
    for fold in (None, 3):
        assert fold is None or rollup.fold_rollup(spark, path, rollup.CUBE_DDL) == fold
        got = marts.hourly_summary(rollup.read_hour_cube(spark, path), dim)
        assert sorted(got.collect()) == sorted(want.collect())
    assert not os.path.exists(f"{path}/slices/batch_id=0") and os.path.exists(f"{path}/slices/batch_id=4")


def test_summaries_out_of_order_with_restart_and_replay(spark, trades, tmp_path):
    """Half a day arrives last; then the stream loses its checkpoint and delivers all once more."""
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "flow")
    want = sorted(rollup.bucketed(trades, "5 minutes", rollup.flow_measures()).select(*rollup.KEYS, "n").collect())
    for low, high in ((300, 449), (450, 599), (0, 299)):
        trades.where(F.col("id").between(low, high)).coalesce(1).write.mode("append").parquet(inbox)
        rollup.five_minute_stream(_stream(spark, inbox), path, str(tmp_path / "cp"), **NOW).awaitTermination()
    assert sorted(rollup.read_rollup(spark, path).select(*rollup.KEYS, "n").collect()) == want
    rollup.five_minute_stream(_stream(spark, inbox), path, str(tmp_path / "lost"), **NOW).awaitTermination()
    assert sorted(rollup.read_rollup(spark, path).select(*rollup.KEYS, "n").collect()) == want


def test_five_minute_table_equals_batch(spark, inbox, trades, tmp_path):
    path, cp = str(tmp_path / "flow"), str(tmp_path / "cp")
    rollup.five_minute_stream(_stream(spark, inbox), path, cp, **NOW).awaitTermination()
    flow = rollup.read_rollup(spark, path)
    want = rollup.bucketed(trades, "5 minutes", rollup.flow_measures())
    assert sorted(rollup.vwap(flow).collect()) == sorted(rollup.vwap(want).collect())
    assert sorted(rollup.density(flow).collect()) == sorted(rollup.density(want).collect())


def test_deduplication_across_batches(spark, trades, tmp_path):
    """Every trade comes twice, the copy in the next file."""
    inbox = str(tmp_path / "inbox")
    for n in range(5):
        trades.where(F.col("id").between((n - 1) * 150, n * 150 + 149)).coalesce(1).write.mode("append").parquet(inbox)
    out = str(tmp_path / "out")
    for cp in ("cp", "cp_lost"):  # and once more after the checkpoint is lost
        stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / cp), **NOW).awaitTermination()
        assert _ids(stateful.read_deduplicated(spark, out, trades)) == list(range(600))


def test_deduplication_reads_only_slices_that_may_hold_its_keys(spark, trades, tmp_path, monkeypatch):
    """Ten batches of one day; then new rows only, and then copies of the third batch among new ones."""
    inbox, out, read = str(tmp_path / "inbox"), str(tmp_path / "out"), []

    def noted(*args):
        stored = chosen(*args)
        read.append((0, 0) if stored is None else (len(stored.select("batch_id").distinct().collect()), stored.count()))
        return stored

    chosen = stateful.seen_slices
    monkeypatch.setattr(stateful, "seen_slices", noted)
    rows = spark.range(2400).selectExpr(
        "id", "timestamp_seconds(1774396800 + (id div 200) * 7 + (id % 200) * 400) event_time", f"'{BTC}' symbol", "1d price", "1d volume")
    for n in range(10):
        rows.where(f"id div 200 = {n}").coalesce(1).write.mode("append").parquet(inbox)
    stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / "cp"), **NOW).awaitTermination()
    assert read == [(0, 0)] * 9
    for more in ("id div 200 = 10", "id div 200 = 11 or id between 400 and 402"):
        rows.where(more).coalesce(1).write.mode("append").parquet(inbox)
        stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / "cp"), **NOW).awaitTermination()
    # Three copies, in the first hour of batch 2: nine rows are used of the 2,200 that are stored for the day, of one slice.
    assert read[9:] == [(0, 0), (1, 9)]
    assert _ids(stateful.read_deduplicated(spark, out, trades)) == list(range(2400))


def test_deduplication_counts_nulls_as_keys_and_refuses_other_keys(spark, trades, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    odd = spark.createDataFrame([(1, None, "A", 1.0, None), (2, None, "A", 1.0, None), (3, None, None, 1.0, None)],
                                "id bigint, event_time timestamp, symbol string, price double, volume double")
    for _ in range(2):
        odd.coalesce(1).write.mode("append").parquet(inbox)
        stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / "cp"), **NOW).awaitTermination()
    assert stateful.read_deduplicated(spark, out, trades).select("symbol").distinct().count() == 2
    assert stateful.read_deduplicated(spark, out, trades).count() == 2
    with pytest.raises(ValueError):
        stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / "cp2"), ["id"])


def test_key_filter_never_misses():
    rng = np.random.default_rng(5)
    hashes = rng.integers(-2**63, 2**63, 20_000)
    bits = keyfilter.made(hashes)
    assert keyfilter.may_hold(bits, hashes).all()
    assert keyfilter.may_hold(bits, rng.integers(-2**63, 2**63, 100_000)).mean() < 1e-3
    assert not keyfilter.may_hold(keyfilter.made(hashes[:0]), hashes).any()


def test_late_originals_are_kept(spark, trades, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    for part in ("id >= 300", "id < 300", "id % 7 = 0"):
        trades.where(part).coalesce(1).write.mode("append").parquet(inbox)
        stateful.dedup_batches(_stream(spark, inbox), out, str(tmp_path / "cp"), **NOW).awaitTermination()
    assert _ids(stateful.read_deduplicated(spark, out, trades)) == list(range(600))


@pytest.mark.parametrize("seconds", [700, 5000])
def test_throttle_stream_equals_batch_with_a_restart(spark, trades, tmp_path, seconds):
    inbox, out, cp = (str(tmp_path / n) for n in ("inbox", "out", "cp"))
    for lo, hi in ((0, 299), (300, 599)):
        for half in (lo, lo + 150):
            trades.where(F.col("id").between(half, min(half + 149, hi))).coalesce(1).write.mode("append").parquet(inbox)
        with stateful.rocksdb(spark):
            rows = stateful.throttle_stream(_stream(spark, inbox), seconds)
            query = ingest.append_files(rows, out, cp, partition_by=(), **NOW)
            query.awaitTermination()
        assert len(_batches(query)) == 2
    assert _ids(spark.read.parquet(out)) == _ids(batch.throttle(trades, seconds))


def test_throttle_stream_marks_late_ticks(spark, trades, tmp_path):
    inbox, out, cp = (str(tmp_path / n) for n in ("inbox", "out", "cp"))
    for lo, hi in ((300, 599), (0, 299)):
        trades.where(F.col("id").between(lo, hi)).coalesce(1).write.mode("append").parquet(inbox)
        with stateful.rocksdb(spark):
            rows = stateful.throttle_stream(_stream(spark, inbox), 5000, late="late")
            ingest.append_files(rows, out, cp, partition_by=(), **NOW).awaitTermination()
    got = spark.read.parquet(out)
    assert _ids(got.where("late")) == list(range(300))
    assert _ids(got.where("NOT late")) == _ids(batch.throttle(trades.where("id >= 300"), 5000))


@pytest.mark.parametrize("seconds", [0.5, 700])
def test_throttle_of_large_batches_with_restart_and_replay(spark, trades, tmp_path, seconds):
    inbox, out, cp = (str(tmp_path / n) for n in ("inbox", "out", "cp"))
    for n in range(4):
        trades.where(F.col("id").between(n * 150, n * 150 + 149)).coalesce(1).write.mode("append").parquet(inbox)
        if n % 2:
            stateful.throttle_batches(_stream(spark, inbox), out, cp, seconds, **NOW).awaitTermination()
    want = _ids(batch.throttle(trades, seconds))
    assert _ids(slices.read_slices(spark, f"{out}/passed", trades.schema)) == want
    stateful.throttle_batches(_stream(spark, inbox), out, cp + "_lost", seconds, **NOW).awaitTermination()
    assert _ids(slices.read_slices(spark, f"{out}/passed", trades.schema)) == want


def test_lateness(spark, trades, tmp_path):
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "late")
    for part in (trades.where("id between 300 and 449"), trades.where("id < 300"), trades.where("id >= 450")):
        part.coalesce(1).write.mode("append").parquet(inbox)
    query = stateful.lateness_stream(_stream(spark, inbox), path, str(tmp_path / "cp"), delay_seconds=240 * 160, **NOW)
    query.awaitTermination()
    rows = slices.read_slices(spark, path, stateful.LATENESS_DDL).orderBy("batch_id").collect()
    # The mark after the first file is 160 ticks before tick 449.
    assert [(r["rows"], r["late_rows"]) for r in rows] == [(150, 0), (300, 289), (150, 0)]
    assert rows[0]["watermark"] is None
    assert [r["rows_dropped"] for r in stateful.dropped_by_watermark(query).collect()][:3] == [0, 0, 0]


def test_table_life_cycle(spark, trades, tmp_path):
    path, cp = str(tmp_path / "t"), str(tmp_path / "cp")
    tables.ensure_table(spark, "life", path=path)
    tables.ensure_table(spark, "life", path=path)
    rows = cleaning.add_day_columns(cleaning.enrich(trades, {}, AS_OF))
    holes = rows.withColumn("price", F.when(F.col("id") >= 10, F.col("price")))
    bad = tables.insert_rows(holes, "life")
    assert _ids(bad) == list(range(10)) and _ids(spark.table("life")) == list(range(10, 600))
    os.makedirs(cp)
    tables.reset_table(spark, "life", path, cp)
    assert not spark.catalog.tableExists("life") and not os.path.exists(path) and not os.path.exists(cp)
    with pytest.raises(Exception):
        tables.reset_table(spark, "life", "/")


def test_a_hot_day_is_split_on_write(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 8).selectExpr(
        "uuid() symbol", "timestamp_seconds(1774396800 + if(id % 3 > 0, id % 86400, id * 9)) event_time"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.by_day(cleaning.add_day_columns(rows)).write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(tmp_path / "t" / "year=2026" / "month=3" / "day=25") if f.endswith(".parquet")]
    assert len(hot) > 2


def test_shared_folder_is_the_one_the_session_names(spark):
    assert tables.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_messages_survive_the_ledger_of_a_bad_batch(spark, tmp_path):
    """A batch of nothing but broken messages is a batch with rejects only."""
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "out")
    bad = [(i, json.dumps({"n": i})) for i in range(5)]
    spark.createDataFrame(bad, "id bigint, value string").write.parquet(inbox)
    stream = read_file_stream(spark, inbox, "id bigint, value string")
    ingest.fan_out(stream, root, str(tmp_path / "cp"), {}, keep=["id"], trigger=NOW).awaitTermination()
    assert slices.read_slices(spark, f"{root}/rejects", REJECTS_DDL).count() == 5
    ledger = {r["sink"]: r["rows"] for r in ingest.read_ledger(spark, root).collect()}
    assert ledger == {"silver": 0, "rejects": 5, "lake": 0}


def test_a_version_binds_from_its_time_and_late_ones_are_caught_up_with(spark, trades, inbox, tmp_path):
    path, versions = str(tmp_path / "bound"), str(tmp_path / "versions")
    made = lambda rows: spark.createDataFrame(rows, "symbol string, t string, symbol_key int, asset_name string").selectExpr(
        "symbol", "cast(t as timestamp) valid_from", "symbol_key", "asset_name")
    made([(BTC, "2026-03-25 06:00:00", 1, "Bitcoin"), (ETH, "2020-01-01", 2, "Ether")]).write.parquet(versions)
    dimension.bind_stream(_stream(spark, inbox), versions, path, str(tmp_path / "cp"), **NOW).awaitTermination()
    fields = dimension.bound_fields(trades.schema)
    bound = spark.read.schema(fields).parquet(path)
    early = "event_time < timestamp '2026-03-25 06:00:00'"
    assert bound.where(f"symbol = '{BTC}' and {early} and asset_name is not null").count() == 0
    assert bound.where(f"symbol = '{BTC}' and not ({early}) and asset_name = 'Bitcoin'").count() == trades.where(f"symbol = '{BTC}' and not ({early})").count()
    assert bound.where("symbol like '%DOGE%' and symbol_key is null").count() == trades.where("symbol like '%DOGE%'").count() and bound.count() == 600
    late = made([(ETH, "2026-03-26 05:00:00", 2, "Ether 2")])
    late.write.mode("append").parquet(versions)
    found = dimension.rebind(spark, path, trades.schema, spark.read.schema(dimension.VERSIONS_DDL).parquet(versions), late)
    assert found == [2, 3]
    names = {(r["asset_name"], r["new"]) for r in spark.read.schema(fields).parquet(path).where(f"symbol = '{ETH}'").selectExpr(
        "asset_name", "event_time >= timestamp '2026-03-26 05:00:00' as new").distinct().collect()}
    assert names == {("Ether", False), ("Ether 2", True)} and spark.read.schema(fields).parquet(path).count() == 600


def test_refused_messages_come_again_and_are_given_up(spark, trades, tmp_path):
    """Every attempt of a message is one row; a message is sent when it is due, and not again."""
    inbox, path, cp = str(tmp_path / "inbox"), str(tmp_path / "out"), str(tmp_path / "cp")
    send = lambda rows: rows.withColumn("error", F.when((F.col("id") % 4 >= F.col("attempt")) | (F.col("id") % 10 == 0), "no"))
    for n in range(6):
        trades.where(F.col("id").between(n * 100, n * 100 + 99)).coalesce(1).write.mode("append").parquet(inbox)
    retry.forward_stream(_stream(spark, inbox), send, path, cp, **NOW).awaitTermination()
    stored = retry._stored(spark, path, trades.schema)
    first = {r["batch_id"]: r["n"] for r in stored.where("id < 100").groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    # Attempts 1, 2 and 3 in batches 0, 2 and 6: the third is not due yet.
    assert first == {0: 100, 2: 100 - len([i for i in range(100) if i % 4 == 0 and i % 10])}
    assert retry.outcomes(spark, path, trades.schema).where("status = 'waiting'").count() > 0
    assert retry.drain(spark, send, path, trades.schema) == 2 and retry.drain(spark, send, path, trades.schema) == 0
    got = {r["id"]: (r["status"], r["attempt"]) for r in retry.outcomes(spark, path, trades.schema).collect()}
    want = {i: ("dead", 3) if i % 10 == 0 or i % 4 == 3 else ("delivered", i % 4 + 1) for i in range(600)}
    assert got == want
    assert retry._stored(spark, path, trades.schema).groupBy("id", "attempt").count().where("count > 1").count() == 0
    # The stream goes on; what was drained is not sent again.
    trades.where("id < 5").withColumn("id", F.col("id") + 1000).coalesce(1).write.mode("append").parquet(inbox)
    retry.forward_stream(_stream(spark, inbox), send, path, cp, **NOW).awaitTermination()
    assert retry._stored(spark, path, trades.schema).groupBy("id", "attempt").count().where("count > 1").count() == 0


def test_windows_close_once_behind_the_slowest_partition_and_are_corrected(spark, trades, tmp_path):
    inbox, path, cp = str(tmp_path / "inbox"), str(tmp_path / "w"), str(tmp_path / "cp")
    ddl = DDL + ", source int"
    rows = trades.where(f"symbol = '{BTC}'").withColumn("source", (F.col("id") % 2).cast("int"))

    def deliver(part):
        rows.where(part).coalesce(1).write.mode("append").parquet(inbox)
        stream = read_file_stream(spark, inbox, ddl, max_files=1)
        closing.closing_stream(stream, path, cp, "source", delay_seconds=0, expected=2, **NOW).awaitTermination()
        return {(r["bucket_start"], r["kind"], r["n"]) for r in closing.read_emitted(spark, path).where(f"batch_id = {len(done)}").collect()}

    done = []
    done.append(deliver("id < 300 and source = 0"))
    assert done[0] == set()  # the other partition was not seen
    done.append(deliver("id < 100 and source = 1"))  # it holds all windows from tick 98 on open
    done.append(deliver("id between 100 and 399 and source = 1"))
    done.append(deliver("id = 150 and source = 0"))  # late, for a window that is closed
    emitted = closing.read_emitted(spark, path)
    finals = emitted.where("kind = 'final'").groupBy("bucket_start", "symbol").count().where("count > 1")
    assert finals.count() == 0
    last = rows.where("id < 100 and source = 1").agg(F.max("event_time")).first()[0]
    assert done[1] and max(b for b, _, _ in done[1]).timestamp() + 300 <= last.timestamp()
    slow = rows.where("id < 300 and source = 0").agg(F.max("event_time")).first()[0]
    assert max(b for b, _, _ in done[2]).timestamp() + 300 <= slow.timestamp()
    assert [(k, n) for _, k, n in done[3]] == [("correction", 2)] or [k for _, k, _ in done[3]] == ["correction"]
    sent = rows.where("id < 300 and source = 0 or id < 400 and source = 1").unionByName(rows.where("id = 150"))
    want = {(r["bucket_start"], r["n"]) for r in rollup.bucketed(sent, "5 minutes", rollup.flow_measures()).collect()}
    got = {(r["bucket_start"], r["n"]) for r in closing.read_closed(spark, path).collect()}
    assert got <= want and len(got) == len([b for b, _ in want if b.timestamp() + 300 <= slow.timestamp()])

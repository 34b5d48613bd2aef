import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tickloom import schema
from tickloom.operators import cleaning
from tickloom.operators.candles import candles
from tickloom.operators.scoring import count_from_footers, footer_count, gate, retrain_gate
from tickloom.operators.series import minute_prices
from tickloom.plans import marts, realtime, star, views
from tickloom.sources import tables

BTC, ETH, BNB = schema.DEFAULT_SYMBOLS[:3]
NAMES = {r[1]: r[5] for r in schema.DIM_SYMBOL_SEED}


@pytest.fixture(scope="module")
def trades(spark):
    rows = [
        (1, "2026-03-25 16:00:00", BTC, 100.0, 1.0),
        (2, "2026-03-25 16:59:59", BTC, 110.0, 2.0),
        (3, "2026-03-25 17:00:00", BTC, 90.0, 3.0),
        (4, "2026-03-26 01:02:03", BTC, 95.0, 1.0),
        (5, "2026-03-26 01:02:03", BTC, 96.0, 1.0),
        (6, "2026-03-28 13:00:00", ETH, 10.0, 0.5),
        (7, "2026-03-28 13:00:00", "BINANCE:DOGEUSDT", 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, t string, symbol string, price double, volume double")
    return df.selectExpr("id", "cast(t as timestamp) event_time", "symbol", "price", "volume")


@pytest.fixture(scope="module")
def stored(spark, trades, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "trades")
    from tickloom.operators.cleaning import add_day_columns

    add_day_columns(trades.withColumn("processed_at", F.col("event_time"))).write.partitionBy("year", "month", "day").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dims(spark):
    return schema.dim_symbol(spark), schema.dim_exchange(spark)


def test_dimensions(trades):
    days = {r["date_key"]: r for r in star.dim_date_ext(trades).collect()}
    assert sorted(days) == [20260325, 20260326, 20260328]
    saturday = days[20260328]
    assert (saturday["day_name"], saturday["day_of_week"], saturday["is_weekend"]) == ("Saturday", 7, True)
    assert (saturday["quarter"], saturday["month_name"], saturday["week_of_year"]) == (1, "March", 13)
    times = {r["time_key"]: r for r in star.dim_time_ext(trades).collect()}
    assert len(times) == 5
    assert (times[10203]["hour"], times[10203]["minute"], times[10203]["second"]) == (1, 2, 3)
    assert (times[10203]["period"], times[10203]["trading_session"]) == ("Night", "Asia")
    assert times[165959]["trading_session"] == "US"


def test_fact_drops_unknown_symbols_and_finds_the_exchange(spark, trades, dims):
    rows = {r["trade_id"]: r for r in star.fact_trades(trades, *dims).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert (rows[2]["date_key"], rows[2]["time_key"], rows[2]["trade_value"]) == (20260325, 165959, 220.0)
    assert {r["exchange_key"] for r in rows.values()} == {1}
    no_exchange = schema.dim_exchange(spark).where("false")
    assert {r["exchange_key"] for r in star.fact_trades(trades, dims[0], no_exchange).collect()} == {None}


def test_numbered_fact(trades, dims):
    got = {r["source_id"]: r["trade_id"] for r in star.numbered_fact(trades, *dims).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}


def test_summaries_roll_up(trades, dims):
    cube = marts.hour_cube(trades)
    hours = marts.hourly_summary(cube, dims[0]).collect()
    days = {(r["date_key"], r["asset_name"]): r for r in marts.daily_summary(cube, dims[0]).collect()}
    assert len(hours) == 4
    for key, day in days.items():
        own = [h for h in hours if (h["date_key"], h["asset_name"]) == key]
        assert sum(h["total_trades_count"] for h in own) == day["total_trades_count"]
        assert sum(h["total_hourly_value_usd"] for h in own) == pytest.approx(day["total_daily_value_usd"])
        assert max(h["high_price"] for h in own) == day["high_price"]
    assert days[20260325, "Bitcoin"]["price_volatility_pct"] == 22.22


def test_volatility_of_a_zero_low(make_trades, dims):
    rows = make_trades([(1, "2026-03-25", BTC, 0.0, 1.0), (2, "2026-03-25", BTC, 5.0, 1.0)])
    assert marts.daily_summary(marts.hour_cube(rows), dims[0]).first()["price_volatility_pct"] is None


def test_latest_price_keeps_ties(trades, dims):
    got = sorted((r["asset_name"], r["latest_price"]) for r in marts.latest_price(trades, dims[0]).collect())
    assert got == [("Bitcoin", 95.0), ("Bitcoin", 96.0), ("Ethereum", 10.0)]


def test_reports(trades, dims):
    cube = marts.hour_cube(trades)
    share = {r["asset_name"]: r for r in marts.asset_share(cube, dims[0]).collect()}
    assert (share["Bitcoin"]["trade_count"], share["Bitcoin"]["market_cap_tier"]) == (5, "Large-cap")
    heat = [(r["day_name"], r["hour"], r["trade_count"]) for r in marts.heatmap(cube, dims[0]).collect()]
    assert heat == [("Saturday", 13, 1), ("Thursday", 1, 2), ("Wednesday", 16, 2), ("Wednesday", 17, 1)]
    assert [r["id"] for r in marts.whales(trades, *dims, k=2).collect()] == [3, 2]
    assert [r["trade_id"] for r in marts.trade_listing(trades, *dims).collect()] == [6, 5, 4, 3, 2, 1]
    sample = marts.star_sample(trades, *dims, k=3).orderBy(F.desc("trade_id")).collect()
    assert [(r["trade_id"], r["price"]) for r in sample] == [(6, 10.0), (5, 96.0), (4, 95.0)]
    first = marts.top_volatility(cube, dims[0], k=1).collect()
    assert [(r["asset_name"], r["full_date"]) for r in first] == [("Bitcoin", dt.date(2026, 3, 25))]
    counts = {r["object_name"]: r["rows"] for r in marts.object_counts(trades, cube, *dims).collect()}
    assert counts == {
        "dim_exchange": 1, "dim_symbol": 4, "dim_date": 3, "dim_time": 5,
        "fact_trades": 6, "hourly_summary": 4, "daily_summary": 3,
    }


def test_counts_of_nothing(trades, dims):
    none = trades.where("false")
    counts = {r["object_name"]: r["rows"] for r in marts.object_counts(none, marts.hour_cube(none), *dims).collect()}
    assert counts["fact_trades"] == 0 and counts["daily_summary"] == 0


def test_candles(make_trades):
    rows = make_trades([
        (2, "2026-03-25 00:00:00", "A", 5.0, 1.0), (1, "2026-03-25 00:00:00", "A", 4.0, 1.0),
        (3, "2026-03-25 00:04:59", "A", 9.0, 1.0), (4, "2026-03-25 00:04:59", "A", 7.0, 1.0),
        (5, "2026-03-25 00:05:00", "A", 1.0, 1.0),
    ])
    a, b = candles(rows).orderBy("bucket_start").collect()
    assert (a["open"], a["high"], a["low"], a["close"], a["trades"]) == (4.0, 9.0, 4.0, 7.0, 4)
    assert (b["open"], b["close"]) == (1.0, 1.0)


def test_last_hour_is_one_hour(trades):
    as_of = "2026-03-25 17:00:00"
    got = realtime.money_flow(trades, NAMES, as_of, "event_time").collect()
    assert [(r["asset_name"], r["total_usd"]) for r in got] == [("Bitcoin", 100.0 + 220.0 + 270.0)]
    assert realtime.trade_count(trades, NAMES, "2026-03-25 18:00:01", "event_time").collect() == []
    today = realtime.whale_today(trades, NAMES, "2026-03-25 16:30:00", "event_time").collect()
    assert [r["largest_order_usd"] for r in today] == [100.0]


def test_sliding_equals_direct_windows(trades):
    got = realtime.sliding_flow(realtime.five_minute_flow(trades))
    direct = trades.groupBy(F.window("event_time", "1 hour", "5 minutes"), "symbol").agg(F.count("*").alias("n"))
    want = {(r["window"]["start"], r["symbol"]): r["n"] for r in direct.collect()}
    assert {(r["window_start"], r["symbol"]): r["trade_count"] for r in got.collect()} == want


# Plans


def test_dimensions_are_broadcast_and_trades_read_once(stored, dims):
    cube = marts.hour_cube(stored)
    for report in (marts.hourly_summary(cube, dims[0]), marts.heatmap(cube, dims[0]), star.fact_trades(stored, *dims)):
        plan = plan_of(report)
        assert "SortMergeJoin" not in plan and "Window" not in plan
        assert plan.count("Scan parquet") == 2  # once in the tree, once in the details


def test_partial_aggregation_before_the_shuffle(stored, dims):
    plan = plan_of(marts.hourly_summary(marts.hour_cube(stored), dims[0]))
    assert "partial_sum" in plan and "SortAggregate" not in plan


def test_top_k_is_not_a_global_sort(stored, dims):
    assert "TakeOrderedAndProject" in plan_of(marts.whales(stored, *dims))


def test_latest_price_has_no_window(stored, dims):
    plan = plan_of(marts.latest_price(stored, dims[0]))
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_time_range_prunes_partitions(stored):
    rows = tables.read_range(stored, "2026-03-25 00:00:00", "2026-03-26 00:00:00")
    assert "PartitionFilters: [isnotnull(year" in plan_of(rows)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    bound = {"max_past": schema.MAX_PAST_SECONDS}
    assert "PartitionFilters: [isnotnull(year" in plan_of(realtime.last_hour(stored, "2026-03-25 17:00:00", **bound))
    assert "PartitionFilters: [isnotnull(year" in plan_of(realtime.last_hour(stored, **bound))
    assert "PartitionFilters" not in plan_of(realtime.last_hour(stored, "2026-03-25 17:00:00"))
    assert len(tables.prune_days(stored, "2026-03-26", "2026-03-27").inputFiles()) > 0


def test_counting_a_table_reads_no_column(stored, spark):
    markers = spark.createDataFrame([], "model string, row_count bigint")
    assert "ReadSchema: struct<>" in plan_of(retrain_gate(stored, markers, "m"))


def test_count_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 4 day").repartition(3).write.partitionBy("day").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "PushedAggregation: [COUNT(*)]" in plan_of(footer_count(spark, path))
    assert count_from_footers(spark, path).first()[0] == 1000
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before and "PushedAggregation" not in plan_of(spark.read.parquet(path).agg({"*": "count"}))


def test_views(spark, stored, dims):
    views.register_star_views(stored, *dims)
    got = spark.sql(
        "SELECT ds.asset_name, COUNT(*) AS n FROM vw_fact_crypto_trades f "
        "JOIN vw_dim_date dd ON f.date_key = dd.date_key JOIN vw_dim_time dt ON f.time_key = dt.time_key "
        "JOIN dim_symbol ds ON f.symbol_key = ds.symbol_key JOIN dim_exchange de ON f.exchange_key = de.exchange_key "
        "GROUP BY ds.asset_name"
    ).collect()
    assert sorted((r[0], r[1]) for r in got) == [("Bitcoin", 5), ("Ethereum", 1)]
    assert spark.sql("SELECT SUM(total_trades_count) FROM vw_fact_hourly_summary").first()[0] == 6
    assert spark.sql("SELECT time, symbol, price, volume, year, month, day FROM crypto_trades LIMIT 3").count() == 3
    views.register_realtime_views(stored, NAMES, "2026-03-25 17:00:00")
    assert spark.sql("SELECT Tong_Tien_USD FROM vw_1_ti_trong_dong_tien_usd_1h").first()[0] == 590.0
    for name, columns in views.DASHBOARD_NAMES.items():
        assert spark.table(name).columns == list(columns)


def test_sample_counts_rows_without_an_exchange(spark, make_trades):
    """The newest of three rows has an exchange that is not listed: it has a number but is not shown."""
    rows = make_trades([(1, "2026-03-25 01:00:00", "BINANCE:BTCUSDT", 1.0, 1.0), (2, "2026-03-25 02:00:00", "BINANCE:BTCUSDT", 2.0, 1.0),
                        (3, "2026-03-25 03:00:00", "OTHER:BTCUSDT", 3.0, 1.0)])
    seeds = schema.dim_symbol(spark)
    other = seeds.where("symbol = 'BINANCE:BTCUSDT'").withColumn("symbol", F.lit("OTHER:BTCUSDT")).withColumn("symbol_key", F.lit(9))
    got = marts.star_sample(rows, seeds.unionByName(other), schema.dim_exchange(spark))
    assert sorted((r["trade_id"], r["price"]) for r in got.collect()) == [(1, 1.0), (2, 2.0)]


def test_gate_takes_the_newest_marker_and_notices_a_reset(spark):
    ddl = "model string, row_count bigint, trained_at timestamp"
    day = dt.datetime(2026, 3, 1)
    markers = spark.createDataFrame([("m", 1000, day), ("m", 100, day.replace(day=5)), ("x", 9, day.replace(day=9)), ("m", 7, None)], ddl)

    def judged(n):
        row = gate(spark.createDataFrame([(n,)], "row_count bigint"), markers, "m", 50).first()
        return row["rows_at_training"], row["new_rows"], row["should_train"]

    assert judged(500) == (100, 400, True)
    assert judged(120) == (100, 20, False)
    assert judged(60) == (0, 60, True)


def test_first_and_last_rows_are_hashed_not_sorted(spark, make_trades):
    rows = make_trades([(7, "2026-03-25 01:00:00", "A", 1.0, 1.0), (-3, "2026-03-25 01:00:00", "A", 2.0, 1.0),
                        (None, "2026-03-25 01:00:00", "A", 3.0, 1.0), (2**63 - 1, "2026-03-25 01:00:00", "A", 4.0, 1.0)])
    for df in (candles(rows, 3600), minute_prices(rows)):
        assert "SortAggregate" not in plan_of(df) and "HashAggregate" in plan_of(df)
    row = candles(rows, 3600).first()
    assert (row["open"], row["close"]) == (3.0, 4.0)
    text = rows.withColumn("id", F.col("id").cast("string"))
    assert candles(text, 3600).first()["close"] == 4.0  # "9..." is the greatest text


def test_lasting_views_show_later_rows(spark, trades, dims):
    spark.sql("CREATE DATABASE IF NOT EXISTS lasting")
    rows = cleaning.add_day_columns(cleaning.enrich(trades.withColumn("processed_at", F.col("event_time")), NAMES))
    try:
        assert tables.insert_rows(rows.where("id <= 3"), "lasting.ticks").count() == 0  # creates the table
        views.write_dimensions(*dims, "lasting")
        views.create_views(spark, "lasting", "ticks", "2026-03-25 17:00:00")
        for part in ("id <= 3", "id > 0"):
            if part == "id > 0":
                tables.insert_rows(rows.where("id > 3"), "lasting.ticks")
            seen = trades.where(part)
            for name, want in (("vw_fact_daily_summary", marts.daily_summary(marts.hour_cube(seen), dims[0])),
                               ("vw_fact_crypto_trades", star.fact_trades(seen, *dims)), ("vw_dim_time", star.dim_time(seen))):
                got = spark.table(f"lasting.{name}").select(*want.columns)
                assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
        assert len([t for t in spark.catalog.listTables("lasting") if t.name.startswith("vw_") and not t.isTemporary]) == 12
        for name, columns in views.DASHBOARD_NAMES.items():
            assert spark.table(f"lasting.{name}").columns == list(columns) and spark.table(f"lasting.{name}").count() >= 0
    finally:
        spark.sql("DROP DATABASE lasting CASCADE")

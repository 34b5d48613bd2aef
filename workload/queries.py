"""One function per operator: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import symbols
from tickloom.functions.numeric import round_half_up
from tickloom.operators import anomaly, candles as candle_ops, cleaning, mixed_clusters, numbering, scoring, series
from tickloom.operators.throttle import throttle as throttle_rows
from tickloom.plans import marts, realtime, star, views
from tickloom.sources import messages as shapes
from tickloom.sources import spans, tables
from tickloom.streaming import closing, dimension, ingest, retry, rollup, slices, stateful
from workload import fixtures as fx

NOW = {"availableNow": True}
CORE = ["id", "event_time", "symbol", "price", "volume"]


def _messages(spark, sf):
    return fx.messages(fx.trades(spark, sf))


def _message_stream(spark, sf):
    return fx.messages(fx.trade_stream(spark, sf))


def _dims(spark):
    return fx.dim_symbol(spark), fx.dim_exchange(spark)


def _cube(spark, sf):
    return marts.hour_cube(fx.silver(spark, sf))


def _work(spark):
    """(data folder, checkpoint folder) of one run, in the cluster's shared folder."""
    base = tables.shared_dir(spark)
    return f"{base}/data", f"{base}/checkpoint"


# Sources, parsing, cleaning


def parse_json(spark, sf):
    return cleaning.parse_trades(_messages(spark, sf)).drop("value")


def route_payloads(spark, sf):
    return cleaning.route_payloads(_messages(spark, sf)).select("id", "route")


def clean_trades(spark, sf):
    return cleaning.clean_trades(fx.trades(spark, sf), allowed=fx.ALLOWED, **fx.DRIFT)


def clean_by_table(spark, sf):
    listed = fx.dim_symbol(spark).select("symbol")
    return cleaning.clean_trades(fx.trades(spark, sf), allowed=listed, as_of=fx.WHOLE).select(*CORE)


def reject_reasons(spark, sf):
    rows = cleaning.classify(cleaning.parse_trades(_messages(spark, sf)), allowed=fx.ALLOWED, **fx.DRIFT)
    return rows.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def drop_exact_copies(spark, sf):
    copies = fx.trades(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("volume") % 3).cast("int"))))
    return cleaning.drop_exact_copies(copies.withColumn("id", F.col("id") * 3 + F.col("copy")))


def unpack_envelope(spark, sf):
    t = fx.trades(spark, sf)
    ms = F.unix_millis("event_time")

    def tick(shift: int):
        return F.struct(F.col("symbol").alias("s"), F.col("price").alias("p"), F.col("volume").alias("v"),
                        (ms + shift).alias("t"))

    purchase = F.col("symbol") == "BINANCE:PURCHASEUSDT"
    signup = F.col("symbol") == "BINANCE:SIGNUPUSDT"
    data = F.when(purchase, F.array(tick(0), tick(1500))).when(signup, F.slice(F.array(tick(0)), 1, 0)).otherwise(F.array(tick(0)))
    kind = F.when(F.col("symbol") == "BINANCE:ERRORUSDT", "ping").otherwise("trade")
    raw = t.select("id", F.to_json(F.struct(kind.alias("type"), data.alias("data"))).alias("value"))
    return shapes.unpack_envelope(raw)


def csv_replay(spark, sf):
    path, _ = _work(spark)
    fx.trades(spark, sf).select(
        "id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("time"), "symbol", "price", "volume"
    ).write.csv(path, header=True)
    return shapes.read_csv_replay(spark, path, "id STRING, time STRING, symbol STRING, price STRING, volume STRING")


def decode_push(spark, sf):
    t = fx.trades(spark, sf)
    body = F.to_json(F.struct("symbol", "price", "volume"))
    data = F.when(F.col("volume") == 1, "!!!").otherwise(F.base64(body.cast("binary")))
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    top = F.to_json(F.struct(data.alias("data")))
    bare = F.to_json(F.struct(F.struct(data.alias("data")).alias("message")))
    full = F.to_json(F.struct(F.struct(data.alias("data"), at.alias("publishTime")).alias("message")))
    value = F.when(F.col("symbol").contains("SIGNUP"), top).when(F.col("symbol").contains("ERROR"), bare).otherwise(full)
    return shapes.decode_push(t.select("id", value.alias("value")), arrived_at=fx.ARRIVAL)


def parse_logs(spark, sf):
    e = fx.events(spark, sf)
    record = F.struct(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.col("event_type").alias("component"),
        F.col("props").alias("message"),
    )
    return shapes.parse_logs(e.select(F.col("event_id").alias("id"), F.to_json(record).alias("value")))


def parse_lake_records(spark, sf):
    t = fx.trades(spark, sf)
    record = F.struct("symbol", "price", "volume", F.unix_millis("event_time").cast("double").alias("timestamp"))
    return shapes.parse_lake_records(t.select("id", F.to_json(record).alias("value")))


def forward_messages(spark, sf):
    rows = shapes.forward_rows(_messages(spark, sf))
    named = F.map_from_entries("headers")
    return rows.select("key", "value", *[named[h].cast("string").alias(h) for h in ("symbol", "origin")])


def asset_name(spark, sf):
    known = {s: n for s, n in fx.NAMES.items() if n != "View"}
    rows = cleaning.enrich(fx.silver(spark, sf).withColumn("processed_at", F.col("event_time")), known)
    return rows.select("id", "symbol", "asset_name", cleaning.display_time(F.col("processed_at")).alias("shown_at"))


def split_symbol(spark, sf):
    return symbols.split_symbol(fx.trades(spark, sf)).select("id", "exchange_name", "symbol_code", "base_currency", "quote_currency")


# Star schema and reports


def dim_symbol(spark, sf):
    return star.observed_symbols(fx.silver(spark, sf), fx.dim_symbol(spark))


def dim_exchange(spark, sf):
    return star.observed_exchanges(fx.silver(spark, sf), fx.dim_exchange(spark))


def dim_date(spark, sf):
    return star.dim_date(fx.silver(spark, sf))


def dim_date_ext(spark, sf):
    return star.dim_date_ext(fx.silver(spark, sf))


def dim_time(spark, sf):
    return star.dim_time(fx.silver(spark, sf))


def dim_time_ext(spark, sf):
    return star.dim_time_ext(fx.silver(spark, sf))


def fact_trades(spark, sf):
    return star.fact_trades(fx.silver(spark, sf), *_dims(spark))


def trade_id_rownum(spark, sf):
    return star.numbered_fact(fx.silver(spark, sf), *_dims(spark)).select("trade_id", "source_id", "date_key", "time_key", "symbol_key")


def trade_id_scaled(spark, sf):
    rows = fx.line_trades(spark, sf).select("id", "part", "symbol", "event_time")
    return numbering.number_rows(rows, ["event_time", "id", "part", "symbol"], "trade_id").drop("event_time")


def hourly_summary(spark, sf):
    return marts.hourly_summary(_cube(spark, sf), fx.dim_symbol(spark))


def daily_summary(spark, sf):
    return marts.daily_summary(_cube(spark, sf), fx.dim_symbol(spark))


def price_by_hour(spark, sf):
    return marts.price_by_hour(_cube(spark, sf), fx.dim_symbol(spark))


def top_volatility(spark, sf):
    return marts.top_volatility(_cube(spark, sf), fx.dim_symbol(spark))


def asset_share(spark, sf):
    return marts.asset_share(_cube(spark, sf), fx.dim_symbol(spark))


def heatmap(spark, sf):
    return marts.heatmap(_cube(spark, sf), fx.dim_symbol(spark))


def session_volume(spark, sf):
    return marts.session_volume(_cube(spark, sf), fx.dim_symbol(spark))


def daily_range(spark, sf):
    return marts.daily_range(_cube(spark, sf), fx.dim_symbol(spark))


def hourly_by_pair(spark, sf):
    return marts.hourly_by_pair(_cube(spark, sf), fx.dim_symbol(spark))


def latest_price(spark, sf):
    return marts.latest_price(fx.silver(spark, sf), fx.dim_symbol(spark))


def whales(spark, sf):
    return marts.whales(fx.silver(spark, sf), *_dims(spark))


def trade_listing(spark, sf):
    return marts.trade_listing(fx.silver(spark, sf), *_dims(spark))


def star_sample(spark, sf):
    return marts.star_sample(fx.silver(spark, sf), *_dims(spark))


def object_counts(spark, sf):
    return marts.object_counts(fx.silver(spark, sf), _cube(spark, sf), *_dims(spark))


def _database(spark, sf):
    """A database with the trades, the dimensions and the twelve views over them."""
    database = "market_" + os.urandom(6).hex()
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_work(spark)[0]}'")
    rows = fx.silver(spark, sf).withColumn("processed_at", F.col("event_time"))
    tables.insert_rows(cleaning.add_day_columns(cleaning.enrich(rows, fx.NAMES)), f"{database}.crypto_trades")
    views.write_dimensions(*_dims(spark), database)
    views.create_views(spark, database, "crypto_trades", fx.LAST_HOUR)
    return database


def view_hourly_summary(spark, sf):
    return spark.sql(f"SELECT * FROM {_database(spark, sf)}.vw_fact_hourly_summary")


def view_daily_summary(spark, sf):
    return spark.sql(f"SELECT * FROM {_database(spark, sf)}.vw_fact_daily_summary")


def view_asset_share(spark, sf):
    """Dashboard SQL over three of the lasting views."""
    db = _database(spark, sf)
    return spark.sql(f"""SELECT s.asset_name, s.market_cap_tier, COUNT(*) AS trade_count,
            CAST(ROUND(CAST(SUM(f.trade_value) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS total_value_usd,
            CAST(ROUND(CAST(SUM(f.volume) AS DECIMAL(38, 9)), 4) AS DOUBLE) AS total_volume
        FROM {db}.vw_fact_crypto_trades f JOIN {db}.dim_symbol s ON f.symbol_key = s.symbol_key
        JOIN {db}.vw_dim_date d ON f.date_key = d.date_key JOIN {db}.vw_dim_time t ON f.time_key = t.time_key
        GROUP BY s.asset_name, s.market_cap_tier""")


def view_money_flow(spark, sf):
    view = "vw_1_ti_trong_dong_tien_usd_1h"
    return spark.sql(f"SELECT Dong_Coin AS asset_name, Tong_Tien_USD AS total_usd FROM {_database(spark, sf)}.{view}")


def _view(name, *columns):
    """All rows of a lasting view, its columns renamed if they are given."""
    def query(spark, sf):
        rows = spark.table(f"{_database(spark, sf)}.{name}")
        return rows.toDF(*columns) if columns else rows

    return query


view_dim_date = _view("vw_dim_date")
view_dim_time = _view("vw_dim_time")
view_fact_trades = _view("vw_fact_crypto_trades")
view_price_range = _view("vw_2_bien_do_gia_min_max_1h", "asset_name", "lowest_price", "highest_price")
view_trade_count = _view("vw_3_suc_nong_giao_dich_1h", "asset_name", "trade_count")
view_minute_flow = _view("vw_4_tuong_quan_tien_va_lenh_1h", "minute", "trade_count", "total_usd")
view_vwap_5m = _view("vw_5_xu_huong_gia_trung_binh_5p", "bucket_start", "asset_name", "vwap")
view_whale_today = _view("vw_6_ky_luc_lenh_ca_map_hom_nay", "asset_name", "largest_order_usd")
view_density_5m = _view("vw_7_ban_do_mat_do_lenh_5p", "bucket_start", "asset_name", "trade_count")


def candles(spark, sf):
    return candle_ops.candles(fx.silver(spark, sf), 3600)


def daily_candles_lines(spark, sf):
    return candle_ops.candles(fx.line_trades(spark, sf), 86400, ["id", "part"]).select("symbol", "bucket_start", "open", "high", "low", "close", "trades")


# Last-hour views


def _rt(view, named=True):
    def query(spark, sf):
        rows = fx.silver(spark, sf)
        args = (rows, fx.NAMES) if named else (rows,)
        return view(*args, as_of=fx.LAST_HOUR, when="event_time")

    return query


rt_money_flow = _rt(realtime.money_flow)
rt_price_range = _rt(realtime.price_range)
rt_trade_count = _rt(realtime.trade_count)
rt_minute_flow = _rt(realtime.minute_flow, named=False)
rt_vwap_5m = _rt(realtime.vwap_5m)
rt_whale_today = _rt(realtime.whale_today)
rt_density_5m = _rt(realtime.density_5m)


def rt_backfilled(spark, sf):
    """A table partitioned by event day whose rows were processed 45 days after their event.

    Of its folders only those are read whose processing times reach into the hour.
    """
    path, _ = _work(spark)
    late = F.col("event_time") + F.expr("INTERVAL 45 DAYS")
    rows = cleaning.add_day_columns(fx.silver(spark, sf).withColumn("processed_at", late))
    spans.append(tables.by_day(rows), path, "processed_at")
    hour = spans.read_between(spark, path, rows.schema, "processed_at", "2024-02-29 11:00:00", "2024-02-29 12:00:00")
    return realtime.money_flow(hour, fx.NAMES, as_of="2024-02-29 12:00:00")


def rt_ingested(spark, sf):
    """The last hour of what three deliveries have brought in, compacted in between: all of it."""
    root, checkpoint = _work(spark)
    for stream in _out_of_order(spark, root + "_inbox", _messages(spark, sf), F.col("id") % 3):
        ingest.fan_out(
            stream, root, checkpoint, fx.NAMES, keep=["id"], limits={"allowed": fx.ALLOWED, "as_of": fx.WHOLE}, trigger=NOW,
        ).awaitTermination()
        ingest.compact_silver(spark, root, "id BIGINT")
    return realtime.trade_count(ingest.read_recent(spark, root, keep="id BIGINT"), fx.NAMES)


# Streams: run until the input is used up, then read what they wrote


def ingest_stream(spark, sf):
    path, checkpoint = _work(spark)
    table = "ticks_" + os.urandom(6).hex()
    rows = ingest.trade_stream(_message_stream(spark, sf), allowed=fx.ALLOWED, as_of=fx.WHOLE)
    good = cleaning.accepted(rows).drop("value")
    ingest.append_table(good, table, checkpoint, path, **NOW).awaitTermination()
    return spark.table(table)


def write_partitioned(spark, sf):
    path, checkpoint = _work(spark)
    rows = cleaning.add_day_columns(fx.silver_stream(spark, sf))
    ingest.append_files(rows, path, checkpoint, **NOW).awaitTermination()
    return tables.read_range(spark.read.parquet(path), "2024-01-01", "2024-01-31")


def json_lake(spark, sf):
    path, checkpoint = _work(spark)
    rows = cleaning.add_day_columns(fx.silver_stream(spark, sf))
    ingest.append_files(rows, path, checkpoint, fmt="json", **NOW).awaitTermination()
    ddl = "id BIGINT, event_time TIMESTAMP, symbol STRING, price DOUBLE, volume DOUBLE, year INT, month INT, day INT"
    return spark.read.schema(ddl).json(path)


def _fan_out(spark, sf):
    root, checkpoint = _work(spark)
    ingest.fan_out(
        _message_stream(spark, sf), root, checkpoint, fx.NAMES, keep=["id"],
        limits={"allowed": fx.ALLOWED, "as_of": fx.WHOLE}, trigger=NOW,
    ).awaitTermination()
    return root


def fan_out(spark, sf):
    root = _fan_out(spark, sf)
    ledger = ingest.read_ledger(spark, root)
    silver = ingest.read_silver(spark, root, "id BIGINT")
    lake = slices.read_slices(spark, f"{root}/lake", "symbol STRING, batch_id INT", "json")
    rejects = slices.read_slices(spark, f"{root}/rejects", "id BIGINT, value STRING, reject_reason STRING")
    parts = [
        silver.groupBy(F.lit("silver").alias("sink"), F.col("asset_name").alias("detail")).agg(F.count("*").alias("n")),
        lake.groupBy(F.lit("lake").alias("sink"), F.col("symbol").alias("detail")).agg(F.count("*").alias("n")),
        rejects.groupBy(F.lit("rejects").alias("sink"), F.col("reject_reason").alias("detail")).agg(F.count("*").alias("n")),
        ledger.groupBy(F.lit("ledger").alias("sink"), F.col("sink").alias("detail")).agg(F.sum("rows").alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compact(spark, sf):
    """Compacted after the second of three deliveries, and again after the last."""
    root, checkpoint = _work(spark)
    for stream in _out_of_order(spark, root + "_inbox", _messages(spark, sf), F.col("id") % 3):
        ingest.fan_out(
            stream, root, checkpoint, fx.NAMES, keep=["id"], limits={"allowed": fx.ALLOWED, "as_of": fx.WHOLE}, trigger=NOW,
        ).awaitTermination()
        ingest.compact_silver(spark, root, "id BIGINT")
    return ingest.read_silver(spark, root, "id BIGINT").select(*CORE, "asset_name", "year", "month", "day")


def _filled_table(spark, sf, path, table):
    tables.ensure_table(spark, table, path=path)
    rows = cleaning.add_day_columns(
        cleaning.enrich(fx.silver(spark, sf).withColumn("processed_at", F.col("event_time")), fx.NAMES)
    )
    tables.insert_rows(rows, table)


def ensure_table(spark, sf):
    path, _ = _work(spark)
    table = "ticks_" + os.urandom(6).hex()
    _filled_table(spark, sf, path, table)
    tables.ensure_table(spark, table, path=path)
    return spark.table(table)


def reset_table(spark, sf):
    """Filled, reset with its files, filled again: every row is there once."""
    path, checkpoint = _work(spark)
    table = "ticks_" + os.urandom(6).hex()
    _filled_table(spark, sf, path, table)
    tables.reset_table(spark, table, path, checkpoint)
    _filled_table(spark, sf, path, table)
    return spark.table(table).select(*CORE)


def _copies(rows):
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("volume") % 3).cast("int")))).drop("copy")


def dedup_stream(spark, sf):
    path, checkpoint = _work(spark)
    rows = _copies(fx.trade_stream(spark, sf))
    stateful.dedup_batches(rows, path, checkpoint, **NOW).awaitTermination()
    return stateful.read_deduplicated(spark, path, rows)


def dedup_late(spark, sf):
    """Three deliveries out of order, with copies inside each, and all rows once more in a fourth."""
    path, checkpoint = _work(spark)
    t = fx.trades(spark, sf)
    for stream in _out_of_order(spark, path + "_inbox", _copies(t), again=t):
        stateful.dedup_batches(stream, path, checkpoint, **NOW).awaitTermination()
    return stateful.read_deduplicated(spark, path, t)


THROTTLE_SECONDS = 1800


def throttle(spark, sf):
    return throttle_rows(fx.trades(spark, sf), THROTTLE_SECONDS)


def throttle_stream(spark, sf):
    path, checkpoint = _work(spark)
    with stateful.rocksdb(spark):
        rows = stateful.throttle_stream(fx.trade_stream(spark, sf), THROTTLE_SECONDS)
        ingest.append_files(rows, path, checkpoint, partition_by=(), **NOW).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def throttle_batches(spark, sf):
    path, checkpoint = _work(spark)
    rows = fx.trade_stream(spark, sf)
    stateful.throttle_batches(rows, path, checkpoint, THROTTLE_SECONDS, **NOW).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/passed").drop("batch_id")


def throttle_account(spark, sf):
    """Three deliveries out of order: what passed, waited or came too late, by batch."""
    path, checkpoint = _work(spark)
    for stream in _out_of_order(spark, path + "_inbox", fx.trades(spark, sf)):
        stateful.throttle_batches(stream, path, checkpoint, THROTTLE_SECONDS, **NOW).awaitTermination()
    return slices.read_slices(spark, f"{path}/account", stateful.ACCOUNT_DDL)


def _flow(spark, sf):
    path, checkpoint = _work(spark)
    rollup.five_minute_stream(fx.silver_stream(spark, sf), path, checkpoint, **NOW).awaitTermination()
    return rollup.read_rollup(spark, path)


def _late_flow(spark, sf):
    """Three deliveries out of order, folded in between; the stream starts anew for each."""
    path, checkpoint = _work(spark)
    for stream in _out_of_order(spark, path + "_inbox", fx.silver(spark, sf)):
        rollup.five_minute_stream(stream, path, checkpoint, **NOW).awaitTermination()
        rollup.fold_rollup(spark, path)
    return rollup.read_rollup(spark, path)


def vwap_late(spark, sf):
    return rollup.vwap(_late_flow(spark, sf))


def density_late(spark, sf):
    return rollup.density(_late_flow(spark, sf))


def flow_sliding_late(spark, sf):
    return realtime.sliding_flow(_late_flow(spark, sf))


def vwap_stream(spark, sf):
    return rollup.vwap(_flow(spark, sf))


def density_stream(spark, sf):
    return rollup.density(_flow(spark, sf))


def flow_sliding(spark, sf):
    return realtime.sliding_flow(_flow(spark, sf))


def flow_sliding_batch(spark, sf):
    return realtime.sliding_flow(realtime.five_minute_flow(fx.silver(spark, sf)))


def hourly_stream(spark, sf):
    path, checkpoint = _work(spark)
    rollup.hourly_stream(fx.silver_stream(spark, sf), path, checkpoint, **NOW).awaitTermination()
    return marts.hourly_summary(rollup.read_hour_cube(spark, path), fx.dim_symbol(spark))


def hourly_late(spark, sf):
    path, checkpoint = _work(spark)
    for stream in _out_of_order(spark, path + "_inbox", fx.silver(spark, sf)):
        rollup.hourly_stream(stream, path, checkpoint, **NOW).awaitTermination()
        rollup.fold_rollup(spark, path, rollup.CUBE_DDL)
    return marts.hourly_summary(rollup.read_hour_cube(spark, path), fx.dim_symbol(spark))


def _out_of_order(spark, inbox, rows, part=None, again=None):
    """A stream for each of three deliveries of ``rows``, the second older than the first, then of ``again``."""
    day = F.dayofmonth("event_time") if part is None else None
    part = F.when(day <= 10, 1).when(day <= 20, 0).otherwise(2) if part is None else part
    deliveries = [rows.where(part == n) for n in range(3)] + ([] if again is None else [again])
    for n, delivery in enumerate(deliveries):
        delivery.write.parquet(f"{inbox}/delivery={n}")
        yield spark.readStream.schema(rows.schema).parquet(f"{inbox}/delivery=*")


def late_rows(spark, sf):
    """Three deliveries, the middle one ten days late."""
    path, checkpoint = _work(spark)
    for stream in _out_of_order(spark, path + "_inbox", fx.trades(spark, sf)):
        stateful.lateness_stream(stream, path, checkpoint, **NOW).awaitTermination()
    return slices.read_slices(spark, path, stateful.LATENESS_DDL).drop("high")


def closed_windows(spark, sf):
    """Three deliveries of four partitions, the second older than the first: windows are closed once, or corrected."""
    path, checkpoint = _work(spark)
    rows = fx.silver(spark, sf).withColumn("source", F.col("id") % 4)
    for stream in _out_of_order(spark, path + "_inbox", rows):
        closing.closing_stream(stream, path, checkpoint, "source", expected=4, **NOW).awaitTermination()
    return closing.read_closed(spark, path).select(
        "bucket_start", "symbol", "n", round_half_up(F.col("sum_value"), 4).alias("sum_value"), "kind", F.col("times"))


def bound_dimension(spark, sf):
    """A symbol is renamed in the middle of the month; the stream learns of it after two of three deliveries."""
    path, checkpoint = _work(spark)
    trades, versions = fx.silver(spark, sf), path + "_versions"
    known = fx.dim_symbol(spark).select("symbol", F.lit("2000-01-01").cast("timestamp").alias("valid_from"), F.col("symbol_key").cast("int"), "asset_name")
    known.write.parquet(versions)
    renamed = known.where("asset_name = 'Click'").withColumns({"valid_from": F.lit("2024-01-16").cast("timestamp"), "asset_name": F.lit("Tap")})
    for n, stream in enumerate(_out_of_order(spark, path + "_inbox", trades)):
        if n == 2:
            renamed.write.mode("append").parquet(versions)
            dimension.rebind(spark, path, trades.schema, spark.read.schema(dimension.VERSIONS_DDL).parquet(versions), renamed)
        dimension.bind_stream(stream, versions, path, checkpoint, **NOW).awaitTermination()
    bound = spark.read.schema(dimension.bound_fields(trades.schema)).parquet(path)
    return bound.groupBy("symbol", "symbol_key", "asset_name").agg(F.count("*").alias("n"), F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"))


def forward_retried(spark, sf):
    """Three deliveries to a receiver that refuses some messages once, some twice and some always."""
    path, checkpoint = _work(spark)
    messages = _messages(spark, sf)

    def send(rows):
        refused = ((F.col("id") % 5 == 4) & (F.col("attempt") <= 2)) | ((F.col("id") % 5 == 3) & (F.col("attempt") == 1)) | (F.col("id") % 11 == 0)
        return rows.withColumn("error", F.when(refused, F.concat(F.lit("refused "), F.col("attempt").cast("string"))))

    for stream in _out_of_order(spark, path + "_inbox", messages, F.col("id") % 3):
        retry.forward_stream(stream, send, path, checkpoint, **NOW).awaitTermination()
    retry.drain(spark, send, path, messages.schema)
    out = retry.outcomes(spark, path, messages.schema)
    return out.select("id", F.col("value").cast("string").alias("value"), "status", "attempt", "error")


def score_stream(spark, sf):
    path, checkpoint = _work(spark)
    rows = scoring.score(fx.silver_stream(spark, sf), max_price=30.0, max_volume=50.0).select("id", "prediction")
    ingest.append_files(rows, path, checkpoint, partition_by=(), **NOW).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


# Models


def risk_label(spark, sf):
    return scoring.score(fx.silver(spark, sf), max_price=30.0, max_volume=50.0).select("id", "prediction")


def _grid(spark, sf):
    """The last seven days, the range that forecasts are trained on."""
    return series.minute_grid(series.minute_prices(series.last_days(fx.silver(spark, sf), fx.WHOLE, 7)))


def minute_grid(spark, sf):
    return _grid(spark, sf)


def forecast_drift(spark, sf):
    out = series.forecast_drift(_grid(spark, sf))
    return out.withColumn("forecast_value", round_half_up(F.col("forecast_value"), 4))


def forecast_seasonal(spark, sf):
    return series.forecast_seasonal(_grid(spark, sf))


def forecast_fit(spark, sf):
    out = series.forecast_fit(_grid(spark, sf), p=1, d=1)
    return out.select(
        "symbol",
        round_half_up(F.col("intercept"), 6).alias("intercept"),
        round_half_up(F.col("coefficients")[0], 6).alias("phi"),
        round_half_up(F.col("sigma2"), 4).alias("sigma2"),
        "observations",
        "last_minute",
    )


def forecast(spark, sf):
    out = series.forecast(series.forecast_fit(_grid(spark, sf), p=1, d=1))
    digits = {c: round_half_up(F.col(c), 3) for c in ("forecast_value", "lower_bound", "upper_bound")}
    return out.withColumns(digits).drop("standard_error", "confidence_level")


def forecast_ar3(spark, sf):
    out = series.forecast(series.forecast_fit(_grid(spark, sf), p=3, d=1))
    digits = {c: round_half_up(F.col(c), 3) for c in ("forecast_value", "lower_bound", "upper_bound")}
    return out.withColumns(digits).drop("standard_error", "confidence_level")


def forecast_orders(spark, sf):
    """The orders 0 to 3 of every symbol, and which of them AIC chooses."""
    grid = _grid(spark, sf)
    chosen = series.forecast_fit(grid, select=True).select("symbol", F.col("p").alias("chosen"))
    table = series.order_table(grid).join(chosen, "symbol")
    return table.select("symbol", "p", round_half_up(F.col("sigma2"), 4).alias("sigma2"), round_half_up(F.col("aic"), 3).alias("aic"),
                        (F.col("p") == F.col("chosen")).alias("chosen"))


def seasonal_profile(spark, sf):
    out = series.seasonal_profile(_grid(spark, sf))
    return out.withColumn("effect", round_half_up(F.col("effect"), 6))


def forecast_decomposed(spark, sf):
    return series.forecast_decomposed(_grid(spark, sf))


def anomaly_fit(spark, sf):
    rows = fx.silver(spark, sf)
    return anomaly.centroids(anomaly.anomaly_fit(rows), rows)


def anomalies(spark, sf):
    rows = fx.silver(spark, sf)
    model = anomaly.anomaly_fit(rows)
    return anomaly.anomalies(model, rows, anomaly.anomaly_threshold(model, rows))


def anomaly_facts(spark, sf):
    """What must hold of clusters learnt from the last day: members, nearest and mean centres, and how many are flagged there and in
    the last ten minutes of it."""
    rows = fx.silver(spark, sf)
    day = tables.written(anomaly.recent(rows, fx.WHOLE, 86400))
    minutes = anomaly.recent(day, fx.WHOLE, 600)
    model = mixed_clusters.fit(day)
    scored = tables.written(mixed_clusters.with_distance(model, day))
    limit = numbering.exact_quantile(scored, "distance", 0.98).first()["quantile"]
    # Centres anew, from the members' plain one-hot columns.
    z = {c: F.col(c) / s for c, s in zip(model.numbers, model.scales, strict=True)}
    means = scored.groupBy("centroid_id").agg(F.count("*").alias("members"), *[F.avg(z[c]).alias(f"m_{c}") for c in model.numbers])
    stated = spark.createDataFrame([(i, n, *map(float, c)) for i, (n, c) in enumerate(zip(model.members, model.centres, strict=True))],
                                   "centroid_id int, n bigint, c_price double, c_volume double")
    off = F.greatest(F.abs(F.col("c_price") - F.col("m_price")), F.abs(F.col("c_volume") - F.col("m_volume"))) > 1e-6
    centres = means.join(stated, "centroid_id")
    share = scored.groupBy("centroid_id", "symbol").agg(F.count("*").alias("n")).join(means.select("centroid_id", "members", "m_price", "m_volume"), "centroid_id")
    share = share.join(model.offsets.select("symbol", "weight"), "symbol").withColumn("share", F.col("n") / F.col("members"))
    length = share.groupBy("centroid_id").agg(F.sum(F.col("share") * F.col("share") * F.col("weight")).alias("length"))
    every = means.select("centroid_id", "m_price", "m_volume").join(length, "centroid_id").select(F.col("centroid_id").alias("other"), "m_price", "m_volume", "length")
    pairs = scored.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(len(model.members) - 1)))).join(every, "other")
    pairs = pairs.join(share.select(F.col("centroid_id").alias("other"), "symbol", "share"), ["other", "symbol"], "left")
    pairs = pairs.join(model.offsets.select("symbol", "weight"), "symbol")
    square = F.pow(z["price"] - F.col("m_price"), 2) + F.pow(z["volume"] - F.col("m_volume"), 2) + F.col("length") + F.col("weight") * (1 - 2 * F.coalesce("share", F.lit(0.0)))
    nearer = F.sqrt(F.greatest(square, F.lit(0.0))) < F.col("distance") - 1e-6
    facts = {
        "members add up to": means.agg(F.sum("members").alias("n")),
        "centres that are not means": centres.agg(F.count_if(off | (F.col("n") != F.col("members"))).alias("n")),
        "rows nearer to another centre": pairs.agg(F.count_if(nearer).alias("n")),
        "flagged beyond two percent": scored.agg(F.greatest(F.count_if(F.col("distance") > limit) - F.floor(F.count("*") * 0.02) - 1, F.lit(0)).alias("n")),
        "scored in the last ten minutes": mixed_clusters.with_distance(model, minutes).agg(F.count("*").alias("n")),
    }
    out = [rows.select(F.lit(fact).alias("fact"), F.col("n").cast("bigint").alias("n")) for fact, rows in facts.items()]
    return reduce(DataFrame.unionByName, out)


def anomaly_zscore(spark, sf):
    rows = fx.silver(spark, sf)
    out = anomaly.anomaly_zscore(rows, rows, 2.0)
    return out.select("id", "symbol", round_half_up(F.col("score"), 6).alias("score"))


def value_quantile(spark, sf):
    rows = fx.line_trades(spark, sf).withColumn("value", F.col("price") * F.col("volume"))
    return numbering.exact_quantile(rows, "value", 0.98)


def _markers(rows):
    """Two markers: the newer one has fewer rows, as after a reset."""

    def marker(until, trained_at):
        before = rows.where(F.col("event_time") < F.lit(until).cast("timestamp"))
        return before.agg(F.count("*").alias("row_count")).select(
            F.lit("price").alias("model"), "row_count", F.lit(trained_at).cast("timestamp").alias("trained_at"))

    return marker("2024-01-25", "2024-01-26").unionByName(marker("2024-01-16", "2024-01-28"))


def retrain_gate(spark, sf):
    rows = fx.silver(spark, sf)
    return scoring.retrain_gate(rows, _markers(rows), "price", 1000)


def retrain_gate_footers(spark, sf):
    """The gate on the day-partitioned table, counted from its files' footers."""
    path, _ = _work(spark)
    rows = cleaning.add_day_columns(fx.silver(spark, sf))
    tables.by_day(rows).write.partitionBy("year", "month", "day").parquet(path)
    return scoring.gate(scoring.count_from_footers(spark, path), _markers(spark.read.schema(rows.schema).parquet(path)), "price", 1000)


def retrain_gate_ledger(spark, sf):
    """The gate on the counts that the ingest has written down, without a look at the trades."""
    counted = scoring.count_from_ledger(ingest.read_ledger(spark, _fan_out(spark, sf)))
    markers = spark.sql("SELECT 'price' AS model, 100L AS row_count, TIMESTAMP '2024-01-28' AS trained_at")
    return scoring.gate(counted, markers, "price", 1000)


def market_context(spark, sf):
    return scoring.market_context(fx.silver(spark, sf))


def all_queries():
    """Every public query function of this module, by name."""
    helpers = {"all_queries"}
    return {
        name: f
        for name, f in globals().items()
        if callable(f) and not name.startswith("_") and name not in helpers
        and getattr(f, "__module__", None) == __name__
    }

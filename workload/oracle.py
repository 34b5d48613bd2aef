"""The SQL every query is compared with, written without a look at the Spark code's shape."""

from __future__ import annotations

from workload import fixtures as fx

ALLOWED = ", ".join(f"'{s}'" for s in fx.ALLOWED)
VALUES = ", ".join(str(r) for r in fx.SYMBOL_ROWS)

TRADES = """t AS (
  SELECT event_id AS id, ts AS event_time, 'BINANCE:' || upper(event_type) || 'USDT' AS symbol,
         value AS price, CAST(props->>'k' AS DOUBLE) AS volume
  FROM events)"""
SILVER = f"""{TRADES}, silver AS (
  SELECT * FROM t WHERE symbol IN ({ALLOWED}) AND price > 0 AND volume > 0
    AND event_time >= TIMESTAMP '2024-01-01 00:00:00' AND event_time < TIMESTAMP '2024-02-01 00:00:01')"""
DIMS = f"""dim_symbol AS (
  SELECT * FROM (VALUES {VALUES}) v(symbol_key, symbol, symbol_code, base_currency, quote_currency, asset_name, asset_type, market_cap_tier)),
dim_exchange AS (
  SELECT * FROM (VALUES (1, 'BINANCE', 'Binance Exchange', 'Malta', 'CEX', 'USDT'))
    v(exchange_key, exchange_name, exchange_fullname, country, exchange_type, quote_currency))"""
FACT = f"""{SILVER}, {DIMS}, fact AS (
  SELECT s.id AS trade_id, CAST(strftime(s.event_time, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(strftime(s.event_time, '%H%M%S') AS INTEGER) AS time_key, d.symbol_key, e.exchange_key,
         s.price, s.volume, ROUND(s.price * s.volume, 6) AS trade_value, s.event_time AS trade_time
  FROM silver s JOIN dim_symbol d ON s.symbol = d.symbol
  LEFT JOIN dim_exchange e ON e.exchange_name = split_part(s.symbol, ':', 1)),
full_fact AS (
  SELECT f.*, CAST(f.trade_time AS DATE) AS full_date, CAST(hour(f.trade_time) AS INTEGER) AS hour,
         dayname(f.trade_time) AS day_name, d.asset_name, d.symbol_code, d.base_currency, d.market_cap_tier
  FROM fact f JOIN dim_symbol d ON f.symbol_key = d.symbol_key)"""
LINES = """lines AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS part, l_shipdate AS event_time, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
         l_extendedprice / l_quantity AS price, l_quantity AS volume
  FROM lineitem)"""

# One message per trade; volumes 1 to 6 are spoiled.
MESSAGES = f"""{TRADES}, m AS (
  SELECT *, CAST(volume AS INTEGER) AS k,
    '{{"time":"' || CASE WHEN volume = 3 THEN 'garbage' ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END
    || '","symbol":"' || CASE WHEN volume = 5 THEN '\\t' || symbol || ' ' ELSE symbol END
    || '","price":' || CASE WHEN volume = 4 THEN '"abc"' WHEN volume = 6 THEN '"' || CAST(price AS VARCHAR) || '"'
                            ELSE CAST(price AS VARCHAR) END
    || CASE WHEN volume = 2 THEN '}}' ELSE ',"volume":' || CAST(volume AS VARCHAR) || '}}' END AS fine
  FROM t), msg AS (
  SELECT *, CASE WHEN k = 1 THEN 'not json ' || symbol ELSE fine END AS value FROM m)"""
PARSE_ERROR = """CASE k WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'missing_fields'
  WHEN 3 THEN 'invalid_time' WHEN 4 THEN 'invalid_format' END"""


GATE = """SELECT 'price' AS model, COUNT(*) AS rows_now, COUNT(*) FILTER (WHERE event_time < TIMESTAMP '2024-01-16') AS rows_at_training,
    COUNT(*) FILTER (WHERE event_time >= TIMESTAMP '2024-01-16') AS new_rows,
    COUNT(*) FILTER (WHERE event_time >= TIMESTAMP '2024-01-16') >= 1000 AS should_train FROM silver"""


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes} {body}"


def _sources() -> dict[str, str]:
    checked = f"""SELECT COALESCE({PARSE_ERROR},
        CASE WHEN symbol NOT IN ({ALLOWED}) THEN 'not_in_whitelist'
             WHEN NOT (price > 0 AND volume > 0) THEN 'invalid_values'
             WHEN date_trunc('second', event_time) NOT BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-21' THEN 'clock_drift'
             ELSE 'accepted' END) AS reason FROM msg"""
    return {
        "parse_json": with_(MESSAGES, f"""SELECT id,
            CASE WHEN k NOT IN (1, 3) THEN date_trunc('second', event_time) END AS event_time,
            CASE WHEN k = 5 THEN chr(9) || symbol || ' ' WHEN k <> 1 THEN symbol END AS symbol,
            CASE WHEN k NOT IN (1, 4) THEN price END AS price,
            CASE WHEN k NOT IN (1, 2) THEN volume END AS volume,
            {PARSE_ERROR} AS parse_error FROM msg"""),
        "route_payloads": with_(MESSAGES, """SELECT id,
            CASE WHEN json_valid(value) AND len(list_intersect(json_keys(CASE WHEN json_valid(value) THEN value ELSE '{}' END),
              ['time', 'symbol', 'price', 'volume'])) = 4 THEN 'trade' ELSE 'other' END AS route FROM msg"""),
        "clean_trades": with_(TRADES, f"""SELECT * FROM t WHERE symbol IN ({ALLOWED}) AND price > 0 AND volume > 0
            AND event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-21 00:00:01'"""),
        "clean_by_table": with_(SILVER, "SELECT * FROM silver"),
        "reject_reasons": with_(MESSAGES, f"SELECT reason, COUNT(*) AS n FROM ({checked}) GROUP BY reason"),
        "drop_exact_copies": with_(TRADES, """SELECT MIN(id * 3) AS id, event_time, symbol, price, volume
            FROM t GROUP BY event_time, symbol, price, volume"""),
        "unpack_envelope": with_(TRADES, """SELECT id, CAST(n AS INTEGER) AS position,
            date_trunc('second', date_trunc('millisecond', event_time) + n * INTERVAL 1500 MILLISECONDS) AS event_time,
            symbol, price, volume
            FROM t, (VALUES (0), (1)) v(n)
            WHERE symbol NOT IN ('BINANCE:ERRORUSDT', 'BINANCE:SIGNUPUSDT') AND (n = 0 OR symbol = 'BINANCE:PURCHASEUSDT')"""),
        "csv_replay": with_(TRADES, """SELECT '{"id":"' || CAST(id AS VARCHAR) || '","time":"' || strftime(event_time, '%Y-%m-%d %H:%M:%S')
            || '","symbol":"' || symbol || '","price":"' || CAST(price AS VARCHAR) || '","volume":"' || CAST(volume AS VARCHAR)
            || '"}' AS value FROM t"""),
        "decode_push": with_(TRADES, """SELECT id,
            CASE WHEN volume <> 1 THEN '{"symbol":"' || symbol || '","price":' || CAST(price AS VARCHAR) || ',"volume":' || CAST(volume AS VARCHAR) || '}' END AS payload,
            CASE WHEN symbol IN ('BINANCE:SIGNUPUSDT', 'BINANCE:ERRORUSDT') THEN TIMESTAMP '2024-02-01' ELSE event_time END AS processed_at
            FROM t"""),
        "parse_logs": """SELECT event_id AS id, ts AS logged_at, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
            event_type AS component, props AS message FROM events""",
        "parse_lake_records": with_(TRADES, """SELECT id, date_trunc('millisecond', event_time) AS event_time,
            symbol, price, volume FROM t"""),
        "forward_messages": with_(MESSAGES, """SELECT CASE WHEN k = 5 THEN chr(9) || symbol || ' ' ELSE symbol END AS key, value,
            CASE WHEN k = 5 THEN chr(9) || symbol || ' ' ELSE symbol END AS symbol, 'tick-bridge' AS origin FROM msg WHERE k <> 1"""),
        "asset_name": with_(SILVER, """SELECT id, symbol,
            CASE symbol WHEN 'BINANCE:CLICKUSDT' THEN 'Click' WHEN 'BINANCE:PURCHASEUSDT' THEN 'Purchase'
                        WHEN 'BINANCE:SIGNUPUSDT' THEN 'Signup' ELSE symbol END AS asset_name,
            strftime(event_time + INTERVAL 7 HOURS, '%Y-%m-%d %H:%M:%S') AS shown_at FROM silver"""),
        "split_symbol": """SELECT event_id AS id, 'BINANCE' AS exchange_name, upper(event_type) || 'USDT' AS symbol_code,
            upper(event_type) AS base_currency, 'USDT' AS quote_currency FROM events""",
    }


def _star() -> dict[str, str]:
    measures = f"""COUNT(*) AS total_trades_count, {rnd('SUM(volume)', 4)} AS total_V_volume,
        {rnd('SUM(trade_value)', 2)} AS total_V_value_usd, {rnd('MAX(price)', 2)} AS high_price,
        {rnd('MIN(price)', 2)} AS low_price, {rnd('AVG(price)', 2)} AS avg_price"""
    daily = f"""SELECT date_key, symbol_key, asset_name, {measures.replace('total_V', 'total_daily')},
        {rnd('(MAX(price) - MIN(price)) / MIN(price) * 100', 2)} AS price_volatility_pct
        FROM full_fact GROUP BY date_key, symbol_key, asset_name"""
    hourly = f"SELECT date_key, hour, symbol_key, asset_name, {measures.replace('total_V', 'total_hourly')} FROM full_fact GROUP BY date_key, hour, symbol_key, asset_name"
    date_dim = """SELECT DISTINCT CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_key, CAST(event_time AS DATE) AS full_date,
        CAST(year(event_time) AS INTEGER) AS year, CAST(quarter(event_time) AS INTEGER) AS quarter, CAST(month(event_time) AS INTEGER) AS month,
        monthname(event_time) AS month_name, CAST(week(event_time) AS INTEGER) AS week_of_year, CAST(day(event_time) AS INTEGER) AS day_of_month,
        CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week, dayname(event_time) AS day_name FROM silver"""
    time_dim = """SELECT DISTINCT CAST(strftime(event_time, '%H%M%S') AS INTEGER) AS time_key, CAST(hour(event_time) AS INTEGER) AS hour,
        CAST(minute(event_time) AS INTEGER) AS minute, CAST(second(event_time) AS INTEGER) AS second FROM silver"""
    session = "CASE WHEN hour <= 7 THEN 'Asia' WHEN hour <= 12 THEN 'Europe' WHEN hour <= 20 THEN 'US' ELSE 'Off-hours' END"
    period = "CASE WHEN hour <= 5 THEN 'Night' WHEN hour <= 11 THEN 'Morning' WHEN hour <= 17 THEN 'Afternoon' ELSE 'Evening' END"
    named = "SELECT f.*, e.exchange_name FROM full_fact f JOIN dim_exchange e ON f.exchange_key = e.exchange_key"
    candle = """SELECT symbol, BUCKET AS bucket_start, arg_min(price, ORD) AS open, MAX(price) AS high,
        MIN(price) AS low, arg_max(price, ORD) AS close"""
    return {
        "dim_symbol": with_(f"{SILVER}, {DIMS}", "SELECT * FROM dim_symbol WHERE symbol IN (SELECT symbol FROM silver)"),
        "dim_exchange": with_(f"{SILVER}, {DIMS}", "SELECT * FROM dim_exchange WHERE exchange_name IN (SELECT split_part(symbol, ':', 1) FROM silver)"),
        "dim_date": with_(SILVER, date_dim),
        "dim_date_ext": with_(SILVER, f"SELECT *, day_of_week IN (1, 7) AS is_weekend FROM ({date_dim})"),
        "dim_time": with_(SILVER, time_dim),
        "dim_time_ext": with_(SILVER, f"SELECT *, {period} AS period, {session} AS trading_session FROM ({time_dim})"),
        "fact_trades": with_(FACT, "SELECT * FROM fact"),
        "trade_id_rownum": with_(FACT, """SELECT ROW_NUMBER() OVER (ORDER BY trade_time, trade_id) AS trade_id, trade_id AS source_id,
            date_key, time_key, symbol_key FROM fact"""),
        "trade_id_scaled": with_(LINES, "SELECT id, part, symbol, ROW_NUMBER() OVER (ORDER BY event_time, id, part, symbol) AS trade_id FROM lines"),
        "hourly_summary": with_(FACT, hourly),
        "daily_summary": with_(FACT, daily),
        "view_hourly_summary": with_(FACT, hourly),
        "view_daily_summary": with_(FACT, daily),
        "view_asset_share": with_(FACT, f"""SELECT asset_name, market_cap_tier, COUNT(*) AS trade_count, {rnd('SUM(trade_value)', 2)} AS total_value_usd,
            {rnd('SUM(volume)', 4)} AS total_volume FROM full_fact GROUP BY asset_name, market_cap_tier"""),
        "price_by_hour": with_(FACT, f"""SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS full_date, hour, asset_name, avg_price,
            high_price, low_price, total_trades_count AS trade_count FROM ({hourly})"""),
        "top_volatility": with_(FACT, f"""SELECT strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE AS full_date, asset_name,
            price_volatility_pct, total_daily_volume, total_daily_value_usd FROM ({daily})"""),
        "asset_share": with_(FACT, f"""SELECT asset_name, market_cap_tier, COUNT(*) AS trade_count, {rnd('SUM(trade_value)', 2)} AS total_value_usd,
            {rnd('SUM(volume)', 4)} AS total_volume FROM full_fact GROUP BY asset_name, market_cap_tier"""),
        "heatmap": with_(FACT, f"""SELECT day_name, hour, COUNT(*) AS trade_count, {rnd('AVG(price)', 2)} AS avg_price,
            {rnd('SUM(trade_value)', 2)} AS total_value FROM full_fact GROUP BY day_name, hour"""),
        "session_volume": with_(FACT, f"""SELECT {session} AS trading_session, symbol_code, {rnd('SUM(volume)', 4)} AS total_volume,
            {rnd('SUM(trade_value)', 2)} AS total_usd_value FROM full_fact GROUP BY 1, 2"""),
        "daily_range": with_(FACT, f"""SELECT full_date, asset_name, MIN(price) AS low, MAX(price) AS high, {rnd('AVG(price)', 6)} AS avg_price
            FROM full_fact GROUP BY full_date, asset_name"""),
        "hourly_by_pair": with_(FACT, f"""SELECT full_date, hour, symbol_code, {rnd('AVG(price)', 6)} AS avg_price,
            {rnd('SUM(trade_value)', 2)} AS total_value FROM full_fact GROUP BY full_date, hour, symbol_code"""),
        "latest_price": with_(FACT, """SELECT asset_name, base_currency, price AS latest_price, volume AS latest_volume,
            trade_value AS latest_trade_value, trade_time AS last_updated FROM full_fact f
            WHERE trade_time = (SELECT MAX(trade_time) FROM fact g WHERE g.symbol_key = f.symbol_key)"""),
        "whales": with_(FACT, f"""SELECT trade_id AS id, trade_time, asset_name, exchange_name, price, volume, trade_value AS value_usd
            FROM ({named}) ORDER BY trade_value DESC, trade_id LIMIT 50"""),
        "trade_listing": with_(FACT, f"SELECT trade_id, trade_time, asset_name, exchange_name, price, volume, trade_value FROM ({named})"),
        "star_sample": with_(FACT, f"""SELECT place AS trade_id, trade_time, full_date, day_name, hour,
            CAST(minute(trade_time) AS INTEGER) AS minute, asset_name, base_currency, market_cap_tier, exchange_name, price, volume, trade_value
            FROM ({named}) n JOIN (SELECT trade_id AS own, ROW_NUMBER() OVER (ORDER BY trade_time, trade_id) AS place FROM fact) p
            ON p.own = n.trade_id ORDER BY n.trade_time DESC, n.trade_id DESC LIMIT 20"""),
        "object_counts": with_(FACT, f"""SELECT 'dim_exchange' AS object_name, COUNT(*) AS rows FROM dim_exchange
            UNION ALL SELECT 'dim_symbol', COUNT(*) FROM dim_symbol UNION ALL SELECT 'dim_date', COUNT(*) FROM ({date_dim})
            UNION ALL SELECT 'dim_time', COUNT(*) FROM ({time_dim}) UNION ALL SELECT 'fact_trades', COUNT(*) FROM fact
            UNION ALL SELECT 'hourly_summary', COUNT(*) FROM ({hourly}) UNION ALL SELECT 'daily_summary', COUNT(*) FROM ({daily})"""),
        "candles": with_(SILVER, candle.replace("BUCKET", "date_trunc('hour', event_time)").replace("ORD", "(event_time, id)")
                         + ", SUM(volume) AS volume, COUNT(*) AS trades FROM silver GROUP BY 1, 2"),
        "daily_candles_lines": with_(LINES, candle.replace("BUCKET", "date_trunc('day', event_time)").replace("ORD", "(event_time, id, part)")
                                     + ", COUNT(*) AS trades FROM lines GROUP BY 1, 2"),
    }


def _realtime() -> dict[str, str]:
    name = "CASE symbol " + " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in fx.NAMES.items()) + " ELSE symbol END AS asset_name"
    hour = "FROM silver WHERE event_time >= TIMESTAMP '2024-01-15 11:00:00' AND event_time <= TIMESTAMP '2024-01-15 12:00:00'"
    five = "time_bucket(INTERVAL 5 MINUTES, event_time) AS bucket_start"
    vwap = rnd("SUM(price * volume) / SUM(volume)", 4)
    return {
        "rt_money_flow": with_(SILVER, f"SELECT {name}, {rnd('SUM(price * volume)', 2)} AS total_usd {hour} GROUP BY 1"),
        "rt_price_range": with_(SILVER, f"SELECT {name}, {rnd('MIN(price)', 4)} AS lowest_price, {rnd('MAX(price)', 4)} AS highest_price {hour} GROUP BY 1"),
        "rt_trade_count": with_(SILVER, f"SELECT {name}, COUNT(*) AS trade_count {hour} GROUP BY 1"),
        "rt_minute_flow": with_(SILVER, f"SELECT date_trunc('minute', event_time) AS minute, COUNT(*) AS trade_count, {rnd('SUM(price * volume)', 2)} AS total_usd {hour} GROUP BY 1"),
        "rt_vwap_5m": with_(SILVER, f"SELECT {five}, {name}, {vwap} AS vwap {hour} GROUP BY 1, 2"),
        "rt_density_5m": with_(SILVER, f"SELECT {five}, {name}, COUNT(*) AS trade_count {hour} GROUP BY 1, 2"),
        "rt_whale_today": with_(SILVER, f"""SELECT {name}, {rnd('MAX(price * volume)', 2)} AS largest_order_usd FROM silver
            WHERE event_time >= TIMESTAMP '2024-01-15' AND event_time <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1"""),
        "view_money_flow": with_(SILVER, f"SELECT {name}, {rnd('SUM(price * volume)', 2)} AS total_usd {hour} GROUP BY 1"),
        "rt_backfilled": with_(SILVER, f"SELECT {name}, {rnd('SUM(price * volume)', 2)} AS total_usd {hour} GROUP BY 1"),
        "vwap_late": with_(SILVER, f"SELECT {five}, symbol, {vwap} AS vwap FROM silver GROUP BY 1, 2"),
        "density_late": with_(SILVER, f"SELECT {five}, symbol, COUNT(*) AS trade_count FROM silver GROUP BY 1, 2"),
        "flow_sliding_late": with_(SILVER, SLIDING.replace("VWAP", vwap).replace("USD", rnd("SUM(price * volume)", 2))),
        "vwap_stream": with_(SILVER, f"SELECT {five}, symbol, {vwap} AS vwap FROM silver GROUP BY 1, 2"),
        "density_stream": with_(SILVER, f"SELECT {five}, symbol, COUNT(*) AS trade_count FROM silver GROUP BY 1, 2"),
        "flow_sliding": with_(SILVER, SLIDING.replace("VWAP", vwap).replace("USD", rnd("SUM(price * volume)", 2))),
        "flow_sliding_batch": with_(SILVER, SLIDING.replace("VWAP", vwap).replace("USD", rnd("SUM(price * volume)", 2))),
    }


SLIDING = """SELECT time_bucket(INTERVAL 5 MINUTES, event_time) - n * INTERVAL 5 MINUTES AS window_start, symbol,
    COUNT(*) AS trade_count, USD AS total_usd, VWAP AS vwap FROM silver, range(12) r(n) GROUP BY 1, 2"""

THROTTLE = f"""{TRADES}, picked AS (
  SELECT symbol, MIN(event_time) AS event_time FROM t GROUP BY symbol
  UNION ALL
  SELECT p.symbol, (SELECT MIN(n.event_time) FROM t n WHERE n.symbol = p.symbol AND n.event_time >= p.event_time + INTERVAL 30 MINUTES) AS event_time
  FROM picked p WHERE p.event_time IS NOT NULL)"""

# The first ten days come after the ten that follow them, when every symbol has passed a later tick.
ACCOUNT = THROTTLE.replace("t AS (", "all_rows AS (").replace("FROM events), picked", """FROM events), t AS (
  SELECT *, CASE WHEN day(event_time) BETWEEN 11 AND 20 THEN 0 WHEN day(event_time) <= 10 THEN 1 ELSE 2 END AS batch_id FROM all_rows), picked""")
ACCOUNT = ACCOUNT.replace("FROM t GROUP BY", "FROM t WHERE batch_id <> 1 GROUP BY").replace("FROM t n WHERE", "FROM t n WHERE n.batch_id <> 1 AND")


def _streams() -> dict[str, str]:
    days = ", CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month, CAST(day(event_time) AS INTEGER) AS day"
    named = "CASE symbol " + " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in fx.NAMES.items()) + " END AS asset_name"
    good = f"k > 4 AND symbol IN ({ALLOWED}) AND price > 0"
    reason = f"""COALESCE({PARSE_ERROR}, CASE WHEN symbol NOT IN ({ALLOWED}) THEN 'not_in_whitelist' ELSE 'invalid_values' END)"""
    passed = "SELECT t.* FROM t JOIN picked USING (symbol, event_time)"
    label = "SELECT id, CASE WHEN price > 30 AND volume > 50 THEN 'warning' ELSE 'safe' END AS prediction FROM silver"
    return {
        "ingest_stream": with_(MESSAGES, f"""SELECT id, date_trunc('second', event_time) AS event_time, symbol, price, volume{days}
            FROM msg WHERE {good}"""),
        "write_partitioned": with_(SILVER, f"SELECT *{days} FROM silver"),
        "json_lake": with_(SILVER, f"SELECT id, date_trunc('millisecond', event_time) AS event_time, symbol, price, volume{days} FROM silver"),
        "fan_out": with_(MESSAGES, f"""SELECT 'silver' AS sink, {named.replace(' AS asset_name', '')} AS detail, COUNT(*) AS n FROM msg WHERE {good} GROUP BY 2
            UNION ALL SELECT 'lake', symbol, COUNT(*) FROM msg WHERE {good} GROUP BY 2
            UNION ALL SELECT 'rejects', {reason}, COUNT(*) FROM msg WHERE NOT ({good}) GROUP BY 2
            UNION ALL SELECT 'ledger', CASE WHEN {good} THEN 'silver' ELSE 'rejects' END, COUNT(*) FROM msg GROUP BY 2
            UNION ALL SELECT 'ledger', 'lake', COUNT(*) FROM msg WHERE {good}"""),
        "retrain_gate_ledger": with_(MESSAGES, f"""SELECT 'price' AS model, COUNT(*) AS rows_now, CASE WHEN COUNT(*) < 100 THEN 0 ELSE 100 END AS rows_at_training,
            COUNT(*) - CASE WHEN COUNT(*) < 100 THEN 0 ELSE 100 END AS new_rows,
            COUNT(*) - CASE WHEN COUNT(*) < 100 THEN 0 ELSE 100 END >= 1000 AS should_train FROM msg WHERE {good}"""),
        "rt_ingested": with_(MESSAGES, f"SELECT {named}, COUNT(*) AS trade_count FROM msg WHERE {good} GROUP BY 1"),
        "compact": with_(MESSAGES, f"SELECT id, date_trunc('second', event_time) AS event_time, symbol, price, volume, {named}{days} FROM msg WHERE {good}"),
        "closed_windows": with_(SILVER + """, low AS (SELECT MIN(newest) - INTERVAL 1 HOUR AS low FROM (SELECT MAX(event_time) AS newest FROM silver GROUP BY id % 4))""",
            f"""SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket_start, symbol, COUNT(*) AS n, {rnd('SUM(price * volume)', 4)} AS sum_value,
            CASE WHEN MAX(day(event_time)) <= 10 THEN 'correction' ELSE 'final' END AS kind, 1::BIGINT AS times
            FROM silver GROUP BY 1, 2 HAVING time_bucket(INTERVAL 5 MINUTE, MIN(event_time)) + INTERVAL 5 MINUTE <= (SELECT low FROM low)"""),
        "bound_dimension": with_(SILVER, f"""SELECT symbol, CAST(symbol_key AS INTEGER) AS symbol_key,
            CASE WHEN name = 'Click' AND event_time >= TIMESTAMP '2024-01-16' THEN 'Tap' ELSE name END AS asset_name,
            COUNT(*) AS n, MIN(event_time) AS first_time, MAX(event_time) AS last_time
            FROM silver JOIN (VALUES {VALUES}) d(symbol_key, symbol, code, base, quote, name, kind, tier) USING (symbol) GROUP BY 1, 2, 3"""),
        "forward_retried": with_(MESSAGES, """SELECT id, value, CASE WHEN id % 11 = 0 THEN 'dead' ELSE 'delivered' END AS status,
            CAST(CASE WHEN id % 11 = 0 OR id % 5 = 4 THEN 3 WHEN id % 5 = 3 THEN 2 ELSE 1 END AS INTEGER) AS attempt,
            CASE WHEN id % 11 = 0 THEN 'refused 3' END AS error FROM msg"""),
        "ensure_table": with_(SILVER, f"SELECT id, event_time, symbol, price, volume, {named}, event_time AS processed_at{days} FROM silver"),
        "reset_table": with_(SILVER, "SELECT * FROM silver"),
        "dedup_stream": with_(TRADES, "SELECT DISTINCT * FROM t"),
        "dedup_late": with_(TRADES, "SELECT DISTINCT * FROM t"),
        "throttle_account": recursive(ACCOUNT, """SELECT batch_id, COUNT(*) AS rows,
            COUNT(*) FILTER (WHERE batch_id <> 1 AND p.symbol IS NOT NULL) AS passed, COUNT(*) FILTER (WHERE batch_id = 1) AS late,
            COUNT(*) FILTER (WHERE batch_id <> 1 AND p.symbol IS NULL) AS waiting
            FROM t LEFT JOIN picked p ON p.symbol = t.symbol AND p.event_time = t.event_time GROUP BY batch_id"""),
        "hourly_late": _star()["hourly_summary"],
        "throttle": recursive(THROTTLE, passed),
        "throttle_stream": recursive(THROTTLE, passed),
        "throttle_batches": recursive(THROTTLE, passed),
        "hourly_stream": _star()["hourly_summary"],
        "late_rows": with_(TRADES + """, d AS (SELECT *, CASE WHEN day(event_time) BETWEEN 11 AND 20 THEN 0 WHEN day(event_time) <= 10 THEN 1 ELSE 2 END AS batch_id FROM t),
            per AS (SELECT batch_id, MAX(event_time) AS newest FROM d GROUP BY batch_id),
            mark AS (SELECT b.batch_id, b.newest, (SELECT MAX(newest) FROM per e WHERE e.batch_id < b.batch_id) - INTERVAL 1 HOUR AS watermark FROM per b)""", """SELECT d.batch_id, COUNT(*) AS rows, COUNT(*) FILTER (WHERE d.event_time < m.watermark) AS late_rows,
              MAX(d.event_time) AS newest, MAX(m.watermark) AS watermark
            FROM d JOIN mark m ON d.batch_id = m.batch_id GROUP BY d.batch_id"""),
        "risk_label": with_(SILVER, label),
        "score_stream": with_(SILVER, label),
    }


GRID = f"""{SILVER}, prices AS (
  SELECT symbol, date_trunc('minute', event_time) AS minute, arg_max(price, (event_time, id)) AS price FROM silver
  WHERE event_time >= TIMESTAMP '2024-01-24' AND event_time <= TIMESTAMP '2024-01-31' GROUP BY 1, 2),
span AS (SELECT symbol, MIN(minute) AS lo, MAX(minute) AS hi FROM prices GROUP BY symbol),
every_minute AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS minute FROM span),
grid AS (
  SELECT e.symbol, e.minute, last_value(p.price IGNORE NULLS) OVER (PARTITION BY e.symbol ORDER BY e.minute) AS price,
         p.price IS NULL AS filled
  FROM every_minute e LEFT JOIN prices p ON e.symbol = p.symbol AND e.minute = p.minute)"""

AR1 = f"""{GRID}, changes AS (
  SELECT symbol, minute, price, price - lag(price) OVER w AS x, lag(price) OVER w - lag(price, 2) OVER w AS x1
  FROM grid WINDOW w AS (PARTITION BY symbol ORDER BY minute)),
line AS (
  SELECT symbol, regr_slope(x, x1) AS phi, regr_intercept(x, x1) AS c, regr_syy(x, x1) AS syy, regr_sxy(x, x1) AS sxy,
         regr_count(x, x1) AS n FROM changes GROUP BY symbol),
model AS (
  SELECT l.symbol, phi, c, (syy - phi * sxy) / (l.n - 2) AS sigma2, g.n AS observations, g.last_minute, g.price, g.x
  FROM line l JOIN (SELECT symbol, COUNT(*) AS n, MAX(minute) AS last_minute, arg_max(price, minute) AS price, arg_max(x, minute) AS x
                    FROM changes GROUP BY symbol) g ON l.symbol = g.symbol)"""

AR3 = f"""{GRID}, diffs AS (
  SELECT symbol, minute, price, price - lag(price) OVER (PARTITION BY symbol ORDER BY minute) AS x FROM grid),
lags AS (
  SELECT *, lag(x, 1) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(x, 3) OVER w AS x3 FROM diffs WINDOW w AS (PARTITION BY symbol ORDER BY minute)),
m AS (
  SELECT symbol, COUNT(*) AS n, AVG(x) AS a0, AVG(x1) AS a1, AVG(x2) AS a2, AVG(x3) AS a3, var_pop(x) * COUNT(*) AS c00,
    covar_pop(x, x1) * COUNT(*) AS c01, covar_pop(x, x2) * COUNT(*) AS c02, covar_pop(x, x3) * COUNT(*) AS c03,
    var_pop(x1) * COUNT(*) AS c11, var_pop(x2) * COUNT(*) AS c22, var_pop(x3) * COUNT(*) AS c33,
    covar_pop(x1, x2) * COUNT(*) AS c12, covar_pop(x1, x3) * COUNT(*) AS c13, covar_pop(x2, x3) * COUNT(*) AS c23
  FROM lags WHERE x3 IS NOT NULL GROUP BY symbol),
dets AS (
  SELECT *, c11 * c22 - c12 * c12 AS d2, c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c23 * c13) + c13 * (c12 * c23 - c22 * c13) AS d3 FROM m),
fits AS (
  SELECT symbol, n, 0 AS p, a0 AS c, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3, c00 AS sse FROM dets
  UNION ALL SELECT symbol, n, 1, a0 - c01 / c11 * a1, c01 / c11, 0, 0, c00 - c01 / c11 * c01 FROM dets
  UNION ALL SELECT symbol, n, 2, a0 - b1 * a1 - b2 * a2, b1, b2, 0, c00 - b1 * c01 - b2 * c02
    FROM (SELECT *, (c01 * c22 - c02 * c12) / d2 AS b1, (c11 * c02 - c12 * c01) / d2 AS b2 FROM dets)
  UNION ALL SELECT symbol, n, 3, a0 - b1 * a1 - b2 * a2 - b3 * a3, b1, b2, b3, c00 - b1 * c01 - b2 * c02 - b3 * c03
    FROM (SELECT *,
      (c01 * (c22 * c33 - c23 * c23) - c12 * (c02 * c33 - c23 * c03) + c13 * (c02 * c23 - c22 * c03)) / d3 AS b1,
      (c11 * (c02 * c33 - c23 * c03) - c01 * (c12 * c33 - c23 * c13) + c13 * (c12 * c03 - c02 * c13)) / d3 AS b2,
      (c11 * (c22 * c03 - c02 * c23) - c12 * (c12 * c03 - c02 * c13) + c01 * (c12 * c23 - c22 * c13)) / d3 AS b3 FROM dets)),
orders AS (SELECT *, sse / (n - p - 1) AS sigma2, n * ln(sse / n) + 2 * (p + 1) AS aic FROM fits)"""


def _models() -> dict[str, str]:
    ahead3 = AR3 + """, model AS (
      SELECT f.symbol, c, b1, b2, b3, sigma2, l.* EXCLUDE (symbol) FROM orders f JOIN (
        SELECT symbol, MAX(minute) AS last_minute, arg_max(price, minute) AS price, arg_max(x, minute) AS y1, arg_max(x1, minute) AS y2, arg_max(x2, minute) AS y3
        FROM lags GROUP BY symbol) l ON l.symbol = f.symbol WHERE p = 3),
    ahead AS (
      SELECT symbol, 1 AS step, c + b1 * y1 + b2 * y2 + b3 * y3 AS x, y1 AS x1, y2 AS x2, price + c + b1 * y1 + b2 * y2 + b3 * y3 AS level,
        1.0::DOUBLE AS psi, 0.0::DOUBLE AS psi1, 0.0::DOUBLE AS psi2, 1.0::DOUBLE AS cum, 1.0::DOUBLE AS total FROM model
      UNION ALL
      SELECT a.symbol, a.step + 1, m.c + m.b1 * a.x + m.b2 * a.x1 + m.b3 * a.x2, a.x, a.x1, a.level + m.c + m.b1 * a.x + m.b2 * a.x1 + m.b3 * a.x2,
        m.b1 * a.psi + m.b2 * a.psi1 + m.b3 * a.psi2, a.psi, a.psi1, a.cum + m.b1 * a.psi + m.b2 * a.psi1 + m.b3 * a.psi2,
        a.total + (a.cum + m.b1 * a.psi + m.b2 * a.psi1 + m.b3 * a.psi2) * (a.cum + m.b1 * a.psi + m.b2 * a.psi1 + m.b3 * a.psi2)
      FROM ahead a JOIN model m ON a.symbol = m.symbol WHERE a.step < 30)"""
    ahead = AR1 + """, ahead AS (
      SELECT symbol, 1 AS step, c + phi * x AS x, price + c + phi * x AS level, CAST(1.0 AS DOUBLE) AS power, CAST(1.0 AS DOUBLE) AS psi, CAST(1.0 AS DOUBLE) AS total FROM model
      UNION ALL
      SELECT a.symbol, a.step + 1, m.c + m.phi * a.x, a.level + m.c + m.phi * a.x, a.power * m.phi, a.psi + a.power * m.phi,
             a.total + (a.psi + a.power * m.phi) * (a.psi + a.power * m.phi)
      FROM ahead a JOIN model m ON a.symbol = m.symbol WHERE a.step < 30)"""
    z = "1.6448536269514722"
    return {
        "minute_grid": with_(GRID, "SELECT * FROM grid"),
        "forecast_drift": with_(GRID + """, pts AS (SELECT g.symbol, g.minute, price, date_diff('minute', s.lo, g.minute) AS x FROM grid g JOIN span s ON g.symbol = s.symbol),
            fit AS (SELECT symbol, regr_slope(price, x) AS slope, regr_intercept(price, x) AS intercept, MAX(x) AS last_x, MAX(minute) AS last_minute FROM pts GROUP BY symbol)""",
            f"""SELECT symbol, CAST(step AS INTEGER) AS step, last_minute + step * INTERVAL 1 MINUTE AS forecast_timestamp,
            {rnd('intercept + slope * (last_x + step)', 4)} AS forecast_value FROM fit, range(1, 31) r(step)"""),
        "forecast_seasonal": with_(GRID, """SELECT s.symbol, CAST(step AS INTEGER) AS step, s.hi + step * INTERVAL 1 MINUTE AS forecast_timestamp,
            g.price AS forecast_value FROM span s CROSS JOIN range(1, 31) r(step)
            JOIN grid g ON g.symbol = s.symbol AND g.minute = s.hi + (step - 1440) * INTERVAL 1 MINUTE"""),
        "forecast_fit": with_(AR1, f"""SELECT symbol, {rnd('c', 6)} AS intercept, {rnd('phi', 6)} AS phi, {rnd('sigma2', 4)} AS sigma2,
            CAST(observations AS INTEGER) AS observations, last_minute FROM model"""),
        "forecast": recursive(ahead, f"""SELECT a.symbol, a.step, m.last_minute + a.step * INTERVAL 1 MINUTE AS forecast_timestamp,
            {rnd('a.level', 3)} AS forecast_value, {rnd(f'a.level - {z} * sqrt(m.sigma2 * a.total)', 3)} AS lower_bound,
            {rnd(f'a.level + {z} * sqrt(m.sigma2 * a.total)', 3)} AS upper_bound FROM ahead a JOIN model m ON a.symbol = m.symbol"""),
        "forecast_ar3": recursive(ahead3, f"""SELECT a.symbol, a.step, m.last_minute + a.step * INTERVAL 1 MINUTE AS forecast_timestamp,
            {rnd('a.level', 3)} AS forecast_value, {rnd(f'a.level - {z} * sqrt(m.sigma2 * a.total)', 3)} AS lower_bound,
            {rnd(f'a.level + {z} * sqrt(m.sigma2 * a.total)', 3)} AS upper_bound FROM ahead a JOIN model m ON a.symbol = m.symbol"""),
        "forecast_orders": with_(AR3, f"""SELECT symbol, p, {rnd('sigma2', 4)} AS sigma2, {rnd('aic', 3)} AS aic,
            row_number() OVER (PARTITION BY symbol ORDER BY aic, p) = 1 AS chosen FROM orders"""),
        "seasonal_profile": with_(GRID, f"""SELECT g.symbol, CAST(hour(g.minute) AS INTEGER) AS phase, {rnd('AVG(g.price - d.mean)', 6)} AS effect, COUNT(*) AS minutes
            FROM grid g JOIN (SELECT symbol, CAST(minute AS DATE) AS day, AVG(price) AS mean FROM grid GROUP BY 1, 2) d
              ON d.symbol = g.symbol AND d.day = CAST(g.minute AS DATE) GROUP BY 1, 2"""),
        "anomaly_facts": with_(SILVER, """SELECT 'members add up to' AS fact, COUNT(*) AS n FROM silver WHERE event_time >= TIMESTAMP '2024-01-30' AND event_time <= TIMESTAMP '2024-01-31'
            UNION ALL SELECT 'centres that are not means', 0 UNION ALL SELECT 'rows nearer to another centre', 0 UNION ALL SELECT 'flagged beyond two percent', 0
            UNION ALL SELECT 'scored in the last ten minutes', COUNT(*) FROM silver WHERE event_time >= TIMESTAMP '2024-01-30 23:50:00' AND event_time <= TIMESTAMP '2024-01-31'"""),
        "anomaly_zscore": with_(SILVER, f"""SELECT id, s.symbol, {rnd('greatest(abs((price - mp) / sp), abs((volume - mv) / sv))', 6)} AS score
            FROM silver s JOIN (SELECT symbol, AVG(price) AS mp, stddev_samp(price) AS sp, AVG(volume) AS mv, stddev_samp(volume) AS sv
                                FROM silver GROUP BY symbol) q ON s.symbol = q.symbol
            WHERE greatest(abs((price - mp) / sp), abs((volume - mv) / sv)) > 2.0"""),
        "value_quantile": with_(LINES, "SELECT quantile_cont(price * volume, 0.98) AS quantile FROM lines"),
        "retrain_gate": with_(SILVER, GATE),
        "retrain_gate_footers": with_(SILVER, GATE),
        "market_context": with_(SILVER + """, top AS (SELECT * FROM silver ORDER BY event_time DESC, id DESC LIMIT 5),
            ctx AS (SELECT '[' || string_agg('{"symbol":"' || symbol || '","price":' || CAST(price AS VARCHAR) || ',"volume":' || CAST(volume AS VARCHAR)
                || ',"timestamp":"' || strftime(date_trunc('millisecond', event_time), '%Y-%m-%dT%H:%M:%S.%g') || '"}', ',' ORDER BY event_time DESC, id DESC) || ']' AS context FROM top)""",
            f"SELECT context, replace('{PROMPT}', '%s', context) AS prompt FROM ctx"),
    }


def _prompt() -> str:
    from tickloom.operators.scoring import DEFAULT_PROMPT

    return DEFAULT_PROMPT.replace("'", "''")


PROMPT = _prompt()


def all_sql() -> dict[str, str]:
    sql = {**_sources(), **_star(), **_realtime(), **_streams(), **_models()}
    # The lasting views state what the functions state.
    twins = {"view_dim_date": "dim_date", "view_dim_time": "dim_time", "view_fact_trades": "fact_trades"}
    twins |= {f"view_{n}": f"rt_{n}" for n in ("price_range", "trade_count", "minute_flow", "vwap_5m", "whale_today", "density_5m")}
    return sql | {view: sql[query] for view, query in twins.items()}

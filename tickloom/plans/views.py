"""Views for dashboard SQL: temporary ones of DataFrames, and lasting ones over catalogue tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import marts, realtime, star

# View and column names that dashboards already use for the last-hour views.
DASHBOARD_NAMES = {
    "vw_1_ti_trong_dong_tien_usd_1h": ("Dong_Coin", "Tong_Tien_USD"),
    "vw_2_bien_do_gia_min_max_1h": ("Dong_Coin", "Gia_Thap_Nhat", "Gia_Cao_Nhat"),
    "vw_3_suc_nong_giao_dich_1h": ("Dong_Coin", "Tong_So_Khop_Lenh"),
    "vw_4_tuong_quan_tien_va_lenh_1h": ("Phut_Giao_Dich", "So_Luong_Lenh", "Tong_Tien_USD_Khop"),
    "vw_5_xu_huong_gia_trung_binh_5p": ("Moc_Thoi_Gian_5_Phut", "Dong_Coin", "Gia_Chot_Trung_Binh"),
    "vw_6_ky_luc_lenh_ca_map_hom_nay": ("Dong_Coin", "Lenh_Bom_Tien_Khung_Nhat_USD"),
    "vw_7_ban_do_mat_do_lenh_5p": ("Moc_Thoi_Gian_5_Phut", "Dong_Coin", "So_Lan_Xuat_Chieu"),
}


def register_star_views(trades: DataFrame, dim_symbol: DataFrame, dim_exchange: DataFrame, cube: DataFrame | None = None) -> None:
    """The star schema under its usual names. ``trade_id`` is the stable source id.

    With ``cube``, the live hour table, the two summaries do not read the trades.
    """
    cube = marts.hour_cube(trades) if cube is None else cube
    raw = trades.withColumnRenamed("event_time", "time")
    views = {
        "crypto_trades": raw.select("time", *[c for c in raw.columns if c != "time"]),
        "dim_symbol": dim_symbol,
        "dim_exchange": dim_exchange,
        "vw_dim_date": star.dim_date(trades),
        "vw_dim_time": star.dim_time(trades),
        "vw_fact_crypto_trades": star.fact_trades(trades, dim_symbol, dim_exchange),
        "vw_fact_hourly_summary": marts.hourly_summary(cube, dim_symbol),
        "vw_fact_daily_summary": marts.daily_summary(cube, dim_symbol),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)


def register_realtime_views(trades: DataFrame, names: Mapping[str, str], as_of=None, when: str = "processed_at") -> None:
    """The seven last-hour views; without ``as_of`` each read looks back from its own moment."""
    views = (
        realtime.money_flow(trades, names, as_of, when),
        realtime.price_range(trades, names, as_of, when),
        realtime.trade_count(trades, names, as_of, when),
        realtime.minute_flow(trades, as_of, when),
        realtime.vwap_5m(trades, names, as_of, when),
        realtime.whale_today(trades, names, as_of, when),
        realtime.density_5m(trades, names, as_of, when),
    )
    for (name, columns), rows in zip(DASHBOARD_NAMES.items(), views):
        rows.toDF(*columns).createOrReplaceTempView(name)


def write_dimensions(dim_symbol: DataFrame, dim_exchange: DataFrame, database: str) -> None:
    """The two seeded dimensions as tables of ``database``; written anew if they are there."""
    for name, rows in (("dim_symbol", dim_symbol), ("dim_exchange", dim_exchange)):
        rows.coalesce(1).write.mode("overwrite").saveAsTable(f"{database}.{name}")


def _rounded(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"


def _summary(period: str, keys: str, more: str = "") -> str:
    return f"""SELECT {keys}, f.symbol_key, s.asset_name, COUNT(*) AS total_trades_count,
        {_rounded('SUM(f.volume)', 4)} AS total_{period}_volume, {_rounded('SUM(f.trade_value)', 2)} AS total_{period}_value_usd,
        {_rounded('MAX(f.price)', 2)} AS high_price, {_rounded('MIN(f.price)', 2)} AS low_price,
        {_rounded('AVG(f.price)', 2)} AS avg_price{more}
        FROM {{db}}.vw_fact_crypto_trades f JOIN {{db}}.dim_symbol s ON f.symbol_key = s.symbol_key
        GROUP BY {keys.replace(' AS hour', '')}, f.symbol_key, s.asset_name"""


STAR_SQL = {
    "vw_dim_date": """SELECT CAST(date_format(d, 'yyyyMMdd') AS INT) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
        month(d) AS month, date_format(d, 'MMMM') AS month_name, weekofyear(d) AS week_of_year, dayofmonth(d) AS day_of_month,
        dayofweek(d) AS day_of_week, date_format(d, 'EEEE') AS day_name
        FROM (SELECT DISTINCT to_date(event_time) AS d FROM {db}.{trades})""",
    "vw_dim_time": """SELECT DISTINCT CAST(date_format(event_time, 'HHmmss') AS INT) AS time_key, hour(event_time) AS hour,
        minute(event_time) AS minute, second(event_time) AS second FROM {db}.{trades}""",
    "vw_fact_crypto_trades": """SELECT t.id AS trade_id, CAST(date_format(t.event_time, 'yyyyMMdd') AS INT) AS date_key,
        CAST(date_format(t.event_time, 'HHmmss') AS INT) AS time_key, s.symbol_key, e.exchange_key, t.price, t.volume,
        ROUND(t.price * t.volume, 6) AS trade_value, t.event_time AS trade_time
        FROM {db}.{trades} t JOIN {db}.dim_symbol s ON t.symbol = s.symbol
        LEFT JOIN {db}.dim_exchange e ON split_part(t.symbol, ':', 1) = e.exchange_name""",
    "vw_fact_hourly_summary": _summary("hourly", "f.date_key, hour(f.trade_time) AS hour"),
    "vw_fact_daily_summary": _summary(
        "daily", "f.date_key",
        f", {_rounded('try_divide(MAX(f.price) - MIN(f.price), MIN(f.price)) * 100', 2)} AS price_volatility_pct"),
}
_HOUR = "FROM {db}.{trades} WHERE processed_at >= {now} - INTERVAL 1 HOUR AND processed_at <= {now}"
_FIVE = "timestamp_seconds(unix_seconds(processed_at) div 300 * 300)"
#: In the order of ``DASHBOARD_NAMES``, which gives the columns their names.
RECENT_SQL = (
    f"SELECT asset_name AS {{c[0]}}, {_rounded('SUM(price * volume)', 2)} AS {{c[1]}} {_HOUR} GROUP BY asset_name",
    f"SELECT asset_name AS {{c[0]}}, {_rounded('MIN(price)', 4)} AS {{c[1]}}, {_rounded('MAX(price)', 4)} AS {{c[2]}} {_HOUR} GROUP BY asset_name",
    f"SELECT asset_name AS {{c[0]}}, COUNT(*) AS {{c[1]}} {_HOUR} GROUP BY asset_name",
    f"SELECT date_trunc('MINUTE', processed_at) AS {{c[0]}}, COUNT(*) AS {{c[1]}}, {_rounded('SUM(price * volume)', 2)} AS {{c[2]}} "
    f"{_HOUR} GROUP BY 1",
    f"SELECT {_FIVE} AS {{c[0]}}, asset_name AS {{c[1]}}, {_rounded('try_divide(SUM(price * volume), SUM(volume))', 4)} AS {{c[2]}} "
    f"{_HOUR} GROUP BY 1, 2",
    f"SELECT asset_name AS {{c[0]}}, {_rounded('MAX(price * volume)', 2)} AS {{c[1]}} FROM {{db}}.{{trades}} "
    "WHERE processed_at >= date_trunc('DAY', {now}) AND processed_at <= {now} GROUP BY asset_name",
    f"SELECT {_FIVE} AS {{c[0]}}, asset_name AS {{c[1]}}, COUNT(*) AS {{c[2]}} {_HOUR} GROUP BY 1, 2",
)


def create_views(spark: SparkSession, database: str, trades: str, as_of: str | None = None) -> None:
    """The twelve views as lasting objects of ``database``, over its tables ``trades`` and the dimensions.

    They keep no data: each read computes them anew. The last-hour views look back from the moment
    of reading, or from ``as_of``. Sessions that create and read them run in UTC.
    """
    now = "current_timestamp()" if as_of is None else f"TIMESTAMP '{as_of}'"
    bodies = [(name, body, ()) for name, body in STAR_SQL.items()]
    bodies += [(name, body, c) for (name, c), body in zip(DASHBOARD_NAMES.items(), RECENT_SQL, strict=True)]
    for name, body, c in bodies:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body.format(db=database, trades=trades, now=now, c=c)}")

import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import plan_of
from tickloom import schema
from tickloom.functions import clock
from tickloom.functions.numeric import round_half_up, to_number
from tickloom.operators import cleaning
from tickloom.sources import messages, streams

NOW = "2026-03-25 17:00:00"
GOOD = {"time": "2026-03-25 16:45:18", "symbol": "BINANCE:BTCUSDT", "price": 71263.02, "volume": 0.002}


def _with(**changes):
    return json.dumps({**GOOD, **changes})


def _without(key):
    return json.dumps({k: v for k, v in GOOD.items() if k != key})


CASES = [
    (_with(), None),
    (_with(symbol=" binance:btcusdt "), None),
    (_with(symbol="\tBINANCE:BTCUSDT\n"), None),
    (_with(price="71263.02"), None),
    (_with(time=" 2026-03-25 16:45:18 "), None),
    (_with(time=1774457118000), None),
    ("not json", "malformed_json"),
    ("[1, 2]", "malformed_json"),
    ("17", "malformed_json"),
    ("null", "malformed_json"),
    ("", "malformed_json"),
    (None, "malformed_json"),
    ("{}", "missing_fields"),
    (_without("volume"), "missing_fields"),
    (_with(price=None), "missing_fields"),
    (_with(time="garbage"), "invalid_time"),
    (_with(time="16:45:18"), "invalid_time"),
    (_with(price="abc"), "invalid_format"),
    (_with(price="1.5d"), "invalid_format"),
    (_with(price={"a": 1}), "invalid_format"),
    (_with(symbol="BINANCE:DOGEUSDT"), "not_in_whitelist"),
    (_with(price=0), "invalid_values"),
    (_with(volume=-1), "invalid_values"),
    (_with(price="NaN"), "invalid_values"),
    (_with(price=float("nan")), "invalid_values"),
    (_with(price=float("inf")), "invalid_values"),
    (_with(time="2026-03-26 18:00:00"), "clock_drift"),
    (_with(time="2026-02-22 17:00:00"), "clock_drift"),
    (_with(time="2026-03-26 17:00:00"), None),
    (_with(time="2026-02-23 17:00:00"), None),
    (_with(time="2026-03-26 17:00:01"), "clock_drift"),
    (_with(time="2026-02-23 16:59:59"), "clock_drift"),
]


def _classified(spark):
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "id int, value string")
    return cleaning.classify(cleaning.parse_trades(rows), as_of=NOW)


def test_every_rule_gives_its_reason(spark):
    got = {r["id"]: r["reject_reason"] for r in _classified(spark).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_nothing_is_lost(spark):
    rows = _classified(spark)
    assert cleaning.accepted(rows).count() + cleaning.rejected(rows).count() == len(CASES)


def test_symbols_are_normalised(spark):
    got = {r["symbol"] for r in cleaning.accepted(_classified(spark)).collect()}
    assert got == {"BINANCE:BTCUSDT"}


def test_cleaning_is_idempotent_and_equals_classify(spark):
    parsed = cleaning.parse_trades(
        spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "id int, value string")
    )
    once = cleaning.clean_trades(parsed, as_of=NOW)
    twice = cleaning.clean_trades(once, as_of=NOW)
    ids = sorted(i for i, (_, reason) in enumerate(CASES) if reason is None)
    assert sorted(r["id"] for r in once.collect()) == ids
    assert sorted(once.collect()) == sorted(twice.collect())


def test_list_as_table_equals_list(spark, make_trades):
    trades = make_trades(
        [(1, NOW, "a", 1.0, 1.0), (2, NOW, "b", 1.0, 1.0), (3, NOW, None, 1.0, 1.0), (4, NOW, "A ", 2.0, 0.0)]
    )
    table = spark.createDataFrame([("A",), ("A",)], "symbol string")
    for allowed in (["A"], table):
        rows = cleaning.classify(trades, allowed=allowed, as_of=NOW)
        assert {r["id"]: r["reject_reason"] for r in rows.collect()} == {
            1: None, 2: "not_in_whitelist", 3: "missing_fields", 4: "invalid_values"
        }
        assert [r["id"] for r in cleaning.clean_trades(trades, allowed=allowed, as_of=NOW).collect()] == [1]


def test_filters_reach_the_scan(spark, make_trades, tmp_path):
    make_trades([(1, NOW, "A", 1.0, 1.0)]).write.parquet(str(tmp_path / "t"))
    plan = plan_of(cleaning.clean_trades(spark.read.parquet(str(tmp_path / "t")), allowed=["A"], as_of=NOW))
    assert "GreaterThan(price,0.0)" in plan and "GreaterThanOrEqual(event_time" in plan
    assert "Exchange" not in plan


def test_time_text(spark):
    cases = {
        "2026-03-25 16:45:18": "2026-03-25 09:45:18",
        "2026-03-25T16:45:18Z": "2026-03-25 16:45:18",
        "2026-03-25T16:45:18.5+07:00": "2026-03-25 09:45:18.5",
        "2026-03-25": "2026-03-24 17:00:00",
        "1774457118000": "2026-03-25 16:45:18",
        "25/03/2026": None,
        "now": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["t"] for r in rows.withColumn("t", clock.parse_instant(F.col("s"), "Asia/Ho_Chi_Minh")).collect()}
    assert got == {k: v and dt.datetime.fromisoformat(v) for k, v in cases.items()}


def test_time_text_does_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("2026-03-25 16:45:18",)], "s string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = rows.select(F.unix_seconds(clock.parse_instant(F.col("s"), "UTC"))).first()[0]
        shown = rows.select(cleaning.display_time(clock.parse_instant(F.col("s"), "UTC"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 1774457118
    assert shown == "2026-03-25 23:45:18"


def test_strict_time(spark):
    rows = spark.createDataFrame([("2026-03-25 16:45:18",), ("2026-03-25T16:45:18",), ("2026-13-25 16:45:18",)], "s string")
    got = [r[0] is not None for r in rows.select(clock.parse_instant(F.col("s"), strict=True)).collect()]
    assert got == [True, False, False]


def test_numbers(spark):
    rows = spark.createDataFrame([("1.5",), (" 2 ",), ("1e3",), ("1.5f",), ("x",), ('"NaN"',)], "s string")
    got = [r[0] for r in rows.select(to_number(F.col("s"))).collect()]
    assert got[:5] == [1.5, 2.0, 1000.0, None, None] and got[5] != got[5]


def test_rounding_is_half_up_and_never_fails(spark):
    rows = spark.createDataFrame([(1.005,), (2.675,), (1e35,), (None,)], "x double")
    got = [r[0] for r in rows.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [1.01, 2.68, 1e35, None]


def test_exact_copies(spark, make_trades):
    trades = make_trades([(3, NOW, "A", 1.0, 1.0), (1, NOW, "A", 1.0, 1.0), (2, NOW, "A", 1.0, 2.0)])
    assert sorted(r["id"] for r in cleaning.drop_exact_copies(trades).collect()) == [1, 2]


def test_routing(spark):
    rows = spark.createDataFrame([(_with(),), (_without("price"),), ("[]",), ("x",), (_with(extra=1),)], "value string")
    got = [r["route"] for r in cleaning.route_payloads(rows).collect()]
    assert got == ["trade", "other", "other", "other", "trade"]


def test_provider_envelope(spark):
    tick = {"s": "A", "p": 1.5, "v": 2.0, "t": 1774457118999}
    values = [
        {"type": "ping"},
        {"type": "trade", "data": []},
        {"type": "trade", "data": [tick, {**tick, "p": 2.5}]},
        {"type": "news", "data": [tick]},
    ]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(9, "x")], "id int, value string")
    got = messages.unpack_envelope(rows).orderBy("position").collect()
    assert [(r["id"], r["position"], r["symbol"], r["price"]) for r in got] == [(2, 0, "A", 1.5), (2, 1, "A", 2.5)]
    assert got[0]["event_time"] == dt.datetime(2026, 3, 25, 16, 45, 18)


def test_push_envelope(spark):
    body = base64.b64encode(_with().encode()).decode()
    values = [
        {"message": {"data": body, "publishTime": "2026-03-25T16:50:00.123Z"}},
        {"message": {"data": body}},
        {"data": body},
        {"message": {"data": "!!!", "publishTime": "nonsense"}},
        {},
    ]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, value string")
    got = messages.decode_push(rows, arrived_at=NOW).orderBy("id").collect()
    assert [r["payload"] for r in got] == [_with()] * 3 + [None] * 2
    arrival = dt.datetime.fromisoformat(NOW)
    assert [r["processed_at"] for r in got] == [dt.datetime(2026, 3, 25, 16, 50, 0, 123000)] + [arrival] * 4
    classified = cleaning.classify(cleaning.parse_trades(messages.decode_push(rows, arrived_at=NOW), "payload"), as_of=NOW)
    assert [r["reject_reason"] for r in classified.orderBy("id").collect()] == [None] * 3 + ["malformed_json"] * 2


def test_csv_replay_drops_the_byte_order_mark(spark, tmp_path):
    path = tmp_path / "ticks.csv"
    path.write_text("time,symbol,price,volume\n2026-03-25 16:45:18,BINANCE:BTCUSDT,71263.02,0.002\n", encoding="utf-8-sig")
    rows = messages.read_csv_replay(spark, str(path))
    assert json.loads(rows.first()["value"]) == {k: str(v) for k, v in GOOD.items()}
    assert cleaning.clean_trades(cleaning.parse_trades(rows), as_of=NOW).count() == 1


def test_logs_and_lake_records(spark):
    log = {"timestamp": "2026-03-25T16:45:18.123456", "level": "INFO", "component": "Db", "message": "m"}
    row = messages.parse_logs(spark.createDataFrame([(json.dumps(log),)], "value string")).first()
    assert row["logged_at"] == dt.datetime(2026, 3, 25, 16, 45, 18, 123456) and row["component"] == "Db"
    old = {"symbol": "A", "price": 1, "volume": 2, "timestamp": 1774457118000.0}
    row = messages.parse_lake_records(spark.createDataFrame([(json.dumps(old),)], "value string")).first()
    assert row["event_time"] == dt.datetime(2026, 3, 25, 16, 45, 18) and row["price"] == 1.0


def test_forwarding(spark):
    rows = spark.createDataFrame([(_with(),), ("{}",), ("x",)], "value string")
    got = messages.forward_rows(rows, origin="here").collect()
    assert [r["key"] for r in got] == ["BINANCE:BTCUSDT", "UNKNOWN"]
    assert {h["key"]: bytes(h["value"]).decode() for h in got[0]["headers"]} == {"symbol": "BINANCE:BTCUSDT", "origin": "here"}
    assert messages.unforwardable(rows).count() == 1


def test_broker_options_and_ids(spark):
    opts = streams.kafka_options("h:9092", "ticks", max_offsets_per_trigger=10, include_headers=True)
    assert opts == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "ticks", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10", "includeHeaders": "true",
    }
    assert "startingOffsets" not in streams.kafka_options("h:9092", "ticks", starting_offsets=None)
    records = spark.sql("select 3 partition, 5L offset, cast('x' as binary) value, current_timestamp() timestamp")
    assert streams.with_offset_id(records).first()["id"] == (3 << 48) + 5


def test_symbol_setting():
    assert schema.parse_symbol_list(" A:B , ,C:D,") == ["A:B", "C:D"]


def test_a_list_in_a_table_is_normalised_like_any_other(spark, make_trades):
    rows = make_trades([(1, "2026-03-25 01:00:00", "BINANCE:BTCUSDT", 1.0, 1.0)])
    listed = spark.createDataFrame([(" binance:btcusdt\t",)], "symbol string")
    for allowed in (listed, [" binance:btcusdt\t"]):
        assert cleaning.clean_trades(rows, allowed=allowed, as_of="2026-03-25 02:00:00").count() == 1
        assert cleaning.accepted(cleaning.classify(rows, allowed=allowed, as_of="2026-03-25 02:00:00")).count() == 1

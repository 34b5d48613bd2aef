import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


from tickloom.operators import anomaly, mixed_clusters, scoring, series


def _minutes(spark, values, symbol="A", start=1774396800):
    rows = [(i, start + 60 * i, symbol, float(v), 1.0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id bigint, s bigint, symbol string, price double, volume double")
    return df.selectExpr("id", "timestamp_seconds(s) event_time", "symbol", "price", "volume")


def test_minute_prices_and_gaps(make_trades):
    trades = make_trades([
        (1, "2026-03-25 00:00:10", "A", 1.0, 1.0), (3, "2026-03-25 00:00:50", "A", 3.0, 1.0),
        (2, "2026-03-25 00:00:50", "A", 2.0, 1.0), (4, "2026-03-25 00:03:00", "A", 9.0, 1.0),
        (5, "2026-03-25 00:01:00", "B", 4.0, 1.0),
    ])
    grid = series.minute_grid(series.minute_prices(trades)).orderBy("symbol", "minute").collect()
    assert [(r["symbol"], r["minute"].minute, r["price"], r["filled"]) for r in grid] == [
        ("A", 0, 3.0, False), ("A", 1, 3.0, True), ("A", 2, 3.0, True), ("A", 3, 9.0, False), ("B", 1, 4.0, False)
    ]


def fit_series(values, p, d):
    """Least squares on the lags, in one piece: (intercept, coefficients, variance, sum of squares)."""
    x = np.diff(values, n=d)
    rows = len(x) - p
    lags = np.column_stack([np.ones(rows)] + [x[p - i - 1:len(x) - i - 1] for i in range(p)])
    beta, *_ = np.linalg.lstsq(lags, x[p:], rcond=None)
    residual = x[p:] - lags @ beta
    return float(beta[0]), beta[1:], float(residual @ residual / (rows - p - 1)), float(residual @ residual)


def _grid_of(spark, series_by_symbol):
    rows = [(s, dt.datetime(2026, 3, 20) + dt.timedelta(minutes=i), float(v)) for s, values in series_by_symbol.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, minute timestamp, price double")


def test_fit_equals_least_squares_and_order_is_chosen(spark):
    rng, made = np.random.default_rng(8), {}
    for name, lags in (("none", []), ("one", [0.6]), ("two", [0.5, -0.4])):
        x = np.zeros(1500)
        for i in range(2, len(x)):
            x[i] = 0.1 + sum(b * x[i - 1 - k] for k, b in enumerate(lags)) + rng.normal(0, 1)
        made[name] = 100 + np.cumsum(x)
    grid = _grid_of(spark, made | {"flat": [5.0] * 30, "short": [1.0, 2.0, 4.0]})
    for p in (0, 1, 3):
        for r in series.forecast_fit(grid, p=p).collect():
            if r["symbol"] in made:
                c, beta, sigma2, _ = fit_series(made[r["symbol"]], p, 1)
                assert (r["intercept"], r["sigma2"]) == pytest.approx((c, sigma2), rel=1e-8)
                assert r["coefficients"] == pytest.approx(beta.tolist(), rel=1e-8) and len(r["tail"]) == p + 1
            elif r["symbol"] == "flat":
                assert (r["intercept"], r["sigma2"], set(r["coefficients"])) == (0.0, 0.0, {0.0} if p else set())
            else:
                assert r["intercept"] == pytest.approx(1.5) and r["observations"] == 3
    chosen = {r["symbol"]: r["p"] for r in series.forecast_fit(grid, select=True).collect()}
    assert chosen["one"] >= 1 and chosen["two"] >= 2 and chosen["none"] <= 1
    table = {(r["symbol"], r["p"]): r["aic"] for r in series.order_table(grid).collect()}
    for p in range(4):  # all orders on the minutes that have three lags
        sse = fit_series(made["two"][3 - p:], p, 1)[3]
        assert table["two", p] == pytest.approx(1496 * np.log(sse / 1496) + 2 * (p + 1))


def test_seasons_are_found_and_put_back(spark):
    day = [10 + 3 * (h in (9, 10)) - 2 * (h == 20) for h in range(24)]
    values = [day[(i // 60) % 24] for i in range(3 * 1440)]
    grid = _grid_of(spark, {"A": values})
    effects = {r["phase"]: r["effect"] for r in series.seasonal_profile(grid).collect()}
    mean = sum(day) / 24
    assert effects == pytest.approx({h: day[h] - mean for h in range(24)})
    ahead = series.forecast_decomposed(grid.where("minute < timestamp '2026-03-22 08:50:00'"), steps=30).collect()
    values = {r["forecast_timestamp"].minute: r["forecast_value"] for r in ahead}
    assert values[55] == pytest.approx(10, abs=0.1) and values[10] == pytest.approx(13, abs=0.1)


def test_known_coefficients_are_found(spark):
    rng = np.random.default_rng(1)
    x = np.zeros(20000)
    noise = rng.normal(0, 0.5, len(x))
    for i in range(2, len(x)):
        x[i] = 0.3 + 0.5 * x[i - 1] - 0.2 * x[i - 2] + noise[i]
    row = series.forecast_fit(_grid_of(spark, {"A": np.cumsum(x)}), p=2).first()
    intercept, beta, sigma2 = row["intercept"], row["coefficients"], row["sigma2"]
    assert intercept == pytest.approx(0.3, abs=0.03)
    assert beta == pytest.approx([0.5, -0.2], abs=0.03)
    assert sigma2 == pytest.approx(0.25, abs=0.02)


def test_interval_covers_about_as_often_as_it_says(spark):
    """A random walk: the 0.9 interval holds about nine of ten future values."""
    rng = np.random.default_rng(2)
    hits = total = 0
    for _ in range(300):
        walk = np.cumsum(rng.normal(0, 1, 430))
        known, future = walk[:400], walk[400:]
        intercept, beta, sigma2, _ = fit_series(known, 1, 1)
        mean, error = series.extend_series(known[-2:], intercept, beta, sigma2, 1, 30)
        hits += np.sum(np.abs(future - mean) <= 1.6448536 * error)
        total += 30
    assert 0.85 < hits / total < 0.94


def test_forecast_shape_and_order(spark):
    trades = _minutes(spark, [10 + 0.5 * i for i in range(50)]).unionByName(_minutes(spark, [7.0] * 40, "B"))
    grid = series.minute_grid(series.minute_prices(trades))
    out = series.forecast(series.forecast_fit(grid)).collect()
    assert [r["symbol"] for r in out] == ["A"] * 30 + ["B"] * 30
    assert [r["step"] for r in out[:30]] == list(range(1, 31))
    assert out[0]["forecast_value"] == pytest.approx(35.0) and out[29]["forecast_value"] == pytest.approx(49.5)
    assert out[0]["forecast_timestamp"] - dt.timedelta(minutes=1) == dt.datetime(2026, 3, 25, 0, 49)
    assert all(r["lower_bound"] <= r["forecast_value"] <= r["upper_bound"] for r in out)
    drift = series.forecast_drift(grid).where("symbol = 'A' and step = 30").first()
    assert drift["forecast_value"] == pytest.approx(49.5)


def test_short_series_do_not_fail(spark):
    trades = _minutes(spark, [5.0]).unionByName(_minutes(spark, [1.0, 2.0], "B"))
    grid = series.minute_grid(series.minute_prices(trades))
    out = {(r["symbol"], r["step"]): r["forecast_value"] for r in series.forecast(series.forecast_fit(grid)).collect()}
    assert out["A", 30] == 5.0 and out["B", 1] == 3.0


def test_seasonal_baseline_goes_back_whole_seasons(spark):
    grid = series.minute_grid(series.minute_prices(_minutes(spark, range(10))))
    got = {r["step"]: r["forecast_value"] for r in series.forecast_seasonal(grid, steps=7, season=3).collect()}
    assert got == {1: 7.0, 2: 8.0, 3: 9.0, 4: 7.0, 5: 8.0, 6: 9.0, 7: 7.0}


def test_training_range(spark):
    trades = _minutes(spark, range(10))
    assert series.last_days(trades, "2026-03-25 00:05:00", 7).count() == 6


@pytest.fixture(scope="module")
def market(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 1774396800 + i, f"S{i % 2}", float(100 * (i % 2) + rng.normal(0, 1)), float(rng.gamma(2, 1))) for i in range(2000)]
    rows += [(5000, 1774400000, "S0", 500.0, 300.0)]
    df = spark.createDataFrame(rows, "id bigint, s bigint, symbol string, price double, volume double")
    return df.selectExpr("id", "timestamp_seconds(s) event_time", "symbol", "price", "volume")


def test_anomalies(spark, market):
    model = anomaly.anomaly_fit(market)
    cut = anomaly.anomaly_threshold(model, market, 0.02)
    flagged = anomaly.anomalies(model, market, cut).collect()
    assert len(flagged) == pytest.approx(0.02 * 2001, abs=2)
    times = [r["event_time"] for r in flagged]
    assert times == sorted(times, reverse=True)
    centres = anomaly.centroids(model, market).collect()
    assert len(centres) == 4 and sum(r["members"] for r in centres) == 2001
    # A symbol the model has not seen is scored, not refused.
    fresh = market.limit(1).withColumn("symbol", F.lit("NEW"))
    assert anomaly.with_distance(model, fresh).first()["distance"] > 0


def test_training_rows_are_computed_once(spark, market):
    model = anomaly.anomaly_fit(market)
    for step, times in ((anomaly.anomaly_fit, 1), (lambda rows: anomaly.anomaly_threshold(model, rows), 1),
                        (mixed_clusters.fit, 2)):  # once for the null check, once for the value
        seen = spark.sparkContext.accumulator(0)
        count = F.udf(lambda x: seen.add(1) or x, "double")
        step(market.withColumn("price", count("price")))
        assert 0 < seen.value <= times * market.count()


def test_zscore_finds_the_outlier(market):
    got = anomaly.anomaly_zscore(market, market, 10.0)
    assert [r["id"] for r in got.collect()] == [5000]


def test_risk_rule_and_model_fallback(spark):
    rows = spark.createDataFrame([(1, 60000.0, 11.0), (2, 60000.0, 10.0), (3, None, 11.0)], "id int, price double, volume double")
    rule = {r["id"]: r["prediction"] for r in scoring.score(rows).collect()}
    assert rule == {1: "warning", 2: "safe", 3: "unknown"}

    def model(x: pd.DataFrame) -> pd.Series:
        return pd.Series(["high" if p > 1 else None for p in x["price"].fillna(0)])

    assert {r["id"]: r["prediction"] for r in scoring.score(rows, model).collect()} == {1: "high", 2: "high", 3: "unknown"}


def test_retraining(spark, market, tmp_path):
    path, runs = str(tmp_path / "markers"), []
    assert scoring.retrain_if_due(market, path, "m", lambda: runs.append(1), threshold=1000)
    assert not scoring.retrain_if_due(market, path, "m", lambda: runs.append(1), threshold=1000)
    assert scoring.retrain_if_due(market, path, "other", lambda: runs.append(2), threshold=1000)

    def fails():
        raise RuntimeError("no model")

    bigger = market.unionByName(market)
    with pytest.raises(RuntimeError):
        scoring.retrain_if_due(bigger, path, "m", fails, threshold=1000)
    assert scoring.retrain_if_due(bigger, path, "m", lambda: runs.append(3), threshold=1000)
    assert runs == [1, 2, 3]


def test_context(spark, market):
    row = scoring.market_context(market, k=2, template="ticks: %s").first()
    ticks = json.loads(row["context"])
    assert [t["timestamp"] for t in ticks] == ["2026-03-25T00:53:20.000", "2026-03-25T00:33:19.000"]
    assert row["prompt"] == "ticks: " + row["context"]
    flagged = market.where("id = 5000").select("id")
    ticks = json.loads(scoring.market_context(market, k=2, flagged=flagged).first()["context"])
    assert [t["is_anomaly"] for t in ticks] == [True, False]


def test_mixed_clusters_equal_plain_rounds_on_a_dense_one_hot(spark):
    """From its own last centres, Lloyd's rounds on the written-out columns stay where the model is."""
    rng = np.random.default_rng(4)
    rows = [(i, f"S{rng.integers(6)}", float(rng.normal(10 * (i % 3), 1)), float(rng.exponential(2) + 5 * (i % 2))) for i in range(900)]
    rows += [(1000, None, 3.0, 4.0), (1001, "S1", None, 2.0)]
    df = spark.createDataFrame(rows, "id int, symbol string, price double, volume double")
    model = mixed_clusters.fit(df, k=5)
    assert model.settled and sum(model.members) == 901
    got = {r["id"]: (r["centroid_id"], r["distance"]) for r in mixed_clusters.with_distance(model, df.where("price is not null")).collect()}
    full = [r for r in rows if r[2] is not None]
    names = sorted({r[1] for r in full}, key=str)
    dense = np.array([[r[2], r[3], *(float(r[1] == s) for s in names)] for r in full])
    dense = dense / dense.std(axis=0, ddof=1)
    own = np.array([got[r[0]][0] for r in full])
    centres = np.array([dense[own == c].mean(axis=0) for c in range(5)])
    distance = np.sqrt(((dense[:, None, :] - centres[None]) ** 2).sum(axis=2))
    assert np.allclose(distance[np.arange(len(full)), own], [got[r[0]][1] for r in full])
    assert (distance.min(axis=1) >= distance[np.arange(len(full)), own] - 1e-9).all()


def test_mixed_clusters_of_few_rows(spark):
    df = spark.createDataFrame([(1, "A", 1.0, 1.0), (2, "A", 1.0, 1.0)], "id int, symbol string, price double, volume double")
    model = mixed_clusters.fit(df)
    assert sum(model.members) == 2 and {r["distance"] for r in mixed_clusters.with_distance(model, df).collect()} == {0.0}
    with pytest.raises(ValueError):
        mixed_clusters.fit(df.where("id > 5"))

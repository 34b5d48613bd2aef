"""Per-minute price series, drift baseline, autoregressive fit and forecast.

Ticks are first reduced to one price per symbol and minute, combined per task. What reaches a
window is bounded by the minutes of the training range (10,080 for 7 days), not
by the number of ticks.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import clock

def last_days(trades: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    return trades.where(clock.within(F.col("event_time"), as_of, days * 86400))


def minute_prices(trades: DataFrame, ident: str = "id") -> DataFrame:
    """Last price per symbol and minute by (event_time, id)."""
    minute = clock.bucket(F.col("event_time"), 60).alias("minute")
    return (
        trades.groupBy(minute, "symbol")
        .agg(F.max_by("price", clock.moment_key(trades, "event_time", ident)).alias("price"))
        .select("symbol", "minute", "price")
    )


def minute_grid(prices: DataFrame) -> DataFrame:
    """Every minute from the first to the last of each symbol, gaps filled with the last price.

    Each known minute is repeated up to the next known one, so the grid needs one window over the
    known minutes and no join.
    """
    after = F.lead("minute").over(Window.partitionBy("symbol").orderBy("minute"))
    gap = F.coalesce(F.col("_next") - F.expr("INTERVAL 1 MINUTE"), F.col("minute"))
    steps = F.sequence(F.col("minute"), gap, F.expr("INTERVAL 1 MINUTE"))
    return prices.withColumn("_next", after).select(
        "symbol",
        F.explode(steps).alias("at"),
        "price",
        F.col("minute").alias("_known"),
    ).select(
        "symbol", F.col("at").alias("minute"), "price", (F.col("at") != F.col("_known")).alias("filled")
    )


def forecast_drift(grid: DataFrame, steps: int = 30) -> DataFrame:
    """Straight-line baseline in closed form: regression of price on minutes since the start.

    Minutes are counted from the first one of the symbol; epoch seconds would lose digits.
    """
    first = F.min(F.unix_seconds("minute")).over(Window.partitionBy("symbol"))
    x = ((F.unix_seconds("minute") - first) / 60).alias("x")
    fit = grid.select("symbol", "minute", "price", x).groupBy("symbol").agg(
        F.regr_slope("price", "x").alias("slope"),
        F.regr_intercept("price", "x").alias("intercept"),
        F.max("x").alias("last_x"),
        F.max("minute").alias("last_minute"),
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(steps)))
    return fit.select("*", ahead.alias("step")).select(
        "symbol",
        "step",
        F.timestamp_seconds(F.unix_seconds("last_minute") + F.col("step") * 60).alias("forecast_timestamp"),
        (F.col("intercept") + F.col("slope") * (F.col("last_x") + F.col("step"))).alias("forecast_value"),
    )


def forecast_seasonal(grid: DataFrame, steps: int = 30, season: int = 1440) -> DataFrame:
    """Seasonal-naive baseline: the value one season earlier.

    A step beyond one season goes back by whole seasons until it falls on a known minute.
    """
    ends = grid.groupBy("symbol").agg(F.max("minute").alias("last_minute"))
    ahead = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    back = F.ceil(F.col("step") / season) * season
    target = F.unix_seconds("last_minute") + (F.col("step") - back) * 60
    wanted = ahead.select(
        "symbol",
        "step",
        F.timestamp_seconds(F.unix_seconds("last_minute") + F.col("step") * 60).alias("forecast_timestamp"),
        F.timestamp_seconds(target).alias("minute"),
    )
    return wanted.join(grid.select("symbol", "minute", F.col("price").alias("forecast_value")), ["symbol", "minute"]).drop("minute")


def lagged_moments(grid: DataFrame, p: int, d: int) -> DataFrame:
    """One row per symbol with the sums and cross products of the d-th difference and its ``p`` lags.

    Columns: ``n``, ``s0`` .. ``sp`` and ``s0_0`` .. ``sp_p``, over the minutes that have all lags, ``observations`` (all minutes),
    ``total`` and ``total2`` (sums over all differences, also those without lags), ``changes`` (their number) and ``last_minute``. The
    window is the only place where a symbol's minutes meet; the sums are combined per task.
    """
    order = Window.partitionBy("symbol").orderBy("minute")
    rows = grid.select("symbol", "minute", F.col("price").cast("double").alias("x0"))
    for _ in range(d):
        rows = rows.withColumn("x0", F.col("x0") - F.lag("x0").over(order))
    rows = rows.withColumns({f"x{i}": F.lag("x0", i).over(order) for i in range(1, p + 1)})
    whole = F.col(f"x{p}").isNotNull()
    at = [F.when(whole, F.col(f"x{i}")) for i in range(p + 1)]
    sums = [F.coalesce(F.sum(at[i]), F.lit(0.0)).alias(f"s{i}") for i in range(p + 1)]
    products = [F.coalesce(F.sum(at[i] * at[j]), F.lit(0.0)).alias(f"s{i}_{j}") for i in range(p + 1) for j in range(i, p + 1)]
    return rows.groupBy("symbol").agg(
        F.count(at[0]).alias("n"), *sums, *products, F.count("*").cast("int").alias("observations"), F.max("minute").alias("last_minute"),
        F.coalesce(F.sum("x0"), F.lit(0.0)).alias("total"), F.coalesce(F.sum(F.col("x0") * F.col("x0")), F.lit(0.0)).alias("total2"),
        F.count("x0").alias("changes"))


def solved(moments: DataFrame, p: int, most: int) -> DataFrame:
    """``moments`` of ``most`` lags with the least-squares fit of order ``p``: intercept, coefficients, sse.

    The normal equations of the centred lags are solved by elimination, written out in columns: there is one row per
    symbol. A lag that adds nothing to those before it, as in a constant series, has the coefficient 0.
    """
    n = F.col("n")

    def centred(i: int, j: int):
        i, j = min(i, j), max(i, j)
        return F.col(f"s{i}_{j}") - F.try_divide(F.col(f"s{i}") * F.col(f"s{j}"), n)

    width = range(1, p + 1)
    table = {f"_m{i}_{j}": F.coalesce(centred(i, j), F.lit(0.0)) for i in width for j in width}
    table |= {f"_y{i}": F.coalesce(centred(0, i), F.lit(0.0)) for i in width} | {f"_c{i}": F.coalesce(centred(0, i), F.lit(0.0)) for i in range(p + 1)}
    rows = moments.withColumns({k: v.alias(k) for k, v in table.items()})
    for k in width:
        pivot = F.col(f"_m{k}_{k}")
        # Beside what its own sum of squares was, a pivot of rounding errors is none.
        sound = pivot > 1e-12 * F.greatest(F.col(f"s{k}_{k}"), F.lit(1e-300))
        step = {}
        for i in range(k + 1, p + 1):
            ratio = F.when(sound, F.col(f"_m{i}_{k}") / pivot).otherwise(0.0)
            step |= {f"_m{i}_{j}": F.col(f"_m{i}_{j}") - ratio * F.col(f"_m{k}_{j}") for j in range(k, p + 1)}
            step[f"_y{i}"] = F.col(f"_y{i}") - ratio * F.col(f"_y{k}")
        rows = rows.withColumns(step | {f"_ok{k}": sound})
    for k in reversed(width):
        rest = F.col(f"_y{k}")
        for j in range(k + 1, p + 1):
            rest = rest - F.col(f"_m{k}_{j}") * F.col(f"_b{j}")
        rows = rows.withColumn(f"_b{k}", F.when(F.col(f"_ok{k}"), rest / F.col(f"_m{k}_{k}")).otherwise(0.0))
    sse, mean = F.col("_c0"), F.try_divide(F.col("s0"), n)
    for k in width:
        sse = sse - F.col(f"_b{k}") * F.col(f"_c{k}")
        mean = mean - F.col(f"_b{k}") * F.try_divide(F.col(f"s{k}"), n)
    coefficients = F.array(*[F.col(f"_b{k}") for k in width]) if p else F.array().cast("array<double>")
    return rows.select(*moments.columns, F.lit(p).alias("p"), F.coalesce(mean, F.lit(0.0)).alias("intercept"),
                       coefficients.alias("coefficients"), F.greatest(sse, F.lit(0.0)).alias("sse"))


def order_table(grid: DataFrame, most: int = 3, d: int = 1) -> DataFrame:
    """(symbol, p, sigma2, aic) for every order up to ``most``, all fitted on the same minutes, so that they compare."""
    moments = lagged_moments(grid, most, d)
    fits = [solved(moments, p, most) for p in range(most + 1)]
    out = fits[0]
    for fit in fits[1:]:
        out = out.unionByName(fit)
    n = F.col("n")
    return out.withColumns({
        "d": F.lit(d), "sigma2": F.col("sse") / F.greatest(n - F.col("p") - 1, F.lit(1)),
        "aic": n * F.log(F.greatest(F.try_divide(F.col("sse"), n), F.lit(1e-300))) + 2 * (F.col("p") + 1)})


def forecast_fit(grid: DataFrame, p: int = 3, d: int = 1, select: bool = False) -> DataFrame:
    """One model row per symbol: AR(p) with intercept on the d-th difference, by least squares.

    With ``select`` the order is the one up to ``p`` with the least AIC, the lower one of equals. A symbol with
    too few minutes gets the mean of its differences and no lags.
    """
    if select:
        fits = order_table(grid, p, d)
        best = F.row_number().over(Window.partitionBy("symbol").orderBy("aic", "p"))  # p + 1 rows each
        fitted = fits.withColumn("_rank", best).where("_rank = 1").drop("_rank", "aic")
    else:
        fitted = solved(lagged_moments(grid, p, d), p, p)
        fitted = fitted.withColumn("sigma2", F.col("sse") / F.greatest(F.col("n") - F.col("p") - 1, F.lit(1)))
    few = F.col("n") <= p + 1
    mean = F.coalesce(F.try_divide(F.col("total"), F.col("changes")), F.lit(0.0))
    spread = F.coalesce(F.try_divide(F.col("total2"), F.col("changes")), F.lit(0.0)) - mean * mean
    fitted = fitted.select(
        "symbol", "p", F.lit(d).alias("d"), F.when(few, mean).otherwise(F.col("intercept")).alias("intercept"),
        F.when(few, F.transform("coefficients", lambda _: F.lit(0.0))).otherwise(F.col("coefficients")).alias("coefficients"),
        F.when(few, F.greatest(spread, F.lit(0.0))).otherwise(F.col("sigma2")).alias("sigma2"), "observations", "last_minute")
    # The grid has every minute, so the last ones are found by their time.
    ends = fitted.select("symbol", F.col("last_minute").alias("_end"))
    recent = grid.join(ends, "symbol").where(F.unix_seconds("minute") > F.unix_seconds("_end") - 60 * (p + d))
    tail = recent.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("minute", F.col("price").cast("double").alias("price")))).alias("_t"))
    return fitted.join(tail.select("symbol", F.col("_t.price").alias("tail")), "symbol")


def seasonal_profile(grid: DataFrame, width: int = 3600, season: int = 86400) -> DataFrame:
    """(symbol, phase, effect, minutes): how far prices lie from their season's mean, by ``width`` seconds of the season.

    Seasons begin at multiples of ``season`` seconds; effects of a symbol add up to about 0.
    """
    second = F.unix_seconds("minute")
    cells = grid.groupBy("symbol", F.floor(second / season).alias("_season"), F.floor(F.pmod(second, F.lit(season)) / width).cast("int").alias("phase")).agg(
        F.sum("price").alias("_sum"), F.count("*").alias("_n"))
    whole = cells.groupBy("symbol", "_season").agg((F.sum("_sum") / F.sum("_n")).alias("_mean"))
    off = cells.join(whole, ["symbol", "_season"]).groupBy("symbol", "phase").agg(
        (F.sum(F.col("_sum") - F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("effect"), F.sum("_n").alias("minutes"))
    return off


def forecast_decomposed(grid: DataFrame, steps: int = 30, confidence: float = 0.9, most: int = 3, width: int = 3600, season: int = 86400) -> DataFrame:
    """Forecast of the prices without their seasonal effects, by the order that AIC chooses, with the effects put back."""
    profile = seasonal_profile(grid, width, season).select("symbol", "phase", "effect")
    phase = lambda at: F.floor(F.pmod(F.unix_seconds(at), F.lit(season)) / width).cast("int")
    flat = grid.withColumn("phase", phase("minute")).join(profile, ["symbol", "phase"])
    flat = flat.withColumn("price", F.col("price") - F.col("effect")).select(*grid.columns)
    ahead = forecast(forecast_fit(flat, most, select=True), steps, confidence).withColumn("phase", phase("forecast_timestamp"))
    shown = ahead.join(profile, ["symbol", "phase"], "left").withColumn("effect", F.coalesce("effect", F.lit(0.0)))
    moved = {c: F.col(c) + F.col("effect") for c in ("forecast_value", "lower_bound", "upper_bound")}
    return shown.withColumns(moved).drop("phase")


def extend_series(tail, intercept, coefficients, sigma2, d, steps) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and standard errors; errors from the weights of the moving-average form."""
    p = len(coefficients)
    levels = [np.diff(np.asarray(tail, float), n=k) for k in range(d + 1)]
    history = list(levels[d])
    out = []
    ends = [float(lv[-1]) for lv in levels[:d]]
    for _ in range(steps):
        step = intercept
        for i in range(min(p, len(history))):
            step += coefficients[i] * history[-1 - i]
        history.append(step)
        value = step
        for k in range(d - 1, -1, -1):
            ends[k] += value
            value = ends[k]
        out.append(value)
    psi = np.zeros(steps)
    psi[0] = 1.0
    for j in range(1, steps):
        psi[j] = sum(coefficients[i] * psi[j - 1 - i] for i in range(min(p, j)))
    for _ in range(d):
        psi = np.cumsum(psi)
    return np.asarray(out), np.sqrt(sigma2 * np.cumsum(psi**2))


def forecast(models: DataFrame, steps: int = 30, confidence: float = 0.9) -> DataFrame:
    """Forecast with interval for every model row, ordered by symbol and time."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for m in pdf.itertuples(index=False):
                mean, error = extend_series(m.tail, m.intercept, m.coefficients, m.sigma2, m.d, steps)
                yield pd.DataFrame(
                    {
                        "symbol": m.symbol,
                        "step": np.arange(1, steps + 1, dtype=np.int32),
                        "forecast_timestamp": m.last_minute + pd.to_timedelta(np.arange(1, steps + 1), unit="min"),
                        "forecast_value": mean,
                        "standard_error": error,
                        "confidence_level": confidence,
                        "lower_bound": mean - z * error,
                        "upper_bound": mean + z * error,
                    }
                )

    out = models.mapInPandas(
        extend,
        "symbol string, step int, forecast_timestamp timestamp, forecast_value double, standard_error double, "
        "confidence_level double, lower_bound double, upper_bound double",
    )
    return out.orderBy("symbol", "forecast_timestamp")

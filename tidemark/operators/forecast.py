"""Daily series: gap-free calendars, a seasonal-naive baseline, errors, and a Fourier regression.

The Fourier regression (trend, weekdays and yearly harmonics by least squares) is a model of its own; seasonal ARIMA
isn't part of this library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import exact_ratio, exact_round, fourier_terms


def daily_series(volume: DataFrame, fraud: DataFrame) -> DataFrame:
    """day, txns, fraud_txns and fraud_rate for every day between the first and the last, zero where there was nothing.

    ``volume`` (day, txns) and ``fraud`` (day, fraud_txns) may each lack days that the other has.
    """
    both = volume.join(fraud, "day", "full")
    calendar = both.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    out = calendar.join(both, "day", "left").select("day", F.coalesce("txns", F.lit(0)).cast("long").alias("txns"), F.coalesce("fraud_txns", F.lit(0)).cast("long").alias("fraud_txns"))
    return out.withColumn("fraud_rate", F.coalesce(exact_ratio(F.col("fraud_txns"), F.col("txns")), F.lit(0.0)))


def seasonal_naive(series: DataFrame, horizon: int, season: int = 7) -> DataFrame:
    """day and forecast for the last ``horizon`` days: the season before them, repeated."""
    end = series.agg(F.max("day").alias("end"))
    back = series.crossJoin(F.broadcast(end)).withColumn("i", horizon - 1 - F.datediff("end", "day"))
    test = back.where("i >= 0").select("day", "i", F.col("txns").alias("actual"))
    last = back.where(F.col("i").between(-season, -1)).select((F.col("i") + season).alias("slot"), F.col("txns").alias("forecast"))
    return test.join(F.broadcast(last), F.col("i") % season == F.col("slot"), "left").select("day", "actual", "forecast")


def errors(forecast: DataFrame, actual: str = "actual", predicted: str = "forecast") -> DataFrame:
    """mape (per cent, over days with a value) and mae."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return forecast.agg(exact_round(F.avg(F.when(a != 0, F.abs(a - p) / F.abs(a) * 100)), 3).alias("mape"), exact_round(F.avg(F.abs(a - p)), 3).alias("mae"))


def with_terms(series: DataFrame, orders: int) -> DataFrame:
    """Trend, weekday dummies and Fourier terms of the day's index."""
    t = F.datediff("day", F.lit("1970-01-01").cast("date"))
    dummies = [(F.weekday("day") == k).cast("double").alias(f"w{k}") for k in range(1, 7)]
    return series.select("*", (t / 365.25).alias("trend"), *dummies, *fourier_terms(t, orders))


Z95 = 1.959964


def _predicted(train: DataFrame, test: DataFrame, orders: int) -> DataFrame:
    """``test`` with forecast, lower and upper by least squares on ``train``: a 95 % interval by the residuals' deviation.

    The coefficients' own uncertainty is not in the interval.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    x, y = with_terms(train, orders), with_terms(test, orders)
    features = VectorAssembler(inputCols=[c for c in x.columns if c not in train.columns], outputCol="features")
    model = LinearRegression(regParam=1e-6, solver="normal").fit(features.transform(x).select("features", F.col("txns").cast("double").alias("label")))
    fit = model.summary
    spread = Z95 * (fit.meanSquaredError * fit.numInstances / max(1, fit.degreesOfFreedom)) ** 0.5
    p = F.col("prediction")
    return model.transform(features.transform(y)).select(*test.columns, p.alias("forecast"), (p - spread).alias("lower"), (p + spread).alias("upper"))


def fourier_forecast(series: DataFrame, horizon: int, orders: int = 5) -> DataFrame:
    """day, actual, forecast, lower and upper of the last ``horizon`` days by least squares on the days before."""
    x = series.select("day", "txns").crossJoin(F.broadcast(series.agg(F.max("day").alias("end"))))  # one row
    back = F.datediff("end", "day")
    return _predicted(x.where(back >= horizon), x.where(back < horizon), orders).select("day", F.col("txns").alias("actual"), "forecast", "lower", "upper")


def fourier_future(series: DataFrame, days: int = 28, orders: int = 5) -> DataFrame:
    """day, forecast, lower and upper of the ``days`` after the last, fitted anew on all of them."""
    future = series.agg(F.max("day").alias("end")).select(F.explode(F.sequence(F.date_add("end", 1), F.date_add("end", days))).alias("day"))
    return _predicted(series.select("day", "txns"), future, orders)


def sweep(series: DataFrame, horizon: int, orders: Sequence[int] = (3, 4, 5, 6, 8, 10)) -> DataFrame:
    """orders, mape and mae on the ``horizon`` days before the last ``horizon``: a window inside the training days."""
    end = series.agg(F.max("day").alias("end"))
    inner = series.crossJoin(F.broadcast(end)).where(F.datediff("end", "day") >= horizon).drop("end")
    out = None
    for k in orders:
        one = errors(fourier_forecast(inner, horizon, k)).select(F.lit(k).alias("orders"), "mape", "mae")
        out = one if out is None else out.unionAll(one)
    return out.orderBy("mape", "orders")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import conform, forecast, kpis, parity, scoring


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_velocity_counts_calendar_days(spark):
    rows = [("a", day(0), 10.0), ("a", day(0), 5.005), ("a", day(6), 1.0), ("a", day(7), 2.0), ("b", day(7), 9.0)]
    tx = spark.createDataFrame(rows, "cc_num_hash string, trans_date date, amt double")
    got = {(r["cc_num_hash"], r["trans_date"]): (r["txns_trailing_7d"], r["amt_trailing_7d"]) for r in kpis.card_velocity(tx).collect()}
    assert got["a", day(6)] == (3, 16.01)
    assert got["a", day(7)] == (2, 3.0)  # day 0 is out of the frame, though it is the row before the last but one
    assert got["b", day(7)] == (1, 9.0)


def test_merchants_below_the_volume_are_left_out(spark):
    rows = [("m", "c", 1.0, k % 2) for k in range(20)] + [("n", "c", 1.0, 1)] * 19
    got = kpis.merchant_risk(spark.createDataFrame(rows, "merchant string, category string, amt double, is_fraud int")).collect()
    assert [(r["merchant"], r["txns"], r["fraud_rate"]) for r in got] == [("m", 20, 0.5)]


def test_keep_latest_is_deterministic_on_ties(spark):
    rows = [("k", 1, "x"), ("k", 1, "y"), ("k", 0, "z"), (None, 3, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "key string, at int, v string")
    first = sorted(conform.keep_latest(df, ["key"], ["at"]).collect(), key=str)
    again = sorted(conform.keep_latest(df.orderBy(F.desc("v")).repartition(3), ["key"], ["at"]).collect(), key=str)
    assert first == again and len(first) == 2 and {r["v"] for r in first if r["key"] is None} == {"n"}


def test_reject_budget(spark):
    df = spark.createDataFrame([(None,)] * 9 + [("bad",)], "reject_reason string")
    assert conform.check_budget(df, 0.10) == pytest.approx(0.1)
    with pytest.raises(conform.RejectBudgetExceeded):
        conform.check_budget(df, 0.05)
    assert conform.check_budget(df.limit(0)) == 0


def test_drift_sees_nulls_and_missing_rows(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.005), (2, 2.0), (4, 4.5), (5, 5.0)], "k int, v double")
    assert sorted(r["k"] for r in parity.drift(a, b, ["k"], {"v": 0.01}).collect()) == [2, 3, 4, 5]
    assert parity.drift(a, a, ["k"], {"v": 0.0}).count() == 0


def test_lag_check(spark):
    now = dt.datetime(2024, 1, 1, 0, 10, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([("2024-01-01 00:05:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert parity.check_lag(df, "t", 5, now) == 5
    for bad in (df.limit(0), df):
        with pytest.raises(parity.Stale):
            parity.check_lag(bad, "t", 4, now)


def test_calendar_fills_days_missing_on_either_side(spark):
    volume = spark.createDataFrame([(day(0), 5), (day(3), 7)], "day date, txns long")
    fraud = spark.createDataFrame([(day(1), 1), (day(3), 2)], "day date, fraud_txns long")
    got = [tuple(r) for r in forecast.daily_series(volume, fraud).orderBy("day").collect()]
    assert got == [(day(0), 5, 0, 0.0), (day(1), 0, 1, 0.0), (day(2), 0, 0, 0.0), (day(3), 7, 2, 0.285714)]
    assert forecast.daily_series(volume.limit(0), fraud.limit(0)).count() == 0


def test_seasonal_naive_repeats_the_last_season(spark):
    s = spark.createDataFrame([(day(k), k % 7 + 10 * (k // 7)) for k in range(24)], "day date, txns long")
    got = [(r["actual"], r["forecast"]) for r in forecast.seasonal_naive(s, 10).orderBy("day").collect()]
    last = [k % 7 + 10 * (k // 7) for k in range(7, 14)]
    assert [p for _, p in got] == [*last, *last[:3]]
    assert [a for a, _ in got] == [k % 7 + 10 * (k // 7) for k in range(14, 24)]


def test_errors(spark):
    e = forecast.errors(spark.createDataFrame([(100, 90.0), (50, 60.0), (0, 5.0)], "actual long, forecast double")).first()
    assert (e["mape"], e["mae"]) == (15.0, 8.333)


def test_fourier_regression_follows_a_season(spark):
    import math

    s = spark.createDataFrame([(day(k), int(1000 + 200 * math.sin(2 * math.pi * k / 365.25) + 50 * (k % 7 == 0))) for k in range(800)], "day date, txns long")
    assert forecast.errors(forecast.fourier_forecast(s, 28, 2)).first()["mape"] < 2


def test_fourier_regression_is_least_squares(spark):
    """Forecasts, intervals and the refit against a solution by numpy."""
    import math

    import numpy as np

    rows = [(day(k), int(900 + 2 * k + 90 * math.sin(k / 58.0) + 40 * (k % 7 == 2) + (k * 7919) % 23)) for k in range(500)]
    s = spark.createDataFrame(rows, "day date, txns long")

    def terms(d):
        t = d.toordinal() - 719163
        angle = [2 * math.pi * k * t / 365.25 for k in (1, 2)]
        return [1.0, t / 365.25, *(float(d.weekday() == k) for k in range(1, 7)), *(f(a) for a in angle for f in (math.sin, math.cos))]

    def solve(train, days):
        x, y = np.array([terms(d) for d, _ in train]), np.array([float(n) for _, n in train])
        w = np.linalg.lstsq(x, y, rcond=None)[0]
        off = 1.959964 * math.sqrt(((y - x @ w) ** 2).sum() / (len(y) - x.shape[1]))
        return np.array([terms(d) for d in days]) @ w, off

    got = forecast.fourier_forecast(s, 56, 2).orderBy("day").collect()
    want, off = solve(rows[:-56], [d for d, _ in rows[-56:]])
    assert [r["day"] for r in got] == [d for d, _ in rows[-56:]] and [r["actual"] for r in got] == [n for _, n in rows[-56:]]
    assert np.allclose([r["forecast"] for r in got], want, rtol=1e-3) and np.allclose([r["upper"] - r["lower"] for r in got], 2 * off, rtol=1e-3)
    ahead = forecast.fourier_future(s, 28, 2).orderBy("day").collect()
    assert [r["day"] for r in ahead] == [day(500 + k) for k in range(28)]
    assert np.allclose([r["forecast"] for r in ahead], solve(rows, [r["day"] for r in ahead])[0], rtol=1e-3)


def separable(spark):
    rows = [(10.0 + k % 5, 5.0, "food", 12, 0) for k in range(400)] + [(900.0 + k, 80.0, "net", 2, 1) for k in range(40)]
    return spark.createDataFrame(rows, "amt double, distance_km double, category string, trans_hour int, is_fraud int")


def test_scorer_separates_and_survives_saving(spark, tmp_path):
    df = separable(spark)
    model = scoring.train(df, ["food", "net"])
    model.save(spark, f"file://{tmp_path}/model.json")
    loaded = scoring.Scorer.load(spark, f"file://{tmp_path}/model.json")
    rows = loaded.score(df).collect()
    assert min(r["fraud_probability"] for r in rows if r["is_fraud"]) > max(r["fraud_probability"] for r in rows if not r["is_fraud"])
    assert {r["decision"] for r in rows if r["is_fraud"]} <= {"REVIEW", "DECLINE"}
    one = loaded.score_one(spark, {"amt": 905.0, "distance_km": 80.0, "category": "net", "trans_hour": 2})
    same = [r["fraud_probability"] for r in rows if r["amt"] == 905.0][0]
    assert one["fraud_probability"] == same
    with pytest.raises(FileNotFoundError):
        scoring.Scorer.load(spark, f"file://{tmp_path}/none.json")


def test_features_of_incomplete_events(spark):
    df = spark.createDataFrame([(None, None, "2024-01-01T07:08:09"), (-5.0, "x", "junk")], "amt double, category string, event_ts string")
    got = [(r["log_amt"], r["distance"], r["hour"], r["category"]) for r in scoring.features(df).collect()]
    assert got == [(0.0, 0.0, 7.0, "unknown"), (0.0, 0.0, 0.0, "x")]


def test_ranking_quality_against_pairs(spark):
    data = [((k * 37 % 50) / 50, int(k * 7 % 11 == 0)) for k in range(300)]
    got = scoring.ranking_quality(spark.createDataFrame(data, "score double, is_fraud int")).first()
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-8)
    ap, before = 0.0, 0.0
    for s in sorted({s for s, _ in data}, reverse=True):
        k = [y for t, y in data if t >= s]
        ap += (sum(k) / len(pos) - before) * sum(k) / len(k)
        before = sum(k) / len(pos)
    assert got["average_precision"] == pytest.approx(ap, abs=1e-8)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import functions as f
from tidemark.sources.feeds import FEED_CATEGORIES


def one(spark, col, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, v if not isinstance(v, (str, int, float, type(None), dt.datetime, dt.date)) else F.lit(v))
    return df.select(col.alias("x")).first()["x"]


def test_rounding_ties_go_up_in_decimal(spark):
    assert one(spark, f.exact_round("v", 3), v=65.3175) == 65.318
    assert one(spark, f.exact_ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize(
    ("born", "at", "age"),
    [("1990-06-15", "2020-06-14 23:59:59", 29), ("1990-06-15", "2020-06-15 00:00:00", 30), ("1988-02-29", "2019-02-28 12:00:00", 31), ("not a date", "2020-01-01 00:00:00", None)],
)
def test_age_at_birthdays(spark, born, at, age):
    assert one(spark, f.age_years("b", F.col("t").cast("timestamp_ntz")), b=born, t=at) == age


def test_haversine_known_distance(spark):
    assert one(spark, f.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278))) == pytest.approx(343.556, abs=0.01)
    assert one(spark, f.haversine_km(F.lit(1.0), F.lit(2.0), F.lit(1.0), F.lit(2.0))) == 0.0
    assert one(spark, f.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(20015.115, abs=0.01)


def test_masking_needs_a_salt(spark):
    with pytest.raises(ValueError, match="salt"):
        f.card_hash("pan", "")
    assert one(spark, f.card_last4("pan"), pan=4000000000001234) == "1234"
    a, b = one(spark, f.card_hash("pan", "x"), pan=1), one(spark, f.card_hash("pan", "y"), pan=1)
    assert len(a) == 64 and a != b


GOOD = {"trans_num": "0" * 32, "trans_time": dt.datetime(2024, 1, 1), "amt": 1.0, "category": "click", "is_fraud": 0, "merch_lat": 0.0, "merch_long": 0.0}


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"trans_num": None}, "invalid_trans_num"),
        ({"trans_num": "F" * 32}, "invalid_trans_num"),
        ({"trans_time": None}, "missing_timestamp"),
        ({"amt": None}, "non_positive_amount"),
        ({"amt": 0.0}, "non_positive_amount"),
        ({"amt": 30000.0}, None),
        ({"amt": 30000.01}, "implausible_amount"),
        ({"amt": float("nan")}, "implausible_amount"),
        ({"category": "other"}, "invalid_category"),
        ({"category": None}, None),
        ({"is_fraud": 2}, "invalid_is_fraud_flag"),
        ({"is_fraud": None}, "invalid_is_fraud_flag"),
        ({"merch_lat": 90.1}, "invalid_merchant_coordinates"),
        ({"merch_long": None}, "invalid_merchant_coordinates"),
        ({"trans_num": "x", "amt": -1.0}, "invalid_trans_num"),
    ],
)
def test_first_rule_wins(spark, change, reason):
    schema = "trans_num string, trans_time timestamp_ntz, amt double, category string, is_fraud int, merch_lat double, merch_long double"
    row = GOOD | change
    df = spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema)
    assert df.select(f.reject_reason(FEED_CATEGORIES)).first()[0] == reason


def test_bands_and_buckets(spark):
    got = [one(spark, f.banding(F.lit(p), 0.5, 0.9)) for p in (0.9, 0.5, 0.4999)]
    assert got == ["DECLINE", "REVIEW", "APPROVE"]
    lags = [one(spark, f.freshness_status(F.lit(x).cast("long"))) for x in (-5, 86400, 86401, 259200, 259201, None)]
    assert lags == ["fresh", "fresh", "stale", "stale", "breached", "breached"]
    assert [one(spark, f.present_tier(F.lit(c).cast("string"))) for c in ("online", "in_person", "other", None)] == ["card_not_present", "card_present", "general", "general"]
    assert one(spark, f.weekday_name(F.lit("2024-01-01").cast("date"))) == "Monday"
    assert one(spark, f.strip_prefix(F.lit("fraud_x"), "fraud_")) == "x"
    assert one(spark, f.day_ordinal(F.lit("1970-01-02").cast("date"))) == 1


def test_compact_numbers(spark):
    from tidemark.functions import compact_number

    want = {0.0: "0", 999.0: "999", 1000.0: "1K", 1234.0: "1.23K", 100000.0: "100K", 1234567.0: "1.23M", -2500000.0: "-2.5M", 7e9: "7B", 1.5e12: "1,500B".replace(",", "")}
    got = {r["v"]: r["s"] for r in spark.createDataFrame([(v,) for v in want], "v double").select("v", compact_number("v").alias("s")).collect()}
    assert got == want
    assert spark.range(1).select(compact_number(F.lit(None).cast("double")).alias("s")).first()["s"] is None

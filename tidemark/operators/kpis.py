"""Fraud and volume figures by hour, state, card, merchant and distance, and what reports derive from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import day_ordinal, exact_avg, exact_ratio, exact_round, exact_share, exact_sum, hour_bucket, weekday_name

MIN_MERCHANT_TXNS = 20


def _txns() -> Column:
    return F.count(F.lit(1)).alias("txns")


def _fraud() -> Column:
    return F.coalesce(F.sum(F.coalesce(F.col("is_fraud"), F.lit(0))), F.lit(0)).cast("long").alias("fraud_txns")


def _rate(places: int = 6) -> Column:
    return exact_ratio(F.col("fraud_txns"), F.col("txns"), places).alias("fraud_rate")


def category_hourly_fraud(tx: DataFrame) -> DataFrame:
    out = tx.groupBy(hour_bucket("trans_time").alias("trans_hour_ts"), "category").agg(_txns(), _fraud(), exact_sum("amt").alias("total_amt"), exact_avg("amt").alias("avg_amt"))
    return out.withColumn("fraud_rate", _rate())


def state_hourly_volume(tx: DataFrame) -> DataFrame:
    return tx.groupBy(hour_bucket("trans_time").alias("trans_hour_ts"), "state").agg(_txns(), exact_sum("amt").alias("total_amt"), exact_avg("amt").alias("avg_amt"))


def card_daily(tx: DataFrame) -> DataFrame:
    return tx.groupBy("cc_num_hash", "trans_date").agg(F.count(F.lit(1)).alias("txns_that_day"), exact_sum("amt").alias("amt_that_day"), exact_round(F.max("amt"), 2).alias("max_amt_that_day"))


def card_velocity(tx: DataFrame, days: int = 7) -> DataFrame:
    """Each card's days with sums over the trailing calendar days: days without transactions count as days."""
    frame = W.partitionBy("cc_num_hash").orderBy(day_ordinal("trans_date")).rangeBetween(-(days - 1), 0)
    total = F.sum(F.col("amt_that_day").cast("decimal(18,2)")).over(frame).cast("double")
    return card_daily(tx).withColumns({f"txns_trailing_{days}d": F.sum("txns_that_day").over(frame), f"amt_trailing_{days}d": total})


def merchant_risk(tx: DataFrame, least: int = MIN_MERCHANT_TXNS) -> DataFrame:
    out = tx.groupBy("merchant", "category").agg(_txns(), _fraud(), exact_sum("amt").alias("total_amt")).where(F.col("txns") >= least)
    return out.withColumn("fraud_rate", _rate())


def distance_profile(tx: DataFrame, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Distances by fraud flag: mean and percentiles, approximate by default (bounded state) or exact."""
    d = F.col("distance_km")
    p = (lambda q: F.expr(f"percentile_disc({q}) within group (order by distance_km)")) if exact else (lambda q: F.percentile_approx(d, q, accuracy))
    return tx.groupBy("is_fraud").agg(_txns(), exact_avg3(d).alias("avg_distance_km"), *(exact_round(p(q / 100), 3).alias(f"p{q}_distance_km") for q in (50, 90, 99)))


def exact_avg3(x: Column) -> Column:
    """The mean of figures of three decimals."""
    return exact_round(F.sum(x.cast("decimal(18,3)")).cast("double") / F.count(x), 3)


def state_shares(tx: DataFrame) -> DataFrame:
    """State volume an hour with its share of the hour."""
    out = tx.groupBy("trans_date", "trans_hour", "state").agg(_txns(), exact_sum("amt").alias("total_amt"), exact_avg("amt").alias("avg_amt"))
    whole = F.sum("txns").over(W.partitionBy("trans_date", "trans_hour"))
    return out.withColumn("txn_share_pct", exact_share(F.col("txns"), whole))


def category_summary(tx: DataFrame) -> DataFrame:
    """Each category's totals and shares of the grand total, which is one row joined on, not a window over everything."""
    out = tx.groupBy("category").agg(_txns(), _fraud(), exact_sum("amt").alias("total_amt"), exact_avg("amt").alias("avg_amt"), F.min("trans_time").alias("first_txn"), F.max("trans_time").alias("last_txn"))
    total = out.agg(F.sum("txns").alias("__t"), F.sum(F.col("total_amt").cast("decimal(18,2)")).cast("double").alias("__a"))
    out = out.crossJoin(F.broadcast(total))  # one row
    return out.select("category", "txns", "fraud_txns", "total_amt", "avg_amt", "first_txn", "last_txn", exact_share(F.col("txns"), F.col("__t")).alias("txn_share_pct"), exact_share(F.col("total_amt"), F.col("__a")).alias("amt_share_pct"))


def rollup(tx: DataFrame, *by: Column | str, rate_places: int | None = 6, average: bool = False) -> DataFrame:
    """Counts, fraud, total and rate by any columns: extracts by date, category, state, hour or weekday."""
    out = tx.groupBy(*by).agg(_txns(), _fraud(), exact_sum("amt").alias("total_amt"), *([exact_avg("amt").alias("avg_amt")] if average else []))
    return out.withColumn("fraud_rate", _rate(rate_places or 8))


def by_weekday(tx: DataFrame) -> DataFrame:
    """Monday to Sunday."""
    d = F.col("trans_date")
    return rollup(tx, F.weekday(d).alias("weekday_no"), weekday_name(d).alias("weekday")).orderBy("weekday_no")


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """Days from the hourly category table: sums of counts and of rounded totals."""
    out = hourly.groupBy(F.to_date("trans_hour_ts").alias("day")).agg(F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"), F.sum(F.col("total_amt").cast("decimal(18,2)")).cast("double").alias("total_amt"))
    return out.withColumn("fraud_rate", _rate())


def kpi_tiles(tx: DataFrame, rejected: DataFrame) -> DataFrame:
    out = tx.agg(_txns(), _fraud(), exact_sum("amt").alias("total_amt"), F.count_distinct("cc_num_hash").alias("cards"), F.count_distinct("merchant").alias("merchants"))
    out = out.crossJoin(F.broadcast(rejected.agg(F.count("*").alias("quarantined"))))
    return out.withColumns({"fraud_rate": _rate(), "quarantine_share": exact_ratio(F.col("quarantined"), F.col("quarantined") + F.col("txns"))})


def hourly_top_categories(hourly: DataFrame, n: int = 3) -> DataFrame:
    """Hours of the ``n`` categories with the most transactions."""
    top = hourly.groupBy("category").agg(F.sum("txns").alias("t")).orderBy(F.desc("t"), "category").limit(n).select("category")
    return hourly.join(F.broadcast(top), "category", "left_semi").groupBy("trans_hour_ts", "category").agg(F.sum("txns").alias("txns"))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows: each task keeps n."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, skip: int, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).offset(skip).limit(n)

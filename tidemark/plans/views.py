"""Staging: views over published tables with fixed columns, so that marts are written as SQL over known names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# The columns that SQL over the views may name.
VIEWS = {
    "stg_transactions": (
        "trans_num", "trans_time", "cast(trans_date as date) as trans_date", "trans_hour", "cc_num_last4", "cc_num_hash", "merchant", "category", "channel", "amt", "gender", "city", "state", "zip",
        "city_pop", "job", "cardholder_age", "merch_lat", "merch_long", "distance_km", "is_fraud", "merch_zipcode", "batch_id", "ingested_at",
    ),
    "stg_dim_category": ("category", "channel"),
    "stg_merchant_risk": ("merchant", "category", "txns", "fraud_txns", "total_amt", "fraud_rate"),
    "stg_spark_category_hourly_fraud": ("trans_hour_ts", "category", "txns", "fraud_txns", "total_amt", "avg_amt", "fraud_rate"),
    "stg_spark_state_hourly_volume": ("trans_hour_ts", "state", "txns", "total_amt", "avg_amt"),
}


def stage(tables: Mapping[str, DataFrame]) -> None:
    """Each table (by the name of its view) as a temporary view of the view's columns; other columns are left out."""
    for name, table in tables.items():
        table.selectExpr(*VIEWS[name]).createOrReplaceTempView(name)

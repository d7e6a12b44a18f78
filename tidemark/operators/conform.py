"""From the raw feed to conformed transactions: types, masking, derived columns, quarantine, one row a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import age_years, card_hash, card_last4, day, haversine_km, reject_reason
from ..sources.feeds import renamed

# The published columns in their order.
SILVER = (
    "trans_num", "trans_time", "trans_date", "trans_hour", "unix_time", "cc_num_last4", "cc_num_hash", "merchant", "category", "channel", "amt", "gender", "city", "state", "zip", "city_pop", "job", "cardholder_age",
    "merch_lat", "merch_long", "distance_km", "is_fraud", "merch_zipcode", "source_file", "source_split", "batch_id", "ingested_at",
)
QUARANTINE = ("trans_num", "reject_reason", "trans_time", "amt", "category", "source_file", "batch_id", "ingested_at")
PERSONAL = ("first", "last", "street", "lat", "long", "dob", "cc_num")


class RejectBudgetExceeded(Exception):
    """More rows were rejected than the caller allows."""


def conform(feed: DataFrame, salt: str) -> DataFrame:
    """Masked and enriched rows, without personal columns. One projection: nothing is shuffled.

    A time that can't be read becomes null, which the quarantine rules see, and stops no job.
    """
    feed = renamed(feed)
    time = F.col("trans_time") if dict(feed.dtypes)["trans_time"].startswith("timestamp") else F.try_to_timestamp("trans_time")
    feed = feed.withColumn("trans_time", time.cast("timestamp_ntz"))
    out = feed.withColumns(
        {
            "cc_num_last4": card_last4("cc_num"),
            "cc_num_hash": card_hash("cc_num", salt),
            "cardholder_age": age_years("dob", "trans_time"),
            "distance_km": haversine_km("lat", "long", "merch_lat", "merch_long"),
            "trans_date": day("trans_time"),
            "trans_hour": F.hour("trans_time"),
        }
    )
    return out.drop(*(c for c in PERSONAL if c in out.columns))


def classify(conformed: DataFrame, categories: Sequence[str]) -> DataFrame:
    return conformed.withColumn("reject_reason", reject_reason(categories))


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined)."""
    good = classified.where("reject_reason is null").drop("reject_reason")
    return good, classified.where("reject_reason is not null")


def reject_counts(classified: DataFrame) -> DataFrame:
    """reject_reason and its rows, the most first; the quarantine's histogram."""
    return classified.where("reject_reason is not null").groupBy("reject_reason").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "reject_reason")


def check_budget(classified: DataFrame, most: float = 0.10) -> float:
    """The rejected share; raises if it exceeds ``most``. One pass for both counts."""
    n, bad = classified.agg(F.count("*"), F.count("reject_reason")).first()
    share = bad / max(1, n)
    if share > most:
        raise RejectBudgetExceeded(f"{bad} of {n} rows rejected, at most {most:.0%} allowed")
    return share


def keep_latest(df: DataFrame, keys: Sequence[str], latest_first: Sequence[str]) -> DataFrame:
    """One row a key: the largest by ``latest_first``, ties by a hash of the whole row, so that reruns agree.

    Spark limits each task to one row a key before the shuffle, so a hot key is one row a task.
    """
    order = [*(F.col(c).desc_nulls_last() for c in latest_first), F.xxhash64(*df.columns).desc()]
    ranked = df.select("*", F.row_number().over(W.partitionBy(*keys).orderBy(*order)).alias("__rank"))
    return ranked.where("__rank = 1").drop("__rank")


def enrich(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Left outer join with a dimension; rows without a partner keep nulls. Spark broadcasts it if its size allows."""
    return df.join(ref, key, "left")

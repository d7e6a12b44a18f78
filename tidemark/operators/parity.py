"""Comparisons of tables: aggregates made twice, orphans, duplicate keys, totals, freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import freshness_status, seconds_between


def drift(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerances: dict[str, float]) -> DataFrame:
    """Rows that stand on one side only or differ by more than a tolerance, null against a value included."""
    x = a.select(*keys, F.lit(True).alias("in_a"), *(F.col(c).alias(f"{c}_a") for c in tolerances))
    y = b.select(*keys, F.lit(True).alias("in_b"), *(F.col(c).alias(f"{c}_b") for c in tolerances))
    both = x.join(y, list(keys), "full")
    off = F.col("in_a").isNull() | F.col("in_b").isNull()
    for c, most in tolerances.items():
        u, v = F.col(f"{c}_a"), F.col(f"{c}_b")
        off = off | (u.isNull() != v.isNull()) | F.coalesce(F.abs(u - v) > most, F.lit(False))
    return both.where(off)


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys without a row in the dimension, and how often they occur."""
    return df.join(dimension, key, "left_anti").groupBy(key).agg(F.count("*").alias("rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def totals_differ(a: DataFrame, b: DataFrame, column: str, tolerance: float = 1.0) -> DataFrame:
    """One row if the sums differ by more than ``tolerance``, else none. Each side is one row."""
    total = lambda df, name: df.agg(F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(name))
    return total(a, "total_a").crossJoin(total(b, "total_b")).where(F.abs(F.coalesce(F.col("total_a"), F.lit(0.0)) - F.coalesce(F.col("total_b"), F.lit(0.0))) > tolerance)


def freshness(tables: dict[str, tuple[DataFrame, str | None]], as_of: datetime | str) -> DataFrame:
    """For each table its rows, latest time, seconds since then and status; the longest lag first. A table without a time
    column has no status."""
    out = None
    for name, (df, column) in tables.items():
        latest = F.max(F.col(column).cast("timestamp_ntz")) if column else F.max(F.lit(None).cast("timestamp_ntz"))
        one = df.agg(F.count("*").alias("row_count"), latest.alias("latest")).select(F.lit(name).alias("table_name"), "row_count", "latest", F.lit(column is None).alias("na"))
        out = one if out is None else out.unionAll(one)
    lag = seconds_between("latest", F.lit(str(as_of)).cast("timestamp_ntz"))
    out = out.withColumn("lag_seconds", lag)
    return out.withColumn("status", F.when(F.col("na"), "n/a").otherwise(freshness_status("lag_seconds"))).drop("na").orderBy(F.desc_nulls_last("lag_seconds"), "table_name")


class Stale(Exception):
    pass


def check_lag(windows: DataFrame, column: str, most_minutes: float, now: datetime) -> float:
    """Minutes since the latest window's end; raises Stale beyond ``most_minutes`` and on an empty table."""
    latest = windows.agg(F.max(F.col(column).cast("timestamp")).cast("double").alias("t")).first()["t"]
    if latest is None:
        raise Stale("no windows")
    lag = (now.timestamp() - latest) / 60
    if lag > most_minutes:
        raise Stale(f"latest window is {lag:.1f} minutes old, at most {most_minutes:g}")
    return lag

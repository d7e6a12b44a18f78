"""The figures of a dashboard, each a small table, as JSON and as a page."""

from __future__ import annotations

import html
import json
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import compact_number, exact_round, exact_sum
from ..operators import conform, kpis, parity


def figures(tx: DataFrame, rejected: DataFrame, as_of: datetime | str, decisions: DataFrame | None = None, windows: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables by name. Each has a row a category, state, day, reason or decision, or a stated number of rows."""
    hourly = kpis.category_hourly_fraud(tx)
    out = {
        "tiles": kpis.kpi_tiles(tx, rejected).withColumns({"txns_text": compact_number("txns"), "total_amt_text": compact_number("total_amt")}),
        "categories": kpis.category_summary(tx).orderBy(F.desc("txns"), "category"),
        "merchants": kpis.top(kpis.merchant_risk(tx).withColumn("fraud_rate_pct", exact_round(F.col("fraud_rate") * 100, 2)), 12, F.desc("fraud_rate"), F.desc("txns"), "merchant", "category"),
        "states": kpis.top(tx.groupBy("state").agg(F.count("*").alias("txns"), exact_sum("amt").alias("total_amt")), 12, F.desc("total_amt"), "state"),
        "daily": kpis.daily_from_hourly(hourly).orderBy("day"),
        "hourly_top_categories": kpis.top(kpis.hourly_top_categories(hourly), 3000, "trans_hour_ts", "category"),
        "freshness": parity.freshness({"transactions": (tx, "trans_time"), "transactions_quarantine": (rejected, None)}, as_of),
        "quarantine": conform.reject_counts(rejected),
    }
    if decisions is not None:
        out["decisions"] = decisions.groupBy("decision").agg(F.count("*").alias("txns")).orderBy("decision")
    if windows is not None:
        out["windows"] = kpis.top(windows, 20, F.desc("window_start"), "category")
    return out


def collect(tables: dict[str, DataFrame]) -> dict[str, list[dict]]:
    return {name: [r.asDict() for r in df.collect()] for name, df in tables.items()}


def as_json(rows: dict[str, list[dict]]) -> str:
    return json.dumps(rows, default=str, indent=1)


def as_page(rows: dict[str, list[dict]], title: str = "Transactions") -> str:
    """One HTML page without scripts: a table for each figure."""
    parts = [f"<!doctype html><html lang=en><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, table in rows.items():
        parts.append(f"<h2>{html.escape(name.replace('_', ' '))}</h2>")
        if not table:
            parts.append("<p>no rows</p>")
            continue
        cells = lambda row, tag: "".join(f"<{tag}>{'' if x is None else html.escape(str(x))}</{tag}>" for x in row)
        parts.append(f"<table><tr>{cells(table[0], 'th')}</tr>" + "".join(f"<tr>{cells(r.values(), 'td')}</tr>" for r in table) + "</table>")
    return "\n".join(parts) + "</html>\n"

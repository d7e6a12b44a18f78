"""Command line: ``python -m tidemark.cli COMMAND``. Every step reads what the one before it published."""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from . import session
from .contracts import enforce, load_contracts, results_frame, summarize, validate, write_report
from .operators import conform, kpis, parity, scoring
from .plans import dashboard as board
from .sources import download, feeds
from .sources.tables import Files, Table, export, reconcile
from .streaming import events


def _table(spark: SparkSession, args: argparse.Namespace, name: str) -> Table:
    return Table(spark, f"{args.root}/{name}")


def bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    out = None
    for split in ("train", "test"):
        raw = feeds.with_lineage(feeds.read_csv(spark, f"{args.input}/{split}*.csv"), split, split, args.batch_id)
        out = raw if out is None else out.unionByName(raw)
    _table(spark, args, "bronze/transactions_raw").publish(out, _audit(args, "bronze_transactions"))
    _table(spark, args, "bronze/category_ref_raw").publish(feeds.read_csv(spark, f"{args.input}/category*.csv", feeds.CATEGORY_REF), _audit(args, "bronze_category_ref"))


def _audit(args: argparse.Namespace, name: str):
    if not args.contracts or name not in load_contracts(args.contracts):
        return None
    return lambda df: enforce(df, name, args.contracts)


def silver(spark: SparkSession, args: argparse.Namespace) -> None:
    salt = os.environ.get("TIDEMARK_SALT")
    if not salt:
        raise SystemExit("set TIDEMARK_SALT to the secret that card numbers are hashed with")
    ref = _table(spark, args, "bronze/category_ref_raw").read()
    names = [r["category"] for r in ref.select("category").distinct().collect()]
    raw = _table(spark, args, "bronze/transactions_raw").read()
    classified = conform.classify(conform.conform(raw, salt), names).persist()
    try:
        conform.check_budget(classified, args.reject_budget)
        good, bad = conform.split(classified)
        good = conform.enrich(conform.keep_latest(good, ["trans_num"], ["ingested_at", "batch_id"]), ref, "category")
        good = good.withColumn("merch_zipcode", F.col("merch_zipcode").cast("int"))
        _table(spark, args, "silver/transactions").publish(good.select(*conform.SILVER), _audit(args, "silver_transactions"))
        _table(spark, args, "silver/transactions_quarantine").publish(bad.select(*conform.QUARANTINE))
        _table(spark, args, "silver/dim_category").publish(ref, _audit(args, "silver_dim_category"))
    finally:
        classified.unpersist()


GOLD = {
    "category_hourly_fraud": kpis.category_hourly_fraud,
    "state_hourly_volume": kpis.state_hourly_volume,
    "card_velocity": kpis.card_velocity,
    "merchant_risk_leaderboard": kpis.merchant_risk,
    "geo_distance_anomaly": kpis.distance_profile,
}


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    tx = _table(spark, args, "silver/transactions").read()
    for name, make in GOLD.items():
        _table(spark, args, f"gold/{name}").publish(make(tx), _audit(args, f"gold_{name}"))


def export_all(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = {"transactions": (_table(spark, args, "silver/transactions").read(), "trans_time", False)}
    for name in GOLD:
        tables[name] = (_table(spark, args, f"gold/{name}").read(), None, False)
    tables["quarantine_reasons"] = (conform.reject_counts(_table(spark, args, "silver/transactions_quarantine").read()), None, False)
    export(spark, tables, f"{args.root}/curated")
    print(json.dumps(reconcile(spark, f"{args.root}/curated")))


def produce(spark: SparkSession, args: argparse.Namespace) -> None:
    sent = events.replay(_table(spark, args, "silver/transactions").read())
    send = (lambda df: events.kafka_sink(df, args.kafka, args.topic)) if args.kafka else (lambda df: df.write.mode("append").json(f"{args.root}/stream/in"))
    print(json.dumps({"delivered": events.deliver(sent, send, args.pace)}))


def _source(spark: SparkSession, args: argparse.Namespace):
    return events.kafka_source(spark, args.kafka, args.topic) if args.kafka else events.file_source(spark, f"{args.root}/stream/in")


def consume(spark: SparkSession, args: argparse.Namespace) -> None:
    accounts = events.Accounts()
    spark.streams.addListener(accounts)
    query = events.start_metrics(_source(spark, args), events.window_table(spark, f"{args.root}/stream/txn_metrics_1m"), f"{args.root}/checkpoints/metrics", _audit(args, "stream_txn_metrics_1m"), {"availableNow": True} if args.once else None)
    events.run_for(query, 0 if args.once else args.seconds)
    a = accounts.of(query)
    print(json.dumps(a.__dict__ | {"counted": a.counted}))


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    tx = _table(spark, args, "silver/transactions").read().where("source_split = 'train'")
    names = sorted(r["category"] for r in tx.select("category").distinct().collect() if r["category"])
    scoring.train(tx, names).save(spark, f"{args.root}/models/scorer.json")


def score_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    scorer = scoring.Scorer.load(spark, f"{args.root}/models/scorer.json")
    query = events.start_scoring(_source(spark, args), scorer, events.decision_table(spark, f"{args.root}/stream/txn_decisions"), f"{args.root}/checkpoints/decisions", _audit(args, "stream_txn_decisions"), {"availableNow": True} if args.once else None)
    events.run_for(query, 0 if args.once else args.seconds)


def stream_check(spark: SparkSession, args: argparse.Namespace) -> None:
    print(parity.check_lag(events.window_table(spark, f"{args.root}/stream/txn_metrics_1m").read(), "window_end", args.minutes, datetime.now(timezone.utc)))


def contracts(spark: SparkSession, args: argparse.Namespace) -> None:
    for c in load_contracts(args.contracts).values():
        print(c.name, c.mode, len(c.all_checks), "checks")


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    for step in (bronze, silver, gold, export_all):
        step(spark, args)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(download.fetch_all(json.loads(args.urls), args.input, args.force), indent=1))


def summary(spark: SparkSession, args: argparse.Namespace) -> None:
    """Validate every published table that has a contract, and sum up."""
    reports = []
    for c in load_contracts(args.contracts).values():
        layer, _, name = c.dataset.partition(".")
        table = _table(spark, args, f"{layer}/{name}")
        if table.current() is not None:
            reports.append(validate(table.read(), replace(c, mode="warn"), examples=0))
            write_report(reports[-1], args.reports)
    for row in summarize(results_frame(spark, reports)).orderBy("contract").collect():
        print(json.dumps(row.asDict()))


def dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    """The published tables' figures as JSON and as a page, beside the tables."""
    tx, rejected = (_table(spark, args, f"silver/{name}").read() for name in ("transactions", "transactions_quarantine"))
    decisions, windows = events.decision_table(spark, f"{args.root}/stream/txn_decisions"), events.window_table(spark, f"{args.root}/stream/txn_metrics_1m")
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    rows = board.collect(board.figures(tx, rejected, now, *(t.read() if t.current() is not None else None for t in (decisions, windows))))
    files = Files(spark, args.root)
    files.write(f"{args.root}/dashboard/data.json", board.as_json(rows))
    files.write(f"{args.root}/dashboard/index.html", board.as_page(rows))


COMMANDS = {"dashboard": dashboard, "ingest": ingest, "summary": summary, "bronze": bronze, "silver": silver, "gold": gold, "export": export_all, "batch": batch, "produce": produce, "consume": consume, "train": train, "score-stream": score_stream, "stream-check": stream_check, "contracts": contracts}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--root", default="lake", help="folder or store of the tables")
    p.add_argument("--input", default="input", help="folder of the CSV feed")
    p.add_argument("--contracts", default="", help="folder of contract YAML")
    p.add_argument("--batch-id", default="manual")
    p.add_argument("--reject-budget", type=float, default=0.10)
    p.add_argument("--kafka", default="", help="bootstrap servers; files are used without")
    p.add_argument("--topic", default="transactions")
    p.add_argument("--seconds", type=float, default=120)
    p.add_argument("--pace", type=float, default=0, help="produce in slices of so many seconds, by the clock; 0: at once")
    p.add_argument("--minutes", type=float, default=10)
    p.add_argument("--urls", default="{}", help="JSON of file names and addresses to download")
    p.add_argument("--force", action="store_true", help="download again what is there")
    p.add_argument("--reports", default="reports", help="folder of contract reports")
    p.add_argument("--once", action="store_true", help="take what is there, then end")
    args = p.parse_args(argv)
    COMMANDS[args.command](session.create(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

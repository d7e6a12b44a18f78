import json

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import ContractViolation, validate
from tidemark.contracts.spec import contract_from
from tidemark.operators import scoring
from tidemark.sources.tables import Table, workdir
from tidemark.streaming import events as ev


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (folder / f".{name}").rename(folder / name)


def event(n, second, minute=0, **more):
    return {"trans_num": f"t{n}", "event_ts": f"2024-01-01 00:{minute:02d}:{second:02d}", "amt": 1.5, "category": "c", "is_fraud": n % 2} | more


def test_account_of_progress_events():
    a = ev.Account()
    ops = lambda late, dup: [{"operatorName": "x", "numRowsDroppedByWatermark": late, "customMetrics": {"numDroppedDuplicateRows": dup}}, {"operatorName": "y"}]
    for p in ({"numInputRows": 56, "stateOperators": ops(0, 6)}, {"numInputRows": 20, "stateOperators": ops(20, 0)}, {"numInputRows": 0, "stateOperators": []}, {}):
        a.add(p)
    assert (a.rows_in, a.duplicates, a.late, a.counted) == (76, 6, 20, 50)


def test_duplicates_and_late_rows_are_accounted_for(spark, tmp_path):
    """56 rows on time of which 6 are duplicates, then 20 late ones: 50 are counted."""
    accounts = ev.Accounts()
    spark.streams.addListener(accounts)
    table, source, check = Table(spark, workdir(spark)), tmp_path / "in", f"file://{tmp_path}/check"
    on_time = [event(k, k % 60, 10) for k in range(50)]
    drop(source, "1.json", on_time + on_time[:6])

    def go():
        q = ev.start_metrics(ev.file_source(spark, f"file://{source}"), table, check, trigger={"availableNow": True})
        q.awaitTermination()
        return accounts.of(q)

    first = go()
    drop(source, "2.json", [event(100 + k, k, 0) for k in range(20)])
    total = go()  # the same query goes on from its checkpoint, and so does its account
    spark.streams.removeListener(accounts)
    assert (first.rows_in, first.duplicates) == (56, 6)
    assert (total.rows_in, total.duplicates, total.late, total.counted) == (76, 6, 20, 50)
    assert table.read().agg(F.sum("txns")).first()[0] == 50


def test_windows_are_updated_in_place(spark, tmp_path):
    table, source = Table(spark, workdir(spark)), tmp_path / "in"
    drop(source, "1.json", [event(1, 0), event(2, 59)])
    drop(source, "2.json", [event(3, 30), event(4, 0, 1)])
    ev.start_metrics(ev.file_source(spark, f"file://{source}"), table, f"file://{tmp_path}/c", trigger={"availableNow": True}).awaitTermination()
    got = [(r["window_start"].minute, r["txns"], r["fraud_txns"], r["total_amt"]) for r in table.read().orderBy("window_start").collect()]
    assert got == [(0, 3, 2, 4.5), (1, 1, 0, 1.5)]


def test_a_breached_contract_stops_the_batch(spark, tmp_path):
    contract = contract_from({"name": "m", "checks": [{"type": "accepted_range", "column": "total_amt", "max": 1}]})
    table, source = Table(spark, workdir(spark)), tmp_path / "in"
    drop(source, "1.json", [event(1, 0), event(2, 1)])

    def audit(df):
        validate(df, contract)

    q = ev.start_metrics(ev.file_source(spark, f"file://{source}"), table, f"file://{tmp_path}/c", audit, {"availableNow": True})
    with pytest.raises(Exception, match="accepted_range|outside"):
        q.awaitTermination()
    assert table.current() is None
    assert ContractViolation is not None


def test_scored_once_each(spark, tmp_path):
    model = scoring.Scorer(["c"], dict.fromkeys(scoring.NUMERIC, 0.0), dict.fromkeys(scoring.NUMERIC, 1.0), {**dict.fromkeys(scoring.NUMERIC, 0.0), "log_amt": 1.0, "category=c": 0.0}, -3.0, 0.3, 0.9)
    table, source = Table(spark, workdir(spark)), tmp_path / "in"
    drop(source, "1.json", [event(1, 0, amt=1.0), event(1, 0, amt=1.0), event(2, 1, amt=15.0), event(3, 2, amt=1e6), event(4, 3, amt=None)])
    ev.start_scoring(ev.file_source(spark, f"file://{source}"), model, table, f"file://{tmp_path}/c", trigger={"availableNow": True}).awaitTermination()
    assert {r["trans_num"]: r["decision"] for r in table.read().collect()} == {"t1": "APPROVE", "t2": "REVIEW", "t3": "DECLINE", "t4": "APPROVE"}


def test_replay_is_repeatable(spark):
    tx = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("trans_num"), F.lit(1.0).alias("amt"), F.lit("c").alias("category"))
    a, b = ev.replay(tx).collect(), ev.replay(tx.repartition(5)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    again = [r for r in a if r["redelivery"]]
    assert len(a) == 500 + len(again) and 5 < len(again) < 60 and any(r["late"] for r in a)
    assert all(r["late"] for r in ev.replay(tx, force_late=600).collect())


def test_delivery_is_paced_and_counted(spark):
    rows = [(k, f"2024-01-01 00:00:{k % 4:02d}") for k in range(40)] + [(99, None)]
    df, now, sent = spark.createDataFrame(rows, "id int, ingested_ts string"), [0.0], []
    wait = lambda s: now.__setitem__(0, now[0] + s)
    send = lambda part: sent.append((now[0], sorted(r["id"] for r in part.collect())))
    assert ev.deliver(df, send, 1, clock=lambda: now[0], sleep=wait) == 41
    assert sent == [(0.0, [99])] + [(float(k), list(range(k, 40, 4))) for k in range(4)]
    assert ev.deliver(df, send) == 41 and ev.deliver(df.limit(0), send, 1) == 0
    with pytest.raises(ev.Undelivered):
        ev.deliver(df, lambda part: part.limit(3).collect(), 1, clock=lambda: now[0], sleep=wait)

"""The streaming arm: deduplicated windows and decisions, upserted batch by batch, and accounts of what came in and went out."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from time import monotonic, sleep
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import exact_avg, exact_sum
from ..operators.scoring import Scorer
from ..sources.feeds import STREAM_EVENT, decode_events
from ..sources.tables import Table, buckets, days

WATERMARK, WINDOW = "2 minutes", "1 minute"
MAX_OFFSETS = 50_000
WINDOW_KEYS = ("window_start", "category")
DECISION_BUCKETS = 64


def window_table(spark: SparkSession, path: str) -> Table:
    """The sink of ``start_metrics``, a partition a day: a batch reads and writes the days it has windows of."""
    return Table(spark, path, keyed_partitions=True, transforms={"window_day": days("window_start")})


def decision_table(spark: SparkSession, path: str, n: int = DECISION_BUCKETS) -> Table:
    """The sink of ``start_scoring``, in ``n`` buckets by trans_num: choose as many as hold the rows in parts of some hundred MB."""
    return Table(spark, path, keyed_partitions=True, transforms={"bucket": buckets("trans_num", n)})


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """Messages of a topic from its start; needs Spark's Kafka package on the class path."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": max_offsets, "failOnDataLoss": False}
    return decode_events(spark.readStream.format("kafka").options(**options).load())


def file_source(spark: SparkSession, path: str, files_each: int = 1) -> DataFrame:
    """JSON lines that appear in a folder, as decoded events."""
    raw = spark.readStream.schema(STREAM_EVENT).option("maxFilesPerTrigger", files_each).json(path)
    return raw.withColumn("event_ts", F.try_to_timestamp("event_ts")).where("trans_num is not null and event_ts is not null")


def kafka_sink(df: DataFrame, servers: str, topic: str) -> None:
    out = df.select(F.col("trans_num").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    out.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true"}).save()


class Undelivered(Exception):
    """Fewer rows went out than there were."""


def deliver(sent: DataFrame, send: Callable[[DataFrame], None], seconds: float = 0, time: str = "ingested_ts", clock: Callable[[], float] = monotonic, sleep: Callable[[float], None] = sleep) -> int:
    """Hand ``sent`` to ``send``, which writes it or raises, and return how many rows went out.

    With ``seconds`` it goes out in slices of so many seconds of ``time``, each at its place on the clock and not before; rows
    without a time go first. Slices are counted before, and one that goes out short raises Undelivered.
    """
    if not seconds:
        parts = {0: (sent, None)}
    else:
        at = F.coalesce(F.unix_timestamp(F.try_to_timestamp(F.col(time).cast("string"))), F.lit(0))
        sent = sent.withColumn("__slot", F.floor(at / seconds)).persist(StorageLevel.DISK_ONLY)
        counts = {r["__slot"]: r["count"] for r in sent.groupBy("__slot").count().collect()}  # one row a slice
        parts = {k: (sent.where(F.col("__slot") == k).drop("__slot"), counts[k]) for k in sorted(counts)}
    begun, first, done = clock(), min((k for k in parts if k), default=0), 0
    try:
        for slot, (part, n) in parts.items():
            if (early := begun + (slot - first) * seconds - clock()) > 0:
                sleep(early)
            seen = Observation(f"deliver-{uuid.uuid4().hex[:8]}")
            send(part.observe(seen, F.count(F.lit(1)).alias("n")))
            went = int(seen.get["n"])
            if n is not None and went != n:
                raise Undelivered(f"{went} of {n} rows of slice {slot}")
            done += went
    finally:
        if seconds:
            sent.unpersist()
    return done


def deduplicated(events: DataFrame, watermark: str = WATERMARK, time: str = "event_ts") -> DataFrame:
    """Each trans_num once within the watermark; state is dropped as the watermark passes."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["trans_num"])


def window_metrics(events: DataFrame, window: str = WINDOW, time: str = "event_ts") -> DataFrame:
    """Tumbling windows by category: transactions, frauds, total and mean amount. For streams and tables alike."""
    out = events.groupBy(F.window(time, window).alias("w"), "category").agg(
        F.count("*").alias("txns"), F.sum(F.coalesce(F.col("is_fraud"), F.lit(0))).cast("long").alias("fraud_txns"), exact_sum("amt").alias("total_amt"), exact_avg("amt").alias("avg_amt")
    )
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "category", "txns", "fraud_txns", "total_amt", "avg_amt")


def upsert_into(table: Table, keys: tuple[str, ...], audit: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler: the batch is audited, then upserted. If the audit raises the batch isn't committed; a batch that is
    replayed after a crash is applied once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            if audit is not None:
                audit(batch)
            table.upsert(batch, keys, batch_id)
        finally:
            batch.unpersist()

    return handle


def start_metrics(events: DataFrame, table: Table, checkpoint: str, audit: Callable[[DataFrame], None] | None = None, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Windows that changed are upserted by (window_start, category)."""
    stream = window_metrics(deduplicated(events)).writeStream.outputMode("update")
    return stream.foreachBatch(upsert_into(table, WINDOW_KEYS, audit)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_scoring(events: DataFrame, scorer: Scorer, table: Table, checkpoint: str, audit: Callable[[DataFrame], None] | None = None, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Each event's decision, upserted by trans_num; scored in the plan, row by row."""
    scored = scorer.score(deduplicated(events)).withColumn("scored_at", F.current_timestamp())
    keep = ["trans_num", "event_ts", "amt", "category", "state", "distance_km", "fraud_probability", "decision", "is_fraud", "scored_at"]
    stream = scored.select(*(c for c in keep if c in scored.columns)).writeStream.outputMode("append")
    return stream.foreachBatch(upsert_into(table, ("trans_num",), audit)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let it run for so long, then stop it; 0: until it ends by itself."""
    if seconds:
        query.awaitTermination(int(seconds))
        query.stop()
    else:
        query.awaitTermination()


@dataclass
class Account:
    """Rows that came in, were dropped as late or duplicate, and hence were counted."""

    rows_in: int = 0
    late: int = 0
    duplicates: int = 0

    @property
    def counted(self) -> int:
        return self.rows_in - self.late - self.duplicates

    def add(self, progress: dict[str, Any]) -> None:
        self.rows_in += int(progress.get("numInputRows") or 0)
        for op in progress.get("stateOperators") or ():
            self.late += int(op.get("numRowsDroppedByWatermark") or 0)
            self.duplicates += int((op.get("customMetrics") or {}).get("numDroppedDuplicateRows") or 0)


class Accounts(StreamingQueryListener):
    """Adds up every progress event of each query, however many there are; ``of(query)`` gives its account.

    ``on_lag`` is called with each progress as a dict, to pass lag on to a monitor.
    """

    def __init__(self, on_lag: Callable[[dict[str, Any]], None] | None = None):
        self._by: dict[str, Account] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._on_lag = on_lag

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._news:
            self._by.setdefault(str(event.id), Account())
            self._ended.discard(str(event.id))  # it may be a query that goes on from its checkpoint

    def onQueryProgress(self, event) -> None:  # noqa: N802
        import json

        progress = json.loads(event.progress.json)
        with self._news:
            self._by.setdefault(str(event.progress.id), Account()).add(progress)
            self._news.notify_all()
        if self._on_lag is not None:
            self._on_lag(progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._news:
            self._ended.add(str(event.id))
            self._news.notify_all()

    def of(self, query: StreamingQuery, wait: float = 10.0) -> Account:
        """After the query ended: waits until its last event came in."""
        with self._news:
            self._news.wait_for(lambda: str(query.id) in self._ended, wait)
            return replace(self._by.get(str(query.id), Account()))


def replay(tx: DataFrame, duplicates: float = 0.05, late: float = 0.03, late_seconds: tuple[int, int] = (60, 240), per_second: int = 400, start: str = "2024-01-01 00:00:00", seed: int = 42, force_late: int | None = None) -> DataFrame:
    """Stream events from transactions: times at an even pace in the order of trans_num, shares of them sent twice or late.

    Which ones follows from hashes of the key and ``seed``, so that a rerun, or another partitioning, sends the same.
    ``force_late`` moves every event back by so many seconds. The running number is a global rank made of ranks in parts.
    """
    from pyspark.sql import Window as W

    key = F.col("trans_num")
    draw = lambda k: F.pmod(F.xxhash64(key, F.lit(seed), F.lit(k)), F.lit(1_000_000)) / 1_000_000.0
    parts = tx.withColumn("__part", F.conv(F.substring(F.md5(key), 1, 2), 16, 10).cast("int"))
    starts = parts.groupBy("__part").agg(F.count("*").alias("c"))  # 256 rows
    starts = starts.select("__part", (F.sum("c").over(W.orderBy("__part")) - F.col("c")).alias("__first"))
    numbered = parts.join(F.broadcast(starts), "__part").withColumn("__n", F.col("__first") + F.row_number().over(W.partitionBy("__part").orderBy(key)) - 1)
    base = F.lit(start).cast("timestamp")
    at = F.timestamp_add("SECOND", (F.col("__n") / per_second).cast("int"), base)
    is_late = F.lit(True) if force_late is not None else draw(1) < late
    back = F.lit(force_late) if force_late is not None else (F.lit(late_seconds[0]) + F.floor(draw(2) * (late_seconds[1] - late_seconds[0] + 1))).cast("int")
    out = numbered.withColumns({"late": is_late, "ingested_ts": at.cast("string"), "event_ts": F.when(is_late, F.timestamp_add("SECOND", -back, at)).otherwise(at).cast("string"), "redelivery": F.explode(F.when(draw(3) < duplicates, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))})
    have = set(out.columns)
    return out.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in STREAM_EVENT.fields))

"""The library's queries by name: operators applied to whole tables. ORACLES holds the SQL for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contracts import contract_from_dict, results_frame, summarize, validate
from ..functions import compact_number, exact_round, fourier_terms, present_tier, seconds_between, strip_prefix, weekday_name
from ..operators import conform, forecast, kpis, parity, scoring
from ..session import utc
from ..sources import feeds
from ..sources.tables import Table, buckets, export, overwrite_partitions, reconcile, workdir
from ..streaming import events as stream
from . import sql as q
from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(utc(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return put


def tx(spark: SparkSession, sf_dir: str, state: bool = False) -> DataFrame:
    """Conformed transactions without rejects; the adapted feed has none. The state is joined on where it is asked for."""
    return conform.conform(feeds.transactions(spark, sf_dir, state), q.SALT)


# ---- sources and sinks


@query("s02_csv_scan", f"WITH {q.FEED} SELECT category, {q.SUMS}, min(trans_time) AS first_txn FROM feed GROUP BY ALL")
def _csv(spark, sf_dir):
    """The feed written as CSV with a header and read again with its schema."""
    path = workdir(spark)
    feed = feeds.transactions(spark, sf_dir).withColumnRenamed("trans_time", "trans_date_trans_time")
    names = [f.name for f in feeds.RAW_FEED.fields if f.name in feed.columns]
    feed.select(*names).write.option("header", True).option("timestampNTZFormat", feeds.CSV_TIME).csv(path)
    schema = type(feeds.RAW_FEED)([f for f in feeds.RAW_FEED.fields if f.name in names])
    raw = feeds.renamed(feeds.read_csv(spark, path, schema))
    return raw.groupBy("category").agg(F.count("*").alias("txns"), F.sum("is_fraud").alias("fraud_txns"), kpis.exact_sum("amt").alias("total_amt"), F.min("trans_time").alias("first_txn"))


@query("s05_lineage_union", f"WITH {q.FEED} SELECT source_split AS source_file, source_split, 'b1' AS batch_id, {q.COUNT}, {q.total()} AS total_amt FROM feed GROUP BY source_split")
def _lineage(spark, sf_dir):
    feed = feeds.transactions(spark, sf_dir, False)
    parts = [feeds.with_lineage(feed.where(F.col("source_split") == s), s, s, "b1") for s in ("train", "test")]
    return parts[0].unionByName(parts[1]).groupBy("source_file", "source_split", "batch_id").agg(F.count("*").alias("txns"), kpis.exact_sum("amt").alias("total_amt"))


@query(
    "s07_partition_overwrite",
    f"WITH {q.FEED} SELECT CAST(trans_time AS DATE) AS d, count(*) FILTER (WHERE day(trans_time) % 2 = 0 OR event_id % 2 = 0) AS txns FROM feed GROUP BY 1 HAVING count(*) FILTER (WHERE day(trans_time) % 2 = 0 OR event_id % 2 = 0) > 0",
)
def _overwrite(spark, sf_dir):
    """All days written, then odd days overwritten by their even ids: even days stay as they were."""
    path = workdir(spark)
    days = feeds.transactions(spark, sf_dir, False).select("event_id", F.to_date("trans_time").alias("d"))
    overwrite_partitions(days, path, ["d"])
    overwrite_partitions(days.where((F.dayofmonth("d") % 2 == 1) & (F.col("event_id") % 2 == 0)), path, ["d"])
    return spark.read.parquet(path).groupBy("d").agg(F.count("*").alias("txns"))


@query("s09_write_audit_publish", f"WITH {q.FEED} SELECT category, {q.COUNT} FROM feed GROUP BY 1")
def _wap(spark, sf_dir):
    """A published table, and a second version whose contract fails: readers still see the first."""
    from ..contracts import ContractViolation

    table = Table(spark, workdir(spark))
    feed = feeds.transactions(spark, sf_dir, False).select("trans_num", "category", "amt")
    contract = contract_from_dict({"name": "feed", "checks": [{"type": "accepted_range", "column": "amt", "min": 0.0}]})
    table.publish(feed, lambda df: validate(df, contract))
    try:
        table.publish(feed.withColumn("amt", -F.col("amt")), lambda df: validate(df, contract))
        raise AssertionError("a breach was published")
    except ContractViolation:
        pass
    return table.read().groupBy("category").agg(F.count("*").alias("txns"))


@query("s10_export_manifest", f"{q.WITH}, {q.HOURLY} SELECT 'hourly' AS table_name, count(*) AS row_count, count(*) AS rows_read FROM hourly UNION ALL SELECT 'transactions', count(*), count(*) FROM tx")
def _export(spark, sf_dir):
    path = workdir(spark)
    t = tx(spark, sf_dir)
    export(spark, {"transactions": (t, "trans_time", False), "hourly": (kpis.category_hourly_fraud(t), "trans_hour_ts", False), "absent": (None, None, True)}, path)
    return spark.createDataFrame([(k, a, b) for k, (a, b) in reconcile(spark, path).items()], "table_name string, row_count long, rows_read long")


@query("s11_quarantine_summary", f"WITH {q.FEED}, {q.DIRTY}, c AS (SELECT {q.REASON} AS reject_reason FROM dirty) SELECT reject_reason, count(*) AS rows FROM c WHERE reject_reason IS NOT NULL GROUP BY 1")
def _quarantine_summary(spark, sf_dir):
    return conform.reject_counts(_classified(spark, sf_dir))


@query("s15_json_decode", f"WITH {q.FEED} SELECT trans_num, trans_time AS event_ts, amt, category, state, CAST(is_fraud AS BIGINT) AS is_fraud FROM feed")
def _json(spark, sf_dir):
    """Messages encoded and decoded; broken ones between them are dropped."""
    feed = feeds.transactions(spark, sf_dir).withColumn("event_ts", F.col("trans_time").cast("string"))
    good = feed.select(F.to_json(F.struct("trans_num", "event_ts", "amt", "category", "state", "is_fraud")).alias("value"))
    bad = feed.select(F.when(F.col("event_id") % 2 == 0, F.lit('{"trans_num": ')).otherwise(F.lit('{"trans_num": "x", "event_ts": "never"}')).alias("value"))
    return feeds.decode_events(good.union(bad)).select("trans_num", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "amt", "category", "state", "is_fraud")


@query("s17_paced_delivery", "SELECT 'all' AS what, count(*) AS delivered, count(*) AS arrived FROM events")
def _deliver(spark, sf_dir):
    """Every event handed over in slices by its time, as fast as they go; what was counted on the way and what arrived."""
    path = f"{workdir(spark)}/out"
    sent = stream.replay(feeds.transactions(spark, sf_dir, False), duplicates=0.0, per_second=200)
    n = sent.count()
    went = stream.deliver(sent, lambda df: df.write.mode("append").json(path), max(1.0, n / 200 / 4), sleep=lambda _: None)
    return spark.read.schema(feeds.STREAM_EVENT).json(path).groupBy(F.lit("all").alias("what")).agg(F.lit(went).cast("long").alias("delivered"), F.count("*").alias("arrived"))


@query("s16_replay_identity", "SELECT 'all' AS what, count(*) AS events FROM events")
def _replay(spark, sf_dir):
    """Replayed events without redeliveries: as many as transactions, whichever are late."""
    sent = stream.replay(feeds.transactions(spark, sf_dir, False))
    return sent.where("not redelivery").groupBy(F.lit("all").alias("what")).agg(F.count_distinct("trans_num").alias("events"))


@query("s21_table_kind", f"{q.WITH} {q.STATES}")
def _kind(spark, sf_dir):
    """A partitioned table in another file format, published and read again."""
    table = Table(spark, workdir(spark), transforms={"day": "to_date(trans_hour_ts)"}, kind="orc")
    return table.publish(kpis.state_hourly_volume(tx(spark, sf_dir, state=True)))


@query(
    "s18_upsert",
    f"WITH {q.FEED} SELECT category, {q.COUNT}, {q.total('CASE WHEN event_id % 2 = 0 OR event_id % 5 = 1 THEN amt + 1 ELSE amt END')} AS total_amt FROM feed GROUP BY 1",
)
def _upsert(spark, sf_dir):
    """A table, then a batch that changes rows and adds all those the table lacks, then the same batch again."""
    table = Table(spark, workdir(spark), keyed_partitions=True, transforms={"bucket": buckets("event_id", 8)})
    feed = feeds.transactions(spark, sf_dir, False).select("event_id", "category", "amt")
    table.upsert(feed.where("event_id % 5 <> 1"), ["event_id"], 0)
    for _ in range(2):
        table.upsert(feed.where("event_id % 2 = 0 or event_id % 5 = 1").withColumn("amt", F.col("amt") + 1), ["event_id"], 1)
    return table.read().groupBy("category").agg(F.count("*").alias("txns"), kpis.exact_sum("amt").alias("total_amt"))


# ---- projections, rules, deduplication


@query(
    "p01_conform",
    f"""{q.WITH} SELECT trans_num, trans_time, trans_date, trans_hour, right(CAST(cc_num AS VARCHAR), 4) AS cc_num_last4, cc_num_hash, distance_km,
    merchant, category, amt, state, is_fraud, merch_zipcode FROM tx""",
)
def _conform(spark, sf_dir):
    return tx(spark, sf_dir, state=True).select("trans_num", "trans_time", "trans_date", "trans_hour", "cc_num_last4", "cc_num_hash", "distance_km", "merchant", "category", "amt", "state", "is_fraud", "merch_zipcode")


@query("p04_age", f"""WITH {q.FEED} SELECT trans_num, CAST(date_diff('year', dob, CAST(trans_time AS DATE)) - CASE WHEN month(trans_time) < month(dob) OR (month(trans_time) = month(dob)
    AND day(trans_time) < day(dob) AND NOT (CAST(trans_time AS DATE) = last_day(CAST(trans_time AS DATE)) AND dob = last_day(dob))) THEN 1 ELSE 0 END AS INTEGER) AS cardholder_age FROM feed""")  # fmt: skip
def _age(spark, sf_dir):
    return tx(spark, sf_dir).select("trans_num", "cardholder_age")


def _classified(spark, sf_dir):
    return conform.classify(conform.conform(feeds.dirty_transactions(spark, sf_dir), q.SALT), feeds.FEED_CATEGORIES)


@query("p12_quarantine_rules", f"WITH {q.FEED}, {q.DIRTY} SELECT event_id, {q.REASON} AS reject_reason FROM dirty")
def _rules(spark, sf_dir):
    return _classified(spark, sf_dir).select("event_id", "reject_reason")


@query("p15_split", f"WITH {q.FEED}, {q.DIRTY}, c AS (SELECT {q.REASON} AS x FROM dirty) SELECT CASE WHEN x IS NULL THEN 'accepted' ELSE 'quarantined' END AS part, count(*) AS rows FROM c GROUP BY 1")
def _split(spark, sf_dir):
    good, bad = conform.split(_classified(spark, sf_dir))
    return good.select(F.lit("accepted").alias("part")).unionAll(bad.select(F.lit("quarantined"))).groupBy("part").agg(F.count("*").alias("rows"))


@query("p19_seconds_between", "SELECT o_orderkey, date_sub('second', TIMESTAMP '1992-01-01 00:00:00', CAST(o_orderdate AS TIMESTAMP)) AS seconds FROM orders")
def _seconds(spark, sf_dir):
    o = feeds.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", seconds_between(F.lit("1992-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate").cast("timestamp_ntz")).alias("seconds"))


@query("p25_fourier_terms", f"WITH {q.FEED}, d AS (SELECT DISTINCT CAST(trans_time AS DATE) AS day FROM feed) SELECT day, " + ", ".join(f"{q.r(f'{f}(2.0::DOUBLE * pi() * {k} * (day - DATE {chr(39)}1970-01-01{chr(39)}) / 365.25)', 6)} AS {n}{k}" for k in range(1, 6) for f, n in (("sin", "s"), ("cos", "c"))) + " FROM d")
def _fourier(spark, sf_dir):
    d = feeds.transactions(spark, sf_dir, False).select(F.to_date("trans_time").alias("day")).distinct()
    terms = d.select("day", *fourier_terms(F.unix_date("day"), 5))
    return terms.select("day", *(exact_round(c, 6).alias(c) for c in terms.columns[1:]))


@query("p30_display", f"WITH {q.FEED} SELECT DISTINCT merchant, replace(merchant, 'fraud_', '') AS merchant_name FROM feed")
def _display(spark, sf_dir):
    return feeds.transactions(spark, sf_dir, False).select("merchant", strip_prefix("merchant", "fraud_").alias("merchant_name")).distinct()


@query(
    "w02_keep_latest",
    "SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1, 2",
)
def _latest(spark, sf_dir):
    return conform.keep_latest(feeds.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select("l_orderkey", "l_linenumber", "l_shipdate")


# ---- joins and comparisons


@query("j01_enrich", f"WITH {q.FEED}, {q.CHANNELS} SELECT trans_num, category, channel, CASE channel WHEN 'online' THEN 'card_not_present' WHEN 'in_person' THEN 'card_present' ELSE 'general' END AS tier FROM feed LEFT JOIN channels USING (category)")
def _enrich(spark, sf_dir):
    return conform.enrich(feeds.transactions(spark, sf_dir, False), feeds.categories(spark), "category").select("trans_num", "category", "channel", present_tier("channel").alias("tier"))


@query(
    "j02_parity",
    f"{q.WITH}, a AS (SELECT category, trans_hour_ts, count(*) AS txns, {q.total()} AS total_amt FROM tx GROUP BY ALL), b AS (SELECT category, trans_hour_ts, count(*) AS txns, {q.total('amt * 1.5')} AS total_amt FROM tx WHERE category <> 'view' GROUP BY ALL)"
    " SELECT coalesce(a.category, b.category) AS category, coalesce(a.trans_hour_ts, b.trans_hour_ts) AS trans_hour_ts, a.txns AS txns_a, b.txns AS txns_b FROM a FULL JOIN b ON a.category = b.category AND a.trans_hour_ts = b.trans_hour_ts"
    " WHERE a.txns IS NULL OR b.txns IS NULL OR abs(a.total_amt - b.total_amt) > 0.01",
)
def _parity(spark, sf_dir):
    t = tx(spark, sf_dir)
    a = kpis.category_hourly_fraud(t)
    b = kpis.category_hourly_fraud(t.where("category <> 'view'").withColumn("amt", F.col("amt") * 1.5))
    return parity.drift(a, b, ["category", "trans_hour_ts"], {"txns": 0, "total_amt": 0.01}).select("category", "trans_hour_ts", "txns_a", "txns_b")


@query(
    "j02_parity_clean",
    f"{q.WITH}, {q.HOURLY}, twin AS (SELECT trans_hour_ts, category, count(*) AS n, {q.total()} AS amount FROM tx GROUP BY ALL)"
    " SELECT count(*) AS differing FROM hourly h FULL JOIN twin t ON h.trans_hour_ts = t.trans_hour_ts AND h.category = t.category WHERE h.txns IS DISTINCT FROM t.n OR h.total_amt IS DISTINCT FROM t.amount",
)
def _parity_clean(spark, sf_dir):
    """The hourly table made twice, once from daily-hour figures in SQL: nothing differs."""
    t = tx(spark, sf_dir)
    t.createOrReplaceTempView("tidemark_tx")
    twin = spark.sql("SELECT cast(date_trunc('hour', trans_time) AS timestamp_ntz) AS trans_hour_ts, category, count(*) AS txns, cast(sum(cast(amt AS decimal(18,2))) AS double) AS total_amt FROM tidemark_tx GROUP BY 1, 2")
    return parity.drift(kpis.category_hourly_fraud(t), twin, ["category", "trans_hour_ts"], {"txns": 0, "total_amt": 0.0}).agg(F.count("*").alias("differing"))


@query("j03_orphans", f"WITH {q.FEED}, {q.CHANNELS} SELECT f.category, count(*) AS rows FROM feed f LEFT JOIN channels c ON f.category = c.category WHERE c.category IS NULL GROUP BY 1")
def _orphans(spark, sf_dir):
    return parity.orphans(feeds.transactions(spark, sf_dir, False), feeds.categories(spark), "category")


@query("j04_totals", f"{q.WITH} SELECT (SELECT {q.total()} FROM tx) AS total_a, (SELECT {q.total()} FROM tx WHERE is_fraud = 0) AS total_b")
def _totals(spark, sf_dir):
    t = tx(spark, sf_dir)
    return parity.totals_differ(t, t.where("is_fraud = 0"), "amt")


@query("j06_calendar", f"WITH {q.FEED}, {q.SERIES} SELECT * FROM series")
def _calendar(spark, sf_dir):
    return _series(spark, sf_dir)


def _series(spark, sf_dir):
    feed = feeds.transactions(spark, sf_dir, False)
    by_day = F.to_date("trans_time").alias("day")
    volume = feed.where("category <> 'error'").groupBy(by_day).agg(F.count("*").alias("txns"))
    fraud = feed.where("is_fraud = 1").groupBy(by_day).agg(F.sum("is_fraud").alias("fraud_txns"))
    return forecast.daily_series(volume, fraud)


@query("j08_scalar_subqueries", f"{q.WITH} SELECT (SELECT count(DISTINCT cc_num_hash) FROM tx) AS cards, (SELECT count(DISTINCT merchant) FROM tx) AS merchants")
def _scalars(spark, sf_dir):
    tx(spark, sf_dir).createOrReplaceTempView("tidemark_tx")
    return spark.sql("SELECT (SELECT count(DISTINCT cc_num_hash) FROM tidemark_tx) AS cards, (SELECT count(DISTINCT merchant) FROM tidemark_tx) AS merchants")


@query("a12_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _duplicates(spark, sf_dir):
    return parity.duplicate_keys(feeds.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a09_freshness",
    f"""{q.WITH}, t AS (SELECT 'transactions' AS table_name, count(*) AS row_count, max(trans_time) AS latest FROM tx UNION ALL
    SELECT 'orders', count(*), CAST(max(o_orderdate) AS TIMESTAMP) FROM orders UNION ALL SELECT 'lineitem', count(*), CAST(max(l_shipdate) AS TIMESTAMP) FROM lineitem UNION ALL SELECT 'nation', count(*), NULL FROM nation)
    SELECT table_name, row_count, latest, date_sub('second', latest, TIMESTAMP '2024-02-01 00:00:00') AS lag_seconds,
    CASE WHEN table_name = 'nation' THEN 'n/a' WHEN date_sub('second', latest, TIMESTAMP '2024-02-01 00:00:00') <= 86400 THEN 'fresh' WHEN date_sub('second', latest, TIMESTAMP '2024-02-01 00:00:00') <= 259200 THEN 'stale' ELSE 'breached' END AS status FROM t""",
)
def _freshness(spark, sf_dir):
    tables = {"transactions": (tx(spark, sf_dir), "trans_time"), "orders": (feeds.table(spark, sf_dir, "orders"), "o_orderdate"), "lineitem": (feeds.table(spark, sf_dir, "lineitem"), "l_shipdate"), "nation": (feeds.table(spark, sf_dir, "nation"), None)}
    return parity.freshness(tables, "2024-02-01 00:00:00")


# ---- figures


@query("a01_category_hourly_fraud", f"{q.WITH}, {q.HOURLY} SELECT * FROM hourly")
def _a01(spark, sf_dir):
    return kpis.category_hourly_fraud(tx(spark, sf_dir))


@query("a02_state_hourly_volume", f"{q.WITH} {q.STATES}")
def _a02(spark, sf_dir):
    return kpis.state_hourly_volume(tx(spark, sf_dir, state=True))


@query("a03_card_daily", f"{q.WITH}, {q.DAILY} SELECT * FROM daily")
def _a03(spark, sf_dir):
    return kpis.card_daily(tx(spark, sf_dir))


@query("a04_merchant_risk", f"{q.WITH} SELECT merchant, category, {q.SUMS}, {q.ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY 1, 2 HAVING count(*) >= 20")
def _a04(spark, sf_dir):
    return kpis.merchant_risk(tx(spark, sf_dir))


@query(
    "a05_distance_profile",
    f"{q.WITH} SELECT is_fraud, {q.COUNT}, {q.mean('distance_km', 3, 3)} AS avg_distance_km, " + ", ".join(f"{q.r(f'quantile_disc(distance_km, {p / 100})', 3)} AS p{p}_distance_km" for p in (50, 90, 99)) + " FROM tx GROUP BY 1",
)
def _a05(spark, sf_dir):
    return kpis.distance_profile(tx(spark, sf_dir), exact=True)


@query("w01_card_velocity", f"""{q.WITH}, {q.DAILY} SELECT *, CAST(sum(txns_that_day) OVER w AS BIGINT) AS txns_trailing_7d, CAST(sum(CAST(amt_that_day AS DECIMAL(18,2))) OVER w AS DOUBLE) AS amt_trailing_7d FROM daily
    WINDOW w AS (PARTITION BY cc_num_hash ORDER BY trans_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")  # fmt: skip
def _w01(spark, sf_dir):
    return kpis.card_velocity(tx(spark, sf_dir))


@query("w03_state_shares", f"""{q.WITH}, s AS (SELECT trans_date, trans_hour, state, {q.COUNT}, {q.total()} AS total_amt, {q.mean()} AS avg_amt FROM tx GROUP BY ALL)
    SELECT *, {q.share('txns', 'sum(txns) OVER (PARTITION BY trans_date, trans_hour)')} AS txn_share_pct FROM s""")  # fmt: skip
def _w03(spark, sf_dir):
    return kpis.state_shares(tx(spark, sf_dir, state=True))


@query("w04_category_summary", f"""{q.WITH}, c AS (SELECT category, {q.SUMS}, {q.mean()} AS avg_amt, min(trans_time) AS first_txn, max(trans_time) AS last_txn FROM tx GROUP BY 1)
    SELECT *, {q.share('txns', 'sum(txns) OVER ()')} AS txn_share_pct, {q.share('total_amt', 'sum(CAST(total_amt AS DECIMAL(18,2))) OVER ()')} AS amt_share_pct FROM c""")  # fmt: skip
def _w04(spark, sf_dir):
    return kpis.category_summary(tx(spark, sf_dir))


@query("w05_seasonal_naive", f"WITH {q.FEED}, {q.SERIES}, {q.NAIVE} SELECT * FROM naive")
def _w05(spark, sf_dir):
    return forecast.seasonal_naive(_series(spark, sf_dir), 7)


@query("a15_daily_rollup", f"{q.WITH}, {q.HOURLY} SELECT CAST(trans_hour_ts AS DATE) AS day, CAST(sum(txns) AS BIGINT) AS txns, CAST(sum(fraud_txns) AS BIGINT) AS fraud_txns, {q.total('total_amt')} AS total_amt, {q.ratio('sum(fraud_txns)', 'sum(txns)')} AS fraud_rate FROM hourly GROUP BY 1")
def _a15(spark, sf_dir):
    return kpis.daily_from_hourly(kpis.category_hourly_fraud(tx(spark, sf_dir)))


@query("a16_hourly_top_categories", f"{q.WITH}, {q.HOURLY}, top AS (SELECT category FROM hourly GROUP BY 1 ORDER BY sum(txns) DESC, category LIMIT 3) SELECT trans_hour_ts, category, CAST(sum(txns) AS BIGINT) AS txns FROM hourly WHERE category IN (SELECT category FROM top) GROUP BY 1, 2")
def _a16(spark, sf_dir):
    return kpis.hourly_top_categories(kpis.category_hourly_fraud(tx(spark, sf_dir)))


@query("a17_state_totals", f"{q.WITH} SELECT state, {q.COUNT}, {q.total()} AS total_amt FROM tx GROUP BY 1")
def _a17(spark, sf_dir):
    return tx(spark, sf_dir, state=True).groupBy("state").agg(F.count("*").alias("txns"), kpis.exact_sum("amt").alias("total_amt"))


def _extract(name: str, column: str, average: bool = False, select: str | None = None) -> None:
    mean = f", {q.mean()} AS avg_amt" if average else ""

    @query(name, f"{q.WITH} SELECT {select or column}, {q.SUMS}{mean}, {q.ratio('sum(is_fraud)', 'count(*)', 8)} AS fraud_rate FROM tx GROUP BY ALL")
    def _run(spark, sf_dir):
        return kpis.rollup(tx(spark, sf_dir, state=column == "state"), column, rate_places=8, average=average)


_extract("a18_extract_by_date", "trans_date")
_extract("a19_extract_by_category", "category")
_extract("a20_extract_by_state", "state")
_extract("a21_extract_by_hour", "trans_hour", average=True)


@query("a22_extract_by_weekday", f"{q.WITH} SELECT CAST(isodow(trans_date) - 1 AS INTEGER) AS weekday_no, dayname(trans_date) AS weekday, {q.SUMS}, {q.ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY ALL")
def _a22(spark, sf_dir):
    return kpis.by_weekday(tx(spark, sf_dir))


@query("p10_weekday", "SELECT o_orderkey, dayname(CAST(o_orderdate AS DATE)) AS weekday FROM orders")
def _p10(spark, sf_dir):
    return feeds.table(spark, sf_dir, "orders").select("o_orderkey", weekday_name(F.to_date("o_orderdate")).alias("weekday"))


@query(
    "a29_kpi_tiles",
    f"""{q.WITH}, {q.DIRTY}, z AS (SELECT count(*) AS quarantined FROM (SELECT {q.REASON} AS x FROM dirty) WHERE x IS NOT NULL), k AS (SELECT {q.SUMS}, count(DISTINCT cc_num_hash) AS cards, count(DISTINCT merchant) AS merchants FROM tx)
    SELECT k.*, z.quarantined, {q.ratio('fraud_txns', 'txns')} AS fraud_rate, {q.ratio('quarantined', 'quarantined + txns')} AS quarantine_share FROM k, z""",
)
def _a29(spark, sf_dir):
    return kpis.kpi_tiles(tx(spark, sf_dir), conform.split(_classified(spark, sf_dir))[1])


# ---- ranked reports, where the limit is the feature


@query("l01_category_headline", f"{q.WITH} SELECT category, {q.SUMS}, {q.mean()} AS avg_amt, {q.ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY 1")
def _l01(spark, sf_dir):
    return kpis.rollup(tx(spark, sf_dir), "category", average=True).orderBy(F.desc("txns"), "category")


@query("l02_top_categories", f"{q.WITH} SELECT category, {q.COUNT} FROM tx GROUP BY 1 ORDER BY txns DESC, category LIMIT 3")
def _l02(spark, sf_dir):
    return kpis.top(tx(spark, sf_dir).groupBy("category").agg(F.count("*").alias("txns")), 3, F.desc("txns"), "category")


@query("p18_staging_views", f"{q.WITH}, {q.HOURLY} SELECT CAST(h.trans_hour_ts AS DATE) AS day, h.category, c.n AS days_with_any, CAST(sum(h.txns) AS BIGINT) AS txns FROM hourly h JOIN (SELECT category, count(DISTINCT CAST(trans_hour_ts AS DATE)) AS n FROM hourly GROUP BY 1) c USING (category) GROUP BY ALL")
def _staging(spark, sf_dir):
    """Marts as Spark SQL over named views of the published tables."""
    kpis.category_hourly_fraud(tx(spark, sf_dir)).createOrReplaceTempView("stg_category_hourly")
    return spark.sql(
        "SELECT to_date(h.trans_hour_ts) AS day, h.category, c.n AS days_with_any, sum(h.txns) AS txns FROM stg_category_hourly h"
        " JOIN (SELECT category, count(DISTINCT to_date(trans_hour_ts)) AS n FROM stg_category_hourly GROUP BY category) c ON h.category = c.category GROUP BY 1, 2, 3"
    )


@query("p18_stg_transactions", f"{q.WITH}, {q.CHANNELS} SELECT trans_num, trans_date, trans_hour, cc_num_hash, merchant, tx.category, channel, amt, state, distance_km, is_fraud, 'b1' AS batch_id FROM tx LEFT JOIN channels USING (category)")
def _stg_transactions(spark, sf_dir):
    t = conform.enrich(tx(spark, sf_dir, state=True), feeds.categories(spark), "category")
    views.stage({"stg_transactions": t.withColumns({"batch_id": F.lit("b1"), "ingested_at": F.current_timestamp()})})
    return spark.sql("SELECT trans_num, trans_date, trans_hour, cc_num_hash, merchant, category, channel, amt, state, distance_km, is_fraud, batch_id FROM stg_transactions")


@query("p18_stg_dim_category", f"WITH {q.CHANNELS} SELECT category, channel FROM channels")
def _stg_dim_category(spark, sf_dir):
    views.stage({"stg_dim_category": feeds.categories(spark)})
    return spark.table("stg_dim_category")


@query("p18_stg_merchant_risk", f"{q.WITH} SELECT merchant, category, {q.SUMS}, {q.ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY 1, 2 HAVING count(*) >= 20")
def _stg_merchant_risk(spark, sf_dir):
    views.stage({"stg_merchant_risk": kpis.merchant_risk(tx(spark, sf_dir))})
    return spark.table("stg_merchant_risk")


@query("p18_stg_category_hourly", f"{q.WITH}, {q.HOURLY} SELECT * FROM hourly")
def _stg_category_hourly(spark, sf_dir):
    views.stage({"stg_spark_category_hourly_fraud": kpis.category_hourly_fraud(tx(spark, sf_dir))})
    return spark.table("stg_spark_category_hourly_fraud")


@query("p18_stg_state_hourly", f"{q.WITH} {q.STATES}")
def _stg_state_hourly(spark, sf_dir):
    views.stage({"stg_spark_state_hourly_volume": kpis.state_hourly_volume(tx(spark, sf_dir, state=True))})
    return spark.table("stg_spark_state_hourly_volume")


@query(
    "p26_compact_numbers",
    f"""{q.WITH}, t AS (SELECT state, CAST(count(*) AS DOUBLE) AS v FROM tx GROUP BY 1 UNION ALL SELECT state, {q.total()} FROM tx GROUP BY 1 UNION ALL SELECT state, -1000 * {q.total()} FROM tx GROUP BY 1)
    SELECT state, v, CASE WHEN abs(v) >= 1e9 THEN regexp_replace(printf('%.2f', {q.r('v / 1e9', 2)}), '\\.?0+$', '') || 'B' WHEN abs(v) >= 1e6 THEN regexp_replace(printf('%.2f', {q.r('v / 1e6', 2)}), '\\.?0+$', '') || 'M'
    WHEN abs(v) >= 1e3 THEN regexp_replace(printf('%.2f', {q.r('v / 1e3', 2)}), '\\.?0+$', '') || 'K' ELSE printf('%.0f', v) END AS shown FROM t""",
)
def _compact(spark, sf_dir):
    t = tx(spark, sf_dir, state=True)
    count, amount = F.count("*").cast("double").alias("v"), kpis.exact_sum("amt")
    rows = t.groupBy("state").agg(F.explode(F.array(count, amount, -1000 * amount)).alias("v"))
    return rows.withColumn("shown", compact_number("v"))


@query(
    "a12_contract_tests",
    f"""{q.WITH}, {q.HOURLY}, found AS (SELECT (SELECT count(*) FROM (SELECT 1 FROM hourly GROUP BY trans_hour_ts, category HAVING count(*) > 1)) AS repeated,
    count(*) FILTER (WHERE txns <= 0) AS none, count(*) FILTER (WHERE fraud_rate < 0 OR fraud_rate > 1) AS outside, count(*) FILTER (WHERE trans_hour_ts IS NULL OR category IS NULL) AS missing FROM hourly),
    n AS (SELECT CAST(repeated > 0 AS BIGINT) + CAST(none > 0 AS BIGINT) + CAST(outside > 0 AS BIGINT) + CAST(missing > 0 AS BIGINT) AS errors FROM found)
    SELECT 'hourly' AS contract, CAST(4 AS BIGINT) AS checks, errors, CAST(0 AS BIGINT) AS warnings, CASE WHEN errors = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM n""",
)
def _warehouse_tests(spark, sf_dir):
    """Grain, ranges and positive counts of a mart, as contract checks."""
    c = contract_from_dict(
        {
            "name": "hourly",
            "checks": [
                {"type": "unique_combination", "columns": ["trans_hour_ts", "category"]},
                {"type": "positive_values", "column": "txns"},
                {"type": "fraction_range", "column": "fraud_rate"},
                {"type": "not_null", "columns": ["trans_hour_ts", "category"]},
            ],
        }
    )
    return summarize(results_frame(spark, [validate(kpis.category_hourly_fraud(tx(spark, sf_dir)), c)]))


@query("l03_top_merchants", f"{q.WITH} SELECT merchant, category, {q.SUMS}, {q.ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY 1, 2 HAVING count(*) >= 20 ORDER BY fraud_rate DESC, txns DESC, merchant, category LIMIT 12")
def _l03(spark, sf_dir):
    return kpis.top(kpis.merchant_risk(tx(spark, sf_dir)), 12, F.desc("fraud_rate"), F.desc("txns"), "merchant", "category")


@query("l04_top_states", f"{q.WITH} SELECT state, {q.COUNT}, {q.total()} AS total_amt FROM tx GROUP BY 1 ORDER BY total_amt DESC, state LIMIT 12")
def _l04(spark, sf_dir):
    return kpis.top(_a17(spark, sf_dir), 12, F.desc("total_amt"), "state")


@query("l05_latest_windows", f"WITH {q.FEED} SELECT date_trunc('minute', trans_time) AS window_start, category, {q.COUNT} FROM feed GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 20")
def _l05(spark, sf_dir):
    windows = stream.window_metrics(feeds.transactions(spark, sf_dir, False), time="trans_time")
    return kpis.top(windows, 20, F.desc("window_start"), "category").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "category", "txns")


@query("l09_offset_slice", "SELECT event_id, value FROM events ORDER BY ts, event_id LIMIT 500 OFFSET 250")
def _l09(spark, sf_dir):
    return kpis.page(feeds.table(spark, sf_dir, "events"), 250, 500, "ts", "event_id").select("event_id", "value")


# ---- contracts


CONTRACT = {
    "name": "feed_contract",
    "mode": "warn",
    "schema": {"columns": [{"name": "trans_num", "type": "string", "nullable": False}, {"name": "amt", "type": "double", "nullable": False}, {"name": "category", "type": "string", "nullable": False}], "strict": False},
    "checks": [
        {"type": "unique", "name": "key", "columns": ["trans_num"]},
        {"type": "row_count", "name": "some_rows", "min": 1},
        {"type": "accepted_range", "name": "amounts", "column": "amt", "min": 0.01, "max": 30000.0},
        {"type": "accepted_values", "name": "categories", "column": "category", "values": ["click", "error", "purchase", "signup", "view"], "severity": "warn"},
        {"type": "null_rate", "name": "zips", "column": "merch_zipcode", "max": 0.1},
        {"type": "expression", "name": "flag", "expr": "is_fraud in (0, 1)"},
        {"type": "freshness", "name": "recent", "column": "trans_time", "max_age": "3 days", "as_of": "2024-02-01 00:00:00"},
        {"type": "positive_values", "name": "positive", "column": "amt"},
        {"type": "percentage_range", "name": "latitude", "column": "merch_lat", "severity": "warn"},
        {"type": "fraction_range", "name": "fraud_fraction", "column": "is_fraud"},
        {"type": "not_null", "name": "gone", "columns": ["no_such_column"]},
    ],
}


def _check(name: str, kind: str, bad: str, severity: str = "error", passed: str | None = None) -> str:
    return f"SELECT 'feed_contract' AS contract, '{name}' AS check, '{kind}' AS type, '{severity}' AS severity, {passed or f'({bad}) = 0'} AS passed, CAST({bad} AS BIGINT) AS failing_rows, (SELECT count(*) FROM dirty) AS rows"


def _n(where: str) -> str:
    return f"(SELECT count(*) FROM dirty WHERE {where})"


C_ORACLE = f"WITH {q.FEED}, {q.DIRTY} " + " UNION ALL ".join(
    [
        _check("schema", "schema", "0", passed="true"),
        _check("required_columns", "not_null", f"{_n('trans_num IS NULL')} + {_n('amt IS NULL')} + {_n('category IS NULL')}"),
        _check("key", "unique", "(SELECT count(*) FROM dirty) - (SELECT count(DISTINCT coalesce(trans_num, '')) FROM dirty)"),
        _check("some_rows", "row_count", "0", passed="(SELECT count(*) FROM dirty) >= 1"),
        _check("amounts", "accepted_range", _n("amt < 0.01 OR amt > 30000")),
        _check("categories", "accepted_values", _n("category NOT IN ('click', 'error', 'purchase', 'signup', 'view')"), "warn"),
        _check("zips", "null_rate", f"CASE WHEN {_n('merch_zipcode IS NULL')} > 0.1 * (SELECT count(*) FROM dirty) THEN {_n('merch_zipcode IS NULL')} ELSE 0 END"),
        _check("flag", "expression", _n("NOT coalesce(is_fraud IN (0, 1), false)")),
        _check("recent", "freshness", "0", passed="(SELECT date_diff('second', max(trans_time), TIMESTAMP '2024-02-01 00:00:00') <= 259200 FROM dirty)"),
        _check("positive", "positive_values", _n("amt <= 0")),
        _check("latitude", "percentage_range", _n("merch_lat < 0 OR merch_lat > 100"), "warn"),
        _check("fraud_fraction", "fraction_range", _n("is_fraud < 0 OR is_fraud > 1")),
        _check("gone", "not_null", "0", passed="false"),
    ]
)


def _report(spark, sf_dir):
    return validate(feeds.dirty_transactions(spark, sf_dir), contract_from_dict(CONTRACT), examples=0)


@query("c00_contract_results", C_ORACLE)
def _contract(spark, sf_dir):
    return results_frame(spark, [_report(spark, sf_dir)])


@query("l08_failing_examples", f"SELECT contract, \"check\", least(failing_rows, 5) AS examples FROM ({C_ORACLE}) WHERE NOT passed AND \"check\" IN ('required_columns', 'amounts', 'categories', 'zips', 'flag', 'positive', 'latitude', 'fraud_fraction')")
def _examples(spark, sf_dir):
    """How many failing rows each failed check shows: 5 at most, where a row by itself can fail."""
    report = validate(feeds.dirty_transactions(spark, sf_dir), contract_from_dict(CONTRACT))
    return spark.createDataFrame([(report.contract, r.name, len(r.examples)) for r in report.results if r.examples], "contract string, check string, examples long")


@query("a23_contract_summary", f"SELECT contract, count(*) AS checks, count(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors, count(*) FILTER (WHERE NOT passed AND severity = 'warn') AS warnings, 'FAILED' AS status FROM ({C_ORACLE}) GROUP BY 1")
def _summary(spark, sf_dir):
    return summarize(results_frame(spark, [_report(spark, sf_dir)]))


# ---- streams


@query(
    "t04_stream_windows",
    f"WITH {q.FEED} SELECT date_trunc('minute', trans_time) AS window_start, date_trunc('minute', trans_time) + INTERVAL 1 MINUTE AS window_end, category, {q.SUMS}, {q.mean()} AS avg_amt FROM feed GROUP BY ALL",
)
def _stream(spark, sf_dir):
    """The feed as JSON files through the streaming arm: redelivered events are counted once."""
    path = workdir(spark)
    _on_time(spark, sf_dir).drop("event_id").write.json(f"{path}/in")
    table = stream.window_table(spark, f"{path}/windows")
    stream.start_metrics(stream.file_source(spark, f"{path}/in", 10_000), table, f"{path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    out = table.read()
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _on_time(spark, sf_dir):
    """The feed as stream events; those with an id divisible by 11 are sent twice."""
    twice = F.when(F.col("event_id") % 11 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    feed = feeds.transactions(spark, sf_dir, False).withColumns({"event_ts": F.col("trans_time").cast("string"), "redelivery": F.explode(twice)})
    return feed.select("event_id", "trans_num", "event_ts", "amt", "category", F.col("is_fraud").cast("long").alias("is_fraud"), "redelivery")


@query(
    "t07_late_account",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 11 = 0) AS twice, count(*) FILTER (WHERE event_id % 13 = 0) AS late FROM events)
    SELECT n + twice + late AS rows_in, twice AS duplicates, late, n AS counted, n AS in_windows FROM n""",
)
def _late(spark, sf_dir):
    """All events, some twice; then, on the same checkpoint, new ones a year older, which the watermark has passed."""
    path, accounts = workdir(spark), stream.Accounts()
    events, table = _on_time(spark, sf_dir), stream.window_table(spark, f"{path}/windows")
    old = events.where("event_id % 13 = 0 and not redelivery").withColumns({"trans_num": F.concat(F.lit("late-"), "trans_num"), "event_ts": (F.col("event_ts").cast("timestamp_ntz") - F.expr("interval 366 days")).cast("string")})
    spark.streams.addListener(accounts)
    try:
        for sent in (events, old):
            sent.drop("event_id").write.mode("append").json(f"{path}/in")
            run = stream.start_metrics(stream.file_source(spark, f"{path}/in", 10_000), table, f"{path}/checkpoint", trigger={"availableNow": True})
            run.awaitTermination()
            account = accounts.of(run)
    finally:
        spark.streams.removeListener(accounts)
    seen = spark.createDataFrame([(account.rows_in, account.duplicates, account.late, account.counted)], "rows_in long, duplicates long, late long, counted long")
    return seen.crossJoin(table.read().agg(F.sum("txns").alias("in_windows")))


@query(
    "t06_audited_batches",
    f"WITH {q.FEED} SELECT date_trunc('minute', trans_time) AS window_start, category, {q.COUNT}, false AS published_in_breach FROM feed GROUP BY 1, 2",
)
def _audited(spark, sf_dir):
    """A stream whose batch breaches its contract publishes nothing; restarted under a contract that holds, it publishes all."""
    path = workdir(spark)
    table = stream.window_table(spark, f"{path}/windows")
    _on_time(spark, sf_dir).drop("event_id").write.json(f"{path}/in")

    def run(most: float):
        contract = contract_from_dict({"name": "windows", "checks": [{"type": "accepted_range", "column": "txns", "min": 1, "max": most}]})
        stream.start_metrics(stream.file_source(spark, f"{path}/in", 10_000), table, f"{path}/checkpoint", lambda df: validate(df, contract), {"availableNow": True}).awaitTermination()

    try:
        run(0)
    except StreamingQueryException:
        pass
    early = table.current() is not None
    run(1e12)
    return table.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "category", "txns", F.lit(early).alias("published_in_breach"))


@query(
    "t10_stream_decisions",
    f"WITH {q.FEED}, p AS (SELECT *, 1 / (1 + exp(-(ln(1 + greatest(coalesce(amt, 0), 0)) - 3 + CASE WHEN category = 'error' THEN 0.5 ELSE 0 END))) AS p FROM feed)"
    " SELECT trans_num, amt, category, CAST(is_fraud AS BIGINT) AS is_fraud, CASE WHEN p >= 0.9 THEN 'DECLINE' WHEN p >= 0.3 THEN 'REVIEW' ELSE 'APPROVE' END AS decision FROM p",
)
def _decisions(spark, sf_dir):
    """Events scored in the stream by a given model, redelivered ones once."""
    path, zero = workdir(spark), dict.fromkeys(scoring.NUMERIC, 0.0)
    weights = zero | {"log_amt": 1.0, "category=error": 0.5}
    model = scoring.Scorer(["error"], zero, dict.fromkeys(scoring.NUMERIC, 1.0), weights, -3.0, 0.3, 0.9)
    table = stream.decision_table(spark, f"{path}/decisions", 8)
    _on_time(spark, sf_dir).drop("event_id").write.json(f"{path}/in")
    stream.start_scoring(stream.file_source(spark, f"{path}/in", 10_000), model, table, f"{path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return table.read().select("trans_num", "amt", "category", "is_fraud", "decision")


@query("t11_lag", f"WITH {q.FEED} SELECT CAST(date_diff('minute', max(date_trunc('minute', trans_time)) + INTERVAL 1 MINUTE, TIMESTAMP '2024-03-01 00:00:00') AS BIGINT) AS minutes FROM feed")
def _lag(spark, sf_dir):
    windows = stream.window_metrics(feeds.transactions(spark, sf_dir, False), time="trans_time")
    minutes = parity.check_lag(windows, "window_end", float("inf"), datetime(2024, 3, 1, tzinfo=timezone.utc))
    return spark.createDataFrame([(round(minutes),)], "minutes long")


@query(
    "t12_replay_late",
    f"""WITH {q.FEED}, n AS (SELECT trans_num, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST((row_number() OVER (ORDER BY left(md5(trans_num), 2), trans_num) - 1) // 400 AS BIGINT)) AS ingested_ts FROM feed)
    SELECT trans_num, ingested_ts, ingested_ts - INTERVAL 600 SECONDS AS event_ts FROM n""",
)
def _replay_late(spark, sf_dir):
    """Every event replayed ten minutes late, at an even pace."""
    sent = stream.replay(feeds.transactions(spark, sf_dir, False), duplicates=0.0, force_late=600)
    return sent.select("trans_num", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("ingested_ts", "event_ts")))


# ---- scoring and forecasting


def _scored(spark, sf_dir):
    """A score that follows from the id by whole-number arithmetic, with ties."""
    return feeds.transactions(spark, sf_dir, False).withColumn("score", ((F.col("event_id") * 7919 + F.col("is_fraud") * 211) % 1000).cast("double") / 1000.0)


@query("a24_thresholds", f"WITH {q.FEED}, {q.SCORED} SELECT {q.r('quantile_cont(score, 0.9)', 6)} AS review, {q.r('quantile_cont(score, 0.99)', 6)} AS decline FROM scored")
def _thresholds(spark, sf_dir):
    t = scoring.thresholds(_scored(spark, sf_dir))
    return t.select(exact_round("review", 6).alias("review"), exact_round("decline", 6).alias("decline"))


@query(
    "a25_ranking_quality",
    f"""WITH {q.FEED}, {q.SCORED}, s AS (SELECT score, sum(is_fraud) AS pos, count(*) AS n FROM scored GROUP BY 1),
    c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS k FROM s)
    SELECT round(CAST(sum((n - pos) * (tp - pos / 2.0)) AS DOUBLE) / (sum(pos) * sum(n - pos)), 9) AS roc_auc, round(sum(CAST(pos AS DOUBLE) * tp / k) / sum(pos), 9) AS average_precision FROM c""",
)
def _ranking(spark, sf_dir):
    return scoring.ranking_quality(_scored(spark, sf_dir))


@query("a27_confusion", f"WITH {q.FEED}, {q.SCORED}, {q.DECIDED} SELECT decision, count(*) AS n, {q.ratio('count(*)', '(SELECT count(*) FROM decided)')} AS share, CAST(sum(is_fraud) AS BIGINT) AS frauds, {q.ratio('sum(is_fraud)', 'count(*)')} AS precision FROM decided GROUP BY 1")
def _confusion(spark, sf_dir):
    from ..functions import banding

    return scoring.confusion(_scored(spark, sf_dir).withColumn("decision", banding("score", 0.7, 0.9)))


@query("p21_features", f"WITH {q.FEED} SELECT trans_num, {q.r('ln(1 + greatest(coalesce(amt, 0), 0))', 6)} AS log_amt, CAST(coalesce(hour(trans_time), 0) AS DOUBLE) AS hour, coalesce(category, 'unknown') AS category FROM feed")
def _features(spark, sf_dir):
    return scoring.features(feeds.transactions(spark, sf_dir, False)).select("trans_num", exact_round("log_amt", 6).alias("log_amt"), "hour", "category")


@query("m01_score")
def _score(spark, sf_dir):
    """Trained on one split, applied to the other."""
    t = tx(spark, sf_dir)
    model = scoring.train(t.where("source_split = 'train'"), list(feeds.FEED_CATEGORIES))
    return model.score(t.where("source_split = 'test'")).select("trans_num", "amt", "category", "distance_km", "fraud_probability", "decision", "is_fraud")


@query("a28_forecast_errors", f"WITH {q.FEED}, {q.SERIES}, {q.NAIVE} SELECT {q.r('avg(CASE WHEN actual <> 0 THEN abs(CAST(actual AS DOUBLE) - forecast) / abs(actual) * 100 END)', 3)} AS mape, {q.r('avg(abs(CAST(actual AS DOUBLE) - forecast))', 3)} AS mae FROM naive")
def _errors(spark, sf_dir):
    return forecast.errors(forecast.seasonal_naive(_series(spark, sf_dir), 7))


@query("m08_fourier_forecast")
def _fourier_forecast(spark, sf_dir):
    return forecast.fourier_forecast(_order_series(spark, sf_dir), 56)


def _order_series(spark, sf_dir):
    """Orders a day: years of them."""
    o = feeds.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
    return forecast.daily_series(o.agg(F.count("*").alias("txns")), o.agg(F.count_if(F.col("o_orderkey") % 37 == 0).alias("fraud_txns")))


@query("m08_fourier_future")
def _fourier_future(spark, sf_dir):
    return forecast.fourier_future(_order_series(spark, sf_dir), 28)


@query("m09_fourier_sweep")
def _sweep(spark, sf_dir):
    return forecast.sweep(_order_series(spark, sf_dir), 56)

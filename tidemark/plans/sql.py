"""The SQL side of the queries: what another engine computes from the same tables."""

from __future__ import annotations

SALT = "tidemark-test-salt"

#: The transaction feed of sources.feeds.transactions.
FEED = """
feed AS (
  SELECT md5(CAST(e.event_id AS VARCHAR)) AS trans_num, CAST(e.ts AS TIMESTAMP) AS trans_time, 4000000000000000 + e.user_id AS cc_num,
    'fraud_m_' || CAST(e.event_id % 97 AS VARCHAR) AS merchant, e.event_type AS category, e.value AS amt,
    CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 'city_' || CAST(e.user_id % 31 AS VARCHAR) AS city, n.n_name AS state,
    CAST(e.user_id % 90000 + 10000 AS INTEGER) AS zip, CAST((e.user_id * 37) % 180 - 90 AS DOUBLE) AS lat, CAST((e.user_id * 53) % 360 - 180 AS DOUBLE) AS long,
    CAST((e.user_id * 101) % 50000 AS INTEGER) AS city_pop, 'job_' || CAST(e.user_id % 13 AS VARCHAR) AS job,
    DATE '1950-01-01' + CAST((e.user_id * 97) % 20000 AS INTEGER) AS dob,
    CAST((e.event_id * 41) % 180 - 90 AS DOUBLE) AS merch_lat, CAST((e.event_id * 59) % 360 - 180 AS DOUBLE) AS merch_long,
    CASE WHEN e.event_id % 37 = 0 THEN 1 ELSE 0 END AS is_fraud,
    CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE CAST(e.event_id % 90000 AS INTEGER) END AS merch_zipcode,
    CASE WHEN e.event_id % 3 = 0 THEN 'test' ELSE 'train' END AS source_split, e.event_id
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

DIRTY = """
dirty AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 101 = 1 THEN 'not-an-id' WHEN event_id % 101 = 2 THEN NULL ELSE trans_num END AS trans_num,
    CASE WHEN event_id % 101 = 3 THEN NULL ELSE trans_time END AS trans_time,
    CASE WHEN event_id % 101 = 4 THEN 0.0 WHEN event_id % 101 = 5 THEN 40000.0 WHEN event_id % 101 = 6 THEN NULL ELSE amt END AS amt,
    CASE WHEN event_id % 101 = 7 THEN 'no_such' WHEN event_id % 101 = 8 THEN NULL ELSE category END AS category,
    CASE WHEN event_id % 101 = 9 THEN 2 WHEN event_id % 101 = 10 THEN NULL ELSE is_fraud END AS is_fraud,
    CASE WHEN event_id % 101 = 11 THEN 200.0 WHEN event_id % 101 = 12 THEN NULL ELSE merch_lat END AS merch_lat)
  FROM feed
)"""

REASON = """CASE WHEN trans_num IS NULL OR NOT regexp_full_match(trans_num, '[0-9a-f]{32}') THEN 'invalid_trans_num'
  WHEN trans_time IS NULL THEN 'missing_timestamp' WHEN amt IS NULL OR amt <= 0 THEN 'non_positive_amount' WHEN amt > 30000 THEN 'implausible_amount'
  WHEN category NOT IN ('click', 'error', 'purchase', 'signup', 'view') THEN 'invalid_category'
  WHEN is_fraud IS NULL OR is_fraud NOT IN (0, 1) THEN 'invalid_is_fraud_flag'
  WHEN merch_lat IS NULL OR merch_long IS NULL OR merch_lat NOT BETWEEN -90 AND 90 OR merch_long NOT BETWEEN -180 AND 180 THEN 'invalid_merchant_coordinates' END"""

CHANNELS = "channels AS (SELECT * FROM (VALUES ('click', 'online'), ('view', 'online'), ('purchase', 'in_person'), ('error', 'general')) t(category, channel))"


def r(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), {places}) AS DOUBLE)"


def total(x: str = "amt", places: int = 2) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{places}))) AS DOUBLE)"


def mean(x: str = "amt", places: int = 3, inner: int = 2) -> str:
    return r(f"CAST(sum(CAST({x} AS DECIMAL(18,{inner}))) AS DOUBLE) / count({x})", places)


def ratio(a: str, b: str, places: int = 6) -> str:
    return r(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", places)


def share(a: str, b: str, places: int = 3) -> str:
    return r(f"100.0::DOUBLE * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", places)


COUNT, FRAUD = "count(*) AS txns", "CAST(sum(coalesce(is_fraud, 0)) AS BIGINT) AS fraud_txns"
SUMS = f"{COUNT}, {FRAUD}, {total()} AS total_amt"
HAVERSINE = r("2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians(merch_lat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians(long)) / 2), 2))))", 3)
TX = f"""
tx AS (
  SELECT *, date_trunc('hour', trans_time) AS trans_hour_ts, CAST(trans_time AS DATE) AS trans_date, CAST(hour(trans_time) AS INTEGER) AS trans_hour,
    sha256('{SALT}' || CAST(cc_num AS VARCHAR)) AS cc_num_hash, {HAVERSINE} AS distance_km
  FROM feed
)"""
WITH = f"WITH {FEED}, {TX}"
HOURLY = f"hourly AS (SELECT trans_hour_ts, category, {SUMS}, {mean()} AS avg_amt, {ratio('sum(is_fraud)', 'count(*)')} AS fraud_rate FROM tx GROUP BY ALL)"
STATES = f"SELECT trans_hour_ts, state, {COUNT}, {total()} AS total_amt, {mean()} AS avg_amt FROM tx GROUP BY ALL"
DAILY = f"daily AS (SELECT cc_num_hash, trans_date, count(*) AS txns_that_day, {total()} AS amt_that_day, {r('max(amt)', 2)} AS max_amt_that_day FROM tx GROUP BY ALL)"
SERIES = f"""
volume AS (SELECT CAST(trans_time AS DATE) AS day, count(*) AS txns FROM feed WHERE category <> 'error' GROUP BY 1),
fraud AS (SELECT CAST(trans_time AS DATE) AS day, CAST(sum(is_fraud) AS BIGINT) AS fraud_txns FROM feed WHERE is_fraud = 1 GROUP BY 1),
days AS (SELECT coalesce(v.day, f.day) AS day, txns, fraud_txns FROM volume v FULL JOIN fraud f ON v.day = f.day),
series AS (
  SELECT CAST(c.day AS DATE) AS day, CAST(coalesce(txns, 0) AS BIGINT) AS txns, CAST(coalesce(fraud_txns, 0) AS BIGINT) AS fraud_txns,
    coalesce({ratio('coalesce(fraud_txns, 0)', 'coalesce(txns, 0)')}, 0.0) AS fraud_rate
  FROM (SELECT unnest(generate_series((SELECT min(day) FROM days), (SELECT max(day) FROM days), INTERVAL 1 DAY)) AS day) c LEFT JOIN days d ON CAST(c.day AS DATE) = d.day
)"""
NAIVE = """
naive AS (
  SELECT t.day, t.txns AS actual, l.txns AS forecast
  FROM (SELECT *, 6 - date_diff('day', day, (SELECT max(day) FROM series)) AS i FROM series) t
  LEFT JOIN (SELECT 13 - date_diff('day', day, (SELECT max(day) FROM series)) AS slot, txns FROM series) l ON l.slot = t.i % 7 AND l.slot BETWEEN 0 AND 6
  WHERE t.i >= 0
)"""
SCORED = "scored AS (SELECT *, CAST((event_id * 7919 + is_fraud * 211) % 1000 AS DOUBLE) / 1000.0 AS score FROM feed)"
DECIDED = "decided AS (SELECT *, CASE WHEN score >= 0.9 THEN 'DECLINE' WHEN score >= 0.7 THEN 'REVIEW' ELSE 'APPROVE' END AS decision FROM scored)"

"""Feeds: explicit schemas for files and messages, and adapters that bring other tables into the shape of a transaction feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(columns: str) -> T.StructType:
    """Of "name type, ..."; needs no session, as a parser of Spark would."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


# Column names and types of the feed and of stream events.
RAW_FEED = _struct(
    "trans_date_trans_time timestamp_ntz, cc_num bigint, merchant string, category string, amt double, first string, last string, gender string, street string, city string, state string, zip int,"
    " lat double, long double, city_pop int, job string, dob string, trans_num string, unix_time bigint, merch_lat double, merch_long double, is_fraud int, merch_zipcode double"
)
STREAM_EVENT = _struct(
    "trans_num string, event_ts string, ingested_ts string, late boolean, amt double, category string, merchant string, state string, cc_num_hash string, cc_num_last4 string, is_fraud bigint, distance_km double, redelivery boolean"
)
CATEGORY_REF = _struct("category string, channel string")
RENAMES = {"trans_date_trans_time": "trans_time"}
#: Seconds with or without a fraction.
CSV_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
INDEX_COLUMNS = ("_c0", "Unnamed: 0")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_FEED) -> DataFrame:
    """A CSV with a header. With a schema nothing is inferred: one pass, and the same types for every file."""
    if schema is not None:
        return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("timestampNTZFormat", CSV_TIME).csv(path)
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return df.drop(*(c for c in INDEX_COLUMNS if c in df.columns))


def renamed(df: DataFrame, names: dict[str, str] = RENAMES) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns and a != b})


def with_lineage(df: DataFrame, file: str, split: str, batch_id: str, at: Column | None = None) -> DataFrame:
    return df.withColumns({"source_file": F.lit(file), "source_split": F.lit(split), "batch_id": F.lit(batch_id), "ingested_at": F.current_timestamp() if at is None else at})


def decode_events(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to typed columns; rows without a key or a readable time are dropped, a malformed message is such a row."""
    parsed = df.select(F.from_json(F.col(value).cast("string"), STREAM_EVENT).alias("e")).select("e.*")
    return parsed.withColumn("event_ts", F.try_to_timestamp("event_ts")).where("trans_num is not null and event_ts is not null")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, state: bool = True) -> DataFrame:
    """The ``events`` table as a raw transaction feed; customer and nation give the state, which costs two joins if asked for.

    Everything follows from ids by whole-number arithmetic, so that any engine gets the same feed.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    if state:
        events = _with_state(spark, sf_dir, events)
    return events.select(*_feed_columns(), *(["state"] if state else []))


def _feed_columns() -> list[Column]:
    e, u = F.col("event_id"), F.col("user_id")
    return [
        F.md5(e.cast("string")).alias("trans_num"),
        F.col("ts").cast("timestamp_ntz").alias("trans_time"),
        (F.lit(4_000_000_000_000_000) + u).alias("cc_num"),
        F.concat(F.lit("fraud_m_"), (e % 97).cast("string")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amt"),
        F.when(u % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("city_"), (u % 31).cast("string")).alias("city"),
        (u % 90000 + 10000).cast("int").alias("zip"),
        ((u * 37) % 180 - 90).cast("double").alias("lat"),
        ((u * 53) % 360 - 180).cast("double").alias("long"),
        ((u * 101) % 50000).cast("int").alias("city_pop"),
        F.concat(F.lit("job_"), (u % 13).cast("string")).alias("job"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((u * 97) % 20000).cast("int")).cast("string").alias("dob"),
        ((e * 41) % 180 - 90).cast("double").alias("merch_lat"),
        ((e * 59) % 360 - 180).cast("double").alias("merch_long"),
        F.when(e % 37 == 0, 1).otherwise(0).alias("is_fraud"),
        F.when(e % 7 == 0, None).otherwise(e % 90000).cast("int").alias("merch_zipcode"),
        F.when(e % 3 == 0, "test").otherwise("train").alias("source_split"),
        e,
    ]


def _with_state(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    return events.join(customers, "user_id", "left").join(nations, "c_nationkey", "left")


def dirty_transactions(spark: SparkSession, sf_dir: str, state: bool = False) -> DataFrame:
    """The feed with faults put in by id, one kind in each residue class, so that every rule has rows."""
    e = F.col("event_id") % 101
    return transactions(spark, sf_dir, state).withColumns(
        {
            "trans_num": F.when(e == 1, "not-an-id").when(e == 2, None).otherwise(F.col("trans_num")),
            "trans_time": F.when(e == 3, None).otherwise(F.col("trans_time")),
            "amt": F.when(e == 4, 0.0).when(e == 5, 40000.0).when(e == 6, None).otherwise(F.col("amt")),
            "category": F.when(e == 7, "no_such").when(e == 8, None).otherwise(F.col("category")),
            "is_fraud": F.when(e == 9, 2).when(e == 10, None).otherwise(F.col("is_fraud")),
            "merch_lat": F.when(e == 11, 200.0).when(e == 12, None).otherwise(F.col("merch_lat")),
        }
    )


def categories(spark: SparkSession) -> DataFrame:
    """A category dimension for the adapted feed; ``signup`` is left out, which leaves rows unmatched."""
    return spark.createDataFrame([("click", "online"), ("view", "online"), ("purchase", "in_person"), ("error", "general")], CATEGORY_REF)


FEED_CATEGORIES = ("click", "error", "purchase", "signup", "view")

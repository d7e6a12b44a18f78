"""Sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def create(name: str = "tidemark", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """``spark`` with its clock set to UTC, which casts between zoned and zone-less times go by."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def object_store(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict[str, str]:
    """Settings for tables in a store that speaks S3; needs Hadoop's AWS package on the class path."""
    base = "spark.hadoop.fs.s3a."
    return {
        f"{base}endpoint": endpoint,
        f"{base}access.key": access_key,
        f"{base}secret.key": secret_key,
        f"{base}path.style.access": str(path_style).lower(),
        f"{base}connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }

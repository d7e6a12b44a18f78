"""Versioned tables on plain Parquet: atomic publish, write-audit-publish, partition overwrite, upsert, export.

A table is a folder of data folders, manifests and a pointer file that names the current manifest. A manifest lists the
folders that make up a version, one a partition, so that a version may share the partitions it doesn't change with the one
before. New data is written in full, checked, and only then named; readers that resolved the pointer before go on with their
version. All file access goes through Hadoop's FileSystem API, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

POINTER, VERSION = "_CURRENT", "tidemark_version"


def workdir(spark: SparkSession) -> str:
    """A shared folder for tables of queries and tests: ``spark.checkpoint.dir``, or one of our own in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"


class Files:
    """The little of Hadoop's FileSystem that tables need."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.Path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.utils = jvm.org.apache.commons.io.IOUtils

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.Path(path))

    def write(self, path: str, text: str) -> None:
        """Through a file beside it and a rename, so that no reader sees half of it."""
        beside = self.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(beside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target = self.Path(path)
        if not self.fs.rename(beside, target):
            self.fs.delete(target, False)
            if not self.fs.rename(beside, target):
                raise OSError(f"cannot replace {path}")

    def read(self, path: str) -> str:
        stream = self.fs.open(self.Path(path))
        try:
            return self.utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self.fs.delete(self.Path(path), True)

    def list(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.Path(path))) if self.exists(path) else []


def days(time: str) -> str:
    """The UTC day of a timestamp column, whatever the session's time zone; a transform of tables. For a column without zone ``to_date`` does."""
    return f"date_from_unix_date(cast(floor(unix_seconds({time}) / 86400) as int))"


def buckets(key: str, n: int) -> str:
    """One of ``n`` buckets by the hash of a column; a transform of tables."""
    return f"cast(pmod(xxhash64({key}), {n}) as int)"


class AuditError(Exception):
    """A staged version was not published."""


@dataclass
class Table:
    """A versioned table at ``path``.

    ``keyed_partitions``: the partition columns follow from the keys of an upsert (as a window's day from its start), so
    that a row and the one it replaces lie in one partition. ``transforms`` are further partition columns by name, as SQL over
    the rows (``days`` and ``buckets`` write such SQL); they are made on writing and readers don't see them. ``kind`` is the
    format of the files, one that Spark writes in folders with a schema of their own: parquet or orc.
    """

    spark: SparkSession
    path: str
    partition_by: Sequence[str] = ()
    keyed_partitions: bool = False
    transforms: Mapping[str, str] = field(default_factory=dict)
    kind: str = "parquet"

    @property
    def _by(self) -> list[str]:
        return [*self.partition_by, *self.transforms]

    @property
    def files(self) -> Files:
        return Files(self.spark, self.path)

    def current(self) -> str | None:
        files = self.files
        return files.read(f"{self.path}/{POINTER}").strip() if files.exists(f"{self.path}/{POINTER}") else None

    def _manifest(self) -> dict | None:
        version = self.current()
        return json.loads(self.files.read(f"{self.path}/_manifests/{version}.json")) if version is not None else None

    def _open(self, manifest: dict, only: Sequence[str] | None = None) -> DataFrame:
        """The rows of a manifest's partitions, or of those named in ``only``."""
        schema = StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/{v}/{p}".rstrip("/") for p, v in manifest["partitions"].items() if only is None or p in only]
        if not folders:
            return self.spark.createDataFrame([], schema).drop(*self.transforms)
        reader = self.spark.read.schema(StructType([*schema.fields, StructField(VERSION, StringType())])) if self._by else self.spark.read.schema(schema)
        out = (reader.option("basePath", self.path) if self._by else reader).format(self.kind).load(folders)
        return out.select(*(c for c in schema.names if c not in self.transforms))

    def read(self) -> DataFrame:
        manifest = self._manifest()
        if manifest is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        return self._open(manifest)

    def _stage(self, df: DataFrame) -> dict:
        """Write ``df`` to a folder of its own; the manifest of what it holds."""
        version = f"{VERSION}={uuid.uuid4().hex}"
        if clash := set(self.transforms) & set(df.columns):
            raise ValueError(f"columns named as transforms: {sorted(clash)}")
        df = df.withColumns({name: F.expr(made) for name, made in self.transforms.items()}) if self.transforms else df
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*self._by) if self._by else writer).format(self.kind).save(f"{self.path}/{version}")
        found = [""]
        for _ in self._by:
            found = [f"{p}/{d}".lstrip("/") for p in found for d in self.files.list(f"{self.path}/{version}/{p}") if "=" in d]
        return {"schema": df.schema.jsonValue(), "partitions": dict.fromkeys(found, version)}

    def _name(self, manifest: dict) -> None:
        version = uuid.uuid4().hex
        self.files.write(f"{self.path}/_manifests/{version}.json", json.dumps(manifest))
        self.files.write(f"{self.path}/{POINTER}", version)

    def publish(self, df: DataFrame, audit: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Write, audit what was written, then point readers to it. If ``audit`` raises, the table is as before and what was
        staged stays for inspection."""
        manifest = self._stage(df)
        staged = self._open(manifest)
        if audit is not None:
            audit(staged)
        self._name(manifest)
        return staged

    def replace(self, rows: DataFrame, partitions: Sequence[str], audit: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """``partitions`` (as "day=2020-01-01") hold the rows of ``rows`` and nothing else from now on, those without rows
        are gone, and all others stay as they are, unread. ``rows`` must not have rows of other partitions."""
        manifest = self._manifest()
        kept = {p: v for p, v in (manifest["partitions"] if manifest else {}).items() if p not in set(partitions)}
        fresh = self._stage(rows)
        if audit is not None:
            audit(self._open(fresh))
        if stray := set(fresh["partitions"]) - set(partitions):
            raise AuditError(f"rows of other partitions: {sorted(stray)[:5]}")
        merged = fresh | {"partitions": kept | fresh["partitions"]}
        self._name(merged)
        return self._open(merged)

    def partitions(self) -> list[str]:
        manifest = self._manifest()
        return sorted(manifest["partitions"]) if manifest else []

    def upsert(self, rows: DataFrame, keys: Sequence[str], batch_id: int | str | None = None, audit: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Rows of ``rows`` replace those with equal keys. A batch whose id was the last one applied is not applied again.

        With ``keyed_partitions`` only the partitions that ``rows`` falls into are read and written anew.
        """
        files, mark = self.files, f"{self.path}/_LAST_BATCH"
        if batch_id is not None and files.exists(mark) and files.read(mark) == str(batch_id):
            return self.read()
        manifest, kept = self._manifest(), {}
        if manifest is not None:
            old, only = self._open(manifest), None
            as_now = all([d.split("=")[0] for d in p.split("/")] == self._by for p in manifest["partitions"])
            if self.keyed_partitions and self._by and as_now:
                fresh = self._stage(rows)  # its folders name the partitions
                rows, only = self._open(fresh), set(fresh["partitions"])
                kept = {p: v for p, v in manifest["partitions"].items() if p not in only}
                old = self._open(manifest, only)
            rows = old.join(rows, [old[k].eqNullSafe(rows[k]) for k in keys], "left_anti").unionByName(rows)
        merged = self._stage(rows)
        merged["partitions"] = kept | merged["partitions"]
        out = self._open(merged)
        if audit is not None:
            audit(out)
        self._name(merged)
        if batch_id is not None:
            files.write(mark, str(batch_id))
        return out


def save_managed(df: DataFrame, name: str, kind: str = "delta", path: str | None = None) -> DataFrame:
    """``name`` in Spark's catalog, overwritten whole in a table format of its own choice (``delta`` needs its package);
    at ``path``, or where the catalog puts it."""
    writer = df.write.format(kind).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def export(spark: SparkSession, tables: dict[str, tuple[DataFrame | None, str | None, bool]], path: str, files_each: int = 4) -> list[dict]:
    """Write each table as Parquet and a manifest of row counts, columns and watermarks.

    ``tables``: name to (table or None, watermark column or None, optional). Counts and watermarks are observed while
    the rows are written, not in a second pass.
    """
    from pyspark.sql import Observation

    manifest = []
    for name, (df, watermark, optional) in tables.items():
        if df is None:
            if optional:
                continue
            raise FileNotFoundError(f"{name} is missing and not optional")
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        top = F.max(F.col(watermark).cast("string") if watermark else F.lit(None).cast("string"))
        observed = df.observe(seen, F.count(F.lit(1)).alias("n"), top.alias("w"))
        observed.coalesce(files_each).write.mode("overwrite").parquet(f"{path}/{name}")
        got = seen.get
        manifest.append({"table": name, "row_count": int(got["n"]), "columns": df.columns, "watermark": got["w"]})
    Files(spark, path).write(f"{path}/_manifest.json", json.dumps({"tables": manifest}, indent=1))
    return manifest


def reconcile(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Row counts of the exported files against the manifest; raises if any differ."""
    manifest = json.loads(Files(spark, path).read(f"{path}/_manifest.json"))
    counts = {t["table"]: (t["row_count"], spark.read.parquet(f"{path}/{t['table']}").count()) for t in manifest["tables"]}
    wrong = {k: v for k, v in counts.items() if v[0] != v[1]}
    if wrong:
        raise AuditError(f"manifest and files differ: {wrong}")
    return counts


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header: for extracts of bounded size."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_warehouse(df: DataFrame, url: str, table: str, **options: str) -> int:
    """Replace a table of a warehouse through JDBC, and compare what it then holds with what was sent; needs its driver."""
    from pyspark.sql import Observation

    seen = Observation(f"jdbc-{uuid.uuid4().hex[:8]}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options).mode("overwrite").save()
    held = df.sparkSession.read.format("jdbc").options(url=url, dbtable=table, **options).load().count()
    if held != seen.get["n"]:
        raise AuditError(f"{table} holds {held} rows of {seen.get['n']}")
    return held

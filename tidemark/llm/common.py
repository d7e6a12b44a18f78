"""What the operators of this subpackage share: scratch tables, text batches and packed payloads.

Scratch tables go to the folder that the cluster names in ``spark.checkpoint.dir``; every executor and the driver
see it, so a lost executor costs a re-read and nothing else.
"""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

#: Bytes of text that one batch (one call of a grouped Python function) holds on average.
BATCH_BYTES = 8 << 20
LAST_ID = (1 << 63) - 1


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; a folder of our own only in local mode with the setting unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to be none of ``df``'s columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(docs: DataFrame, rows: int = 512) -> DataFrame:
    """``docs``; its session sends Python workers Arrow batches of at most ``rows`` rows from now on.

    The default of 10,000 rows is meant for numbers; with texts it fills the JVM with buffers of tens of MB.
    """
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if int(conf.get(key, "10000")) > rows:
        conf.set(key, str(rows))
    return docs


def squeezed(df: DataFrame, column: str, back: bool = False) -> DataFrame:
    """``df`` with the texts of ``column`` compressed to binary, or ``back`` again; null stays null.

    Texts that are shuffled more than once take about half the bytes so.
    """
    at = df.columns.index(column)

    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            if back:
                values = [None if x is None else codec.decompress(x[4:], int.from_bytes(x[:4], "little"), asbytes=True) for x in batch.column(at).to_pylist()]
                values = pa.array(values, pa.binary()).cast(pa.string())
            else:
                raw = batch.column(at).cast(pa.binary()).to_pylist()
                values = pa.array([None if x is None else len(x).to_bytes(4, "little") + codec.compress(x, asbytes=True) for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([values if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    schema = StructType([StructField(f.name, StringType() if back else BinaryType(), True) if k == at else f for k, f in enumerate(df.schema.fields)])
    return df.mapInArrow(run, schema)


def text_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES, carry: bool = False) -> DataFrame:
    """(batch, doc_id, text) and, to ``carry`` them along, all other columns as a struct ``rest``: documents dealt by hash into batches of about ``batch_bytes`` of text each.

    The number of batches follows the bytes of the table, so a batch keeps its size at any scale. Copies of one text
    under different doc_ids fall into different batches.
    """
    rest = [F.struct(F.lit(None).cast("int").alias("__"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text"))).alias("rest")] if carry else []
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *rest)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / batch_bytes))
    return docs.select(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n)).cast("int").alias("batch"), *docs.columns)


BLOB_BYTES = 16 << 20
DOC = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def blob_batches(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """(batch, blob): like text_batches, but documents of one batch that a task meets lie together in a compressed blob.

    Texts shuffled this way take about half the bytes that they take as rows.
    """
    batched = text_batches(docs, batch_bytes)

    def run(batches):
        held, size = [], 0

        def flush():
            table = pa.concat_tables(held)
            batch = table["batch"].to_numpy()
            out = []
            for b in np.unique(batch):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, DOC, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_table(table.select(["doc_id", "text"]).take(np.flatnonzero(batch == b)).cast(DOC).combine_chunks())
                out.append((int(b), sink.getvalue().to_pybytes()))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["batch", "blob"])

        for b in batches:
            held.append(pa.Table.from_batches([b]))
            size += b.nbytes
            if size >= BLOB_BYTES:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return batched.mapInArrow(run, "batch int, blob binary")


def of_blobs(blobs: pa.ChunkedArray) -> pa.Table:
    """The documents (doc_id, text) of one batch's blobs."""
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in blobs.to_pylist()] or [DOC.empty_table()])


def sorted_rows(table: pa.Table) -> tuple[np.ndarray, list, list[int]]:
    """doc_ids (null: LAST_ID) and texts (null: None) of a batch in an order that depends on the rows alone, and that order."""
    ids = np.array([LAST_ID if x is None else x for x in table["doc_id"].to_pylist()], np.int64)
    texts = table["text"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or ""))
    return ids[order], [texts[i] for i in order], order


def pack(a: np.ndarray) -> bytes:
    """An integer array as bytes, byte planes apart and compressed; sorted input should be differenced before."""
    a = np.ascontiguousarray(a)
    width = a.dtype.itemsize
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes() if len(a) else b""
    return pa.Codec("zstd").compress(planes, asbytes=True)


def unpack(b: bytes, n: int, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = pa.Codec("zstd").decompress(b, n * dtype.itemsize, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).reshape(-1).view(dtype) if n else np.empty(0, dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, n: int, dtype) -> np.ndarray:
    return np.cumsum(unpack(b, n, dtype), dtype=dtype)


def fixed(x: np.ndarray, bits: int) -> np.ndarray:
    """``x`` rounded to ``bits`` binary digits after the point. Sums of products of such numbers are exact in any order while they fit 53 bits."""
    return np.rint(np.asarray(x, np.float64) * (1 << bits)) / (1 << bits)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the result depends on every bit of ``h``."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hash_words(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: its bytes times random numbers by place, summed and mixed; no table of words is kept."""
    if not words:
        return np.empty(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    factor = mix(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    value = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    value *= factor[place]
    return mix(np.add.reduceat(value, first) ^ (sizes.astype(np.uint64) << np.uint64(56)))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` consecutive word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
    return mix(out)

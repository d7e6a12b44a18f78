"""Approximate nearest neighbours by multi-index hashing.

Codes are the signs of learned rotations of the vectors, turned by iterative quantisation on a bounded sample from different
starts until there are bits enough. A code is split into ``SUBSTRINGS`` substrings, about as
long as the logarithm of the number of vectors, and each substring is indexed. By the pigeonhole principle a code that differs from
the query's in fewer than (flips + 1) * SUBSTRINGS bits agrees with it in one substring up to ``flips`` bits; probing all
values that near retrieves every such code, and many that are further. Codes beyond ``radius`` go, the others' floats are reranked by exact cosine.

The index is a table of buckets. A bucket is a substring and the first bits of its value; a vector goes to one bucket
for each substring, a query to all buckets that its flips can reach, with the flips that are left for the other bits.
Buckets hold about ``SHARD_ROWS`` rows at any size of the table; larger ones (vectors that lie close together) and those that
many queries reach are dealt over parts. A bucket is sorted once, and queries look their values up in it.

``flips`` and ``radius`` come from ``PROBES`` sampled vectors and their true neighbours in the whole table: the fewest flips that reach
``RECALL`` of these. A query that finds fewer than ``k`` rows probes again with more flips, up to all rows.

Different vectors are indexed once, however many rows hold them; of the rows that hold one vector the few with the smallest
vec_ids can be among the nearest of anything, and only those are reranked.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no part; vectors of different lengths are
searched apart, each among those of its length; ties go to the smaller vec_id; a null vec_id takes no part; repeated rows are candidates each, and one query; no row
with a query's vec_id is its candidate; a query's vec_id with several vectors takes the largest cosine of any; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import fixed, materialize

SAMPLE, SUBSTRINGS, ITERATIONS, SEED = 4096, 20, 20, 11
#: Least and most bits of a substring; sampled vectors whose neighbours are looked up; shares of these to be reached by probing and by radius.
LEAST_BITS, MOST_BITS, PROBES, RECALL, WITHIN = 8, 24, 192, 0.93, 0.995
SHARD_ROWS = 65536
#: Queries of one part of a bucket; most buckets that are dealt over parts, which sets how large one must be.
PART_QUERIES, MOST_DEALT = 16384, 1 << 16
#: Bytes of query vectors that are sent to the executors at once for reranking.
BLOCK_BYTES = 64 << 20


@dataclass
class Codes:
    """The learned codes: a fixed size for a number of dimensions."""

    mean: np.ndarray
    turn: np.ndarray  # dimensions x code bits, whole rotations
    width: int  # bits of a substring
    flips: int
    radius: int

    @property
    def substrings(self) -> int:
        return self.turn.shape[1] // self.width

    def bits(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        # fixed point: the sums are exact in any order, so a vector has one code whatever batch it comes in
        return fixed(unit - self.mean, 20) @ fixed(self.turn[:, : self.substrings * self.width], 22) > 0

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Rows of 64-bit words."""
        packed = np.packbits(self.bits(x), axis=1)
        out = np.zeros((len(x), self.words * 8), np.uint8)
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)

    @property
    def words(self) -> int:
        return -(-self.substrings * self.width // 64)

    def values(self, codes: np.ndarray, j: int) -> np.ndarray:
        """The ``j``-th substring of each code as a number."""
        own = np.unpackbits(codes.view(np.uint8), axis=1, count=(j + 1) * self.width)[:, j * self.width :]
        return own @ (1 << np.arange(self.width - 1, -1, -1, dtype=np.int64))


def distances(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ query).sum(axis=1, dtype=np.int32)


def learn(sample: np.ndarray, width: int = 16) -> Codes:
    """Rotations by iterative quantisation; flips and radius are set to reach everything."""
    rng = np.random.default_rng(SEED)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = x.mean(0)
    c = x - mean
    dims = x.shape[1]
    turns = []
    for _ in range(-(-SUBSTRINGS * width // dims)):
        r, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
        for _ in range(ITERATIONS):
            u, _, vt = np.linalg.svd(np.sign(c @ r).T @ c)
            r = vt.T @ u.T
        turns.append(r)
    turn = np.concatenate(turns, axis=1)
    return Codes(mean, turn, width, width, turn.shape[1])


class MultiIndex:
    """A sorted table for each column of ``codes`` (a column is a substring), in which up to all of the ``width`` low bits may differ."""

    def __init__(self, codes: np.ndarray, width: int | None = None):
        self.codes, self.width = codes, codes.itemsize * 8 if width is None else width
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.sorted = [c[o] for c, o in zip(codes.T, self.order, strict=True)]
        self.looked_at = 0  # rows that probes have brought up

    def probe(self, query: np.ndarray, flips: int) -> np.ndarray:
        """All rows that agree with ``query`` in a substring up to ``flips`` bits."""
        found = []
        low = self.codes.dtype.type((1 << self.width) - 1)
        for value, have, order in zip(query, self.sorted, self.order, strict=True):
            if sum(math.comb(self.width, f) for f in range(flips + 1)) > len(have):  # fewer rows than values: look at each
                other = have ^ value
                rows = order[(np.bitwise_count(other) <= flips) & (other <= low)]
            else:
                values = value ^ _flips(self.width, flips).astype(have.dtype)
                first, last = np.searchsorted(have, values, "left"), np.searchsorted(have, values, "right")
                n = last - first
                rows = order[np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)]
            found.append(rows)
            self.looked_at += len(rows)
        return np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``query`` in ``radius`` bits or fewer."""
        rows = self.probe(query, min(self.width, radius // len(query)))
        return rows[distances(self.codes[rows], query) <= radius]


_flip_cache: dict[tuple[int, int], np.ndarray] = {}


def _flips(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with up to ``most`` set."""
    if (width, most) not in _flip_cache:
        _flip_cache[width, most] = np.array([sum(1 << b for b in c) for n in range(min(width, most) + 1) for c in combinations(range(width), n)], np.int64)
    return _flip_cache[width, most]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; a row's result doesn't depend on the other rows."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _matrix(column, dims: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (float or double), size, and two hashes that name the vector."""
    v = F.col("embedding")
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = v if kind == "array<float>" else v.cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(~bad & F.exists(v, lambda c: c != 0))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"), F.size(v).alias("size"), F.xxhash64(v).alias("v1"), F.xxhash64(F.lit(1), v).alias("v2"))


def calibrate(codes: Codes, sample: np.ndarray, nodes: DataFrame, k: int, recall: float = RECALL) -> Codes:
    """``codes`` with the flips and the radius that sampled vectors need to reach their true neighbours among all ``nodes``."""
    dims, few = codes.turn.shape[0], sample[:PROBES]
    unit = few / np.sqrt((few * few).sum(axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows = np.full((len(few), k + 1), -2.0), np.zeros((len(few), k + 1, dims))
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["embedding"], dims)
            s = unit @ (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).T
            top = np.argpartition(-s, min(k, s.shape[1] - 1), axis=1)[:, : k + 1]
            both, each = np.concatenate([best, np.take_along_axis(s, top, 1)], axis=1), np.concatenate([rows, x[top]], axis=1)
            kept = np.argsort(-both, axis=1, kind="stable")[:, : k + 1]
            best, rows = np.take_along_axis(both, kept, 1), np.take_along_axis(each, kept[:, :, None], 1)
        at, _ = np.nonzero(best > -2)
        found = rows[best > -2]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best[best > -2]), pa.array(list(found), pa.list_(pa.float64()))], names=["probe", "score", "embedding"])

    near = nodes.select("embedding").mapInArrow(run, "probe int, score double, embedding array<double>")
    near = near.withColumn("r", F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score")))).where(F.col("r").between(2, k + 1)).toArrow()  # k rows a probe; the first is the vector itself
    if len(near):
        a, b = codes.bits(few)[near["probe"].to_numpy()], codes.bits(_matrix(near["embedding"], dims))
        apart = (a != b).reshape(len(a), codes.substrings, codes.width).sum(axis=2)
        codes.flips = int(np.quantile(apart.min(axis=1), recall, method="higher"))
        codes.radius = int(np.quantile(apart.sum(axis=1), WITHIN, method="higher"))
    return codes


class Buckets:
    """Which buckets codes and queries go to, and over how many parts those with many of either are dealt."""

    def __init__(self, codes: Codes, n: int, shard_rows: int):
        self.codes, self.part_rows = codes, max(2 * shard_rows, 2 * n * codes.substrings // MOST_DEALT)
        self.prefix = min(codes.width, max(0, math.ceil(math.log2(max(1, n) / shard_rows))))
        self.low = codes.width - self.prefix
        self.dealt: dict[int, tuple[int, int]] = {}

    def of_rows(self, code: np.ndarray) -> np.ndarray:
        """Rows x substrings."""
        return np.stack([(j << self.prefix) + (self.codes.values(code, j) >> self.low) for j in range(self.codes.substrings)], axis=1)

    def of_queries(self, code: np.ndarray, flips: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets as queries x (substrings * ways), and the flips that are left for each way."""
        ways = _flips(self.prefix, flips)
        at = self.of_rows(code)
        return (at[:, :, None] ^ ways).reshape(len(code), -1), np.tile(flips - np.bitwise_count(ways).astype(np.int64), at.shape[1])


DEALT = "bucket long, row_part int, query_part int, is_query boolean, payload binary"


def _deal(frame: DataFrame, buckets: Buckets, flips: int | None) -> DataFrame:
    """Codes of ``frame`` (v1, embedding) packed by bucket: of rows, or of queries with ``flips``.

    A row goes to one row part of its bucket and to all query parts, a query to all row parts and one query part.
    """
    codes, dims = buckets.codes, buckets.codes.turn.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            code, name = codes.encode(_matrix(batch["embedding"], dims)), batch["v1"].to_numpy()
            at, left = (buckets.of_rows(code), None) if flips is None else buckets.of_queries(code, flips)
            row = np.repeat(np.arange(len(code)), at.shape[1])
            rest = np.zeros(len(row), np.int64) if left is None else np.tile(left, len(code))
            to = at.ravel()
            order = np.argsort(to, kind="stable")
            to, row, rest = to[order], row[order], rest[order]
            edge = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]]))
            out: list[tuple] = []
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                bucket, own = int(to[i]), np.arange(i, j)
                row_parts, query_parts = buckets.dealt.get(bucket, (1, 1))
                mine, others = (row_parts, query_parts) if flips is None else (query_parts, row_parts)
                part = (name[row[own]].view(np.uint64) >> np.uint64(7)) % np.uint64(mine)
                for p in np.unique(part).tolist():
                    x = own[part == p]
                    payload = name[row[x]].tobytes() + code[row[x]].tobytes() + (b"" if left is None else rest[x].astype(np.uint8).tobytes())
                    out += [(bucket, int(p), o, False, payload) if flips is None else (bucket, o, int(p), True, payload) for o in range(others)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["bucket", "row_part", "query_part", "is_query", "payload"])

    return frame.select("v1", "embedding").mapInArrow(run, DEALT)


def _set_parts(buckets: Buckets, rows: DataFrame, queries: DataFrame, flips: int) -> None:
    """Deal buckets of many rows or queries over parts. Only these buckets reach the driver, MOST_DEALT for either reason at most."""
    codes, dims, many = buckets.codes, buckets.codes.turn.shape[0], max(PART_QUERIES, buckets.part_rows // 8)

    def counting(is_query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code = codes.encode(_matrix(batch["embedding"], dims))
                to, n = np.unique(buckets.of_queries(code, flips)[0] if is_query else buckets.of_rows(code), return_counts=True)
                none = np.zeros(len(n), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(none if is_query else n), pa.array(n if is_query else none)], names=["bucket", "r", "q"])

        return run

    kind = "bucket long, r long, q long"
    counts = rows.select("embedding").mapInArrow(counting(False), kind).union(queries.select("embedding").mapInArrow(counting(True), kind))
    large = counts.groupBy("bucket").agg(F.sum("r").alias("r"), F.sum("q").alias("q")).where((F.col("r") > buckets.part_rows) | (F.col("q") > many))
    buckets.dealt = {r["bucket"]: (-(-max(1, r["r"]) // buckets.part_rows), -(-max(1, r["q"]) // many)) for r in large.toLocalIterator()}


def candidates(rows: DataFrame, queries: DataFrame, buckets: Buckets, flips: int, radius: int) -> DataFrame:
    """(q, c): names of query vectors and of vectors within ``radius`` that agree with them in a substring up to ``flips`` bits."""
    codes, words, low = buckets.codes, buckets.codes.words, buckets.low

    def unpacked(payloads: list[bytes], extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        each, size = [], 8 + 8 * words + extra
        for p in payloads:
            n = len(p) // size
            each.append((np.frombuffer(p, np.int64, n), np.frombuffer(p, np.uint64, n * words, 8 * n).reshape(n, words), np.frombuffer(p, np.uint8, n * extra, 8 * n * (1 + words))))
        return tuple(np.concatenate(x) for x in zip(*each, strict=True))

    def search(key: tuple, table: pa.Table) -> pa.Table:
        is_query, payload = np.array(table["is_query"].to_pylist(), bool), table["payload"].to_pylist()
        q, c = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if is_query.any() and not is_query.all():
            bucket = table["bucket"][0].as_py()
            j, prefix = bucket >> buckets.prefix, bucket & ((1 << buckets.prefix) - 1)
            names, code, _ = unpacked([p for p, x in zip(payload, is_query, strict=True) if not x], 0)
            asked, query, left = unpacked([p for p, x in zip(payload, is_query, strict=True) if x], 1)
            index = MultiIndex(codes.values(code, j)[:, None], low)
            values = (prefix << low) + (codes.values(query, j) & ((1 << low) - 1))
            for i in range(len(asked)):
                found = index.probe(values[i : i + 1], min(low, int(left[i])))
                found = names[found[distances(code[found], query[i]) <= radius]]
                c.append(found)
                q.append(np.full(len(found), asked[i]))
        return pa.table({"q": pa.array(np.concatenate(q)), "c": pa.array(np.concatenate(c))})

    cells = _deal(rows, buckets, None).union(_deal(queries, buckets, flips))
    return cells.groupBy("bucket", "row_part", "query_part").applyInArrow(search, "q long, c long").distinct()


def rerank(pairs: DataFrame, rows: DataFrame, queries: DataFrame, dims: int, k: int) -> DataFrame:
    """(q, q2, best): of each query vector the rows that can be the ``k`` nearest of a query that holds it, nearest first.

    Query vectors are sent out in blocks of at most BLOCK_BYTES; a block is a pass over the pairs of its queries.
    """
    spark, done = rows.sparkSession, []
    blocks = max(1, math.ceil(queries.count() * dims * 8 / BLOCK_BYTES))
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("v1"), F.lit(blocks)) == b).select("v1", "v2", "embedding").toArrow()
        names, order = own["v1"].to_numpy(), np.argsort(own["v1"].to_numpy(), kind="stable")
        sent = spark.sparkContext.broadcast((names[order], own["v2"].to_numpy()[order], _matrix(own["embedding"], dims)[order]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, second, vectors = sent.value
            for batch in batches:
                x, lists = _matrix(batch["embedding"], dims), batch["qs"]
                ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                asked = lists.flatten().to_numpy()
                first, last = np.searchsorted(names, asked, "left"), np.searchsorted(names, asked, "right")
                n = last - first  # one, unless two vectors share a name
                at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
                row = np.repeat(np.repeat(np.arange(len(x)), np.diff(ends)), n)
                for i in range(0, len(at), 65536):
                    a, r = at[i : i + 65536], row[i : i + 65536]
                    score = cosine(x[r], vectors[a])
                    r = pa.array(r)
                    yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(second[a]), batch["vec_id"].take(r), pa.array(score), batch["v1"].take(r), batch["v2"].take(r), batch["copy"].take(r)], names=["q", "q2", "vec_id", "score", "c", "c2", "copy"])

        asked = pairs.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).groupBy("c").agg(F.collect_list("q").alias("qs"))  # a block's queries at most
        met = rows.join(asked, rows["v1"] == asked["c"]).select("vec_id", "embedding", "v1", "v2", "copy", "qs")
        found = met.mapInArrow(run, "q long, q2 long, vec_id long, score double, c long, c2 long, copy int")
        # k rows of each of k + 1 vec_ids are enough whichever vec_id is the query's own
        by_id = W.partitionBy("q", "q2", "vec_id").orderBy(F.desc("score"), "c", "c2", "copy")
        of_all = W.partitionBy("q", "q2").orderBy(F.desc("score"), "vec_id", "c", "c2", "copy")
        found = found.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k).withColumn("r", F.row_number().over(of_all)).where(F.col("r") <= k * (k + 1)).drop("r")
        done.append(found.groupBy("q", "q2").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "c", "c2", "copy"))).alias("best")))
    return reduce(DataFrame.union, done)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row of ``vectors`` (vec_id, embedding) with ``is_query`` the ``k`` nearest."""
    spark = vectors.sparkSession
    good = usable(vectors.withColumn("vec_id", F.col("vec_id").cast("long")))
    asked = usable(vectors.where(is_query)).select("vec_id", "size", "v1", "v2").distinct()
    # of the rows of one vector: k rows of each of its k + 1 smallest vec_ids
    of_id, of_vector = W.partitionBy("v1", "v2", "vec_id").orderBy("vec_id"), W.partitionBy("v1", "v2").orderBy("vec_id")
    rows = good.withColumn("copy", F.row_number().over(of_id)).where(F.col("copy") <= k).withColumn("r", F.dense_rank().over(of_vector)).where(F.col("r") <= k + 1)
    rows = materialize(rows.withColumn("first", (F.col("r") == 1) & (F.col("copy") == 1)).drop("r"), "vectors")
    asked = materialize(asked, "asked")
    found = [_nearest(rows.where(F.col("size") == r["size"]), asked.where(F.col("size") == r["size"]), r["n"], r["size"], k, shard_rows) for r in rows.where("first").groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect()]
    out = reduce(DataFrame.union, found) if found else spark.createDataFrame([], "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _nearest(rows: DataFrame, asked: DataFrame, n: int, dims: int, k: int, shard_rows: int) -> DataFrame:
    """(query_id, vec_id, score) among vectors of one length, ``n`` different ones."""
    nodes = rows.where("first")
    sample = _matrix(nodes.orderBy(F.xxhash64("vec_id"), "vec_id", "v1").limit(SAMPLE).select("embedding").toArrow()["embedding"], dims)  # SAMPLE rows
    codes = calibrate(learn(sample, min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(n + 1))))), sample, nodes, k)
    flips, radius, everything, done = codes.flips, codes.radius, codes.substrings * codes.width, []
    while True:
        queries = nodes.join(asked.select("v1", "v2").distinct(), ["v1", "v2"], "left_semi")
        buckets = Buckets(codes, n, shard_rows)
        _set_parts(buckets, nodes, queries, flips)
        best = rerank(candidates(nodes, queries, buckets, flips, radius), rows, queries, dims, k)
        met = asked.join(best, (asked["v1"] == best["q"]) & (asked["v2"] == best["q2"]), "left")
        others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
        met = materialize(met.select("vec_id", "size", "v1", "v2", others.alias("best")), "found")
        last = flips >= codes.width and radius >= everything
        enough = F.coalesce(F.size("best"), F.lit(0)) >= k
        done.append(met if last else met.where(enough))
        short = met.where(~enough)
        if last or short.isEmpty():
            break
        asked, flips, radius = short.select("vec_id", "size", "v1", "v2"), min(codes.width, 2 * flips + 2), everything
    found = reduce(DataFrame.union, done).select(F.col("vec_id").alias("query_id"), F.explode("best").alias("x"))
    # a row that several vectors of one query_id have found counts once
    return found.groupBy("query_id", "x.vec_id", "x.c", "x.c2", "x.copy").agg(F.max(-F.col("x.far")).alias("score")).select("query_id", "vec_id", "score")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0)

"""Resharding by minimum-cost flow.

``reshard`` takes rows that lie in old shards and new capacities in bytes. A min-cost flow from old to new shards
(staying costs nothing, moving a byte costs one) says how many bytes go where; the transfers are then cut from runs of
blocks of the smallest rows, so that whole rows move and sizes meet the capacities. Further rounds mend what whole
rows left over. Only the shards x shards flow problem is solved on the driver; no row goes there.

Defined results: a null text counts as empty (size 1); repeated rows are placed one by one; a null key is a key like
any other; an empty table gives an empty result; other columns are ignored by the plan and kept by ``rewrite``, one named as
its partition column too. A row larger than a capacity gets a shard that holds as little else as possible.

``rewrite`` carries the plan out on a versioned table of shards: shards whose rows change are written anew, those that are empty
now are dropped, the others keep their files; readers see all of it or nothing.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.sources.tables import Table

from .common import materialize, scratch_root, small_batches, spare, squeezed

#: Blocks of one size class in a shard, and of a shard without size classes. With the classes (4 to a power of 2) they
#: bound a shard's block table.
SUB_BLOCKS, MIXED_BLOCKS = 64, 1024
#: Rows of a shard that are numbered in one group, on average; rows a group repeats at once; bytes of text in a file.
SLOT_ROWS, REPEAT_ROWS, FILE_BYTES = 100_000, 10_000, 256 << 20


def min_cost_flow(supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[int]]) -> dict[tuple[int, int], int]:
    """Bytes from source i to sink j that serve all demand at least cost: successive shortest paths with potentials.

    ``sum(supply) == sum(demand)``. Every augmentation empties a source or fills a sink or an arc's reverse, so the
    work is bounded by the number of shards, not by bytes.
    """
    n, m = len(supply), len(demand)
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(demand)
    pot = [0] * (n + m)
    while any(left):
        dist, prev = [None] * (n + m), [None] * (n + m)
        heap = [(0, i) for i in range(n) if left[i]]
        for _, i in heap:
            dist[i] = 0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            arcs = ((n + j, cost[u][j]) for j in range(m)) if u < n else ((i, -cost[i][u - n]) for i in range(n) if flow.get((i, u - n)))
            for v, c in arcs:
                e = d + c + pot[u] - pot[v]
                if dist[v] is None or e < dist[v]:
                    dist[v], prev[v] = e, u
                    heapq.heappush(heap, (e, v))
        ends = [n + j for j in range(m) if room[j] and dist[n + j] is not None]
        t = min(ends, key=lambda v: (dist[v] + pot[v], v))
        pot = [p + (dist[t] if d is None else min(d, dist[t])) for p, d in zip(pot, dist, strict=True)]
        path, v = [], t
        while prev[v] is not None:
            path.append((prev[v], v))
            v = prev[v]
        amount = min(left[v], room[t - n], *(flow[y, x - n] for x, y in path if x >= n))
        for x, y in path:
            if x < n:
                flow[x, y - n] = flow.get((x, y - n), 0) + amount
            else:
                flow[y, x - n] -= amount
        left[v] -= amount
        room[t - n] -= amount
    return {k: v for k, v in flow.items() if v}


def capacities(total: int, largest: Sequence[int]) -> list[int]:
    """Equal parts of ``total``; a shard whose largest row exceeds its part is given that row's size instead."""
    n, out, pinned = len(largest), [0] * len(largest), set()
    while True:
        free = [j for j in range(n) if j not in pinned]
        rest = max(0, total - sum(largest[j] for j in pinned))
        part, extra = divmod(rest, len(free)) if free else (0, 0)
        for k, j in enumerate(free):
            out[j] = part + (k < extra)
        over = {j for j in free if largest[j] > out[j]}
        if not over or len(over) == len(free):
            break
        pinned |= over
    for j in pinned:
        out[j] = largest[j]
    out[-1 if not pinned else min(free, default=n - 1)] += total - sum(out)
    return out


def transfers(sizes: Sequence[int], room: Sequence[int]) -> dict[tuple[int, int], int]:
    """The bytes that each old shard sends to each other shard. Old shard i is at home in new shard i mod n."""
    n = len(room)
    cost = [[0 if i % n == j else 1 for j in range(n)] for i in range(len(sizes))]
    return min_cost_flow(sizes, room, cost)


def _round(rows: DataFrame, sizes: list[int], room: list[int], mixed: bool) -> DataFrame:
    """One application of the flow: rows keep or change ``shard``.

    ``mixed``: a shard sends rows of all sizes, as their hashes come, so that every shard has small ones for later.
    Otherwise it sends its largest rows that are not larger than what it has to send, from large to small, each to the
    transfer into which its bytes end; rows that would end beyond the last transfer stay. What is left over is less
    than a row, and a later round sends it in smaller rows.
    """
    spark, n = rows.sparkSession, len(room)
    sent = transfers(sizes, room)
    edges, surplus = [], []
    for i in range(len(sizes)):
        at = 0
        for j in range(n):
            if j != i % n and (amount := sent.get((i, j), 0)):
                edges.append((i, at, at + amount, j))
                at += amount
        edges.append((i, at, 1 << 62, i % n))  # the rest stays
        surplus.append((i, at, i % n))
    # (old shards) x (new shards) rows at most: a bound that doesn't grow with the data
    edge = F.broadcast(spark.createDataFrame(edges, "shard int, lo long, hi long, dest int"))
    limit = F.broadcast(spark.createDataFrame(surplus, "shard int, surplus long, home int"))
    block = ["shard", "class", "sub"]
    size_class = F.lit(0) if mixed else -F.floor(F.log2(F.col("size").cast("double")) * 4).cast("int")
    rows = rows.join(limit, "shard").withColumn("class", size_class).withColumn("sub", F.pmod(F.col("row_hash"), F.lit(MIXED_BLOCKS if mixed else SUB_BLOCKS)).cast("int"))
    may = rows.where(F.col("size") <= F.col("surplus"))
    stats = may.groupBy(*block).agg(F.sum("size").alias("block_bytes"))
    starts = stats.select(*block, (F.sum("block_bytes").over(W.partitionBy("shard").orderBy("class", "sub")) - F.col("block_bytes")).alias("before"))
    within = W.partitionBy(*block).orderBy(*([] if mixed else [F.desc("size")]), "row_hash", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    placed = may.join(starts, block).withColumn("end", F.col("before") + F.sum("size").over(within)).join(edge, "shard")
    placed = placed.where((F.col("end") > F.col("lo")) & (F.col("end") <= F.col("hi")))
    kept = ["doc_id", "size", "text_crc32", "row_hash", "old"]
    return placed.select(*kept, F.col("dest").alias("shard")).union(rows.where(F.col("size") > F.col("surplus")).select(*kept, F.col("home").alias("shard")))


def _sizes(rows: DataFrame, n: int) -> tuple[list[int], list[int]]:
    found = {r["shard"]: r for r in rows.groupBy("shard").agg(F.sum("size").alias("b"), F.max("size").alias("m")).collect()}  # a row a shard
    return [found[i]["b"] if i in found else 0 for i in range(n)], [found[i]["m"] if i in found else 0 for i in range(n)]


def reshard(docs: DataFrame, old_shard: Column, n_old: int, n_new: int, rounds: int = 7) -> DataFrame:
    """(doc_id, size, text_crc32, row_hash, old, shard, slot) of every row of ``docs``: where it lies and where it goes.

    ``old_shard`` gives the shard, 0 to n_old - 1, in which a row lies now. Sizes of the new shards differ by about
    the smallest rows, as far as whole rows allow.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("row_hash"), old_shard.cast("int").alias("old")).withColumn("shard", F.col("old"))
    rows = materialize(rows, "rows")
    n = n_old
    for k in range(rounds):
        sizes, largest = _sizes(rows, n)
        if n == n_new:
            room = capacities(sum(sizes), largest)
            if sizes == room:
                break
        else:
            room = capacities(sum(sizes), [0] * n_new)
        rows, n = materialize(_round(rows, sizes, room, k == 0), "round"), n_new
    return with_slots(rows)


def with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32, row_hash, shard and more) with ``slot``, gapless from 0 in each shard.

    Rows are numbered in parts by hash, as many as the rows ask for. Equal rows are one until they have their numbers.
    """
    parts = max(1, -(-rows.count() // SLOT_ROWS))
    each = rows.groupBy(*rows.columns).agg(F.count("*").alias("c")).withColumn("part", F.pmod(F.shiftright("row_hash", 8), F.lit(parts)))
    counts = each.groupBy("shard", "part").agg(F.sum("c").alias("n"))
    first = counts.select("shard", "part", (F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    before = F.sum("c").over(W.partitionBy("shard", "part").orderBy("row_hash", *[c for c in rows.columns if c not in ("row_hash", "shard")])) - F.col("c")
    placed = each.join(first, ["shard", "part"]).withColumn("at", F.col("first") + before)
    for step in (REPEAT_ROWS, 1):  # c copies in two steps, so that no array is longer than the square root of what there may be
        placed = placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.col("c") - 1) / step))))
        placed = placed.withColumn("at", F.col("at") + F.col("k") * step).withColumn("c", F.least(F.lit(step), F.col("c") - F.col("k") * step))
    return placed.select(*rows.columns, F.col("at").cast("long").alias("slot"))


def shard_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, ["shard"])


def rewrite(docs: DataFrame, plan: DataFrame, old_shard: Column, path: str) -> DataFrame:
    """Carry ``plan`` out on the shards at ``path``; returns the shards that were written or dropped.

    These are the shards that rows leave or enter, and those that ``path`` doesn't hold yet; only their texts move. Rows are met
    again by old shard, doc_id and hash of doc_id and text; where the copies of a row go to several shards, as many go to each as the plan says.
    """
    spark, table = docs.sparkSession, shard_table(docs.sparkSession, path)
    keys = ["old", "doc_id", "row_hash"]
    dest = materialize(plan.groupBy(*keys, "shard").agg(F.count("*").alias("c"), F.sum("size").alias("bytes")), "destinations")
    shards = dest.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()  # a row a shard
    moved = dest.where("old <> shard").select(F.explode(F.array("old", "shard")).alias("s")).distinct().collect()  # a row a shard
    absent = {r["shard"] for r in shards} - {int(p.partition("=")[2]) for p in table.partitions()}
    touched = sorted({r["s"] for r in moved} | absent)
    old, id_, row, to, part, o, i, r, lo, hi = spare(docs, "old", "id", "row", "to", "part", "o", "i", "r", "lo", "hi")
    from_ = [x["old"] for x in dest.where(F.col("shard").isin(touched)).select("old").distinct().collect()]  # a row a shard
    own = docs.withColumns({old: old_shard.cast("int"), id_: F.col("doc_id").cast("long"), row: F.xxhash64("doc_id", "text")}).where(F.col(old).isin(from_))
    own = squeezed(small_batches(own), "text")  # texts are shuffled twice: to meet the plan, and to their shards
    named = [F.col("old").alias(o), F.col("doc_id").alias(i), F.col("row_hash").alias(r)]
    met = (F.col(old) == F.col(o)) & F.col(id_).eqNullSafe(F.col(i)) & (F.col(row) == F.col(r))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    several = materialize(dest.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*named), "several")
    one = dest.where(F.col("shard").isin(touched)).select(*named, F.col("shard").alias(to)).join(several.toDF("a", "b", "c"), (F.col(o) == F.col("a")) & F.col(i).eqNullSafe(F.col("b")) & (F.col(r) == F.col("c")), "left_anti")
    rows = own.join(one, met).select(*kept, row, to)
    if not several.isEmpty():
        # copies are numbered in parts that are written down first, so that a task that runs again numbers them alike
        copies = materialize(own.join(several, met, "left_semi").withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(64))), "copies")
        counts = copies.groupBy(old, id_, row, part).agg(F.count("*").alias(hi))
        first = counts.withColumn(lo, F.sum(hi).over(W.partitionBy(old, id_, row).orderBy(part)) - F.col(hi)).select(F.col(old).alias(o), F.col(id_).alias(i), F.col(row).alias(r), F.col(part).alias(hi), lo)
        number = F.row_number().over(W.partitionBy(old, id_, row, part).orderBy(F.lit(0)))
        ranked = copies.withColumn(to, number).join(first, met & (F.col(part) == F.col(hi))).select(*kept, old, id_, row, (F.col(to) + F.col(lo)).alias(part))
        ranges = dest.withColumn("hi", F.sum("c").over(W.partitionBy(*keys).orderBy("shard"))).select(*named, F.col("shard").alias(to), (F.col("hi") - F.col("c")).alias(lo), F.col("hi").alias(hi))
        placed = ranked.join(ranges, met & (F.col(part) > F.col(lo)) & (F.col(part) <= F.col(hi)))
        rows = rows.union(placed.where(F.col(to).isin(touched)).select(*kept, row, to))
    (name,) = spare(docs, "shard")
    stored = [F.col(f"`{c}`").alias(name, metadata={"own_name": c}) if c.lower() == "shard" else F.col(f"`{c}`") for c in docs.columns]
    each = max(1, -(-max((r["bytes"] for r in shards), default=0) // FILE_BYTES))
    dealt = rows.repartition(max(1, len(touched) * each), F.col(to), F.pmod(F.xxhash64(row), F.lit(each)))
    table.replace(squeezed(dealt, "text", back=True).select(*stored, F.col(to).alias("shard")), [f"shard={s}" for s in touched])
    return spark.createDataFrame([(s,) for s in touched], "shard int")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version, with all their columns and ``to_shard`` (with underscores in front if there is such a column)."""
    rows = shard_table(spark, path).read()
    own = {f.name: f.metadata["own_name"] for f in rows.schema.fields if "own_name" in (f.metadata or {})}
    kept = rows.select(*(F.col(f"`{c}`").alias(own.get(c, c)) for c in rows.columns if c != "shard"), F.col("shard").alias("\0"))
    (name,) = spare(kept, "to_shard")
    return kept.withColumnRenamed("\0", name)


#: Shards that the documents lie in before, by the hash of doc_id.
OLD_SHARDS, NEW_SHARDS = 12, 16


def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan, carry out, and describe what lies in the rewritten shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}-shards"
    rewrite(docs, materialize(reshard(docs, old, OLD_SHARDS, NEW_SHARDS), "plan"), old, path)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = read_shards(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("row_hash"), F.col("to_shard").alias("shard"))
    return with_slots(materialize(rows, "placed")).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

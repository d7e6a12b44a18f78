import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding as s


def cheapest(supply, demand, cost):
    """Brute force over all ways to split the first supply, and so on."""

    def ways(n, rooms):
        if len(rooms) == 1:
            yield (n,) if n <= rooms[0] else None
            return
        for k in range(min(n, rooms[0]) + 1):
            for rest in ways(n - k, rooms[1:]):
                if rest is not None:
                    yield (k, *rest)

    best = {tuple(demand): 0}
    for i, n in enumerate(supply):
        new = {}
        for rooms, c in best.items():
            for w in ways(n, list(rooms)):
                if w is not None:
                    left = tuple(r - x for r, x in zip(rooms, w))
                    v = c + sum(x * cost[i][j] for j, x in enumerate(w))
                    new[left] = min(new.get(left, v), v)
        best = new
    return min(best.values())


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    n, m = rng.randint(1, 4), rng.randint(1, 3)
    supply = [rng.randint(0, 6) for _ in range(n)]
    cuts = sorted(rng.randint(0, sum(supply)) for _ in range(m - 1))
    demand = [b - a for a, b in itertools.pairwise([0, *cuts, sum(supply)])]
    cost = [[rng.randint(0, 4) for _ in range(m)] for _ in range(n)]
    flow = s.min_cost_flow(supply, demand, cost)
    assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(n)] == supply
    assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(m)] == demand
    assert sum(v * cost[i][j] for (i, j), v in flow.items()) == cheapest(supply, demand, cost)


def test_capacities_pin_large_rows():
    assert s.capacities(10, [1, 1, 1]) == [4, 3, 3]
    assert s.capacities(30, [20, 1, 1]) == [20, 5, 5]
    assert sum(s.capacities(17, [9, 9, 0])) == 17
    assert s.capacities(0, [0, 0]) == [0, 0]


def check(got, rows, n):
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(n))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    return [sum(r["size"] for r in by.get(k, ())) for k in range(n)]


def test_shards_are_nearly_equal(spark, make):
    rng = random.Random(1)
    rows = [(k, "x" * int(rng.expovariate(1 / 300))) for k in range(3000)]
    sizes = check(s.reshard(make(rows), F.pmod(F.xxhash64("doc_id"), F.lit(12)), 12, 16).collect(), rows, 16)
    assert max(sizes) - min(sizes) < 0.005 * sum(sizes) / 16


def test_odd_rows(spark, make, corpus):
    sizes = check(s.reshard(make(corpus), F.lit(0), 1, 4).collect(), corpus, 4)
    assert max(sizes) == max(len((t or "").encode()) + 1 for _, t in corpus) or max(sizes) - min(sizes) < 1000
    assert s.reshard(make([]), F.lit(0), 1, 4).count() == 0
    check(s.reshard(make([(1, "same")] * 50), F.lit(2), 5, 3).collect(), [(1, "same")] * 50, 3)


def test_few_bytes_move(spark, make):
    rows = [(k, "y" * (k % 50)) for k in range(2000)]
    old = F.pmod(F.col("doc_id"), F.lit(4))
    got = {r["doc_id"]: r for r in s.reshard(make(rows), old, 4, 5).collect()}
    moved = sum(r["size"] for i, r in got.items() if i % 4 != r["shard"])
    assert moved < 1.05 * sum(r["size"] for r in got.values()) / 5


def test_files_are_rewritten(spark, make, corpus, tmp_path):
    docs = make(corpus)
    old = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    path = f"file://{tmp_path}/out"
    plan = s.reshard(docs, old, 3, 4)
    touched = {r["shard"] for r in s.rewrite(docs, plan, old, path).collect()}
    back = spark.read.parquet(path)
    assert 3 in touched and {r["shard"] for r in back.select("shard").distinct().collect()} <= touched
    place = {(r["doc_id"], r["row_hash"]): r["shard"] for r in plan.collect()}
    for r in back.select("doc_id", "text", "shard", F.xxhash64("doc_id", "text").alias("h")).collect():
        assert place[r["doc_id"], r["h"]] == r["shard"] or (r["doc_id"], r["text"]) in [x for x in corpus if corpus.count(x) > 1]
    if touched == {0, 1, 2, 3}:
        assert back.count() == len(corpus)


def carried_out(spark, docs, n_old, n_new, path):
    old = F.pmod(F.xxhash64("doc_id"), F.lit(n_old))
    plan = s.materialize(s.reshard(docs, old, n_old, n_new), "plan")
    touched = {r["shard"] for r in s.rewrite(docs, plan, old, path).collect()}
    back = s.read_shards(spark, path)
    assert back.columns == [*docs.columns, "to_shard"]
    where = lambda df, shard: sorted((str(r["doc_id"]), str(r["text"]), r[shard]) for r in df.collect())
    keyed = docs.select(F.col("doc_id").alias("d"), "text", F.xxhash64("doc_id", "text").alias("r")).distinct()
    planned = plan.join(keyed, plan["doc_id"].eqNullSafe(keyed["d"]) & (plan["row_hash"] == keyed["r"])).select(plan["doc_id"], "text", "shard")
    assert where(back, "to_shard") == where(planned, "shard")
    assert sorted(map(str, back.drop("to_shard").collect())) == sorted(map(str, docs.collect()))
    return touched, plan


@pytest.mark.parametrize(("n_old", "n_new"), [(16, 12), (4, 2), (3, 5)])
def test_rewritten_shards_hold_every_row_once(spark, make, corpus, tmp_path, n_old, n_new):
    """Growing and shrinking, with repeated rows and a column named shard; the second plan starts from the first one's files."""
    docs = make([*corpus, *[(None, "repeated")] * 70, *[(9, "again")] * 5])
    path = f"file://{tmp_path}/shards"
    touched, _ = carried_out(spark, docs, n_old, n_new, path)
    assert touched >= set(range(n_new)) and not [p for p in s.shard_table(spark, path).partitions() if int(p[6:]) >= n_new]


def test_only_touched_shards_are_written(spark, make, tmp_path):
    """Shards that a plan leaves alone keep their files; one that it empties is dropped."""
    rows = [(k, "z" * 20) for k in range(90)]
    docs, path = make(rows), f"file://{tmp_path}/shards"
    lie = {k: k % 3 for k in range(90)}
    frame = lambda where: s.materialize(docs.select("doc_id", F.lit(21).cast("long").alias("size"), F.lit(0).cast("long").alias("text_crc32"), F.xxhash64("doc_id", "text").alias("row_hash"), F.pmod("doc_id", F.lit(3)).cast("int").alias("old"), where.cast("int").alias("shard")), "plan")
    old = F.pmod("doc_id", F.lit(3))
    s.rewrite(docs, frame(old), old, path)
    table = s.shard_table(spark, path)
    before = {f for f in table.read().inputFiles() if "/shard=0/" in f}
    touched = {r["shard"] for r in s.rewrite(docs, frame(F.when(old == 2, 1).otherwise(old)), old, path).collect()}
    assert touched == {1, 2} and table.partitions() == ["shard=0", "shard=1"]
    assert {f for f in table.read().inputFiles() if "/shard=0/" in f} == before
    got = {r["doc_id"]: r["to_shard"] for r in s.read_shards(spark, path).collect()}
    assert got == {k: min(x, 1) for k, x in lie.items()}


def test_slots_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(s, "SLOT_ROWS", 7)
    monkeypatch.setattr(s, "REPEAT_ROWS", 4)
    rows = spark.createDataFrame([(1, 2, 3, 4, 0)] * 30 + [(k, 2, 3, k * 7919, k % 2) for k in range(20)] + [(None, 1, 1, 5, 1)] * 3, "doc_id long, size long, text_crc32 long, row_hash long, shard int")
    got = s.with_slots(rows).collect()
    for shard in (0, 1):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert len(got) == 53 and sum(r["doc_id"] == 1 and r["row_hash"] == 4 for r in got) == 30

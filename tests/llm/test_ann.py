import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, shard string, block string, query_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x", "x") for i, v in rows], SCHEMA)


def exact(rows, queries, k=5):
    dims = 16
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q in queries:
            s = sorted(((-(a * v).sum() / (np.sqrt((a * a).sum()) * np.sqrt((v * v).sum())), i) for i, a in good if i != q))
            out[q] = [(i, -c) for c, i in s[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_recall_and_exact_scores(spark, shard_rows):
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(600)]
    want = exact(rows, set(range(0, 600, 50)))
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert [x for x in found] == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, c in found:
            a, b = vectors[i], vectors[q]
            assert c == (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))


def test_ties_bad_vectors_and_repeats(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=16).tolist()
    rows = [(k, v) for k in range(300)] + [(k, rng.normal(size=16).tolist()) for k in range(300, 330)]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + v[1:]), (1150, [float("inf")] + v[1:]), (1200, [None] + v[1:]), (1250, v[:8]), (None, v), (7, v), (1300, [])]
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4]
    assert set(got) == {0, 50, 100, 150, 200, 250, 300}


def test_few_rows(spark):
    assert ann.nearest(frame(spark, []), F.lit(True)).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0, 2.0])]), F.lit(True)).count() == 0
    got = ann.nearest(frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [-1.0, -2.0])]), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(1, 1), (2, 2)]


def test_multi_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (500, 4), dtype=np.uint8)
    codes[:100] = codes[0] ^ (rng.random((100, 4)) < 0.1) * rng.integers(0, 256, (100, 4), dtype=np.uint8)
    index = ann.MultiIndex(codes)
    for radius in (0, 1, 3, 4, 7, 12, 31, 32):
        for q in (codes[0], rng.integers(0, 256, 4, dtype=np.uint8)):
            assert index.within(q, radius).tolist() == np.flatnonzero(ann.distances(codes, q) <= radius).tolist()


def test_rotations_are_orthogonal():
    x = np.random.default_rng(3).normal(size=(300, 16))
    c = ann.learn(x)
    for k in range(0, c.turn.shape[1], 16):
        r = c.turn[:, k : k + 16]
        assert np.allclose(r.T @ r, np.eye(16), atol=1e-9)


def clustered(rng, n, dims=32, centres=40):
    c = rng.normal(size=(centres, dims))
    return [(k, (c[rng.integers(centres)] + rng.normal(size=dims) * 0.25).tolist()) for k in range(n)]


def test_probes_bring_up_few_rows_of_clustered_vectors():
    """Recall by the index alone, and how many rows its tables were asked for."""
    rng = np.random.default_rng(6)
    x = np.array([v for _, v in clustered(rng, 4000)])
    codes = ann.learn(x[:1000], 12)
    code = codes.encode(x)
    index = ann.MultiIndex(np.stack([codes.values(code, j) for j in range(codes.substrings)], axis=1), codes.width)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    share, hits = [], 0
    for q in range(0, 4000, 50):
        rows = index.probe(index.codes[q], 1)
        share.append(len(rows) / len(x))
        hits += len(set(np.argsort(-(unit @ unit[q]), kind="stable")[1:6]) & set(rows))
    assert hits / (5 * len(share)) >= 0.9 and np.mean(share) < 0.1
    assert index.looked_at < 0.05 * len(share) * len(x) * codes.substrings  # of what a scan of each table would look at


@pytest.mark.parametrize("part", [16384, 5])
def test_every_row_against_brute_force(spark, monkeypatch, part):
    """Clustered vectors in many buckets, some of which are dealt over parts; every row is a query."""
    monkeypatch.setattr(ann, "PART_QUERIES", part)
    monkeypatch.setattr(ann, "BLOCK_BYTES", 64 << 20 if part > 5 else 50_000)
    rows = clustered(np.random.default_rng(7), 500, 16, 10)
    want = exact(rows, set(range(500)))
    got = {}
    for r in ann.nearest(frame(spark, rows), F.lit(True), 5, 40).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert all(len(v) == 5 for v in got.values()) and len(got) == 500
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / 2500 >= 0.9
    best = {q: dict(v) for q, v in want.items()}
    assert all(s == best[q][i] for q, v in got.items() for i, s in v if i in best[q])


def test_repeated_queries_and_two_vectors_of_one_id(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(60)]
    once = {q: [i for i, _ in v] for q, v in exact(rows, {0, 50}).items()}
    other = rng.normal(size=16).tolist()
    twice = [*rows, rows[0], rows[0], (50, other)]
    got = {}
    for r in ann.nearest(frame(spark, twice), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = {q: v for q, v in exact([r for r in twice if r[0] != 50 or r[1] is not other], {0}).items()}
    assert [i for i, _ in got[0]][:1] == once[0][:1] and len(got[0]) == 5 and 0 not in dict(got[0])
    assert {i for i, _ in got[0]} <= {i for i, _ in want[0]} | {50}
    # query 50 asks with both vectors: the larger cosine of each row counts, and none of its own rows is found
    a, b = np.array(rows[50][1], np.float32).astype(float), np.array(other, np.float32).astype(float)
    cos = lambda x, y: (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))
    each = [(-max(cos(np.array(v, np.float32).astype(float), a), cos(np.array(v, np.float32).astype(float), b)), i) for i, v in [*rows, rows[0], rows[0]] if i != 50]
    assert [(i, s) for i, s in got[50]] == [(i, -s) for s, i in sorted(each)[:5]]


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=8 if k % 2 else 16).tolist()) for k in range(40)]
    for r in ann.nearest(frame(spark, rows), F.lit(True), 3).collect():
        assert r["query_id"] % 2 == r["vec_id"] % 2

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import lm


def training(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0


def brute(rows, order=lm.ORDER):
    """PPM with method C and exclusion, byte by byte over a trie of dictionaries."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    tokens = Counter()
    for i, t in rows:
        if training(i):
            data, words = lm.symbols(t)
            tokens.update([*words, None])
            p = bytes(order) + data
            for q in range(order, len(p)):
                for k in range(order + 1):
                    counts[k][p[q - k : q]][p[q]] += 1
    total, kinds = sum(tokens.values()), len(tokens)
    out = []
    for i, t in rows:
        data, words = lm.symbols(t)
        own = [*words, None]
        base = sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own) if total else None
        score, p = 0.0, bytes(order) + data
        for q in range(order, len(p)):
            gone = set()
            for k in range(order, -1, -1):
                seen = counts[k].get(p[q - k : q])
                if not seen:
                    continue
                left = {s: c for s, c in seen.items() if s not in gone}
                n, d = sum(left.values()), len(left)
                if p[q] in left:
                    score += math.log10(left[p[q]] / (n + d))
                    break
                if d:
                    score += math.log10(d / (n + d))
                gone |= set(seen)
            else:
                score -= math.log10(256 - len(gone))
        out.append((i, not training(i), len(own), sum(tokens[w] > 0 for w in own), total, base, score))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[6]))


@pytest.mark.parametrize("batch_bytes", [32 << 20, 3000])
def test_against_a_trie(spark, make, corpus, batch_bytes, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1000)
    got = lm.lm_scores(make(corpus), batch_bytes=batch_bytes).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[2], r[6]))
    want = brute(corpus)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=0, atol=1e-6)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-6, atol=1e-4)


def test_odd_tables(spark, make):
    assert lm.lm_scores(make([])).count() == 0
    held = next(i for i in range(1000) if not training(i))
    r = lm.lm_scores(make([(held, "abc")])).collect()[0]  # nothing to learn from
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (2, 0, 0)
    assert r["score"] == pytest.approx(-5 * math.log10(256), rel=1e-6)
    both = lm.lm_scores(make([(1, None), (2, ""), (3, " \n")])).collect()
    assert {r["n_tokens"] for r in both} == {1}


def test_probabilities_sum_to_one(spark, make):
    """Over all 256 bytes after one context, seen or not."""
    rows = [(k, "the cat sat on the mat the cat ran") for k in range(30)]
    counts = Counter()
    for i, t in rows:
        if training(i):
            counts.update(lm.grams(lm.symbols(t)[0]).tolist())
    for ctx in (b"e cat", b"zzzzz", b"t the", b"\0\0\0\0\0"):
        asked = {int.from_bytes(ctx + bytes([s]), "big"): 0 for s in range(256)}
        all_ = {**asked, **counts}
        df = spark.createDataFrame([(0, h, c) for h, c in all_.items()], "bucket int, h long, c long")
        x = {r["h"]: r["x"] for r in lm.probabilities(df).collect()}
        assert sum(10 ** x[h] for h in asked) == pytest.approx(1, abs=1e-9)

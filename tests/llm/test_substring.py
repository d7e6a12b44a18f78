import hashlib
import random

import pytest

from tidemark.llm import common, substring as s

from texts import prose


def brute(rows, window=13):
    first = {}
    key = lambda i: common.LAST_ID if i is None else i
    texts = [(key(i), (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in texts:
        cover = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                cover[k : k + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cover) if not c)
        out.append((None if i == common.LAST_ID else i, len(w), sum(cover), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batch_bytes", [8 << 20, 2000])
def test_against_brute_force(spark, make, corpus, monkeypatch, batch_bytes):
    """In one batch, and over many: within and across batches alike."""
    monkeypatch.setattr(s, "text_batches", lambda d, carry=False: common.text_batches(d, batch_bytes, carry))
    got = s.remove_repeats(make(corpus)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(corpus)


def test_overlapping_repeats_at_all_offsets(spark, make):
    rng = random.Random(9)
    source = prose(rng, 200).split()
    rows = [(0, " ".join(source))]
    for k in range(40):
        a = rng.randrange(180)
        rows.append((k + 1, f"{prose(rng, rng.randint(0, 9))} {' '.join(source[a : a + rng.randint(11, 40)])} {prose(rng, 3)}"))
    rows.append((50, "na " * 40))  # repeats within a document alone stay
    rows.append((51, "ba " * 12))
    rows.append((52, "ba " * 13))
    rows.append((53, "ba " * 14))
    got = s.remove_repeats(make(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_texts_and_columns_that_stay(spark, make, corpus):
    docs = make(corpus)
    out = s.without_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = {(i, h) for i, _, _, h in brute(corpus)}
    for r in out.collect():
        assert (r["doc_id"], hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest()) in want
        assert r["n_chars"] == len(r["text"] or "") and r["batch"] == "batch" and r["rest"] == "rest"
    assert s.without_repeats(make([])).count() == 0
    assert s.remove_repeats(make([(1, None), (None, "")])).count() == 2


def test_packing_round_trip():
    import numpy as np

    rng = np.random.default_rng(0)
    for kind in (np.uint8, np.uint32, np.uint64, np.int64, np.float64):
        for n in (0, 1, 1000):
            a = rng.integers(0, 200, n).astype(kind)
            assert (common.unpack(common.pack(a), n, kind) == a).all()
    a = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(a), 1000, np.uint64) == a).all()

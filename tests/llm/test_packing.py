import random
import zlib

import numpy as np
import pytest

from tidemark.llm import packing as p

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def ids(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 2]


ODD = ["Hello, world! It's 3.14 o'clock\n\n  x", "naïve façade ßẞ œuvre ÿ ž", "日本語 текст عربى", "a<|endoftext|>b", " nbsp­ soft", "x y　z", "½ ² ª º 𝒳 😀", "\r\n\t \x0b\x0c", "don't DON'T we'LL", "   lead", "trail   ", "1a2b 3c_d-e", "\x00\x01\x7f\x80\x85\x9f", "“q” – — … €"]


def test_ids_are_those_of_the_tokenizer(reference, corpus):
    encode = p.encoder()
    rng = random.Random(0)
    chars = "".join(map(chr, [*range(0x20, 0x17F), *range(0x2010, 0x2028), 0x20AC, 0x300, 0x4E00, 0x1F600, 10, 9, 13]))
    noise = ["".join(rng.choice(chars) for _ in range(200)) for _ in range(100)]
    plain = [c for c in map(chr, range(0x180)) if encode.plain(c)] + [c for c in map(chr, range(0x2010, 0x2030)) if encode.plain(c)]
    every = [f"a{c}b {c}{c} 1{c} {c}" for c in plain]
    for t in [*(t or "" for _, t in corpus), *ODD, *noise, *every]:
        assert encode(t) == ids(reference, t)[:-1], repr(t)


def best_fit_one_by_one(lengths, capacity):
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            bins += 1
            gaps.append(capacity - n)
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_bulk_steps_pack_as_well_as_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    lengths = [min(capacity, 1 + int(rng.expovariate(1 / (capacity / rng.choice([2, 4, 9]))))) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps, bins = p.best_fit(counts, capacity)
    fill = np.zeros(bins, int)
    done = dict.fromkeys(counts, 0)
    for n, rank, take, first, offset in steps:
        assert rank == done[n] and (fill[first : first + take] == offset).all()
        fill[first : first + take] += n
        done[n] += take
    assert done == counts and fill.max() <= capacity
    assert bins <= best_fit_one_by_one(lengths, capacity) * 1.02 + 1
    assert bins >= -(-sum(lengths) // capacity)


@pytest.mark.parametrize("capacity", [1024, 16])
def test_pieces_and_places(spark, make, corpus, reference, capacity):
    got = p.pack_documents(make(corpus), capacity).collect()
    want = []
    for i, t in corpus:
        x = ids(reference, t)
        first = (len(x) - 1) % capacity + 1
        for k, at in enumerate([0, *range(first, len(x), capacity)]):
            n = first if k == 0 else capacity
            want.append((str(i), k, at, n, zlib.crc32(np.array(x[at : at + n], "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(by) <= 1.15 * total / capacity + 1


def test_empty_and_equal(spark, make):
    assert p.pack_documents(make([])).count() == 0
    got = p.pack_documents(make([(7, "same text")] * 500 + [(None, None)] * 5)).collect()
    assert len(got) == 505 and {r["length"] for r in got if r["doc_id"] is None} == {1}
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 505


def test_cut():
    assert p.cut(1, 4) == [(0, 1)] and p.cut(4, 4) == [(0, 4)] and p.cut(5, 4) == [(0, 1), (1, 4)] and p.cut(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("seed", range(4))
def test_rounds_pack_as_well_as_one_sweep(spark, seed):
    """Rounds of Spark stages against the sweep of all sizes at once: every row once, no bin too full, about as many bins."""
    rng = random.Random(seed)
    capacity = 1024
    draw = [lambda: int(rng.expovariate(1 / 300)), lambda: rng.randint(200, 500), lambda: rng.randint(0, 8), lambda: rng.choice([1023, rng.randint(0, 1023)])][seed]
    lengths = [min(capacity, 1 + draw()) for _ in range(3000)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = p.rounds(spark.createDataFrame(list(counts.items()), "length int, c long"), capacity).collect()
    fill, placed = {}, {}
    for r in sorted(steps, key=lambda r: (r["size"] * 2 <= capacity, r["offset"])):
        for k in range(r["n"]):
            placed.setdefault(r["size"], []).append(r["first"] + k)
            fill.setdefault(r["bin"] + k, []).append((r["offset"], r["size"]))
    assert {n: sorted(x) for n, x in placed.items()} == {n: list(range(c)) for n, c in counts.items()}
    for own in fill.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(fill) <= 1.02 * p.best_fit(counts, capacity)[1] + 1


def test_other_columns_stay(spark):
    rows = spark.createDataFrame([(k, 0, 0, 5, k, "a", "b", "c") for k in range(9)], "doc_id long, piece int, start long, length long, ids_crc32 long, part string, first string, rank string")
    got = p.place(rows, 10)
    assert got.columns == ["length", *[c for c in rows.columns if c != "length"], "sequence_id", "offset"] or got.columns == [*rows.columns, "sequence_id", "offset"]
    assert {(r["part"], r["first"], r["rank"]) for r in got.collect()} == {("a", "b", "c")}

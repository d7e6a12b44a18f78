import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as s

from texts import prose, word


def naive(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(fps, distance):
    """{doc: smallest linked doc} by comparing all pairs."""
    ids = list(range(len(fps)))
    parent = ids[:]

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids[:a]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return [find(i) for i in ids]


def test_fingerprints(corpus):
    for _, t in corpus:
        assert s.fingerprint(t) == naive(t)


def test_components_match_all_pairs(spark, make, corpus):
    got = s.groups(s.fingerprints(make(corpus))).collect()
    assert len(got) == len(corpus)
    fps = [naive(t) for _, t in corpus]
    root = groups_of(fps, 3)
    least = {}
    for (i, _), r in zip(corpus, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), fps[k], str(least.get(root[k]))) for k, (i, _) in enumerate(corpus))
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in got) == want
    assert s.groups(s.fingerprints(make([]))).count() == 0


@pytest.mark.parametrize("chunk", [2048, 8])
def test_links_lose_nothing(spark, chunk):
    """A dense ball and chains, with keys that hold more members than a chunk."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        x = centre
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        fps.add(x)
    chain = rng.getrandbits(64)
    for _ in range(30):
        for b in rng.sample(range(64), 3):
            chain ^= 1 << b
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    rows = spark.createDataFrame([(0, s._signed(f)) for f in fps], "family int, fp long")
    edges = s.links(rows, 3, 6, chunk)
    for e in edges.collect():
        assert bin((e["a"] ^ e["b"]) % (1 << 64)).count("1") <= 3
    parts = {r["node"]: r["root"] for r in s.components(edges).collect()}
    by = [parts.get(s._signed(f), s._signed(f)) for f in fps]
    root = groups_of(fps, 3)
    assert all((by[a] == by[b]) == (root[a] == root[b]) for a in range(len(fps)) for b in range(a))


def test_long_chains_become_one_component(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in s.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, n), 0), 1001: 1000}


def jaccard(a, b, n=5):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_one_of_each_group_stays(spark, make):
    """Against all pairs: copies and near copies go, everything else stays."""
    rng = random.Random(6)
    base = [prose(rng, 90) for _ in range(40)]
    rows = [(1000 + k, t) for k, t in enumerate(base)]
    for k in range(60):
        w = base[k % 20].split()
        w[rng.randrange(len(w))] = word(rng)
        rows.append((k, " ".join(w)))
    rows += [(2000 + k, base[30]) for k in range(300)] + [(5, rows[45][1]), (None, base[35]), (None, "alone"), (3000, None), (3001, ""), (3002, "  ")]
    texts = sorted({t or "" for _, t in rows})
    near = {(a, b) for a in texts for b in texts if a < b and jaccard(a, b) >= 0.8}
    parent = {t: t for t in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near:
        parent[find(a)] = find(b)
    groups = {}
    for i, t in rows:
        groups.setdefault(find(t or ""), []).append(i)
    kept = s.keep_first(make(rows))
    got = kept.collect()
    assert kept.columns == make(rows).columns
    want = sorted(str(min((i for i in g if i is not None), default=None)) for g in groups.values())
    assert sorted(str(r["doc_id"]) for r in got) == want
    assert s.keep_first(make([])).count() == 0


def stay(spark, make, texts):
    """The rows that stay, and those that should by all pairs; row k is document k."""
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if jaccard(texts[a], texts[b]) >= 0.8:
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    got = s.keep_first(make(list(enumerate(texts)), False)).collect()
    return sorted(r["doc_id"] for r in got), [k for k in range(len(texts)) if find(k) == k]


def test_long_texts_are_decided_on_all_shingles(spark, make):
    """Similarities close to both sides of 0.8, texts of 300 to 2000 words."""
    rng = random.Random(31)
    texts = []
    for _ in range(40):
        w = prose(rng, n := rng.randint(300, 2000)).split()
        texts.append(" ".join(w))
        edits = round(n * rng.uniform(0.019, 0.026))
        for k in rng.sample(range(n // 6), edits):
            w[6 * k] = word(rng) + "x"
        texts.append(" ".join(w))
    got, want = stay(spark, make, texts)
    assert 45 < len(want) < 75 and got == want


def test_a_large_group_of_near_copies_collapses(spark, make):
    """Copies of one text with two words changed: alike to it by 0.8 or more, mostly not to one another."""
    rng = random.Random(32)
    base = prose(rng, 110).split()
    texts = []
    for k in range(400):
        w = base[:]
        for at in rng.sample(range(110), 2 if k else 0):
            w[at] = word(rng) + "x"
        texts.append(" ".join(w))
    rng.shuffle(texts)
    got, want = stay(spark, make, texts)
    assert len(want) == 1 and got == want


def test_block_edits_and_short_texts(spark, make):
    """Words appended, a tail replaced, a head cut off, and short texts: all that are alike by 0.8 are found."""
    rng = random.Random(33)
    texts = []
    for _ in range(40):
        for n, cut, more in ((100, 0, 15), (100, 0, 24), (300, 0, 30), (200, 20, 20), (13, 1, 1), (23, 2, 2)):
            w = prose(rng, n).split()
            texts += [" ".join(w), " ".join(w[: n - cut] + prose(rng, more).split())]
        texts += [" ".join(w := prose(rng, 150).split()), " ".join(w[25:])]
    got, want = stay(spark, make, texts)
    assert len(want) < 300 and got == want


def test_orders_of_the_same_words(spark, make):
    """Lists of the same words in other orders, each with a near copy that swaps two neighbours."""
    rng = random.Random(34)
    base = sorted({word(rng) + str(k) for k in range(110)})
    texts = []
    for _ in range(60):
        w = rng.sample(base, len(base))
        texts.append(" ".join(w))
        at = rng.randrange(len(w) - 1)
        w[at], w[at + 1] = w[at + 1], w[at]
        texts.append(" ".join(w))
    got, want = stay(spark, make, texts)
    assert len(want) == 60 and got == want


def test_forests_keep_what_is_connected():
    """Within a part and across two, against all pairs."""
    rng = np.random.default_rng(3)

    def alike(shared, sizes, size):
        return shared >= 0.5 * (sizes + size - shared)

    for trial in range(60):
        bases = [rng.choice(4000, 30, replace=False) for _ in range(12)]
        sets = [np.unique(np.where(rng.random(30) < rng.uniform(0, 0.4), rng.integers(0, 4000, 30), bases[rng.integers(12)])) for _ in range(90)]
        sets += [np.empty(0, np.int64)] * 2
        sets = [sets[k] for k in rng.permutation(len(sets))]
        split = 0 if trial % 2 else 40
        roots = []
        every = [(a, b) for a in range(split or len(sets)) for b in range(split or a + 1, len(sets)) if len(np.intersect1d(sets[a], sets[b])) >= 0.5 * len(np.union1d(sets[a], sets[b]))]
        for edges in (s.spanning(sets, split, alike), every):
            label = list(range(len(sets)))
            for a, b in edges:
                label = [label[a] if x == label[b] else x for x in label]
            first = {}
            roots.append([first.setdefault(x, k) for k, x in enumerate(label)])
        assert roots[0] == roots[1] and set(s.spanning(sets, split, alike)) <= set(every)


@pytest.mark.parametrize("hot", [1 << 18, 20])
def test_large_and_hot_keys_lose_nothing(spark, monkeypatch, hot):
    """Fingerprints that share 40 bits: keys beyond a chunk are keyed again, and hot ones never meet in one call."""
    monkeypatch.setattr(s, "BUCKET_KEYS", 400)
    monkeypatch.setattr(s, "HOT_KEY", hot)
    monkeypatch.setattr(s, "OVERLOADED", 1)
    rng = random.Random(41)
    base, fps = rng.getrandbits(64) >> 24 << 24, set()
    for _ in range(60):
        x = base | rng.getrandbits(24)
        for _ in range(6):
            fps.add(x)
            x ^= 1 << rng.randrange(24) | 1 << rng.randrange(24)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(200)})
    if hot == 20:
        assert len(s._hot_keys(spark.createDataFrame([(s._signed(f),) for f in fps], "fp long"), s.Keys(s.chosen_masks((1 << 64) - 1, 6, 3)), 40)) > 0
    edges = s.links(spark.createDataFrame([(s._signed(f),) for f in fps], "fp long"), 3, 6, 32)
    parts = {r["node"]: r["root"] for r in s.components(edges).collect()}
    by = [parts.get(s._signed(f), s._signed(f)) for f in fps]
    root = groups_of(fps, 3)
    assert all((by[a] == by[b]) == (root[a] == root[b]) for a in range(len(fps)) for b in range(a))


def test_masks_cover_all_bits():
    for bits in ((1 << 64) - 1, 0x0F0F0F0F0F0F0F0F, 0xFFF):
        masks = s.chosen_masks(bits, 6, 3)
        assert len(masks) == 20 and all(m & ~bits == 0 for m in masks)
        rng = random.Random(1)
        for _ in range(50):  # whichever three bits differ, some mask holds none of them
            apart = [1 << b for b in rng.sample([k for k in range(64) if bits >> k & 1], 3)]
            assert any(not m & sum(apart) for m in masks)


def test_columns_of_any_name_are_kept(spark, make):
    from pyspark.sql import functions as F

    docs = make([(1, "a b c"), (2, "a b c"), (3, None)])
    for name in ("__id", "__t1", "__t2", "id", "_id", "T2", "dotted.name"):
        docs = docs.withColumn(name, F.lit("mine"))
    got = s.keep_first(docs)
    assert got.schema == docs.schema
    assert sorted((r["doc_id"], r["__t1"], r["_id"], r["T2"], r["dotted.name"]) for r in got.collect()) == [(1, *["mine"] * 4), (3, *["mine"] * 4)]


def test_weighted_fingerprints_take_every_shingle():
    """Against sums over all shingles, one at a time; an alike text is near in a good part of them, others are not."""
    rng = random.Random(51)
    mask = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & mask
        return x ^ x >> 32

    def slow(h, family):
        place = [(mixed(x * int(s._WEIGHT[family, 0]) & mask) >> 11) + 1 for x in h]
        last = sorted(place)[min(s.HEAVIEST, len(place)) - 1]
        weight = [round((min(1, last / p) * min(1, last / p)) ** 2 * 2**s.FULL) for p in place]
        bits = [mixed(x * int(s._BITS[family, 0]) & mask) for x in h]
        return sum(1 << b for b in range(64) if 2 * sum(w for w, x in zip(weight, bits) if x >> b & 1) > sum(weight))

    for n in (1, 5, 6, 9, 40, 300):
        h = s.shingle_hashes(prose(rng, n))
        got = s.weighted_fingerprints(h)
        assert [int(x) for x in got] == [slow(h.tolist(), f) for f in range(s.FAMILIES)]
    for n, cut, more in ((100, 0, 24), (200, 20, 20), (13, 1, 1)):
        w = prose(rng, n).split()
        a, b, c = (s.weighted_fingerprints(s.shingle_hashes(" ".join(x))) for x in (w, w[: n - cut] + prose(rng, more).split(), prose(rng, n).split()))
        assert (np.bitwise_count(a ^ b) <= s.DISTANCE).sum() >= 6 and (np.bitwise_count(a ^ c) > s.DISTANCE).all()
    text = prose(rng, 80)
    assert s._signed(s.fingerprint(text)) in s.profile(text)[0] and s.profile(" ") == ([0], b"", 0, b"")


@pytest.mark.parametrize("apart", [0b111, 0b1111])
def test_candidates_are_found_by_distance(spark, make, monkeypatch, apart):
    """Alike texts without an equal fingerprint: three bits apart in one family they meet, four bits apart they don't."""
    from pyspark.sql import functions as F

    rng = random.Random(52)
    w = prose(rng, 100).split()
    rows = [(1, " ".join(w)), (2, " ".join([*w[:-1], "changed"])), (3, prose(rng, 100))]
    real = s.profiles

    def moved(docs):
        far = F.array(F.lit(rng.getrandbits(62)), F.col("fps")[0])
        return real(docs).withColumn("fps", F.when(F.col("doc_id") == 2, F.array(F.lit(rng.getrandbits(62)), F.lit(0x5A5A5A5A << 20 ^ apart << 11))).when(F.col("doc_id") == 1, F.array(F.lit(0x5A5A5A5A << 20))).otherwise(far))

    monkeypatch.setattr(s, "profiles", moved)
    assert sorted(r["doc_id"] for r in s.keep_first(make(rows)).collect()) == ([1, 3] if apart == 0b111 else [1, 2, 3])


def test_runs_with_links_are_found():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 80, 60)
    own = rng.integers(0, 1 << 63, size.sum()).astype(np.uint64)
    at = np.cumsum(size) - size
    for k in range(0, 60, 3):
        if size[k] > 2:
            u, v = rng.choice(size[k], 2, replace=False)
            own[at[k] + u] = own[at[k] + v] ^ np.uint64(0b1011)
    want = [2 < n <= s.FEW and len(s.forest(own[a : a + n], 0, 3)) > 0 for a, n in zip(at, size)]
    assert s._with_links(own, size, 3).tolist() == want and any(want)


def test_buckets_are_counted_once_a_task(spark, monkeypatch):
    """The rows of the count follow tasks and buckets, not Arrow batches."""
    from pyspark.sql import functions as F

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    fps = spark.range(0, 4000, 1, 2).select(F.xxhash64("id").alias("fp"))
    made, cls = [], type(fps)
    real = cls.mapInArrow

    def counted(self, *args):
        out = real(self, *args)
        made.append(out.count())
        return out

    monkeypatch.setattr(cls, "mapInArrow", counted)
    try:
        assert len(s._hot_keys(fps, s.Keys(s.chosen_masks((1 << 64) - 1, 5, 3)), 7)) == 0
    finally:
        spark.conf.set(key, before)
    assert made == [2 * 7]

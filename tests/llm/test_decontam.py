import math
import random
import tracemalloc
from collections import Counter

import pytest
from texts import prose, word

from tidemark.llm import decontam as d

BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def items():
    rng = random.Random(11)
    common = ["of", "the", "and", "to"]
    out = []
    for k in range(60):
        w = [rng.choice(common) if rng.random() < 0.4 else word(rng) for _ in range(rng.randint(15, 55))]
        w[len(w) // 2] += "."
        out.append((k, " ".join(w)))
    return [*out, (99, out[3][1]), (100, None), (101, "  "), (102, "short item"), (103, "Yes.")]


def brute(docs, items):
    """Whole-item shingle overlap of every pair, over whole documents."""
    kept = {}
    for i, t in items:
        if d.words_of(t):
            kept.setdefault(t, i)
    out = {}
    for k, (i, t) in enumerate(docs):
        words = d.words_of(t)
        for text, item in kept.items():
            own = d.words_of(text)
            n = min(d.SHINGLE, len(own))
            want = {b" ".join(own[a : a + n]) for a in range(len(own) - n + 1)}
            have = {b" ".join(words[a : a + n]) for a in range(len(words) - n + 1)}
            if len(own) >= d.SHINGLE and len(want & have) / len(want) >= d.MIN_OVERLAP:
                out.setdefault(k, set()).add(item)
    return out


@pytest.fixture(scope="module")
def docs(items):
    rng = random.Random(12)
    rows = []
    for k in range(120):
        text = prose(rng, rng.randint(5, 400))
        if k % 3 == 0:
            w, leak = text.split(), items[k % 60][1].split()
            at = rng.randrange(len(w))
            if k % 2:
                leak[rng.randrange(len(leak))] = word(rng)
            if k % 9 == 0:
                leak = [x.upper() for x in leak[: len(leak) // 2]]
            text = " ".join(w[:at] + leak + w[at:])
        rows.append((k, text))
    return [*rows, (500, None), (501, ""), (502, "of the and to " * 300), (None, items[5][1]), (5, rows[5][1]), (503, items[7][1] + " " + items[8][1])]


def test_every_leak_is_found_and_nothing_else(spark, make, items, docs):
    bench = spark.createDataFrame(items, BENCH)
    got = {}
    ids = [i for i, _ in docs]
    for r in d.matches(make(docs), bench).collect():
        got.setdefault(r["doc_id"], set()).add(r["item_id"])
        assert d.MIN_OVERLAP <= r["overlap"] <= 1 and d.MIN_SCORE <= r["score"] <= 1
    want = {}
    for k, found in brute(docs, items).items():
        want.setdefault(ids[k], set()).update(found)
    short = {102, 103}
    assert {i: s - short for i, s in got.items() if s - short} == want
    clean = d.decontaminate(make(docs), bench)
    assert clean.columns == make(docs).columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(i) for i in ids if i not in got)


def test_chunks_give_the_same(spark, make, items, docs, monkeypatch):
    bench = spark.createDataFrame(items, BENCH)
    whole = sorted(map(tuple, d.matches(make(docs), bench).select("doc_id", "item_id").collect()), key=str)
    real = d.indexes
    monkeypatch.setattr(d, "indexes", lambda b: real(b, 4000))
    assert len(list(d.indexes(bench))) > 2
    assert sorted(map(tuple, d.matches(make(docs), bench).select("doc_id", "item_id").collect()), key=str) == whole


def test_odd_tables(spark, make, items):
    empty = spark.createDataFrame([], BENCH)
    assert d.matches(make([(1, "x")]), empty).count() == 0
    assert d.decontaminate(make([(1, "x")]), empty).count() == 1
    assert d.matches(make([]), spark.createDataFrame(items, BENCH)).count() == 0


def index_of(items):
    kept = [(i, t) for i, t in items if d.words_of(t)]
    words = [d.words_of(t) for _, t in kept]
    n, c = len(kept), Counter(w for x in words for w in set(x))
    return d.Index(kept, sum(map(len, words)) / n, {w: math.log(1 + (n - k + 0.5) / (k + 0.5)) for w, k in c.items()}, {w for w, k in c.items() if k > max(2, d.COMMON * n)})


def test_wand_equals_exhaustive_scoring(items, docs):
    ix = index_of(items)
    rng = random.Random(1)
    for _ in range(200):
        text = rng.choice([t for _, t in docs if t])
        terms = [t for t in {ix.vocab.get(w, 0) for w in d.words_of(text)[:80]} if t]
        sums = Counter()
        for t in terms:
            for item, share in zip(ix.docs[t], ix.shares[t]):
                sums[item] += share
        for threshold in (0.05, 0.2, 0.5, 0.9):
            got = ix.wand(terms, threshold)
            assert set(got) == {i for i, s in sums.items() if s >= threshold} or all(abs(sums[i] - threshold) < 1e-9 for i in set(got) ^ {i for i, s in sums.items() if s >= threshold})


def test_question_and_answer():
    q, a = d.question_answer("What is it? It is blue.")
    assert (b" ".join(q), b" ".join(a)) == (b"what is it?", b"it is blue.")
    assert d.question_answer("one sentence")[0] == d.question_answer("one sentence")[1]


def test_question_and_answer_must_both_be_there(spark, make):
    rng = random.Random(13)
    question, answer = prose(rng, 30) + "?", prose(rng, 3) + "."
    other = [(k, f"{prose(rng, 20)}? {prose(rng, 6)}.") for k in range(20)]
    bench = spark.createDataFrame([(500, f"{question} {answer}"), *other], BENCH)
    almost = answer.split()
    almost[1] = word(rng)
    rows = [
        (1, f"{prose(rng, 40)} {question} {answer} {prose(rng, 40)}"),
        (2, f"{prose(rng, 40)} {question} {prose(rng, 3)}. {prose(rng, 40)}"),  # another answer: 0.84 of the item
        (3, f"{prose(rng, 40)} {question}"),
        (4, f"{prose(rng, 40)} {answer} {prose(rng, 40)}"),
        (5, f"{prose(rng, 40)} {question} {' '.join(almost)} {prose(rng, 40)}"),
        (6, f"{answer} {prose(rng, 20)}"),
    ]
    got = d.matches(make(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 500), (5, 500)}
    assert all(min(r["question_overlap"], r["answer_overlap"]) >= d.MIN_PART for r in got)
    assert sorted(r["doc_id"] for r in d.decontaminate(make(rows), bench).collect()) == [2, 3, 4, 6]


def _index(items):
    words = Counter(w for _, t in items for w in set(d.words_of(t)))
    return d.Index(items, 20.0, {w: math.log(1 + (len(items) - c + 0.5) / (c + 0.5)) for w, c in words.items()}, set())


def test_search_memory_follows_no_posting_lists():
    rng = random.Random(4)
    shared = [word(rng) for _ in range(20)]
    index = _index([(k, " ".join([*shared, f"own{k}", f"last{k}"])) for k in range(400)])
    texts = [" ".join(rng.choices(shared, k=8)) for _ in range(2000)]  # 0.1 MB of text, 5 million postings
    tracemalloc.start()
    try:
        assert index.search(texts, 0.99, d.MIN_OVERLAP) == [[] for _ in texts]
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()


def test_search_in_runs_of_postings(monkeypatch, items, docs):
    index = _index([(i, t) for i, t in items if d.words_of(t)])
    texts = [t for _, t in docs]
    want = index.search(texts, d.MIN_SCORE, d.MIN_OVERLAP)
    assert sum(map(len, want)) > 20
    for most in (1, 50, 1 << 40):
        monkeypatch.setattr(d, "POSTINGS", most)
        assert index.search(texts, d.MIN_SCORE, d.MIN_OVERLAP) == want

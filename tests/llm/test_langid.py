import random

import numpy as np
import pytest

from tidemark.llm import langid as g

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "ich"], "cc": ["ción", "los", "ñe", "que"]}


def rows(n):
    rng = random.Random(3)
    out = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((k, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))), lang))
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, t, x, "s", "x", "x") for i, t, x in data], "doc_id long, text string, lang string, source string, part string, score string")


def test_held_out_accuracy(spark):
    data = rows(400)
    docs = frame(spark, data)
    got = {r["doc_id"]: r for r in g.predict(docs, g.train(docs, 60)).collect()}
    held = {r["doc_id"] for r in docs.select("doc_id", (g.fold() == 0).alias("x")).collect() if r["x"]}
    assert len(held) > 50
    assert np.mean([got[i]["lang_pred"] == x for i, _, x in data if i in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(spark):
    data = [*rows(100), (500, None, "aa"), (501, "", None), (502, "123 ... !?", "bb"), (503, "kalo", None), (None, "kalo mitu", "aa"), (7, rows(100)[7][1], "bb"), (504, "ka lo " * 100_000, "aa"), (505, "\x00", None)]
    docs = frame(spark, data)
    model = g.train(docs)
    got = {}
    for r in g.predict(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert sum(map(len, got.values())) == len(data)
    assert all(got[i] == [("und", 0.0)] for i in (500, 501, 502, 505))
    assert got[503][0][0] == "aa" and got[504][0][0] == "aa" and got[None][0][0] == "aa" and len(got[7]) == 2
    assert g.predict(frame(spark, []), model).count() == 0
    nothing = g.train(frame(spark, [(1, "abc", None)]))
    assert g.predict(docs, nothing).select("lang_pred").distinct().collect()[0][0] == "und"


def test_kernel_is_shared_ngrams():
    """Products of presence rows are the cosine of hashed n-gram sets, counted by hand."""
    a, b = "Abc abd", "abc xyz"

    def sets(t):
        s = f" {t.lower()} "
        return {s[k : k + n] for n in g.LENGTHS for k in range(len(s) - n + 1)}

    x, y = g.columns(a), g.columns(b)
    assert len(x) == len(sets(a)) and len(y) == len(sets(b))  # no two n-grams meet in a column here
    k = (g.presence([x]) @ g.presence([y]).T)[0, 0]
    assert k == pytest.approx(len(sets(a) & sets(b)) / np.sqrt(len(sets(a)) * len(sets(b))), abs=1e-6)


def test_regression_on_nystroem_features():
    """With all texts as landmarks, the weights solve kernel ridge regression on the full kernel."""
    data = rows(40)
    texts, langs = [t for _, t, _ in data], [x for _, _, x in data]
    m = g.fit(texts, langs, landmarks=40)
    p = presence = g.presence([g.columns(t) for t in texts]).astype(np.float64)
    K = p @ presence.T
    y = np.array([[1.0 if x == name else -1.0 for name in m.languages] for x in langs])
    alpha = np.linalg.solve(K + g.RIDGE * len(texts) / np.linalg.matrix_rank(K, tol=1e-6 * np.linalg.eigvalsh(K)[-1]) * np.eye(len(K)), y)
    assert np.allclose((p @ m.landmarks) @ m.weights, K @ alpha, atol=2e-3)


def test_slices_lose_no_ngram(monkeypatch):
    text = " ".join(t for _, t, _ in rows(20))
    whole = g.columns(text).tolist()
    monkeypatch.setattr(g, "SLICE", 7)
    assert g.columns(text).tolist() == whole


def test_scores_do_not_depend_on_batches(spark):
    data = rows(150)
    model = g.train(frame(spark, data))
    texts = [t for _, t, _ in data] + [None, "", "12"]
    names, scores = model.predict(texts)
    for size in (1, 7):
        parts = [model.predict(texts[k : k + size]) for k in range(0, len(texts), size)]
        assert [x for n, _ in parts for x in n] == names and [x for _, s in parts for x in s.tolist()] == scores.tolist()

import random

import numpy as np
import pytest
from texts import prose

from tidemark.llm import quality as q


def table(rng, n):
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(20, 80))
        rows.append((k, text + "." if good else " ".join(w + rng.choice(["%%%", "!!", " |"]) for w in text.split())))
        labels.append((k, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark, make):
    rows, labels = table(random.Random(0), 600)
    return rows, labels, q.train(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark, make, trained):
    rows, labels, model = trained
    got = {r["doc_id"]: r["score"] for r in q.score(make(rows), model).collect()}
    held = {r["doc_id"] for r in make(rows).select("doc_id", (q.fold(5) == 0).alias("x")).collect() if r["x"]}
    right = [(got[i] >= q.THRESHOLD) == bool(y) for i, y, _ in labels if i in held]
    assert len(right) > 60 and np.mean(right) > 0.97
    assert all(0 <= s <= 1 for s in got.values())


def test_scores_are_those_of_the_model_alone(spark, make, trained):
    """Batches, partitions and other columns change nothing; the same rows give the same model."""
    rows, labels, model = trained
    direct = dict(zip((i for i, _ in rows), model.score([t for _, t in rows])))
    got = {r["doc_id"]: r["score"] for r in q.score(make(rows).repartition(7), model).collect()}
    assert got == pytest.approx(direct, abs=1e-6)
    again = q.train(make(rows).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert np.array_equal(again.w1, model.w1) and again.temperature == model.temperature


def test_gradients_lower_the_loss(trained):
    rows, labels, model = trained
    p = model.score([t for _, t in rows])
    y = np.array([y for _, y, _ in labels])
    assert -np.mean(np.log(np.where(y == 1, p, 1 - p) + 1e-12)) < 0.1


def test_odd_rows(spark, make, corpus, trained):
    _, _, model = trained
    got = q.score(make(corpus), model).collect()
    assert len(got) == len(corpus) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (400, 401, 402, 407)}) == 1
    kept = q.keep_good(make(corpus), model)
    assert kept.columns == make(corpus).columns
    assert kept.count() == sum(r["score"] >= q.THRESHOLD for r in got)
    assert q.score(make([]), model).count() == 0


def test_nothing_to_learn_from(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = q.train(make([(1, "a"), (2, None)]), none)
    assert {r["score"] for r in q.score(make([(1, "a"), (2, None)]), m).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 0) for k in range(50)] + [(None, 0, 0), (51, None, 1), (52, 7, 0)], "doc_id long, quality int, toxic int")
    m = q.train(make([(k, "a b") for k in range(60)]), one)
    assert m.score(["x"])[0] == 1.0


def test_the_sample_is_bounded(spark, make):
    rows, labels = table(random.Random(1), 200)
    got = q.sample(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "quality", 5, 50)
    assert len(got) == 50


def test_index_vectors_are_fixed():
    a, b = q.index_vectors(), q.index_vectors()
    assert np.array_equal(a, b) and set(np.unique(a)) == {-1, 0, 1} and (np.count_nonzero(a, axis=1) == q.NONZERO).all()


def test_context_vectors_against_loops():
    units, index = q.Units(), q.index_vectors()
    text = "a b c a d"
    want = np.zeros_like(index)
    ids = [int(u[0]) for u in units.of(text.encode().split())]
    for i, u in enumerate(ids):
        for j in range(max(0, i - 2), min(len(ids), i + 3)):
            if j != i:
                want[u] += index[ids[j]]
    n = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(q.context_vectors([text], index), want / np.where(n > 0, n, 1), atol=1e-6)


def test_repeated_words_have_a_unit_of_their_own():
    units = q.Units()
    once, again = q.histogram("ba ko mi tu", units)[0], q.histogram("ba ba ko ko mi", units)[0]
    assert again[q.AGAIN] - once[q.AGAIN] == pytest.approx(0.5, abs=0.1)
    assert q.histogram("one", units)[0].sum() == pytest.approx(1)


def test_scores_do_not_depend_on_batches(trained, corpus):
    rows, _, model = trained
    texts = [t for _, t in rows[:200]] + [t for _, t in corpus]
    whole = model.score(texts)
    for size in (1, 7, 128):
        parts = np.concatenate([model.score(texts[k : k + size]) for k in range(0, len(texts), size)])
        assert parts.tolist() == whole.tolist()


def test_score_against_loops(trained):
    """The whole way from a text to its score in plain Python."""
    import math

    rows, _, model = trained
    for text in [rows[0][1], rows[1][1], "One two two.", ""]:
        units, words = q.Units(), text.encode().split()
        ids = [[int(u) for u in row] for row in units.of(words)] if words else []
        x = [0.0] * (2 * q.DIM)
        for k in range(q.DIM):
            x[k] = sum(model.table[u][k] for row in ids for u in row) / max(1, 4 * len(ids))
            if len(ids) > 1:
                x[k] += sum(a[0] == b[0] for a, b in zip(ids, ids[1:])) / (len(ids) - 1) * model.table[q.AGAIN][k]
            x[q.DIM + k] = sum(model.context[row[0]][k] for row in ids) / max(1, len(ids))
        z = [(v - m) / s for v, m, s in zip(x, model.mean, model.scale)]
        h = [math.tanh(sum(v * w for v, w in zip(z, model.w1[:, j])) + model.b1[j]) for j in range(q.HIDDEN)]
        logit = sum(v * w for v, w in zip(h, model.w2)) + model.b2
        assert model.score([text])[0] == pytest.approx(1 / (1 + math.exp(-logit / model.temperature)), abs=1e-3)


def test_gradients_against_differences():
    rng = np.random.default_rng(4)
    z, t = rng.normal(size=(9, 5)), rng.integers(0, 2, 9).astype(float)
    p = {"w1": rng.normal(size=(5, 3)), "b1": rng.normal(size=3), "w2": rng.normal(size=3), "b2": rng.normal(size=1)}

    def loss():
        v = np.tanh(z @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
        return np.mean(np.logaddexp(0, v) - t * v) + 0.5e-3 * ((p["w1"] ** 2).sum() + (p["w2"] ** 2).sum())

    for k, g in q.gradients(p, z, t).items():
        for at in np.ndindex(g.shape):
            old, step = p[k][at], 1e-6
            p[k][at] = old + step
            up = loss()
            p[k][at] = old - step
            down = loss()
            p[k][at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_temperature_is_a_least_one(trained):
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 2, 4000).astype(float)
    for true in (0.05, 1.0, 30.0):
        v = rng.normal(size=4000) * 3
        truth = (rng.random(4000) < 1 / (1 + np.exp(-v))).astype(float)
        assert q.calibrate(v * true, truth) == pytest.approx(true, rel=0.15)
    assert 0 < q.calibrate(np.array([-5.0, 5.0] * 50), np.array([0.0, 1.0] * 50)) < np.exp(19)
    assert np.exp(-19) < trained[2].temperature < np.exp(19)


def test_long_words_count_whole():
    units = q.Units()
    a, b = b"x1" * 40 + b"A.", b"x1" * 40 + b".A"
    assert units[a][2:4] != units[b][2:4]


def test_neighbours_across_slices(monkeypatch):
    rng = random.Random(8)
    texts, index = [prose(rng, 90), "", None, "one", prose(rng, 7)], q.index_vectors()
    whole = q.neighbour_sums(texts, index)
    monkeypatch.setattr(q, "PAIRS", 5)
    assert np.array_equal(q.neighbour_sums(texts, index), whole) and whole.any()

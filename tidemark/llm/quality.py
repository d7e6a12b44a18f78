"""Quality classifier: random-indexing word vectors, pooled per document, and a small neural network.

A word's vector is its sparse random index vector (from the hashes of the word, its shape, its ends, and whether it is the
word before once more) next to its context vector: the sum of the index vectors of its neighbours over the training sample. Words are hashed into ``BUCKETS``
units, so both tables have a fixed size at any vocabulary. A document's vector is the mean over its words, which is the
histogram of its units times the tables. A two-layer network in numpy gives a logit; its temperature is
fitted on a part of the sample held back from training, so that scores are probabilities.

Shares, tables and weights are fixed-point numbers: multiples of a power of two, so small that every sum of their products is
exact in double precision in any order. A row's score is therefore the same in whatever batch or partition it is computed.

Only the ``max_train`` labelled rows with the smallest hashes of doc_id and text are learned from (a documented bound). Their texts
stay in Spark: neighbour sums and document vectors of a fixed size reach the driver. Every row is scored from its whole text.

Defined results: null, empty and wordless texts have the zero vector and get the network's score for it; repeated rows get
one score each; rows without a label or with another label than 0 and 1 are not learned from; with no labelled rows, or one
class only, all scores are the share of label 1 (0.5 without rows); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import fixed, materialize, small_batches

BUCKETS, DIM, HIDDEN, NONZERO = 4096, 96, 32, 6
MAX_TRAIN, EPOCHS, SEED = 6000, 60, 17
THRESHOLD, FOLDS = 0.3, 5
#: Binary digits after the point of shares, context vectors, standardised inputs and both layers; the largest standardised input.
SHARE_BITS, CONTEXT_BITS, INPUT_BITS, WEIGHT_BITS, MOST = 30, 20, 16, 18, 256.0
#: Tasks that learn neighbour sums.
LEARN_TASKS = 16
#: Neighbours that are counted at once.
PAIRS = 1 << 17
#: The unit of a word that stands directly after itself.
AGAIN = 1
#: Capitals, other letters and digits as one sign each; and runs of a sign, which count as two.
SIGNS = bytes(88 if 65 <= c <= 90 else 120 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
PACK = struct.Struct("<4H").pack
RUNS = re.compile(rb"(.)\1+", re.S)


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, nonzero: int = NONZERO) -> np.ndarray:
    """Sparse vectors of -1 and 1, the same in every process."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((buckets, dim))
    for row in out:
        row[rng.choice(dim, nonzero, replace=False)] = rng.choice([-1, 1], nonzero)
    return out


class Units(dict):
    """The units of a word as four 16-bit numbers: itself, its shape, its first and its last three bytes.

    Emptied at ``most`` words.
    """

    most = 250_000

    @classmethod
    def small(cls) -> Units:
        """For the driver."""
        units = cls()
        units.most = 50_000
        return units

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        shape = RUNS.sub(rb"\1\1", word.translate(SIGNS))
        h = xxhash.xxh64_intdigest
        out = self[word] = PACK(h(word) % BUCKETS, h(b"s" + shape, 1) % BUCKETS, h(b"a" + word[:3], 2) % BUCKETS, h(b"z" + word[-3:], 3) % BUCKETS)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row for each word."""
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u2").reshape(-1, 4)


def histogram(text: str | None, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Shares of all units and of whole words, each over ``BUCKETS``."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(BUCKETS), np.zeros(BUCKETS)
    ids = units.of(words)
    all_units = np.bincount(ids.ravel(), minlength=BUCKETS) / (4 * len(words))
    all_units[AGAIN] += (ids[1:, 0] == ids[:-1, 0]).mean() if len(words) > 1 else 0
    return fixed(all_units, SHARE_BITS), fixed(np.bincount(ids[:, 0], minlength=BUCKETS) / len(words), SHARE_BITS)


def neighbour_sums(texts: list[str], index: np.ndarray, reach: int = 2) -> np.ndarray:
    """Random indexing: each word unit's sum of the index vectors of its neighbours, whole numbers."""
    units, out = Units.small(), np.zeros_like(index)
    held, size = [], 0

    def add() -> None:
        code, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(code), 8192):  # bounds the rows of index vectors at hand
            own, times = code[at : at + 8192], n[at : at + 8192]
            left = own // BUCKETS
            first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
            out[left[first]] += np.add.reduceat(index[own % BUCKETS] * times[:, None], first, axis=0)
        held.clear()

    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        for at in range(0, len(words), PAIRS):
            ids = units.of(words[at : at + PAIRS + reach])[:, 0].astype(np.int64)
            for k in range(1, reach + 1):
                b = ids[k : PAIRS + k]
                a = ids[: len(b)]
                held += [a * BUCKETS + b, b * BUCKETS + a]
                size += 2 * len(b)
            if size >= PAIRS:
                add()
                size = 0
    if size:
        add()
    return out


def unit_length(sums: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return fixed(sums / np.where(norm > 0, norm, 1), CONTEXT_BITS)


def context_vectors(texts: list[str], index: np.ndarray, reach: int = 2) -> np.ndarray:
    """The neighbour sums at unit length."""
    return unit_length(neighbour_sums(texts, index, reach))


@dataclass
class Model:
    """Tables and weights: a fixed size, whatever was learned from."""

    table: np.ndarray  # BUCKETS x DIM, index vectors
    context: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    constant: float | None = None

    def vectors(self, texts: list[str | None], units: Units | None = None) -> np.ndarray:
        units = Units() if units is None else units
        out = np.empty((len(texts), 2 * DIM))
        for at in range(0, len(texts), 128):
            both = [histogram(t, units) for t in texts[at : at + 128]]
            if both:
                out[at : at + 128, :DIM] = np.stack([a for a, _ in both]) @ self.table
                out[at : at + 128, DIM:] = np.stack([b for _, b in both]) @ self.context
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = fixed(np.clip((x - self.mean) / self.scale, -MOST, MOST), INPUT_BITS)
        return fixed(np.tanh(z @ self.w1 + self.b1), WEIGHT_BITS) @ self.w2 + self.b2

    def score(self, texts: list[str | None], units: Units | None = None) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.vectors(texts, units)) / self.temperature, -30, 30)))


def gradients(p: dict[str, np.ndarray], z: np.ndarray, t: np.ndarray, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of inputs ``z`` against ``t``, plus half of ``decay`` times the squared weights."""
    h = np.tanh(z @ p["w1"] + p["b1"])
    d = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - t) / len(t)
    dh = np.outer(d, p["w2"]) * (1 - h * h)
    return {"w1": z.T @ dh + decay * p["w1"], "b1": dh.sum(0), "w2": h.T @ d + decay * p["w2"], "b2": np.array([d.sum()])}


def calibrate(logit: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of the least cross-entropy, by golden sections of a range that widens until the least lies inside.

    The targets are (n1 + 1) / (n1 + 2) and 1 / (n0 + 2) for n1 rows of label 1 and n0 of label 0, so that there is a least
    one on rows without an error, too.
    """
    n1 = truth.sum()
    target = np.where(truth == 1, (n1 + 1) / (n1 + 2), 1 / (len(truth) - n1 + 2))

    def loss(u: float) -> float:
        v = logit * np.exp(-u)
        return float(np.mean(np.logaddexp(0, v) - target * v))

    low, high = -1.0, 1.0
    while low > -20 and loss(low) <= loss(low + 0.25):
        low -= 1
    while high < 20 and loss(high) <= loss(high - 0.25):
        high += 1
    golden = (np.sqrt(5) - 1) / 2
    while high - low > 1e-6:
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def blank(index: np.ndarray) -> Model:
    zero = np.zeros(2 * DIM)
    return Model(index, np.zeros_like(index), zero, zero + 1, np.zeros((2 * DIM, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)


def fit(model: Model, x: np.ndarray, labels: np.ndarray) -> Model:
    """Train on four fifths of the vectors ``x``, fit the temperature on the rest. Same rows, same model."""
    if len(labels) < 10 or len(set(labels.tolist())) < 2:
        model.constant = float(labels.mean()) if len(labels) else 0.5
        return model
    y = labels.astype(np.float64)
    held = np.arange(len(y)) % 5 == 0
    model.mean, model.scale = x[~held].mean(0), x[~held].std(0) + 1e-4
    rng = np.random.default_rng(SEED)
    p = {"w1": rng.normal(0, 1 / np.sqrt(2 * DIM), (2 * DIM, HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    z, t = (x[~held] - model.mean) / model.scale, y[~held]
    for _ in range(EPOCHS):
        order = rng.permutation(len(t))
        for at in range(0, len(order), 128):
            own = order[at : at + 128]
            g = gradients(p, z[own], t[own])
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = (fixed(p[k], WEIGHT_BITS) for k in ("w1", "b1", "w2", "b2"))
    model.b2 = float(model.b2[0])
    model.temperature = calibrate(model.logits(x[held]), y[held])
    return model


def fold(folds: int) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, max_train: int) -> list[tuple[int, int, int]]:
    """At most ``max_train`` labelled texts of the learning folds as (doc_id, hash of the text, label): those with the smallest hashes.

    Labels are met by doc_id; of several labels of one doc_id the largest counts. A text that stands twice under a doc_id counts once.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("label"))
    rows = _learning(docs, folds).select("doc_id", "t1").distinct()
    ids = rows.join(known, rows["doc_id"] == known["id"]).select("doc_id", "t1", "label", F.xxhash64("doc_id", "t1").alias("h"))
    return [(r["doc_id"], r["t1"], r["label"]) for r in ids.orderBy("h", "doc_id", "t1").limit(max_train).collect()]  # max_train rows


def _learning(docs: DataFrame, folds: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t1")).where("doc_id is not null").where(fold(folds) != 0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, max_train: int = MAX_TRAIN) -> Model:
    """Learn from the bounded sample. Its texts are written once to the scratch folder and read for neighbours, then for vectors."""
    spark, index = docs.sparkSession, index_vectors()
    model, ids = blank(index), sample(docs, labels, label, folds, max_train)
    if len({y for _, _, y in ids}) < 2:
        return fit(model, np.empty((0, 2 * DIM)), np.array([y for _, _, y in ids], np.int64))
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, t1 long, label int"))  # max_train rows
    # repeats of a row are met by doc_id and text, dealt by the text, and count once
    met = small_batches(_learning(docs, folds)).join(chosen, ["doc_id", "t1"]).groupBy("doc_id", "t1").agg(F.first("text").alias("text"), F.first("label").alias("label"))
    texts = materialize(met, "learned").repartition(LEARN_TASKS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros_like(index)
        for batch in batches:
            own += neighbour_sums(batch["text"].to_pylist(), index)
        units = np.flatnonzero(own.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), pa.array(list(own[units].astype(np.int64)), pa.list_(pa.int64()))], names=["unit", "sums"])

    parts = texts.select("text").mapInArrow(sums, "unit int, sums array<long>").select("unit", F.posexplode("sums").alias("k", "v"))
    total = parts.groupBy("unit", "k").agg(F.sum("v").alias("v")).where("v <> 0").toArrow()  # BUCKETS x DIM numbers at most
    own = np.zeros_like(index)
    own[total["unit"].to_numpy(), total["k"].to_numpy()] = total["v"].to_numpy()
    model.context = unit_length(own)
    sent = spark.sparkContext.broadcast(model)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units.small()
        for batch in batches:
            x = sent.value.vectors(batch["text"].to_pylist(), units)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["t1"], batch["label"], pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "t1", "label", "x"])

    learned = texts.select("doc_id", "t1", "label", "text").mapInArrow(vectors, "doc_id long, t1 long, label int, x array<double>").toArrow().sort_by([("doc_id", "ascending"), ("t1", "ascending")])
    x = learned["x"].combine_chunks().flatten().to_numpy().reshape(-1, 2 * DIM)
    return fit(model, x, learned["label"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, schema: str = "doc_id long, score double") -> DataFrame:
    """(doc_id, score) of every row. The model (some MB, a fixed size) goes out once per executor."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sent.value.score(batch["text"].to_pylist(), units), pa.float64())], names=["doc_id", "score"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is not below ``threshold``, with all their columns."""
    sent, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        for batch in batches:
            texts = batch.column(names.index("text")).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array(sent.value.score(texts, units) >= threshold))

    return small_batches(docs).mapInArrow(run, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (fold(FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Language identification by string kernels.

The kernel of two texts is the blended spectrum of n-gram presence: the number of different n-grams of one to four
letters that both hold, of every length alike weighted by 1 / (number that the text holds), in the cosine form. N-grams are hashed
into ``DIM`` columns. Landmarks (a stratified few of the learning texts) give the Nyström features; one-versus-rest
kernel ridge regression on these is a matrix of landmarks by languages. Texts are scored in batches: presence matrix times
the product of landmarks and weights, normalised. That product is in fixed point: sums of its numbers are exact in any order, so a
row's score doesn't depend on its batch.

Only the ``per_language`` texts of each language with the smallest hashes of doc_id are learned from, a documented bound; every
row is predicted from its whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can be learned;
ties go to the language that comes first; repeated rows get one prediction each; rows with a null lang or doc_id aren't learned from; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import fixed, small_batches

DIM, LENGTHS = 1 << 14, (1, 2, 3, 4)
PER_LANGUAGE, LANDMARKS, RIDGE, SHARPNESS, FOLDS, ROWS = 600, 48, 1e-2, 6.0, 5, 64
#: Characters of a text that are turned into n-grams at once; n-grams across the seams are counted as well.
SLICE = 1 << 18
#: Binary digits after the point of what texts are multiplied by.
DIGITS = 24


def letters(text: str | None) -> np.ndarray:
    """Code points in lower case, every run of others than letters as one space."""
    if not text:
        return np.empty(0, np.uint32)
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isalpha() else text.lower()
    a = np.frombuffer(kept.encode("utf-32-le", "surrogatepass"), "<u4")
    return a[~((a == 32) & np.concatenate([[False], a[:-1] == 32]))] if len(a) else a


def columns(text: str | None) -> np.ndarray:
    """The different columns of a text's n-grams, empty if it has no letter."""
    a = letters(text)
    if not len(a) or not (a != 32).any():
        return np.empty(0, np.int64)
    a = np.concatenate([[32], a, [32]]).astype(np.uint64)
    held = np.zeros(DIM, bool)
    for at in range(0, len(a), SLICE):
        part = a[at : at + SLICE + LENGTHS[-1] - 1]
        h = np.zeros(len(part), np.uint64)
        for n in LENGTHS:
            m = len(part) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :] + np.uint64(n)
            x = h ^ (h >> np.uint64(29))
            held[((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(50)).astype(np.int64)] = True
    return np.flatnonzero(held)


def presence(each: list[np.ndarray]) -> np.ndarray:
    """Rows of unit length."""
    out = np.zeros((len(each), DIM), np.float32)
    for row, c in zip(out, each, strict=True):
        if len(c):
            row[c] = 1 / np.sqrt(len(c))
    return out


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # DIM x landmarks, unit columns
    weights: np.ndarray  # landmarks x languages

    def __post_init__(self):
        self.product = fixed(self.landmarks.astype(np.float64) @ self.weights.astype(np.float64), DIGITS)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for at in range(0, len(texts), ROWS):
            each = [columns(t) for t in texts[at : at + ROWS]]
            if not self.languages:
                names += ["und"] * len(each)
                continue
            held = np.zeros((len(each), DIM))
            for row, c in zip(held, each, strict=True):
                row[c] = 1
            value = (held @ self.product) / np.sqrt(np.maximum(1, [[len(c)] for c in each]))
            p = np.exp(SHARPNESS * (value - value.max(axis=1, keepdims=True)))
            p /= p.sum(axis=1, keepdims=True)
            best = value.argmax(axis=1)
            for k, c in enumerate(each):
                names.append(self.languages[best[k]] if len(c) else "und")
                scores[at + k] = p[k, best[k]] if len(c) else 0.0
        return names, scores


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS) -> Model:
    """Landmarks are the first ``landmarks`` texts of each language in the order given."""
    each = [columns(t) for t in texts]
    keep = [k for k, c in enumerate(each) if len(c)]
    languages = sorted({langs[k] for k in keep})
    if not languages:
        return Model([], np.zeros((DIM, 0), np.float32), np.zeros((0, 0), np.float32))
    marks = [k for name in languages for k in [k for k in keep if langs[k] == name][:landmarks]]
    L = presence([each[k] for k in marks]).T.copy()
    # Nystroem: K(x, L) K(L, L)^-1/2 are features whose products approximate the kernel
    values, vectors = np.linalg.eigh((L.T @ L).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    gram, target = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(languages)))
    for at in range(0, len(keep), ROWS):
        own = keep[at : at + ROWS]
        f = (presence([each[k] for k in own]) @ L) @ root
        gram += f.T @ f
        target += f.T @ np.array([[1.0 if langs[k] == name else -1.0 for name in languages] for k in own])
    w = np.linalg.solve(gram + RIDGE * len(keep) / max(1, len(gram)) * np.eye(len(gram)), target)
    return Model(languages, L, (root @ w).astype(np.float32))


def fold(folds: int = FOLDS) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % folds


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS) -> Model:
    """Learn from the bounded sample. The number of languages is small; the rows are ranked without the texts."""
    from pyspark.sql import Window as W

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("doc_id is not null and lang is not null").where(fold(folds) != 0)
    hashed = rows.where("text is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # the smallest of every part of each language first: no task ranks a whole language
    parts = hashed.withColumn("part", F.pmod("h", F.lit(64))).withColumn("r", F.row_number().over(W.partitionBy("lang", "part").orderBy("h", "doc_id"))).where(F.col("r") <= per_language)
    ids = parts.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("r") <= per_language).select("doc_id", "lang").distinct()
    picked = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text")  # per_language rows a language
    found = sorted({(r["doc_id"], r["lang"], r["text"] or "") for r in picked.toLocalIterator()})
    return fit([t for _, _, t in found], [x for _, x, _ in found])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row. The model has a fixed size for a number of languages."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = sent.value.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, train(docs)).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")

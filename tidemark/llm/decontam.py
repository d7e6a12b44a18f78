"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND.

Test items are indexed by their words (A-Z in lower case) with BM25 impacts, as shares of the score that the item gives itself.
Postings lie in blocks of items with the largest impact of each block. Every passage of every document (windows of words with a
stride that no item spans) is a query. A vectorised form of WAND's bound comes first: the shares of the rare words
that a passage has from an item, plus all that the common words could add, must reach the threshold for one item at
least. Passages that pass go through block-max WAND, which returns all items above the threshold, and these are
verified: a hit holds 0.8 of the item's five-word shingles, and half of its question and half of its answer, both by pairs of neighbouring
words (parts of fewer than four words: by words, as one changed word leaves a short answer no pair). So neither a question with
another answer nor an answer alone is a hit, however long the part that is there.

The index goes to the executors in chunks of at most ``CHUNK_BYTES`` of item text, one pass over the documents a chunk: a bound
that is checked and doesn't grow with the benchmark.

Defined results: null and empty texts hold nothing; null or empty items are skipped; repeated items count by their smallest
item_id; repeated rows get a row each; items or documents of fewer than five words are compared as one shingle; an
empty table gives no rows, an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, small_batches

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach, and share of its shingles that it must hold.
MIN_SCORE, MIN_OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Share of its question and of its answer that a passage must hold, and from how many words on they are compared by pairs.
MIN_PART, PAIRS_FROM = 0.5, 4
CHUNK_BYTES, BLOCK = 8 << 20, 16
#: Postings that the bound over many passages looks at at once (or those of one passage): some 40 MB.
POSTINGS = 1 << 19
#: A word is common if more than this share of items holds it.
COMMON = 0.05


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], n: int = SHINGLE) -> set[bytes]:
    return {b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is the last sentence, the question what stands before; one sentence is both."""
    words = words_of(text)
    ends = [k + 1 for k, w in enumerate(words[:-1]) if w[-1:] in b".?!"]
    return (words[: ends[-1]], words[ends[-1] :]) if ends else (words, words)


def part(words: list[bytes]) -> tuple[int, set[bytes]]:
    """By what a question or answer is compared: pairs of words, or words if it is short."""
    n = 2 if len(words) >= PAIRS_FROM else 1
    return n, shingles(words, n)


class Index:
    """BM25 impacts of the items' words as shares of the item's own score, in posting lists with block maxima."""

    def __init__(self, items: list[tuple[int, str]], average: float, idf: dict[bytes, float], common: set[bytes]):
        self.ids = [i for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        lists: list[list[tuple[int, float]]] = [[]]
        self.shingles, self.parts = [], []
        self.longest = 1
        common_share = []
        for d, (_, text) in enumerate(items):
            words = words_of(text)
            self.longest = max(self.longest, len(words))
            self.shingles.append(shingles(words))
            self.parts.append(tuple(part(p) for p in question_answer(text)))
            counts = Counter(words)
            impact = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / average)) for w, n in counts.items()}
            own = sum(impact.values())
            common_share.append(sum(x for w, x in impact.items() if w in common) / own)
            for w, x in impact.items():
                if w not in self.vocab:
                    self.vocab[w] = len(lists)
                    lists.append([])
                lists[self.vocab[w]].append((d, x / own))
        self.common_share = np.array(common_share)
        self.docs = [[d for d, _ in x] for x in lists]
        self.shares = [[s for _, s in x] for x in lists]
        self.most = [max(x, default=0.0) for x in self.shares]
        self.block_last = [[x[min(k + BLOCK, len(x)) - 1] for k in range(0, len(x), BLOCK)] for x in self.docs]
        self.block_most = [[max(x[k : k + BLOCK]) for k in range(0, len(x), BLOCK)] for x in self.shares]
        # rare words' postings in one array each, for the bound over many passages at once
        rare = np.ones(len(lists), bool)
        rare[0] = False
        for w in common:
            if w in self.vocab:
                rare[self.vocab[w]] = False
        self.rare_size = np.array([len(x) if r else 0 for x, r in zip(self.docs, rare, strict=True)], np.int64)
        self.rare_at = np.cumsum(self.rare_size) - self.rare_size
        self.rare_doc = np.array([d for x, r in zip(self.docs, rare, strict=True) if r for d in x], np.int64)
        self.rare_share = np.array([s for x, r in zip(self.shares, rare, strict=True) if r for s in x])

    @property
    def stride(self) -> int:
        return max(32, self.longest)

    def wand(self, terms: list[int], threshold: float) -> dict[int, float]:
        """All items whose shares over ``terms`` (different words) sum to ``threshold`` or more, by block-max WAND."""
        at = {t: 0 for t in terms if self.docs[t]}
        heap = sorted((self.docs[t][0], t) for t in at)
        found: dict[int, float] = {}
        while heap:
            bound, pivot = 0.0, None
            for k, (d, t) in enumerate(heap):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = d
                    while k + 1 < len(heap) and heap[k + 1][0] == d:
                        k += 1
                    break
            if pivot is None:
                break
            live = heap[: k + 1]
            blocks = [(t, min(bisect_left(self.block_last[t], pivot), len(self.block_last[t]) - 1)) for _, t in live]
            if sum(self.block_most[t][b] for t, b in blocks if self.block_last[t][b] >= pivot) < threshold:
                # no item up to the end of the first of these blocks can reach it
                target = min([self.block_last[t][b] for t, b in blocks if self.block_last[t][b] >= pivot] + ([heap[k + 1][0] - 1] if k + 1 < len(heap) else [])) + 1
            else:
                target = pivot + 1
                if heap[0][0] == pivot:
                    if (s := sum(self.shares[t][at[t]] for d, t in live if d == pivot)) >= threshold:
                        found[pivot] = s
                else:
                    target = pivot
            rest = heap[k + 1 :]
            for d, t in live:
                if d < target:
                    at[t] = bisect_left(self.docs[t], target, at[t])
                if at[t] < len(self.docs[t]):
                    rest.append((self.docs[t][at[t]], t))
            heap = sorted(rest)
        return found

    def verified(self, d: int, have: dict[int, set[bytes]]) -> tuple[float, float, float]:
        """Shares of the item, its question and its answer in a passage with the runs ``have`` of 1, 2 and SHINGLE words."""
        share = lambda s, n: len(s & have[n]) / len(s) if s else 0.0
        return share(self.shingles[d], SHINGLE), *(share(s, n) for n, s in self.parts[d])

    def reached(self, passages: np.ndarray, min_score: float) -> set[int]:
        """Rows of ``passages`` whose rare words reach ``min_score`` for an item, with all that its common words could add.

        Taken in runs of at most POSTINGS postings: a passage's words may have any share of the index each, so its text doesn't bound them.
        """
        live: set[int] = set()
        ends = np.cumsum(self.rare_size[passages].sum(axis=1))
        at = 0
        while at < len(passages):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS, side="right")))
            r, c = np.nonzero(self.rare_size[passages[at:end]])
            term = passages[at:end][r, c]
            size = self.rare_size[term]
            row = np.repeat(r, size)
            post = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.rare_at[term], size)
            key = row * len(self.ids) + self.rare_doc[post]
            each, where = np.unique(key, return_inverse=True)
            bound = np.bincount(where, self.rare_share[post], len(each)) + self.common_share[each % len(self.ids)]
            live |= set((at + each[bound >= min_score - 1e-9] // len(self.ids)).tolist())
            at = end
        return live

    def search(self, texts: list[str | None], min_score: float, min_overlap: float) -> list[list[tuple]]:
        """For each text its verified items: (item_id, score, overlap, question overlap, answer overlap), best passage each."""
        stride, get = self.stride, self.vocab.get
        tokens = [words_of(t) for t in texts]
        rows, owner, first = [], [], []
        for k, words in enumerate(tokens):
            n = -(-len(words) // stride)
            ids = np.zeros(n * stride, np.int32)
            ids[: len(words)] = [get(w, 0) for w in words]
            rows.append(ids.reshape(n, stride))
            owner.append(np.full(n, k))
            first.append(np.arange(n) * stride)
        out: list[dict[int, tuple]] = [{} for _ in texts]
        owner, first = np.concatenate(owner) if owner else np.empty(0, np.int64), np.concatenate(first) if first else np.empty(0, np.int64)
        if not len(owner):
            return [[] for _ in texts]
        blocks = np.concatenate(rows)
        after = np.zeros_like(blocks)
        after[:-1] = np.where((owner[1:] == owner[:-1])[:, None], blocks[1:], 0)
        passages = np.sort(np.concatenate([blocks, after], axis=1), axis=1)
        passages[:, 1:][passages[:, 1:] == passages[:, :-1]] = 0  # each word once
        live = self.reached(passages, min_score)
        if (all_common := self.common_share >= min_score - 1e-9).any():  # items of common words alone: no rare word needed
            common = [t for t in range(1, len(self.docs)) if self.rare_size[t] == 0 and any(all_common[d] for d in self.docs[t])]
            live |= set(np.flatnonzero(np.isin(passages, common).any(axis=1)).tolist())
        for p in sorted(live):
            hits = self.wand([int(t) for t in passages[p] if t], min_score)
            if not hits:
                continue
            k = int(owner[p])
            have = {n: shingles(tokens[k][first[p] : first[p] + 2 * stride], n) for n in (1, 2, SHINGLE)}
            for d, score in hits.items():
                overlap, question, answer = self.verified(d, have)
                if overlap >= min_overlap and min(question, answer) >= MIN_PART:
                    row = (self.ids[d], min(score, 1.0), overlap, question, answer)
                    if self.ids[d] not in out[k] or row[1:] > out[k][self.ids[d]][1:]:
                        out[k][self.ids[d]] = row
        return [[x[i] for i in sorted(x)] for x in out]


def indexes(benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Index]:
    """Indexes over chunks of the items. Word statistics cover all items and stay in Spark; the driver holds a chunk at a time, of at
    most ``chunk_bytes`` of text (or one item), and the statistics of its words."""
    text = F.col("text").cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")).where(text.rlike(r"[^\x20\x09-\x0D]")).groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = materialize(items.where("item_id is not null"), "items")
    words = materialize(_words(items).groupBy("word").agg(F.count("*").alias("items"), F.sum("n").alias("n")), "words")
    n, total = items.count(), words.agg(F.sum("n")).first()[0]

    def index(held: list[tuple[int, str]]) -> Index:
        own = _words(items.where(F.col("item_id").between(held[0][0], held[-1][0]))).select("word").distinct()
        found = {r["word"]: r["items"] for r in words.join(own, "word").select("word", "items").toLocalIterator()}  # the words of a chunk
        counts = {bytes(w): c for w, c in found.items()}
        return Index(held, total / n, {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in counts.items()}, {w for w, c in counts.items() if c > max(2, COMMON * n)})

    held, size = [], 0
    for row in items.orderBy("item_id").toLocalIterator():
        if held and size + len(row["text"]) * 4 > chunk_bytes:
            yield index(held)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"]) * 4
    if held:
        yield index(held)


def _words(items: DataFrame) -> DataFrame:
    """(word, n): a row for each item and different word in it, and how often it stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for text in batch["text"] for x in Counter(words_of(text.as_py())).items()]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], names=["word", "n"])

    return items.select("text").mapInArrow(run, "word binary, n long")


HITS = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, text: pa.Array) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of an Arrow batch with about SLICE_BYTES of text, which bounds what a search holds at once."""
    at, size, texts = 0, 0, []
    for k, x in enumerate(text):
        texts.append(x.as_py())
        size += len(texts[-1] or "")
        if size >= SLICE_BYTES:
            yield batch.slice(at, k + 1 - at), texts
            at, size, texts = k + 1, 0, []
    if texts:
        yield batch.slice(at), texts


def matches(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """A row for each verified (document, item)."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], HITS)
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in slices(batch, batch["text"]):
                    found = [(i, *x) for i, hits in zip(part["doc_id"].to_pylist(), sent.value.search(texts, min_score, min_overlap), strict=True) for x in hits]
                    kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        out = out.unionByName(rows.mapInArrow(run, HITS))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    names = docs.columns
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in slices(batch, batch.column(names.index("text")).cast(pa.string())):
                    yield part.filter(pa.array([not x for x in sent.value.search(texts, min_score, min_overlap)], pa.bool_()))

        docs = small_batches(docs).mapInArrow(run, docs.schema)
    return docs


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and test item that it holds."""
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

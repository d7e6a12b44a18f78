"""Bulk-synchronous best-fit packing of token sequences.

Documents and gaps are sorted by range of size: a document's successor is the smallest gap that holds it, so most are matched
without looking beyond their range. Each round is a Spark stage over ranges of sizes. A range sweeps its documents from long to short:
those of a length and the bins of its successor gap are matched by rank, as many as there are of both, the bins move to their new gap, and what the
gap can't take goes on to the next larger one. Documents and gaps that a range leaves over meet in the next round, in fewer and wider
ranges; in the last one, of all sizes, new bins are opened for what no gap holds. Documents longer than half of the capacity have a bin of their own
from the start.

Documents of one length have consecutive ranks and so have bins that were opened and filled together, so a table of documents or gaps
is one of intervals of ranks: its size follows from the capacity, not from the rows, and so do the steps that come out. The rows
themselves are ranked and placed in Spark.

Defined results: a null text is an empty one and has the end token alone; repeated rows are packed one by one; an empty
table gives no rows; other columns are ignored by ``pack_documents`` and kept by ``place``, whatever they are called.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import materialize, small_batches, spare

CAPACITY, END_ID = 1024, 2
#: Rows of one length that are ranked in one group, on average over the longest one's: lengths are dealt over parts, as one may hold any share of rows.
RANK_ROWS = 100_000
#: Ranges of sizes in the rounds.
RANGES = (8, 2, 1)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """ids of a byte-level BPE, as the tokenizers library gives them.

    Texts of Latin letters, digits, ASCII and general punctuation go through tiktoken, which holds the same
    merges as ranks and is four times as fast; any other text (and any with a special token's string) goes through tokenizers.
    """

    PLAIN = r"[\x00-\x7f\xa1-\xac\xae-\xffĀ-ſ‐-‧€]*"

    def __init__(self, json_path: str, ranks_path: str | None):
        import re

        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        self.fast = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = re.compile(self.PLAIN).fullmatch

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and "<|" not in text and self.plain(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


_encoders: dict[tuple, Encoder] = {}


def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Encoder:
    """The encoder of this process for the files given, by default those of the installed public vocabularies."""
    if json_path is None:
        import public_tokenizers as P

        json_path, ranks_path = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
    key = (json_path, ranks_path)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all full but the first, which takes the remainder."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def tokenize(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """The pieces of every document, with a digest of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def sweep(docs: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], capacity: int, next_bin: int | None) -> tuple[list, list, list, int | None]:
    """One sweep of documents (length, first rank, count) over bins (gap, first bin, count).

    Returns steps (length, first rank, count, first bin, offset), the documents and the bins that are left, and the next new bin.
    With ``next_bin`` None no bins are opened and documents that no gap holds are left.
    """
    free: dict[int, deque[tuple[int, int]]] = {}
    have: list[int] = []  # the gaps that bins have, sorted
    steps, over = [], []

    def put(gap: int, first: int, count: int) -> None:
        if gap:
            if gap not in free:
                free[gap] = deque()
                insort(have, gap)
            free[gap].append((first, count))

    for gap, first, count in sorted(gaps):
        put(gap, first, count)
    for length, rank, left in sorted(docs, key=lambda d: (-d[0], d[1])):
        while left:
            at = bisect_left(have, length)
            if at == len(have):
                if next_bin is None:
                    over.append((length, rank, left))
                    break
                opened = -(-left // (capacity // length))  # each is to take as many of these as fit
                put(capacity, next_bin, opened)
                next_bin += opened
                continue
            gap = have[at]
            first, count = free[gap].popleft()
            take = min(left, count)
            if take < count:
                free[gap].appendleft((first + take, count - take))
            if not free[gap]:
                del free[gap]
                have.pop(at)
            steps.append((length, rank, take, first, capacity - gap))
            put(gap - length, first, take)
            rank, left = rank + take, left - take
    return steps, over, [(g, *x) for g in have for x in free[g]], next_bin


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Steps and the number of bins for documents counted by length, in a single sweep without ranges."""
    steps, _, _, bins = sweep([(length, 0, n) for length, n in counts.items()], [], capacity, 0)
    return steps, bins


DOCS, GAPS, STEPS = 0, 1, 2
INTERVALS = "kind int, size long, first long, n long, bin long, offset long"
#: Bins opened for documents of a length are numbered from the length times this; those of the last round from (capacity + 1) times this.
BINS_EACH = 1 << 44


def rounds(counts: DataFrame, capacity: int, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """The steps (size, first, n, bin, offset) for documents counted by length (length, c): the rows [first, first + n) of length
    ``size`` go to the bins [bin, bin + n), one each, at ``offset``.

    A round is a stage over intervals of documents and gaps; none of them reaches the driver.
    """
    length = F.col("length").cast("long")
    row = lambda kind, size, bin_: [F.lit(kind).alias("kind"), size.alias("size"), F.lit(0).cast("long").alias("first"), F.col("c").alias("n"), bin_.alias("bin"), F.lit(0).cast("long").alias("offset")]
    none, long_ = F.lit(0).cast("long"), F.col("length") * 2 > capacity
    state = counts.where(~long_).select(*row(DOCS, length, none))
    state = state.union(counts.where(long_).select(*row(STEPS, length, length * BINS_EACH)))
    state = state.union(counts.where(long_ & (F.col("length") < capacity)).select(*row(GAPS, F.lit(capacity) - length, length * BINS_EACH)))

    def run(last: bool):
        def match(key: tuple, rows: pa.Table) -> pa.Table:
            own = list(zip(*(rows[c].to_pylist() for c in ("kind", "size", "first", "n", "bin")), strict=True))
            docs, gaps = [(s, f, n) for k, s, f, n, _ in own if k == DOCS], [(s, b, n) for k, s, _, n, b in own if k == GAPS]
            steps, over, left, _ = sweep(docs, gaps, capacity, (capacity + 1) * BINS_EACH if last else None)
            out = [(STEPS, s, f, n, b, o) for s, f, n, b, o in steps] + [(DOCS, s, f, n, 0, 0) for s, f, n in over] + [(GAPS, s, 0, n, b, 0) for s, b, n in left]
            kinds = (pa.int32(), *[pa.int64()] * 5)
            return pa.table({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate(zip(("kind", "size", "first", "n", "bin", "offset"), kinds, strict=True))})

        return match

    done = []
    for k, n in enumerate(ranges):
        after = state.where(F.col("kind") != STEPS).groupBy(F.floor((F.col("size") - 1) * n / capacity).alias("range")).applyInArrow(run(k == len(ranges) - 1), INTERVALS)
        done.append(state.where(F.col("kind") == STEPS))
        state = materialize(after, "round")
    done.append(state.where(F.col("kind") == STEPS))
    return reduce(DataFrame.union, done).select("size", "first", "n", "bin", "offset")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with doc_id, piece, ids_crc32 and a whole ``length`` of 1 to ``capacity``) with sequence_id and offset."""
    part, first, rank = spare(pieces, "part", "first", "rank")
    by_length = pieces.groupBy("length").agg(F.count("*").alias("c"))
    parts = max(1, -(-(by_length.agg(F.max("c")).first()[0] or 0) // RANK_ROWS))
    pieces = pieces.withColumn(part, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    counts = materialize(pieces.groupBy("length", part).agg(F.count("*").alias("c")), "lengths")
    before = counts.select("length", part, (F.sum("c").over(W.partitionBy("length").orderBy(part)) - F.col("c")).alias(first))
    number = F.row_number().over(W.partitionBy("length", part).orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.join(before, ["length", part]).withColumn(rank, F.col(first) + number - 1).drop(part, first)
    steps = rounds(counts.groupBy("length").agg(F.sum("c").alias("c")), capacity).toArrow()  # a few steps for each length: bounded by the capacity
    steps = steps.sort_by([("size", "ascending"), ("first", "ascending")])
    size, at, bins, offset = (steps[c].to_numpy() for c in ("size", "first", "bin", "offset"))
    edge = np.searchsorted(size, np.arange(capacity + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(zero_copy_only=False), batch[rank].to_numpy(zero_copy_only=False)
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for x in np.unique(length):
                own, (a, b) = np.flatnonzero(length == x), edge[x : x + 2]
                step = a + np.searchsorted(at[a:b], number[own], "right") - 1
                seq[own], off[own] = bins[step] + number[own] - at[step], offset[step]
            keep = [c for c in batch.schema.names if c != rank]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != rank) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **kinds) -> DataFrame:
    """Every document's pieces with their sequence and place in it. The pieces are written once, then ranked and placed."""
    return place(materialize(tokenize(docs, capacity, **kinds), "pieces"), capacity)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

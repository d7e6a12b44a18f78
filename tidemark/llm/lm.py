"""LM scoring by prediction by partial matching over bytes.

The model predicts the next byte from the ``ORDER`` bytes before it. The trie of byte contexts is kept as tables, one an
order: a row for each context and symbol with its count in the training texts. Escape to the next shorter context takes
method C (as many escapes as different symbols), with symbol exclusion: symbols of a longer context that was escaped
from take no part below. An unseen context escapes for free; below order 0 the 256 bytes are alike. A text is read as
its lower-cased words, each followed by a space, and an end byte; its score is the log10 probability of those bytes, the
sum over its (context, symbol) grams.

Documents lie in batches of a fixed size in bytes and are read in smaller chunks. A batch sends its different grams and words once to the buckets of
their hashes, sorted and packed, with their counts in training texts; buckets sum the counts, which makes the model's
tables. Those are joined in Spark, order by order, into a probability for every gram of the corpus; buckets send a
batch the values of its own grams, and the batch sums them by document. No task holds the model, whatever its size.

The base score is that of a unigram model over tokens (words and one end a text) with 0.1 added to each count.

Defined results: a null or wordless text is one end token; repeated rows count as often as they stand in training; a null doc_id
hashes like an empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import LAST_ID, blob_batches, hash_words, materialize, of_blobs, pack, pack_sorted, sorted_rows, unpack, unpack_sorted

#: Bytes of context, folds of which the first is held out, and text bytes of the table for each bucket.
ORDER, FOLDS, BUCKET_BYTES = 5, 10, 4 << 20
#: Text bytes of a batch, and those that are turned into grams at once.
BATCH_BYTES, CHUNK_BYTES = 16 << 20, 1 << 20
END, SPACE, PAD = 10, 32, 0
ALPHA = 0.1
END_WORD = b"\n"
SENT = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("kind", pa.int8()), ("n", pa.int64()), ("h", pa.binary()), ("c", pa.binary())])
SENT_SQL = "bucket int, batch int, kind byte, n long, h binary, c binary"
GRAMS, WORDS = 0, 1


def symbols(text: str | None) -> tuple[bytes, list[bytes]]:
    """The bytes that a text is read as, and its words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return (b" ".join(words) + b" " if words else b"") + bytes([END]), words


def grams(data: bytes, order: int = ORDER) -> np.ndarray:
    """For each byte, itself below the ``order`` bytes before it, as one number."""
    a = np.frombuffer(bytes([PAD]) * order + data, np.uint8)
    g = np.zeros(len(data), np.uint64)
    for k in range(order + 1):
        g = (g << np.uint64(8)) | a[k : k + len(data)]
    return g


def held_out(ids: list[int | None], folds: int = FOLDS) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(str(i).encode() if i is not None else b"") % folds == 0 for i in ids], bool)


class Texts:
    """The documents of a batch, in chunks: their grams and word hashes, document by document."""

    def __init__(self, table: pa.Table, order: int):
        self.order = order
        self.ids, self.texts, _ = sorted_rows(table)
        self.held = held_out([None if i == LAST_ID else i for i in self.ids.tolist()])

    def chunks(self):
        """(documents as a slice, {kind: (values, sizes)})."""
        at, size = 0, 0
        for k, t in enumerate(self.texts):
            size += len(t or "")
            if size >= CHUNK_BYTES or k + 1 == len(self.texts):
                yield slice(at, k + 1), self._read(self.texts[at : k + 1])
                at, size = k + 1, 0

    def _read(self, texts: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        data, words, sizes = [], [], []
        for t in texts:
            b, w = symbols(t)
            data.append(grams(b, self.order))
            words += w
            words.append(END_WORD)
            sizes.append(len(w) + 1)
        return {GRAMS: (np.concatenate(data), np.array([len(d) for d in data])), WORDS: (hash_words(words), np.array(sizes))}


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the place of its like among the different values, and those."""
    import pandas as pd

    return pd.factorize(values)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    x = h * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(16)) % np.uint64(buckets)


def _send(order: int, buckets: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        texts, out = Texts(of_blobs(table["blob"]), order), []
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {GRAMS: [], WORDS: []}
        for docs, read in texts.chunks():
            for kind, (h, sizes) in read.items():
                code, value = distinct(h)
                found[kind].append((value, np.bincount(code, np.repeat(~texts.held[docs], sizes), len(value)).astype(np.int64)))
        for kind, parts in found.items():
            value, count = np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])
            code, value = distinct(value)
            count = np.bincount(code, count, len(value)).astype(np.uint32)
            to = bucket_of(value, buckets)
            by = np.lexsort((value, to))
            value, count, to = value[by], count[by], to[by]
            at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            for a, b in zip(at, np.append(at[1:], len(to)), strict=True):
                out.append((int(to[a]), key[0].as_py(), kind, int(b - a), pack_sorted(value[a:b]), pack(count[a:b])))
        return pa.Table.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(SENT)], schema=SENT)

    return run


def _count(kind: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        n = table["n"].to_pylist()
        h = np.concatenate([unpack_sorted(x, k, np.uint64) for k, x in zip(n, table["h"].to_pylist(), strict=True)])
        c = np.concatenate([unpack(x, k, np.uint32) for k, x in zip(n, table["c"].to_pylist(), strict=True)]).astype(np.int64)
        by = np.argsort(h, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], h[by][1:] != h[by][:-1]]))
        value, count = h[by][at], np.add.reduceat(c[by], at)
        return pa.table({"bucket": pa.array(np.full(len(at), key[0].as_py()), pa.int32()), "h": pa.array(value.view(np.int64)), "c": pa.array(count)})

    return run


def probabilities(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(bucket, h, x): log10 probability of every gram's last byte after its others.

    ``counted``: bucket, gram ``h`` and training count ``c`` (0: in no training text). For order k, the gram of order k
    is h's last k + 1 bytes; its context's rows are those with equal h >> 8.
    """
    level = counted.where("c > 0").select("h", "c")
    tables = {order: materialize(level, f"grams{order}")}
    for k in range(order - 1, -1, -1):
        tables[k] = materialize(tables[k + 1].groupBy(F.col("h").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("h")).agg(F.sum("c").alias("c")), f"grams{k}")
    # for each context: n, d; and, of what the next longer context has, what it takes away here (xn, xd)
    done, todo = None, counted.select("bucket", "h", F.lit(0.0).alias("escaped"), F.lit(0).cast("long").alias("xn"), F.lit(0).cast("long").alias("xd"))
    for k in range(order, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        t = tables[k]
        context = t.groupBy(F.shiftrightunsigned("h", 8).alias("ctx")).agg(F.sum("c").alias("n"), F.count("*").alias("d"))
        if k:  # counts in the shorter context of the symbols seen here
            low = tables[k - 1].select(F.col("h").alias("low"), F.col("c").alias("lc"))
            less = t.select(F.shiftrightunsigned("h", 8).alias("ctx"), F.col("h").bitwiseAND((1 << 8 * k) - 1).alias("low")).join(low, "low").groupBy("ctx").agg(F.sum("lc").alias("below"))
            context = context.join(less, "ctx")
        else:
            context = context.withColumn("below", F.lit(0).cast("long"))
        here = todo.withColumn("g", F.col("h").bitwiseAND(mask)).withColumn("ctx", F.shiftrightunsigned("g", 8))
        here = here.join(context, "ctx", "left").join(t.select(F.col("h").alias("g"), F.col("c").alias("gc")), "g", "left")
        n, d = F.col("n") - F.col("xn"), F.col("d") - F.col("xd")
        here = here.withColumns({"left": (n + d).cast("double"), "rest": d.cast("double")})
        sure = here.where("gc is not null").select("bucket", "h", (F.col("escaped") + F.log10(F.col("gc") / F.col("left"))).alias("x"))
        done = sure if done is None else done.union(sure)
        # an unseen context, or one whose symbols are all excluded, costs nothing
        cost = F.when(F.col("n").isNull() | (F.col("rest") <= 0), 0.0).otherwise(F.log10(F.col("rest") / F.col("left")))
        todo = here.where("gc is null").select("bucket", "h", (F.col("escaped") + cost).alias("escaped"), F.coalesce("below", "xn").alias("xn") if k else F.lit(0).cast("long").alias("xn"), F.coalesce("d", "xd").alias("xd"))
        todo = materialize(todo, f"unseen{k}")
    last = todo.select("bucket", "h", (F.col("escaped") - F.log10(F.greatest(F.lit(256) - F.col("xd"), F.lit(1)).cast("double"))).alias("x"))
    return done.union(last)


def _answer(kind: int) -> Callable:
    """Of one bucket: to each batch the values of what it sent, in the order it sent it: single-precision logarithms for
    grams, whole counts for words."""

    def run(key: tuple, sent: pa.Table, known: pa.Table) -> pa.Table:
        h = known["h"].to_numpy().view(np.uint64)
        by = np.argsort(h)
        h, x = h[by], known["x"].to_numpy()[by].astype(VALUE[kind])
        values = [pack(x[np.searchsorted(h, unpack_sorted(b, n, np.uint64))]) for n, b in zip(sent["n"].to_pylist(), sent["h"].to_pylist(), strict=True)]
        return pa.table({"batch": sent["batch"], "kind": sent["kind"], "n": sent["n"], "h": sent["h"], "x": pa.array(values, pa.binary())})

    return run


VALUE = {GRAMS: np.float32, WORDS: np.uint64}


def _score(order: int, tokens: int, kinds: int) -> Callable:
    def run(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        texts = Texts(of_blobs(table["blob"]), order)
        values: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        kind_of = known["kind"].to_numpy()
        for kind in (GRAMS, WORDS):
            own = known.filter(pa.array(kind_of == kind))
            n = own["n"].to_pylist()
            h = np.concatenate([unpack_sorted(b, k, np.uint64) for b, k in zip(own["h"].to_pylist(), n, strict=True)])
            x = np.concatenate([unpack(b, k, VALUE[kind]) for b, k in zip(own["x"].to_pylist(), n, strict=True)])
            by = np.argsort(h)
            values[kind] = h[by], x[by].astype(np.float64)
        sums, base, seen, sizes = [], [], [], []
        for _, read in texts.chunks():
            for kind, (all_h, size) in read.items():
                h, x = values[kind]
                code, value = distinct(all_h)
                x = x[np.searchsorted(h, value)]
                first = np.cumsum(size) - size
                if kind == GRAMS:
                    sums.append(np.add.reduceat(x[code], first))
                else:
                    base.append(np.add.reduceat(np.log10((x + ALPHA) / (tokens + ALPHA * (kinds + 1)))[code], first))
                    seen.append(np.add.reduceat((x > 0).astype(np.int64)[code], first))
                    sizes.append(size)
        ids = [None if i == LAST_ID else i for i in texts.ids.tolist()]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(texts.held), "n_tokens": pa.array(np.concatenate(sizes).astype(np.int64)), "n_known": pa.array(np.concatenate(seen)), "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)), "base_score": pa.array(np.concatenate(base)), "score": pa.array(np.concatenate(sums))})

    return run


def lm_scores(docs: DataFrame, order: int = ORDER, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Scores of every row under the model of the rows that aren't held out."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(8, math.ceil(total / BUCKET_BYTES))
    by_batch = blob_batches(docs, batch_bytes).groupBy("batch")
    sent = materialize(by_batch.applyInArrow(_send(order, buckets), SENT_SQL), "sent")
    counted = {k: materialize(sent.where(F.col("kind") == k).groupBy("bucket").applyInArrow(_count(k), "bucket int, h long, c long"), f"counted{k}") for k in (GRAMS, WORDS)}
    n, v = counted[WORDS].agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n, v = n or 0, v or 0
    values = {GRAMS: probabilities(counted[GRAMS], order), WORDS: counted[WORDS].select("bucket", "h", F.col("c").alias("x"))}
    known = None
    for k, x in values.items():
        part = sent.where(F.col("kind") == k).groupBy("bucket").cogroup(x.groupBy("bucket")).applyInArrow(_answer(k), "batch int, kind byte, n long, h binary, x binary")
        known = part if known is None else known.union(part)
    return by_batch.cogroup(known.groupBy("batch")).applyInArrow(_score(order, n, v), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))

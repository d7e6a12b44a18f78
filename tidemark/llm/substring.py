"""Exact repeated passages by fixed-block anchors.

A window is ``window`` consecutive words. Non-overlapping blocks of ``(window + 1) // 2`` words are a document's anchors: any
window of it holds one of them whole. Every rolling run of that many words is probed against the anchors of all
documents; around the runs that hit an anchor of another document the windows are compared, which extends the hits to
maximal exact repeats; and the words they cover are removed from all documents but the first.

Documents are dealt into batches of a fixed size in bytes. A batch sends, for every bucket of hashes, one row with the
sorted different hashes it holds, as packed differences: a run that stands in a third of all documents is sent once a batch.

1. probe: 7-word runs, of each whether it is an anchor and whether two documents of the batch hold it; a bucket answers
   with those that two documents hold and one has as an anchor. Short hashes will do: a chance hit costs time only.
2. extend: hashes (128 bits) of the windows around hits, each with the smallest doc_id of the batch; a bucket answers with
   those that have a smaller doc_id in another batch.
3. remove: windows whose first document in the batch or in another batch is smaller cover words that go.

Defined results: a null text has no words; repeated rows and rows with one doc_id don't remove from each other; a null
doc_id comes after all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import LAST_ID, hash_words, mix, pack, pack_sorted, sorted_rows, text_batches, unpack, unpack_sorted, windows

WINDOW = 13
#: Text bytes of the table for each bucket of hashes, so that a bucket's share of them keeps its size.
BUCKET_BYTES = 4 << 20
SENT = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("n", pa.int64()), ("h", pa.binary()), ("x", pa.binary())])
SENT_SQL = "bucket int, batch int, n long, h binary, x binary"
BACK_SQL = "batch int, bucket int, n long, h binary, x binary"


class Batch:
    """The documents of one batch in their order, and the hashes of their words."""

    def __init__(self, table: pa.Table):
        self.ids, self.texts, self.order = sorted_rows(table)
        each = [hash_words((t or "").encode("utf-8", "surrogatepass").split()) for t in self.texts]
        self.sizes = np.array([len(h) for h in each], np.int64)
        self.words = np.concatenate([*each, np.empty(0, np.uint64)])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(each)), self.sizes)
        self.at = np.arange(len(self.words)) - np.repeat(self.first, self.sizes)

    def whole(self, n: int) -> np.ndarray:
        """Where a run of n words begins that lies in one document."""
        return np.flatnonzero(self.at + n <= np.repeat(self.sizes, self.sizes))


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each different value begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.empty(0, np.int64)


def _send(batch: int, bucket: np.ndarray, low: np.ndarray, extra: list[np.ndarray]) -> pa.Table:
    """A row for every bucket; rows come sorted by bucket, then low."""
    at = _runs(bucket)
    stop = np.append(at[1:], len(bucket))
    h = [pack_sorted(low[a:b]) for a, b in zip(at, stop, strict=True)]
    x = [b"".join(len(p).to_bytes(4, "little") + p for p in (pack(e[a:b]) for e in extra)) for a, b in zip(at, stop, strict=True)]
    return pa.Table.from_arrays([pa.array(bucket[at], pa.int32()), pa.array(np.full(len(at), batch), pa.int32()), pa.array(stop - at, pa.int64()), pa.array(h, pa.binary()), pa.array(x, pa.binary())], schema=SENT)


def _parts(x: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(x):
        n = int.from_bytes(x[at : at + 4], "little")
        out.append(x[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _probe(b: Batch, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``block`` words: where they begin, their bucket and a short hash in it."""
    at = b.whole(block)
    h = windows(b.words, block)[at] if len(at) else np.empty(0, np.uint64)
    return at, ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _key(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    return bucket.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)


def _index(block: int, buckets: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        b = Batch(table)
        at, bucket, low = _probe(b, block, buckets)
        code, k = pd.factorize(_key(bucket, low))
        if not len(k):
            return SENT.empty_table()
        doc = b.doc[at]
        anchored, first = np.zeros(len(k), bool), np.empty(len(k), np.int64)
        anchored[code[b.at[at] % block == 0]] = True
        first[code[::-1]] = doc[::-1]  # the document of the first place of each
        many = np.zeros(len(k), bool)
        many[code[doc != first[code]]] = True
        order = np.argsort(k)
        k, anchored, many = k[order], anchored[order], many[order]
        return _send(key[0].as_py(), (k >> np.uint64(32)).astype(np.int32), k.astype(np.uint32), [(anchored + 2 * many).astype(np.uint8)])

    return run


def _answer_probe(key: tuple, table: pa.Table) -> pa.Table:
    """Of one bucket: to each batch the short hashes of runs that two documents hold and one has as an anchor."""
    sent = [unpack_sorted(h, n, np.uint32) for n, h in zip(table["n"].to_pylist(), table["h"].to_pylist(), strict=True)]
    flags = np.concatenate([unpack(_parts(x)[0], n, np.uint8) for n, x in zip(table["n"].to_pylist(), table["x"].to_pylist(), strict=True)])
    low = np.concatenate(sent)
    order = np.argsort(low, kind="stable")
    i = _runs(low[order])
    f = np.bitwise_or.reduceat(flags[order], i)
    hit = (f & 1 > 0) & ((f & 2 > 0) | (np.diff(np.append(i, len(low))) > 1))
    hits = low[order][i[hit]]
    return _back(key, table["batch"].to_pylist(), [s[np.isin(s, hits, assume_unique=True)] for s in sent])


def _back(key: tuple, batches: list[int], found: list[np.ndarray]) -> pa.Table:
    own = [(b, len(f), pack_sorted(f)) for b, f in zip(batches, found, strict=True) if len(f)]
    n = len(own)
    return pa.Table.from_arrays([pa.array([o[0] for o in own], pa.int32()), pa.array([key[0].as_py()] * n, pa.int32()), pa.array([o[1] for o in own], pa.int64()), pa.array([o[2] for o in own], pa.binary()), pa.array([b""] * n, pa.binary())], names=["batch", "bucket", "n", "h", "x"])


def _extend(block: int, window: int, buckets: int) -> Callable:
    def run(key: tuple, table: pa.Table, hits: pa.Table) -> pa.Table:
        if not len(table) or not len(hits):
            return SENT.empty_table()
        b = Batch(table)
        at, bucket, low = _probe(b, block, buckets)
        known = np.concatenate([_key(np.full(n, k), unpack_sorted(h, n, np.uint32)) for k, n, h in zip(hits["bucket"].to_pylist(), hits["n"].to_pylist(), hits["h"].to_pylist(), strict=True)])
        k = _key(bucket, low)
        hit = at[pd.Series(k).isin(known).to_numpy()]
        del k, at, bucket, low
        # a window around a hit begins up to window - block words before it
        reach = np.zeros(len(b.words) + 1, np.int32)
        np.add.at(reach, np.maximum(hit - (window - block), 0), 1)
        np.add.at(reach, hit + 1, -1)
        start = np.flatnonzero(np.cumsum(reach)[:-1] > 0)
        start = start[b.at[start] + window <= b.sizes[b.doc[start]]]
        if not len(start):
            return SENT.empty_table()
        h, other = windows(b.words, window)[start], windows(mix(b.words), window)[start]
        least, ids = _first(h, other, b.ids[b.doc[start]])
        h, other = h[least], other[least]
        to = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((h, to))
        return _send(key[0].as_py(), to[order], h[order], [other[order], ids[order]])

    return run


def _first(h: np.ndarray, other: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different window and its smallest id."""
    order = np.lexsort((other, h))
    i = np.flatnonzero(np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (other[order][1:] != other[order][:-1])]))
    return order[i], np.minimum.reduceat(ids[order], i)


def _answer_extend(key: tuple, table: pa.Table) -> pa.Table:
    """Of one bucket: to each batch the windows that begin in a document of another batch with a smaller doc_id."""
    rows = list(zip(table["n"].to_pylist(), table["h"].to_pylist(), table["x"].to_pylist(), strict=True))
    sizes = [n for n, _, _ in rows]
    h = np.concatenate([unpack_sorted(x, n, np.uint64) for n, x, _ in rows])
    other = np.concatenate([unpack(_parts(x)[0], n, np.uint64) for n, _, x in rows])
    ids = np.concatenate([unpack(_parts(x)[1], n, np.int64) for n, _, x in rows])
    order = np.lexsort((other, h))
    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (other[order][1:] != other[order][:-1])])
    i = np.flatnonzero(new)
    least = np.empty(len(h), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], i), np.diff(np.append(i, len(h))))
    gone, at = ids > least, np.cumsum([0, *sizes])
    own = []
    for k, b in enumerate(table["batch"].to_pylist()):
        pick = np.flatnonzero(gone[at[k] : at[k + 1]]) + at[k]
        if len(pick):
            own.append((b, key[0].as_py(), len(pick), pack_sorted(h[pick]), pack(other[pick])))
    return pa.Table.from_arrays([pa.array([o[j] for o in own], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["batch", "bucket", "n", "h", "x"])


def covered(b: Batch, window: int, gone_h: np.ndarray, gone_other: np.ndarray) -> np.ndarray:
    """Which words of the batch lie in a window that begins in a document with a smaller doc_id."""
    cover = np.zeros(len(b.words) + 1, np.int32)
    start = b.whole(window)
    if len(start):
        h = windows(b.words, window)[start]
        ids = b.ids[b.doc[start]]
        code, value = pd.factorize(h)
        often = np.bincount(code, minlength=len(value)) > 1  # in this batch
        if len(gone_h):
            often |= gone_h[np.minimum(np.searchsorted(gone_h, value), len(gone_h) - 1)] == value
        repeated = often[code]
        pick = np.flatnonzero(repeated)
        if len(pick):
            start, h, ids = start[pick], h[pick], ids[pick]
            other = windows(mix(b.words), window)[start]
            # the windows of other batches take part as those of a document before all
            all_h, all_o = np.concatenate([h, gone_h]), np.concatenate([other, gone_other])
            all_ids = np.concatenate([ids, np.full(len(gone_h), -LAST_ID - 1)])
            order = np.lexsort((all_o, all_h))
            sh, so = all_h[order], all_o[order]
            i = np.flatnonzero(np.concatenate([[True], (sh[1:] != sh[:-1]) | (so[1:] != so[:-1])]))
            least = np.empty(len(all_h), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(all_ids[order], i), np.diff(np.append(i, len(all_h))))
            out = start[ids > least[: len(ids)]]
            np.add.at(cover, out, 1)
            np.add.at(cover, out + window, -1)
    return np.cumsum(cover)[:-1] > 0


def _remove(window: int, with_text: bool) -> Callable:
    def run(key: tuple, table: pa.Table, gone: pa.Table) -> pa.Table:
        b = Batch(table)
        rows = list(zip(gone["n"].to_pylist(), gone["h"].to_pylist(), gone["x"].to_pylist(), strict=True))
        h = np.concatenate([*(unpack_sorted(x, n, np.uint64) for n, x, _ in rows), np.empty(0, np.uint64)])
        other = np.concatenate([*(unpack(x, n, np.uint64) for n, _, x in rows), np.empty(0, np.uint64)])
        order = np.argsort(h, kind="stable")
        cover = covered(b, window, h[order], other[order])
        removed, digest, kept = [], [], []
        for k, text in enumerate(b.texts):
            own = cover[b.first[k] : b.first[k] + b.sizes[k]]
            words = (text or "").encode("utf-8", "surrogatepass").split()
            removed.append(int(own.sum()))
            if removed[-1]:
                words = [w for w, c in zip(words, own.tolist(), strict=True) if not c]
            joined = b" ".join(words)
            digest.append(hashlib.sha256(joined).hexdigest())
            kept.append(joined.decode("utf-8", "replace") if removed[-1] else text)
        arrays = {"doc_id": pa.array([None if i == LAST_ID else i for i in b.ids.tolist()], pa.int64()), "n_words": pa.array(b.sizes), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            arrays |= {"text": pa.array(kept, pa.string()), "rest": _nullable(table["rest"].take(pa.array(b.order, pa.int64())).combine_chunks())}
        return pa.table(arrays)

    return run


def _nullable(a: pa.Array) -> pa.Array:
    """A struct array whose fields may hold nulls, as the schema that goes back to Spark says."""
    if not pa.types.is_struct(a.type):
        return a
    return pa.StructArray.from_arrays([_nullable(a.field(k)) for k in range(a.type.num_fields)], fields=[f.with_type(_nullable(a.field(k)).type).with_nullable(True) for k, f in enumerate(a.type)])


RESULT_SQL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """A row for each row of ``docs``: its numbers of words and of removed words and the SHA-256 of the kept words; with
    ``with_text`` also the text that stays (as it was where nothing was removed, else the kept words joined by spaces)
    and all other columns of ``docs`` in the struct ``rest``."""
    block = (window + 1) // 2
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(8, math.ceil(total / BUCKET_BYTES))
    batched = text_batches(docs, carry=with_text)
    schema = RESULT_SQL
    if with_text:
        schema += f", text string, rest {batched.schema['rest'].dataType.simpleString()}"
    by_batch = batched.groupBy("batch")
    hits = by_batch.applyInArrow(_index(block, buckets), SENT_SQL).groupBy("bucket").applyInArrow(_answer_probe, BACK_SQL)
    sent = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(_extend(block, window, buckets), SENT_SQL)
    gone = sent.groupBy("bucket").applyInArrow(_answer_extend, BACK_SQL)
    return by_batch.cogroup(gone.groupBy("batch")).applyInArrow(_remove(window, with_text), schema)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its columns and rows, and of each repeated passage only the words of its first document.

    A column ``n_chars`` is counted anew; a text whose every word goes becomes empty.
    """
    out = remove_repeats(docs, window, with_text=True)
    cols = []
    for f in docs.schema.fields:
        col = F.col(f.name) if f.name in ("doc_id", "text") else F.length(F.coalesce("text", F.lit(""))) if f.name == "n_chars" else F.col(f"rest.`{f.name}`")
        cols.append(col.cast(f.dataType).alias(f.name))
    return out.select(*cols)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")

"""SimHash near-duplicates: fingerprints, pigeonhole blocks and connected groups.

``fingerprints`` gives every text 64 bits. ``links`` finds all pairs of fingerprints within a Hamming distance:
the bits are cut into blocks, more than the distance, so that a close pair agrees on at least ``blocks - distance`` of them;
fingerprints are keyed by every choice of that many blocks, brought together by key, and verified. Only different
fingerprints take part, so a text with any number of copies counts once. Fingerprints of one key are compared
in chunks of bounded size; those of a key with more of them than a chunk holds are keyed once more by blocks of the bits that the key
leaves open, and keys that are still too large are dealt over pairs of chunks. Keys far too large for one call are found by
counting first and never gathered. A chunk returns a spanning forest of its close pairs, not the pairs: groups keep every link, and output grows with the fingerprints.
``components`` joins the forests into groups by alternating large-star and small-star steps.
``keep_first`` takes its candidates from the same search, over the fingerprint of every text and weighted ones, and decides them on all shingles.

Defined results: a null text is an empty one; a text without words has fingerprint zero, which links like any other;
repeated rows and ties share a fingerprint and a group; a null doc_id is a row of its own and never names a group unless all
ids of the group are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, mix, pack_sorted, small_batches, spare, unpack_sorted

#: Most fingerprints of one key that are compared in one call.
CHUNK = 2048


def fingerprint(text: str | None, words: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included; A-Z in lower case."""
    import xxhash

    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    n = max(1, len(parts) - words + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[words - 1 :] - 1).tolist() if len(parts) >= words else [len(joined)]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    sums = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        h = np.array([digest(view[a:b], 42) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of up to 255 bits fit a byte
            sums += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(x.as_py(), words) for x in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fp: np.ndarray, split: int, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within ``distance``: all pairs if ``split`` is 0, else those across ``split``.

    Members already joined by earlier ones are still compared, so no link is lost.
    """
    n = len(fp)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(split or n - 1):
        rest = fp[split:] if split else fp[i + 1 :]
        for j in np.flatnonzero(np.bitwise_count(rest ^ fp[i]) <= distance) + (split or i + 1):
            a, b = find(i), find(int(j))
            if a != b:
                parent[b] = a
                out.append((i, int(j)))
    return out


#: Fingerprints that are keyed at once, and keyed fingerprints for each bucket.
KEYED_ROWS, BUCKET_KEYS = 1 << 14, 1 << 20
#: A key with more members than this doesn't go to a bucket; it is looked for in buckets of more than OVERLOADED times their share.
HOT_KEY, OVERLOADED = 1 << 18, 2
#: Keys of up to so many members are tried together first; most hold no link.
FEW = 64
#: Parts over which the members of one key are dealt when they learn how many they are.
SALTS = 32


class Keys:
    """Tables of masks: a fingerprint has a key in each, the bits under the mask."""

    def __init__(self, masks: list[int]):
        self.masks = np.array(masks, np.uint64)

    def of(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(table, row, hash of the key) of every fingerprint in every table."""
        table = np.repeat(np.arange(len(self.masks)), len(fp))
        row = np.tile(np.arange(len(fp)), len(self.masks))
        return table, row, mix((fp[row] & self.masks[table]) + table.astype(np.uint64))


def chosen_masks(bits: int, blocks: int, distance: int) -> list[int]:
    """The bits of ``bits`` cut into ``blocks``, in every choice of as many blocks as agree within ``distance``."""
    places = [k for k in range(64) if bits >> k & 1]
    each = [sum(1 << places[k] for k in range(round(b * len(places) / blocks), round((b + 1) * len(places) / blocks))) for b in range(blocks)]
    return [sum(kept) for kept in combinations(each, blocks - distance)]


def _hot_keys(fps: DataFrame, keys: Keys, buckets: int) -> np.ndarray:
    """Hashes of the keys with more than HOT_KEY members: one in HOT_KEY of the keyed fingerprints at most.

    Buckets are counted first, and keys only in those that hold far more than their share.
    """

    def counting(only: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            full = np.zeros(buckets, np.int64)
            for batch in batches:
                key = keys.of(batch["fp"].to_numpy().view(np.uint64))[2]
                to = (key >> np.uint64(20)) % np.uint64(buckets)
                if only is None:
                    full += np.bincount(to.astype(np.int64), minlength=buckets)
                else:
                    what, n = np.unique(key[np.isin(to, only)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(what.view(np.int64)), pa.array(n)], names=["what", "n"])
            if only is None:  # once a task, not once a batch
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(full)), pa.array(full[full > 0])], names=["what", "n"])

        return run

    def most(only: np.ndarray | None, least: int) -> np.ndarray:
        counts = fps.select("fp").mapInArrow(counting(only), "what long, n long").groupBy("what").agg(F.sum("n").alias("n")).where(F.col("n") > least)
        return np.sort(np.array([r["what"] for r in counts.select("what").toLocalIterator()], np.int64).view(np.uint64))

    overloaded = most(None, max(HOT_KEY, OVERLOADED * BUCKET_KEYS))
    return most(overloaded, HOT_KEY) if len(overloaded) else overloaded


def _with_links(own: np.ndarray, size: np.ndarray, distance: int) -> np.ndarray:
    """Whether a run of ``own`` holds a pair within ``distance``, of runs of the sizes ``size`` up to FEW: all runs are tried at once."""
    run, found = np.repeat(np.arange(len(size)), size), np.zeros(len(size), bool)
    i = np.flatnonzero((size[run] > 2) & (size[run] <= FEW))
    for lag in range(1, FEW):
        i = i[i + lag < len(own)]
        i = i[(run[i] == run[i + lag]) & ~found[run[i]]]
        if not len(i):
            break
        found[run[i[np.bitwise_count(own[i] ^ own[i + lag]) <= distance]]] = True
    return found


def links(fps: DataFrame, distance: int = 3, blocks: int = 6, chunk: int = CHUNK) -> DataFrame:
    """(a, b) with a < b: links between the different fingerprints ``fp`` of ``fps``, forests by key.

    A key is a choice of ``blocks - distance`` blocks and their bits. Keyed fingerprints go, packed, to buckets by the hash of the key; a
    bucket sorts them by key and compares those of one key. Members of keys with more than ``chunk`` are sent on.
    """
    keys = Keys(chosen_masks((1 << 64) - 1, blocks, distance))
    buckets = max(1, -(-fps.count() * len(keys.masks) // BUCKET_KEYS))
    hot = _hot_keys(fps, keys, buckets) if buckets > 1 else np.empty(0, np.uint64)  # one bucket holds no more than its share

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def deal_out(fp: np.ndarray) -> pa.RecordBatch:
            table, row, key = keys.of(fp)
            to = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            if len(hot):
                to[np.isin(key, hot)] = -1
            by = np.argsort(to, kind="stable")
            to, table, row = to[by], table[by].astype(np.uint8), row[by]
            at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            payload = [table[i:j].tobytes() + fp[row[i:j]].tobytes() for i, j in zip(at, np.append(at[1:], len(to)), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(to[at], pa.int32()), pa.array(payload, pa.binary())], names=["bucket", "keyed"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch["fp"].to_numpy().view(np.uint64))
            if sum(map(len, held)) >= KEYED_ROWS:
                yield deal_out(np.concatenate(held))
                held.clear()
        if sum(map(len, held)):
            yield deal_out(np.concatenate(held))

    def unpacked(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.frombuffer(p, np.uint8, len(p) // 9), np.frombuffer(p, np.uint64, len(p) // 9, len(p) // 9)) for p in payloads]
        return np.concatenate([t for t, _ in parts]), np.concatenate([f for _, f in parts])

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        table, fp = unpacked(rows["keyed"].to_pylist())
        kind, a, b = [np.empty(0, np.int32)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        order = np.argsort(table, kind="stable")
        edge = np.searchsorted(table[order], np.arange(len(keys.masks) + 1))
        for t, m in enumerate(keys.masks):
            own = fp[order[edge[t] : edge[t + 1]]]
            own = own[np.argsort(own & m, kind="stable")]
            masked = own & m
            at = np.flatnonzero(np.concatenate([[True], masked[1:] != masked[:-1]])) if len(own) else np.empty(0, np.int64)
            size = np.diff(np.append(at, len(own)))
            two = at[size == 2]
            two = two[np.bitwise_count(own[two] ^ own[two + 1]) <= distance]
            u, v = [own[two]], [own[two + 1]]
            tried = (size > 2) & (size <= chunk) & ((size > FEW) | _with_links(own, size, distance))
            for i, n in zip(at[tried].tolist(), size[tried].tolist(), strict=True):
                pairs = forest(own[i : i + n], 0, distance)
                if pairs:
                    p = np.array(pairs, np.int64) + i
                    u.append(own[p[:, 0]])
                    v.append(own[p[:, 1]])
            u, v = np.concatenate(u), np.concatenate(v)
            kind.append(np.full(len(u), -1, np.int32))
            a.append(u)
            b.append(v)
            for i, n in zip(at[size > chunk].tolist(), size[size > chunk].tolist(), strict=True):
                kind.append(np.full(n, t, np.int32))
                a.append(np.zeros(n, np.uint64))
                b.append(own[i : i + n])
        return pa.table({"big": pa.array(np.concatenate(kind)), "a": pa.array(np.concatenate(a).view(np.int64)), "b": pa.array(np.concatenate(b).view(np.int64))})

    dealt = fps.select("fp").mapInArrow(deal, "bucket int, keyed binary")
    if len(hot):
        dealt = materialize(dealt, "dealt")
    found = materialize(dealt.where("bucket >= 0").groupBy("bucket").applyInArrow(compare, "big int, a long, b long"), "links")
    members = found.where("big >= 0").select(F.col("big").alias("t"), F.col("b").alias("fp"))
    if len(hot):

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    table, fp = unpacked(batch["keyed"].to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array(table.astype(np.int32)), pa.array(fp.view(np.int64))], names=["t", "fp"])

        members = members.union(dealt.where("bucket = -1").select("keyed").mapInArrow(spread, "t int, fp long"))
    small = found.where("big < 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return small.union(_in_cells(_keyed_again(members, keys, distance, blocks), distance, chunk)).distinct()


def _keyed_again(members: DataFrame, keys: Keys, distance: int, blocks: int) -> DataFrame:
    """(key, fp): members (t, fp) of large keys of table ``t``, keyed by their key and by blocks of the bits that it leaves open."""
    more = [Keys(chosen_masks(~int(m) & (1 << 64) - 1, blocks, distance)) for m in keys.masks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, fp = batch["t"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
            out = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
            for t in np.unique(table).tolist():
                own = fp[table == t]
                _, row, key = more[t].of(own)
                out.append((mix(key + mix((own[row] & keys.masks[t]) + np.uint64(t))), own[row]))
            key, own = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own)], names=["key", "fp"])

    return members.mapInArrow(run, "key long, fp long")


def _in_cells(members: DataFrame, distance: int, chunk: int) -> DataFrame:
    """Links among the members (key, fp) of each key: a key of more than a chunk is dealt into parts, and every two parts are a cell."""
    size = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / F.lit(chunk * 3 / 4)).cast("int").alias("parts"))
    # a large key's members learn its size in SALTS tasks
    size = size.withColumn("salt", F.explode(F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    large, rest = size.where("parts > 1"), size.where("parts = 1").drop("salt")
    dealt = salted.join(large, ["key", "salt"]).select("key", "fp", "parts").union(members.join(rest, "key").select("key", "fp", "parts"))
    # a member of part p meets every part q: in the cell (p, q) or (q, p)
    dealt = dealt.withColumn("p", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.groupBy("key", F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi")).agg(F.collect_list(F.struct((F.col("p") == F.greatest("p", "q")).alias("right"), "fp")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["m"]
            at, flat = lists.offsets.to_numpy(), lists.values
            fp = flat.field("fp").to_numpy().view(np.uint64)
            right = flat.field("right").to_numpy(zero_copy_only=False)
            same = batch["lo"].to_numpy() == batch["hi"].to_numpy()
            a, b = [], []
            for k in range(len(batch)):
                x, r = fp[at[k] : at[k + 1]], right[at[k] : at[k + 1]]
                if not same[k]:
                    x = np.concatenate([x[~r], x[r]])
                for i, j in forest(x, 0 if same[k] else int((~r).sum()), distance):
                    u, v = x[i : i + 1].view(np.int64)[0], x[j : j + 1].view(np.int64)[0]
                    a.append(min(u, v))
                    b.append(max(u, v))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cells.select("lo", "hi", "m").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node that can be reached.

    Large-star and small-star steps until nothing changes; every step is an aggregation and a join, a table in the scratch
    folder, and no neighbour list is gathered. The number of steps grows with the logarithm of the longest path.
    """
    edges = materialize(edges.select("a", "b").where("a <> b"), "edges")
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = materialize(large.distinct(), "large")
        # small star: every neighbour not larger than u, and u itself, hangs on the smallest of them
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(F.explode(F.array("x", "y")).alias("n"), "m").where("n <> m").distinct()
        after = materialize(small.select(F.col("m").alias("a"), F.col("n").alias("b")), "small")
        digest = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        before = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(*digest).first()
        if tuple(before) == tuple(after.agg(*digest).first()):
            return after.select(F.col("b").alias("node"), F.col("a").alias("root"))
        edges = after


def groups(rows: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """``rows`` (doc_id, fp) with component_id, the smallest doc_id that can be reached through links."""
    each = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    roots = components(links(each.select("fp"), distance, blocks))
    roots = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    named = each.join(roots, each["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    per_fp = named.join(smallest, "root").select("fp", "component_id")
    return rows.join(per_fp, "fp").select("doc_id", "fp", "component_id")


#: For near_duplicates: shingle length, similarity; weighted fingerprints of each text and shingles of full weight in each.
SHINGLE, SIMILARITY, FAMILIES, HEAVIEST = 5, 0.8, 40, 3
#: Bits in which linked fingerprints differ at most, and the blocks that they are cut into.
DISTANCE, BLOCKS = 3, 5
#: So many of the smallest shingle hashes go to the first comparison, and a pair goes on if the smaller one shares this part of them.
FIRST, FIRST_SHARE = 32, 0.4
#: Members and shingles of one part of a cell; bytes that one call compares.
CELL, CELL_SHINGLES, CELL_BYTES = 1024, 1 << 20, 16 << 20

#: A factor of each family for the weights of shingles, and one for their bits.
_WEIGHT, _BITS = (mix(np.arange(1, 2 * FAMILIES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)).reshape(2, FAMILIES, 1)
#: Shingles that are weighed at once; a full weight is so many powers of two, so sums of weights are exact in any order.
WEIGHED, FULL = 128, 44


def shingle_hashes(text: str | None) -> np.ndarray:
    """The different XXH64 of a text's five-word shingles, in order; a shorter text is one shingle, one without words has none."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    n = max(1, len(parts) - SHINGLE + 1)
    stops = (ends[SHINGLE - 1 :] - 1).tolist() if len(parts) >= SHINGLE else [len(joined)]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    return np.unique(np.array([digest(view[a:b]) for a, b in zip([0, *ends[: n - 1].tolist()], stops, strict=True)], "<u8"))


def weighted_fingerprints(h: np.ndarray) -> np.ndarray:
    """``FAMILIES`` SimHash fingerprints of a text with the shingle hashes ``h``: the majority bits of all shingles, by weight.

    A family ranks the shingles by a hash of its own. The ``HEAVIEST`` first weigh the same, and the weight of the others falls with the
    fourth power of their hash; so alike texts differ in few bits of a family whose heavy shingles both have.
    """
    if not len(h):
        return np.zeros(FAMILIES, np.uint64)

    def place(at: int) -> np.ndarray:
        return (mix(_WEIGHT * h[at : at + WEIGHED]) >> np.uint64(11)).astype(np.float64) + 1

    first = np.full((FAMILIES, HEAVIEST), np.inf)
    for at in range(0, len(h), WEIGHED):
        first = np.partition(np.concatenate([first, place(at)], axis=1), HEAVIEST - 1, axis=1)[:, :HEAVIEST]
    last = np.sort(first, axis=1)[:, min(HEAVIEST, len(h)) - 1, None]
    ones, total = np.zeros((FAMILIES, 64)), np.zeros((FAMILIES, 1))
    for at in range(0, len(h), WEIGHED):
        w = np.minimum(1, last / place(at))
        w *= w
        w = np.rint(w * w * (1 << FULL))
        bits = np.unpackbits(mix(_BITS * h[at : at + WEIGHED]).astype("<u8").view(np.uint8).reshape(FAMILIES, -1, 8), axis=2, bitorder="little")
        ones += np.matmul(w[:, None, :], bits.astype(np.float64))[:, 0]
        total += w.sum(axis=1, keepdims=True)
    return np.packbits(2 * ones > total, axis=1, bitorder="little").view("<u8").ravel()


def profile(text: str | None) -> tuple[list[int], bytes, int, bytes]:
    """The different SimHash fingerprints, the ``FIRST`` smallest 32-bit hashes of the shingles, and how many shingles there are and all their 40-bit hashes, packed.

    The fingerprints are that of ``op2_simhash`` and ``FAMILIES`` weighted ones. Texts without words have zero only.
    """
    h = shingle_hashes(text)
    fps = np.unique(np.append(weighted_fingerprints(h), np.uint64(fingerprint(text)))).view(np.int64).tolist()
    sketch = np.unique((h >> np.uint64(32)).astype("<u4"))[:FIRST].tobytes()
    own = np.unique(h >> np.uint64(24))
    return fps, sketch, len(own), pack_sorted(own) if len(own) else b""


def spanning(sets: list[np.ndarray], split: int, alike) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that are ``alike`` (shared, sizes, size): of all pairs if ``split`` is 0, else of those across ``split``.

    Only pairs that the forest joins already are left out, so what is connected by alike pairs stays connected.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    if n == 2:
        shared = np.array([len(np.intersect1d(*sets, assume_unique=True))])
        return [(0, 1)] if alike(shared, sizes[1:], sizes[0])[0] else []
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(sizes)])
    marked, group, out = np.zeros(len(names), bool), np.arange(n), []
    for i in range(split or n - 1):
        js = np.arange(split or i + 1, n)
        js = js[group[js] != group[i]]
        if not len(js):
            continue
        own = ids[at[i] : at[i + 1]]
        marked[own] = True
        heads = np.sort(js[np.unique(group[js], return_index=True)[1]])  # one of each group first: most others needn't be tried then
        for tried in (heads, js) if 2 * len(heads) < len(js) else (js,):
            tried = tried[group[tried] != group[i]]
            if len(tried) <= 8:
                shared = np.array([np.count_nonzero(marked[ids[at[j] : at[j + 1]]]) for j in tried], np.int64)
            else:
                total = np.concatenate([[0], np.cumsum(marked[ids[at[tried[0]] :]])])
                shared = total[at[tried + 1] - at[tried[0]]] - total[at[tried] - at[tried[0]]]
            for j in tried[alike(shared, sizes[tried], sizes[i])].tolist():
                if group[j] != group[i]:
                    out.append((i, j))
                    group[group == group[j]] = group[i]
        marked[own] = False
    return out


def linked(members: DataFrame, texts: DataFrame, decode, alike) -> DataFrame:
    """(a, b): spanning forests of the alike pairs among the members (key, t1) of each key; ``texts`` has t1, size and data.

    Keys of many members or shingles are dealt into parts, and every two parts are a cell; cells are compared many in one call.
    """
    n, shingles = F.count("*"), F.sum(F.col("size").cast("long"))
    counts = members.groupBy("key").agg(n.alias("n")).where("n > 1").select("key")
    members = members.join(counts, "key").join(texts, "t1")
    members = materialize(members.select("key", "t1", "size", "data"), "members")
    sizes = members.groupBy("key").agg(F.ceil(F.greatest(n / F.lit(CELL), shingles / F.lit(CELL_SHINGLES))).cast("int").alias("parts")).where("parts > 1")
    dealt = members.join(sizes, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a member of part p meets every part q: in the cell (p, q) or (q, p)
    dealt = dealt.withColumn("p", F.pmod(F.xxhash64("t1"), F.col("parts")).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    total = members.agg(F.sum(F.octet_length("data") + 16)).first()[0] or 0
    buckets = max(1, -(-total // CELL_BYTES))
    cell = F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q"))
    dealt = dealt.select(F.pmod(cell, F.lit(buckets)).alias("bucket"), cell.alias("cell"), (F.col("parts") > 1).alias("big"), (F.col("p") <= F.col("q")).alias("left"), (F.col("p") == F.col("q")).alias("same"), "t1", "size", "data")
    dealt = dealt.withColumn("bucket", F.when(F.col("big"), F.col("cell")).otherwise(F.col("bucket")))

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        cells, t1, left, same = rows["cell"].to_numpy(), rows["t1"].to_numpy(), rows["left"].to_numpy(), rows["same"].to_numpy()
        order = np.lexsort((t1, ~left, cells))
        edge = np.flatnonzero(np.concatenate([[True], np.diff(cells[order]) != 0, [True]]))
        size, data, a, b = rows["size"].to_numpy(), rows["data"].combine_chunks(), [], []
        for i, j in zip(edge, edge[1:], strict=False):
            at = order[i:j]
            split = 0 if same[at].all() else int(left[at].sum())
            if len(at) > 1 and split < len(at):
                for u, v in spanning([decode(data[k].as_py(), int(size[k])) for k in at.tolist()], split, alike):
                    a.append(min(t1[at[u]], t1[at[v]]))
                    b.append(max(t1[at[u]], t1[at[v]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.drop("big").groupBy("bucket").applyInArrow(compare, "a long, b long").distinct()


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, fps, sketch, size, shingles): the profile of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sketch, size, own = zip(*(profile(x.as_py()) for x in batch["text"]), strict=True) if len(batch) else ((), (), (), ())
            columns = [pa.array(fps, pa.list_(pa.int64())), pa.array(sketch, pa.binary()), pa.array(size, pa.int32()), pa.array(own, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["t1"], batch["t2"], *columns], names=["doc_id", "t1", "t2", "fps", "sketch", "size", "shingles"])

    return keyed(docs).select("doc_id", "t1", "t2", "text").mapInArrow(run, "doc_id long, t1 long, t2 long, fps array<long>, sketch binary, size int, shingles binary")


def by_links(texts: DataFrame) -> DataFrame:
    """(key, t1): the texts (t1, fps) under every group of fingerprints that links within ``DISTANCE`` bits join.

    Fingerprints of all families lie in one table: two that aren't of one family are as near as that by chance once in 4 * 10^14.
    """
    own = texts.select("t1", F.explode("fps").alias("fp"))
    fps = materialize(own.select("fp").distinct(), "fps")
    roots = components(links(fps, DISTANCE, BLOCKS))
    return own.join(roots, own["fp"] == roots["node"], "left").select(F.coalesce("root", "fp").alias("key"), "t1")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(least, t1, t2): of every group the smallest doc_id and the keys of its text; that row stays.

    Texts are grouped if their sets of five-word shingles are ``similarity`` alike or more. Candidates have fingerprints within ``DISTANCE``
    bits, searched by blocks and verified as in ``op2_simhash``: its own fingerprint or one of ``FAMILIES`` weighted ones, whatever was changed and
    wherever. All pairs under a group of linked fingerprints whose sketches aren't far apart make groups of candidates; all pairs of such a group are
    then compared by their whole sets.
    """
    # the rows of one text are one node, named by its key
    texts = materialize(profiles(docs).groupBy("t1", "t2").agg(F.min("doc_id").alias("least"), *(F.min(c).alias(c) for c in ("fps", "sketch", "size", "shingles"))), "texts")
    keys = by_links(texts)
    first = texts.select("t1", F.least("size", F.lit(FIRST)).alias("size"), F.col("sketch").alias("data"))
    near = linked(keys, first, lambda x, n: np.frombuffer(x, "<u4"), lambda shared, sizes, size: shared >= FIRST_SHARE * np.minimum(sizes, size))
    candidates = components(near)
    candidates = candidates.union(candidates.select(F.col("root").alias("node"), "root").distinct()).select(F.col("root").alias("key"), F.col("node").alias("t1"))
    whole = texts.select("t1", "size", F.col("shingles").alias("data"))

    def alike(shared: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
        union = sizes + size - shared
        return np.where(union > 0, shared / np.maximum(union, 1), 1.0) >= similarity

    roots = components(linked(candidates, whole, lambda x, n: unpack_sorted(x, n, np.uint64), alike))
    roots = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    named = texts.join(roots, texts["t1"] == roots["node"], "left").select("t1", "t2", "least", F.coalesce("root", "t1").alias("root"))
    # of a group stays the text with the smallest doc_id; a group without ids keeps its smallest text
    best = named.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "t1", "t2")).alias("best")).select("best.least", "best.t1", "best.t2")
    return best


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes of the text that name it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near duplicates, with all columns: that with the smallest doc_id.

    Null, empty and wordless texts are one group. A group without doc_ids keeps its smallest text's row; a row that stands more than once
    stays once (rows that differ in other columns only: any one of them). Columns of ``docs`` keep their names and values whatever they are called.
    """
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1 << 63))
    id_, t1, t2 = spare(docs, "id", "t1", "t2")
    keep = near_duplicates(docs, similarity).select(number("least").alias(id_), F.col("t1").alias(t1), F.col("t2").alias(t2))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.withColumns({t1: F.xxhash64(text), t2: F.xxhash64(F.lit(1), text), id_: number("doc_id")})
    met = own.join(keep, [id_, t1, t2], "left_semi")
    # a row that stands twice stays once; such rows are neighbours already, dealt and sorted by the join
    return met.dropDuplicates([id_, t1, t2]).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3), "fingerprints")
    return groups(rows, 3).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Operator 10: n-gram Jaccard self-join with Bayesian candidate pruning.

A document is its set of 5-word shingles. Distinct texts get MinHash values
(one per hash function, 16 bits kept); texts that agree on all values of a
band are candidates. Buckets are joined only by star edges to their smallest
member, so no bucket is ever expanded into pairs; connected candidates form a
cluster, large clusters are cut into blocks, and each pair of blocks is one
piece of work. There MinHash values are compared a few at a time: a pair is
dropped as soon as the posterior probability of similarity >= threshold,
given the agreements so far, falls below ``TOLERANCE``. Survivors are
verified exactly on their shingle sets. Each piece returns per text its
number of links and spanning edges, never its pairs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import components, staged, text_id, whole_groups

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5          # a pair at the threshold is missed with probability (1 - 0.8^5)^32 = 3e-6
HASHES = BANDS * ROWS
STEP = 16                    # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-9             # all looks together drop a pair at the threshold with probability 1.1e-8
BLOCK_ROWS = 512             # texts per block of a cluster
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Words as in the contamination rule: A-Z lowered, ASCII signs and white space part words."""
    return _WORD.findall(text.translate(_UPPER) if not text.isascii() else text.lower())


class Shingles:
    """Hashes of word shingles; word hashes are kept in a bounded table."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, texts: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of all texts in one array, and offsets. A text of fewer than k
        words, but not none, has one shingle: all its words."""
        words: list[str] = []
        ends = [0]
        for t in texts:
            words += words_of(t)
            ends.append(len(words))
        off = np.array(ends, dtype=np.int64)
        if len(self.known) > 500_000:
            self.known.clear()
        known, h = self.known, np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            x = known.get(w)
            if x is None:
                x = known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            h[i] = x
        n = np.diff(off)
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        out = np.concatenate([[0], np.cumsum(count)])
        if not len(h):
            return h, out
        p = np.concatenate([h, np.zeros(k, np.uint64)])
        acc = np.zeros(len(h), np.uint64)
        for j in range(k):
            acc = (acc ^ p[j:j + len(h)]) * _MIX
            acc ^= acc >> np.uint64(29)
        starts = np.repeat(off[:-1], count) + np.arange(int(out[-1])) - np.repeat(out[:-1], count)
        s = acc[starts]
        for i in np.flatnonzero((n > 0) & (n < k)):  # short texts: their words alone, with their number
            x = int(n[i])
            for v in h[off[i]:off[i + 1]]:
                x = (x ^ int(v)) * int(_MIX) & 0xFFFFFFFFFFFFFFFF
                x ^= x >> 29
            s[out[i]] = x
        return s, out


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240)
    odd = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def minhash(s: np.ndarray, off: np.ndarray) -> np.ndarray:
    """HASHES 32-bit minima per text (texts without shingles must be left out)."""
    a, b = _multipliers()
    out = np.empty((len(off) - 1, HASHES), np.uint32)
    for lo in range(0, len(off) - 1, 64):  # small parts stay in cache
        hi = min(lo + 64, len(off) - 1)
        x, o = (s[off[lo]:off[hi]] >> np.uint64(32)).astype(np.uint32), off[lo:hi] - off[lo]
        for i in range(HASHES):
            out[lo:hi, i] = np.minimum.reduceat(x * a[i] + b[i], o)
    return out


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For STEP, 2 STEP, ... compared values: the fewest agreements at which the posterior
    P(J >= threshold | agreements) under a uniform prior still reaches the tolerance."""
    grid = (np.arange(2000) + 0.5) / 2000
    high = grid >= threshold
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[high].sum() / p.sum() >= tolerance:
                out.append(m)
                break
    return tuple(out)


def _survivors(a: np.ndarray, b: np.ndarray, same: bool, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of two MinHash matrices that the posterior doesn't drop."""
    agree = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        agree += a[:, k, None] == b[None, :, k]
    ok = agree >= least[0]
    if same:
        ok &= np.tri(len(a), k=-1, dtype=bool).T
    i, j = np.nonzero(ok)
    m = agree[i, j].astype(np.int64)
    for step in range(1, len(least)):
        if not len(i):
            break
        k = slice(step * STEP, (step + 1) * STEP)
        nm = np.empty_like(m)
        for lo in range(0, len(i), 200_000):
            q = slice(lo, lo + 200_000)
            nm[q] = m[q] + (a[i[q], k] == b[j[q], k]).sum(1)
        keep = nm >= least[step]
        i, j, m = i[keep], j[keep], nm[keep]
    return i, j


def _verified(sets: list[np.ndarray], other: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have exact Jaccard >= threshold; rows of ``other`` are taken in turn
    and matched through one table of all shingles of ``sets``."""
    ok = np.zeros(len(i), bool)
    used = np.unique(i)
    if not len(used):
        return ok
    flat = np.concatenate([sets[x] for x in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[x]) for x in used])
    o = np.argsort(flat, kind="stable")
    flat, owner = flat[o], owner[o]
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(j, kind="stable")
    cut = np.flatnonzero(np.diff(j[order], prepend=-1))
    for a, z in zip(cut, [*cut[1:], len(order)], strict=True):
        rows = order[a:z]
        mine = other[j[rows[0]]]
        lo, hi = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
        n = hi - lo
        at = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        inter = np.bincount(owner[at], minlength=len(used))[np.searchsorted(used, i[rows])]
        union = sizes[i[rows]] + len(mine) - inter
        ok[rows] = inter >= np.array([math.ceil(threshold * u - 1e-9) for u in union.tolist()])
    return ok


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest connected row of every row, by pointer jumping over the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _pick(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(-(1 << 63)))


def _keyed(docs: DataFrame, *cols: str) -> DataFrame:
    """``tid, id`` (doc_id) and ``cols`` of every row."""
    return docs.select(text_id().alias("tid"), F.col("doc_id").cast("long").alias("id"), *cols)


def signatures(docs: DataFrame) -> DataFrame:
    """Per distinct text: ``tid, copies, min_id, sig`` (HASHES 16-bit values as bytes; null
    without words) and ``bands`` (64-bit keys). Copies are folded by signature rows, not texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                s, off = shingles.of(part.column(2).to_pylist())
                some = np.flatnonzero(np.diff(off))
                sig: list[bytes | None] = [None] * part.num_rows
                bands: list[np.ndarray | None] = [None] * part.num_rows
                if len(some):
                    m = minhash(s, np.append(off[some], off[-1]))
                    keys = np.zeros((len(m), BANDS), np.uint64)
                    for r in range(ROWS):
                        keys = (keys ^ m[:, r::ROWS].astype(np.uint64)) * _MIX
                        keys ^= keys >> np.uint64(29)
                    keys = ((keys ^ np.arange(BANDS, dtype=np.uint64)) * _MIX).view(np.int64)
                    for k, x, y in zip(some.tolist(), (m & np.uint32(0xFFFF)).astype(np.uint16), keys, strict=True):
                        sig[k], bands[k] = x.tobytes(), y
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                                 ["tid", "id", "sig", "bands"])

    rows = _keyed(docs, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "tid binary, id long, sig binary, bands array<long>")
    return rows.groupBy("tid").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("min_id"),
                                   F.first("sig").alias("sig"), F.first("bands").alias("bands"))


def candidate_clusters(sigs: DataFrame) -> DataFrame:
    """``node, cluster``: 64-bit text hashes that share a band bucket, directly or through
    others. (Two texts of equal hash would only share a cluster.)"""
    rows = sigs.select(F.xxhash64("tid").alias("node"), F.explode("bands").alias("band"))
    low = rows.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    star = rows.join(low.drop("high"), "band").filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    return components(star).select("node", F.col("root").alias("cluster"))


def links(docs: DataFrame, sigs: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(tid, n_links)`` of distinct texts, counting a link once per copy of the partner,
    and ``(a, b)`` edges that span each class of linked texts. ``sigs`` as from ``signatures``."""
    clusters = staged(candidate_clusters(sigs), "join-clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    at = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    named = (sigs.select("tid", "sig", "copies", _pick(F.col("min_id")).alias("pick"), F.xxhash64("tid").alias("node"))
             .join(at, "node"))
    # one row per distinct text: that of its smallest doc_id, so copies don't pile up on one key
    held = _keyed(docs, "text").withColumn("pick", _pick(F.col("id"))).drop("id").join(named, ["tid", "pick"])
    # one piece of work per unordered pair of blocks; a cluster of one block is one piece
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pieces = held.select("cluster", "tid", "sig", "text", "copies", "block", other).select(
        F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("piece"),
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "cluster", "tid", "sig", "text", "copies")
    least = least_matches(threshold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for t in whole_groups(batches, "piece", 1):
            cols = {c: t.column(c) for c in ("block", "lo", "hi", "copies")}
            piece = t.column("piece").to_numpy()
            cl, tids = t.column("cluster").to_pylist(), t.column("tid").to_pylist()
            cut = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(piece)]
            block, lo, hi, copies = (cols[c].to_numpy() for c in ("block", "lo", "hi", "copies"))
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
            out: tuple[list, list, list] = ([], [], [])
            for a, z in zip(cut, cut[1:], strict=False):
                # repeated rows (equal id and text) are one text
                first: dict[bytes, int] = {}
                for r in range(a, z):
                    first.setdefault(tids[r], r)
                rows = list(first.values())
                for key in dict.fromkeys((cl[r], lo[r], hi[r]) for r in rows):  # one, but for a hash tie
                    own = np.array([r for r in rows if (cl[r], lo[r], hi[r]) == key])
                    same = key[1] == key[2]
                    x, y = (own, own) if same else (own[block[own] == key[1]], own[block[own] == key[2]])
                    i, j = _survivors(sig[x], sig[y], same, least)
                    if not len(i):
                        continue
                    need = np.unique(np.concatenate([x[i], y[j]]))
                    s, off = shingles.of(t.column("text").take(pa.array(need)).to_pylist())
                    sets = {int(r): np.unique(s[off[k]:off[k + 1]]) for k, r in enumerate(need)}
                    none = np.zeros(0, np.uint64)
                    ok = _verified([sets.get(int(r), none) for r in x], [sets.get(int(r), none) for r in y], i, j, threshold)
                    i, j = x[i[ok]] - a, y[j[ok]] - a
                    n = np.bincount(i, copies[a + j], z - a) + np.bincount(j, copies[a + i], z - a)
                    root = _forest(z - a, i, j)
                    linked = np.flatnonzero(n)
                    out[0].append(a + linked)
                    out[1].append(a + root[linked])
                    out[2].append(n[linked].astype(np.int64))
            if out[0]:
                tid = t.column("tid").combine_chunks()
                yield pa.RecordBatch.from_arrays([tid.take(pa.array(np.concatenate(out[0]))), tid.take(pa.array(np.concatenate(out[1]))),
                                                  pa.array(np.concatenate(out[2]))], ["a", "b", "n"])

    found = (pieces.repartition("piece").sortWithinPartitions("piece")
             .mapInArrow(work, "a binary, b binary, n long"))
    found = staged(found, "join-links")
    return (found.groupBy(F.col("a").alias("tid")).agg(F.sum("n").alias("n_links")),
            found.filter("a <> b").select("a", "b").distinct())


def similar(docs: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per distinct text: ``tid, copies, min_id``, ``class`` (the tid of the class's
    representative: smallest doc_id, ties to the smaller tid), ``class_id`` (its doc_id) and
    ``n_links``: other rows of ``docs`` at Jaccard >= threshold, copies included.

    Texts of fewer than five words are one shingle of all their words; texts
    without words link to nothing but their exact copies. An empty table gives no rows.
    """
    sigs = staged(signatures(docs), "join-signatures")
    counts, edges = links(docs, sigs, threshold, block_rows)
    roots = staged(components(edges), "join-classes")
    texts = sigs.select("tid", "copies", "min_id")
    low = F.struct(F.col("min_id").isNull().alias("z"), "min_id", F.col("tid").alias("tid"))
    heads = (texts.join(roots, texts["tid"] == roots["node"]).groupBy("root").agg(F.min(low).alias("h")))
    member = roots.join(heads, "root").select(F.col("node").alias("tid"), F.col("h.tid").alias("class"), F.col("h.min_id").alias("class_id"))
    return (texts.join(member.join(counts, "tid", "left"), "tid", "left")
            .withColumn("class_id", F.when(F.col("class").isNull(), F.col("min_id")).otherwise(F.col("class_id")))
            .withColumn("class", F.coalesce("class", "tid"))
            .withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1))


def join_classes(docs: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, class_id, n_links`` (see ``similar``). Null text is empty;
    rows stay one for one, repeated rows being copies; other columns are ignored."""
    found = similar(docs, threshold, block_rows).select("tid", "class_id", "n_links")
    return _keyed(docs).withColumnRenamed("id", "doc_id").join(found, "tid").select("doc_id", "class_id", "n_links")


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One whole row of ``docs`` per class: that of the smallest doc_id (any one of rows
    that repeat it and its text), all columns as they are."""
    heads = similar(docs, threshold).filter("tid = class").select(F.col("tid").alias("__tid"), _pick(F.col("min_id")).alias("__pick"))
    rows = docs.withColumn("__tid", text_id()).withColumn("__pick", _pick(F.col("doc_id").cast("long")))
    return rows.join(heads, ["__tid", "__pick"]).dropDuplicates(["__tid", "__pick"]).select(*docs.columns)


def exact_join(texts: dict[int, str], threshold: float = THRESHOLD) -> dict[int, tuple[int, int]]:
    """Brute force for tests: id -> (class id, number of links)."""
    sh, ids = Shingles(), sorted(texts)
    sets = {i: set(sh.of([texts[i]])[0].tolist()) for i in ids}
    root, n = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for p, i in enumerate(ids):
        for j in ids[:p]:
            u = len(sets[i] | sets[j])
            if texts[i] == texts[j] or u and len(sets[i] & sets[j]) >= threshold * u - 1e-9:
                n[i], n[j] = n[i] + 1, n[j] + 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), n[i]) for i in ids}

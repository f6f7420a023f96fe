"""Operator 9: repeated byte passages through a distributed enhanced suffix array.

A passage of ``length`` bytes that starts anywhere twice is a repeat. Suffix
starts are sampled so that no repeat can be missed: of every ``length``
consecutive bytes, the ``gram``-byte string with the smallest hash is an
anchor, which depends on those bytes alone, so equal passages hold equal
anchors at equal places. Suffixes that start at equal anchors (and the bytes
before them) meet; where an anchor is unique nothing moves.

For the suffixes of equal anchors an enhanced suffix array is built (sorted
order and common-prefix lengths). A stack scan yields its common-prefix
intervals: each is a string with all its occurrences. Left extensions are
tested inside each interval: occurrences whose left contexts agree on l
bytes (in left-sorted order, so all of them meet, not only neighbours of the
suffix array) share a repeat of l + depth bytes, which is left-maximal where
the contexts part. Repeats of at least ``length`` bytes are put out with all
their occurrences.

Anchors with more occurrences than one group should hold are worked by their
windows instead: each occurrence gives the fingerprint of every ``length``-byte
window of which it is the anchor, and a count by fingerprint marks the repeats.

Equal texts are folded first (a text of at least ``length`` bytes that occurs
twice is a repeat as a whole); all offsets are bytes of UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import distinct_texts, small_parts, staged, text_buffer, text_id, whole_groups

LENGTH = 200
GRAM = 40
GROUP_ROWS = 20_000      # occurrences of an anchor up to which they are sorted in one task
_SEGMENT = 1 << 20       # window starts worked at a time
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ELEMENTS = 100_000     # interval members tested at a time


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        p = np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        q = np.cumprod(np.full(n, inv, np.uint64), dtype=np.uint64)
    return p, q


class _Hasher:
    def __init__(self) -> None:
        self.p, self.q = _powers(1024)

    def grams(self, b: np.ndarray, k: int) -> np.ndarray:
        """Mixed polynomial hash of every k-byte string of b."""
        if len(b) > len(self.p):
            self.p, self.q = _powers(len(b) + 1024)
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.p[:len(b)], out=s[1:])
        h = (s[k:] - s[:-k]) * self.q[:len(s) - k]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x7FB5D329728EA185)
        h ^= h >> np.uint64(29)
        return h


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, in linear time (block prefix and suffix minima)."""
    n = len(x)
    pad = np.concatenate([x, np.full(-n % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    pre = np.minimum.accumulate(pad, axis=1).ravel()
    suf = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n - w + 1], pre[w - 1:n])


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM,
            hasher: _Hasher | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts ``buf[off[i]:off[i+1]]``: buffer position, gram hash, and the first
    and last window start of which it is the anchor."""
    hasher = hasher or _Hasher()
    w = length - gram + 1
    mark = np.zeros(len(buf) + 1, np.int8)
    whole = np.flatnonzero(np.diff(off) >= length)
    mark[off[whole]] += 1
    mark[off[whole + 1] - length + 1] -= 1
    ok = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)  # window starts inside one text
    got: list[tuple[np.ndarray, ...]] = []
    lo, hi = int(off[0]), int(off[-1])
    for a in range(lo, hi - length + 1, _SEGMENT):
        n = min(_SEGMENT, hi - length + 1 - a)
        valid = np.flatnonzero(ok[a:a + n])
        if not len(valid):
            continue
        h = hasher.grams(buf[a:a + n + length - 1], gram)
        key = (h & ~np.uint64(0x1FFFFF)) | np.arange(len(h), dtype=np.uint64)
        least = (_sliding_min(key, w)[valid] & np.uint64(0x1FFFFF)).astype(np.int64)
        # runs of one anchor; a break in the valid starts (next text) also changes the anchor
        cut = np.flatnonzero(np.diff(least, prepend=-1))
        got.append((least[cut] + a, h[least[cut]], valid[cut] + a, valid[np.append(cut[1:], len(valid)) - 1] + a))
    if not got:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, np.uint64), z, z
    return tuple(np.concatenate(c) for c in zip(*got, strict=True))


def _rmq(x: np.ndarray) -> list[np.ndarray]:
    table, k = [x], 1
    while 2 * k <= len(x):
        table.append(np.minimum(table[-1][:-k], table[-1][k:]))
        k *= 2
    return table


def _range_min(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of x[lo:hi] for arrays of non-empty ranges."""
    j = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), dtype=table[0].dtype)
    for level in np.unique(j):
        m = j == level
        t = table[level]
        out[m] = np.minimum(t[lo[m]], t[hi[m] - (1 << level)])
    return out


def _sorted_lcp(m: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of zero-padded byte rows of the given sizes, and common-prefix lengths of
    neighbours. Among equal rows the shorter come first, so padding parts no equal rows."""
    key = np.ascontiguousarray(np.concatenate([m, size.astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1))
    order = np.argsort(key.view(f"S{key.shape[1]}").ravel(), kind="stable")
    r = m[order]
    same = r[1:] == r[:-1]
    lcp = np.where(same.all(1), m.shape[1], same.argmin(1)).astype(np.int64)
    return order, np.minimum(lcp, np.minimum(size[order][1:], size[order][:-1]))


def intervals(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, depth) of depth >= least by a stack scan;
    inner intervals come before those around them."""
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # (depth, first)
    values = lcp.tolist()
    values.append(0)
    for i, d in enumerate(values):
        first = i
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            out.append((first, i, depth))
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append((d, first))
    return out


def interval_members(group: np.ndarray, left: np.ndarray, llen: np.ndarray, right: np.ndarray, rlen: np.ndarray,
                     length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Members of all common-prefix intervals of suffixes of equal groups, some intervals at a time.

    ``right`` holds the bytes from each suffix's anchor on, ``left`` those
    before it in reverse, both zero-padded, with their lengths. Yields
    (row, depth, share, outer): members interval by interval, in left order;
    ``share[i]`` is one more than the left bytes that members i and i + 1 agree
    on, or 0 where the interval ends or the whole would be under ``length``;
    ``outer(first, last)`` gives the depth of the smallest interval that
    holds each range of members. An interval nests in at most ``length -
    gram`` others, so members are at most that many times the rows.
    """
    n = len(group)
    if n < 2:
        return
    gb = group.astype(">u8").view(np.uint8).reshape(n, 8)
    order, lcp = _sorted_lcp(np.concatenate([gb, right], axis=1), rlen + 8)
    lcp = np.maximum(lcp - 8, 0)
    lorder, llcp = _sorted_lcp(left, llen)
    lrank = np.empty(n, np.int64)
    lrank[lorder] = np.arange(n)
    ltable, rtable = _rmq(llcp), _rmq(lcp)
    tree = np.array(intervals(lcp, gram), dtype=np.int64).reshape(-1, 3)
    if not len(tree):
        return
    size = tree[:, 1] - tree[:, 0] + 1
    for chosen in np.split(np.arange(len(tree)), np.flatnonzero(np.diff(np.cumsum(size) // _ELEMENTS)) + 1):
        sz = size[chosen]
        node = np.repeat(chosen, sz)
        place = tree[node, 0] + np.arange(len(node)) - np.repeat(np.cumsum(sz) - sz, sz)
        place = place[np.lexsort((lrank[order[place]], node))]
        rank, depth = lrank[order[place]], tree[node, 2]
        share = np.zeros(len(place) - 1, np.int64)
        pair = np.flatnonzero(node[1:] == node[:-1])
        share[pair] = _range_min(ltable, rank[pair], rank[pair + 1])
        share[pair] = np.where(share[pair] + depth[pair] >= length, share[pair] + 1, 0)
        if not share.any():
            continue

        def outer(first: np.ndarray, last: np.ndarray, place: np.ndarray = place) -> np.ndarray:
            return _range_min(rtable, _range_min(_rmq(place), first, last + 1), -_range_min(_rmq(-place), first, last + 1))

        yield order[place], depth, share, outer


def repeats(*suffixes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """All maximal repeats among suffixes (see ``interval_members``) with all their occurrences:
    arrays (row, left bytes, right bytes, repeat number).

    A second stack scan, over the left order inside each interval, yields the
    groups that agree to the left and part one byte further (left-maximal);
    those that agree further to the right belong to an inner interval.
    """
    found, number = [], 0
    for row, depth, share, outer in interval_members(*suffixes, length=length, gram=gram):
        same = np.array(intervals(share, 1), dtype=np.int64).reshape(-1, 3)
        same = same[outer(same[:, 0], same[:, 1]) == depth[same[:, 0]]]
        sz = same[:, 1] - same[:, 0] + 1
        which = np.repeat(np.arange(len(same)), sz)
        at = same[which, 0] + np.arange(len(which)) - np.repeat(np.cumsum(sz) - sz, sz)
        found.append((row[at], same[which, 2] - 1, depth[at], number + which))
        number += len(same)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


def reach(*suffixes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix the longest left and right parts of the repeats it is an occurrence of (0, 0:
    none). All hold its anchor, so together they cover one span; the innermost left group of a
    member is the one it forms with a neighbour in left order."""
    n = len(suffixes[0])
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for row, depth, share, _ in interval_members(*suffixes, length=length, gram=gram):
        best = np.maximum(np.append(share, 0), np.append(0, share))
        hit = best > 0
        np.maximum.at(left, row[hit], best[hit] - 1)
        np.maximum.at(right, row[hit], depth[hit])
    return left, right


def _fingerprints(buf: np.ndarray, starts: np.ndarray, length: int) -> list[bytes]:
    data = buf.tobytes()
    return [hashlib.blake2b(data[s:s + length], digest_size=16).digest() for s in starts.tolist()]


def repeated_spans(rows: DataFrame, texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``tid, start, stop``: spans of distinct ``texts(tid, text)`` covered by repeats (they may
    overlap). ``rows(tid, text)`` are the same texts, each any number of times.

    Every byte of a ``length``-byte string that starts twice lies in a span, no other byte does.
    """
    if length <= gram:
        raise ValueError("repeats must be longer than the anchor gram")

    def emit(batches: Iterator[pa.RecordBatch], fold: bool) -> Iterator[pa.RecordBatch]:
        """Anchors of each text; with ``fold`` each hash once per text, with its number there."""
        hasher = _Hasher()
        for b in small_parts(batches, limit=8 << 20):
            buf, off = text_buffer(b.column(1))
            pos, h, _, _ = anchors(buf, off, length, gram, hasher)
            pos, first = np.unique(pos, return_index=True)
            h = h[first].view(np.int64)
            # texts without bytes share an offset: the last one there owns the position
            doc = np.searchsorted(off, pos, side="right") - 1
            if fold:
                o = np.lexsort((h, doc))
                cut = np.flatnonzero((np.diff(doc[o], prepend=-1) != 0) | (np.diff(h[o], prepend=0) != 0))
                n = np.diff(np.append(cut, len(o)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[o][cut])), pa.array(h[o][cut]),
                                                  pa.array(n.astype(np.int32))], ["tid", "h", "n"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(h),
                                                  pa.array((pos - off[doc]).astype(np.int32))], ["tid", "h", "pos"])

    # anchors that two different texts hold, or one text twice; copies count as one text
    seen = (rows.mapInArrow(partial(emit, fold=True), "tid binary, h long, n int")
            .select("h", "n", F.xxhash64("tid").alias("t")))
    counts = staged(seen.groupBy("h").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min("t").alias("low"), F.max("t").alias("high"))
                    .filter("most > 1 or low < high").select("h", "n"), "sa-anchors")
    found = texts.select("tid", "text").mapInArrow(partial(emit, fold=False), "tid binary, h long, pos int")
    here = (found.join(counts, "h").groupBy("tid")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "h", (F.col("n") > group_rows).alias("hot")))).alias("a"))
            .select("tid", "a.pos", "a.h", "a.hot"))
    held = texts.select("tid", "text").join(here, "tid")

    names = ["h", "tid", "pos", "left", "right", "fp"]
    schema = "h long, tid binary, pos int, left binary, right binary, fp binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for b in small_parts(batches, 1, 8 << 20):
            buf, off = text_buffer(b.column("text"))
            places = b.column("pos")
            n = np.diff(places.offsets.to_numpy())
            doc = np.repeat(np.arange(b.num_rows), n)
            pos = places.flatten().to_numpy().astype(np.int64) + off[doc]
            h = b.column("h").flatten()
            hot = b.column("hot").flatten().to_numpy(zero_copy_only=False)
            cold = np.flatnonzero(~hot)
            for a in range(0, len(cold), 8192):
                c = cold[a:a + 8192]
                # bytes of the text before and after, at most what a repeat can reach
                lo, hi = np.maximum(pos[c] - (length - gram), off[doc[c]]), np.minimum(pos[c] + length, off[doc[c] + 1])
                left = [buf[x:y].tobytes() for x, y in zip(lo, pos[c], strict=True)]
                right = [buf[x:y].tobytes() for x, y in zip(pos[c], hi, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [h.take(pa.array(c)), b.column("tid").take(pa.array(doc[c])), pa.array((pos[c] - off[doc[c]]).astype(np.int32)),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.nulls(len(c), pa.binary())], names)
            if not hot.any():
                continue
            at, _, first, last = anchors(buf, off, length, gram, hasher)
            use = np.isin(at, pos[hot])
            first, last = first[use], last[use]
            size = last - first + 1
            starts = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            owner = np.searchsorted(off, starts, side="right") - 1
            for a in range(0, len(starts), 8192):
                s, w = starts[a:a + 8192], owner[a:a + 8192]
                k = len(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(k, pa.int64()), b.column("tid").take(pa.array(w)), pa.array((s - off[w]).astype(np.int32)),
                     pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array(_fingerprints(buf, s, length), pa.binary())], names)

    places = held.mapInArrow(cut, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "h", 4_000):
            lb, lo = text_buffer(t.column("left"))
            rb, ro = text_buffer(t.column("right"))
            llen, rlen = np.diff(lo), np.diff(ro)
            n = t.num_rows
            left, right = np.zeros((n, length - gram), np.uint8), np.zeros((n, length), np.uint8)
            for i in range(n):
                left[i, :llen[i]] = lb[lo[i]:lo[i + 1]][::-1]
                right[i, :rlen[i]] = rb[ro[i]:ro[i + 1]]
            reach_l, reach_r = reach(t.column("h").to_numpy().view(np.uint64), left, llen, right, rlen, length=length, gram=gram)
            hit = np.flatnonzero(reach_r)
            pos = t.column("pos").to_numpy()[hit].astype(np.int64)
            yield pa.RecordBatch.from_arrays([t.column("tid").combine_chunks().take(pa.array(hit)), pa.array(pos - reach_l[hit]),
                                              pa.array(pos + reach_r[hit])], ["tid", "start", "stop"])

    places = staged(places, "sa-contexts") if _any_hot(counts, group_rows) else places
    cold = (places.filter("fp is null").select("h", "tid", "pos", "left", "right").repartition("h").sortWithinPartitions("h")
            .mapInArrow(scan, "tid binary, start long, stop long"))
    if not _any_hot(counts, group_rows):
        return cold
    windows = places.filter("fp is not null").select("fp", "tid", F.col("pos").cast("long").alias("start"))
    twice = windows.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp")
    hot = windows.join(twice, "fp").select("tid", "start", (F.col("start") + length).alias("stop"))
    return cold.unionByName(hot)


def _any_hot(counts: DataFrame, group_rows: int) -> bool:
    return bool(counts.filter(F.col("n") > group_rows).limit(1).count())


def _kept(batches: Iterator[pa.RecordBatch], length: int, digests: bool) -> Iterator[pa.RecordBatch]:
    """Per text: its removed runs merged and what stays."""
    for b in small_parts(batches, 1, 8 << 20):
        buf, off = text_buffer(b.column("text"))
        spans, copies = b.column("spans"), b.column("copies").to_numpy()
        so = spans.offsets.to_numpy() if len(spans) else np.zeros(1, np.int32)
        flat = spans.flatten()
        first, last = flat.field("start").to_numpy(zero_copy_only=False), flat.field("stop").to_numpy(zero_copy_only=False)
        valid = spans.is_valid().to_numpy(zero_copy_only=False)
        base = int(so[0])
        cols: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "runs": []}
        for i in range(b.num_rows):
            data = buf[off[i]:off[i + 1]]
            n = len(data)
            if copies[i] > 1 and n >= length:
                s, e = np.zeros(1, np.int64), np.array([n])
            elif valid[i]:
                s, e = first[so[i] - base:so[i + 1] - base].astype(np.int64), last[so[i] - base:so[i + 1] - base].astype(np.int64)
            else:
                s = e = np.zeros(0, np.int64)
            if len(s):
                o = np.argsort(s, kind="stable")
                s, reach = s[o], np.maximum.accumulate(e[o])
                new = np.append(True, s[1:] > reach[:-1])  # touching spans are one run
                s, e = s[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
            edges = [0, *np.stack([s, e], 1).ravel().tolist(), n]
            kept = b"".join(data[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2], strict=True))
            cols["n_bytes"].append(n)
            cols["n_removed"].append(n - len(kept))
            cols["n_spans"].append(len(s))
            cols["kept"].append(hashlib.sha256(kept).hexdigest() if digests else kept)
            cols["runs"].append([{"start": x, "stop": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
        run = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        arrays = [b.column("tid"), *(pa.array(cols[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")),
                  pa.array(cols["kept"], pa.string() if digests else pa.binary())]
        names = ["tid", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept"]
        if not digests:
            arrays.append(pa.array(cols["runs"], run))
            names.append("runs")
        yield pa.RecordBatch.from_arrays(arrays, names)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS,
                   digests: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans`` and ``kept`` (bytes), ``runs``, or with
    ``digests`` only ``kept_sha256`` (so that no text goes back to each copy's row).

    Removes every byte of every ``length``-byte string that also starts
    elsewhere, in any row, the same included. Null text is empty; rows stay one
    for one; equal rows are copies of each other; other columns are ignored.
    """
    texts = distinct_texts(docs)
    rows = docs.select(text_id().alias("tid"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(rows, texts, length, gram, group_rows)
    own = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    schema = ("tid binary, n_bytes long, n_removed long, n_spans long, "
              + ("kept_sha256 string" if digests else "kept binary, runs array<struct<start:long,stop:long>>"))
    result = (texts.select("tid", "text", "copies").join(own, "tid", "left")
              .mapInArrow(partial(_kept, length=length, digests=digests), schema))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("tid"))
    return ids.join(result, "tid").drop("tid")

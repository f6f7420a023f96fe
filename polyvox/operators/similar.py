"""Similar vectors without comparing all pairs (X1 near-duplicate statements, H3 density clusters).

Equal vectors are one representative with a weight. Representatives fall into buckets by the
signs of random projections, in as many bands as it takes to meet each pair at the cosine
threshold with probability 1 - ``MISS`` (the number of bits follows from the number of rows, so buckets
of unrelated vectors stay small). A band moves a representative's id and its sketch, ``SKETCH`` more signs
packed into words, not its vector. In a bucket, members whose sketches differ in few enough signs are joined
into sets; a pair at the threshold is parted with probability ``MISS`` at most. Only members of sets get their
vectors and are compared, exactly, inside the tasks; what leaves a task is linear in its rows: a star
per local group of similar vectors, or each vector's few nearest.

A bucket of any size is handled whole. A set over ``BLOCK`` members, or a bucket over ``HELD`` times that, is cut
into rings of equal angle around three of its members; by the triangle inequality similar vectors lie in the
same or in neighbouring rings, so overlapping rings lose no pair. Cells still over ``BLOCK`` members are cut
into blocks, and each two blocks meet in one task.

Where many vectors lie near many others, bands bring the same pairs together again and again, each time with copies
of their vectors. Density clusters count that beforehand (``all_pairs_cost_less``); then all vectors are cut into
blocks, each two blocks meet once in one task (``squares``), and a vector is moved once per block, packed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.functions.exprs import min_cluster_size
from polyvox.functions.vectors import dot, normalize
from polyvox.operators.connected import connected
from polyvox.operators.packed import dump, load
from polyvox.operators.skew import per_dataset, salted_join
from polyvox.sources.store import staged

#: Chance that no band brings together a pair whose cosine is exactly the threshold.
MISS = 1e-7
#: Members that are compared at once; larger buckets are cut.
BLOCK = 1024
#: Signs of a sketch; buckets of up to this many blocks have their sketches compared at once.
SKETCH = 256
HELD = 8
#: So many sketch comparisons cost as much as a row of a band.
ROW_COST = 300
PIVOTS = 3
ROWS = "dataset string, vid bigint, w bigint, u array<double>"


def bits_and_bands(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket number and number of bands for ``n`` vectors: of all choices that meet ``MISS``
    the one with the least work, counting a row per band and the rows that unrelated vectors meet."""
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi

    def bands(bits: int) -> int:
        together = agree ** bits
        return 1 if together >= 1 else math.ceil(math.log(MISS) / math.log1p(-together))
    return min(((b, bands(b)) for b in range(4, 61)), key=lambda x: x[1] * (1 + n / 2 ** x[0] / ROW_COST))


def most_signs(threshold: float) -> int:
    """The number of a sketch's signs in which a pair at the cosine ``threshold`` differs but for ``MISS``."""
    p = math.acos(min(1.0, threshold)) / math.pi + 1e-6
    rest = 1.0
    for k in range(SKETCH):
        rest -= math.exp(math.lgamma(SKETCH + 1) - math.lgamma(k + 1) - math.lgamma(SKETCH - k + 1) + k * math.log(p) + (SKETCH - k) * math.log1p(-p))
        if rest <= MISS:
            return k
    return SKETCH


def representatives(points: DataFrame, vec: str) -> tuple[DataFrame, DataFrame]:
    """(members, reps): ``members(dataset, commentId, h1, h2)`` names each usable vector (not null, not
    zero, finite), ``reps(dataset, vid, w, u, h1, h2)`` has one row per distinct vector: smallest
    statement id, number of statements, unit vector (and ``v``, the vector as it is)."""
    usable = (points.select("dataset", F.col("commentId").cast("bigint").alias("commentId"), F.col(vec).alias("__v"))
              .filter(F.coalesce(F.forall("__v", lambda x: F.coalesce(x - x == 0, F.lit(False))), F.lit(False)))
              .filter(normalize("__v").isNotNull()))
    # 128 bits of two differently seeded hashes name a vector
    named = staged(usable.select("dataset", "commentId", "__v", F.xxhash64("__v").alias("h1"), F.xxhash64(F.lit(1), "__v").alias("h2")), "named")
    reps = (named.groupBy("dataset", "h1", "h2")
            .agg(F.min("commentId").alias("vid"), F.count("*").alias("w"), F.any_value("__v").alias("__v"))
            .select("dataset", "h1", "h2", "vid", "w", normalize("__v").alias("u"), F.col("__v").cast("array<double>").alias("v")))
    return named.drop("__v"), staged(reps, "vectors")


def bucket_rows(reps: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Rows of representatives by group ``g``: every two with cosine >= ``threshold`` share a group (but
    for ``MISS``), no group holds more than about two blocks. Vectors of a run have one length."""
    n, short, long = reps.agg(F.count("*"), F.min(F.size("u")), F.max(F.size("u"))).first()
    if short != long:
        raise ValueError(f"vectors have {short} to {long} components")
    bits, bands = bits_and_bands(n, threshold)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            x = np.asarray(b.column(2).flatten()).reshape(b.num_rows, -1)
            signs = x @ np.random.default_rng(23).standard_normal((x.shape[1], SKETCH)) > 0
            words = np.packbits(signs, axis=1).view(np.int64)
            sketch = [pa.array(words[:, k]) for k in range(SKETCH // 64)]
            for band in range(bands):
                planes = np.random.default_rng([17, band]).standard_normal((x.shape[1], bits))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(np.full(b.num_rows, band, np.int32)), pa.array((x @ planes > 0) @ power), *sketch],
                    ["dataset", "vid", "band", "key", *names])

    names = [f"s{k}" for k in range(SKETCH // 64)]
    keyed = reps.select("dataset", "vid", "u").mapInArrow(
        keys, "dataset string, vid bigint, band int, key bigint, " + ", ".join(f"{k} bigint" for k in names))
    rows = staged(_sets(keyed.select("dataset", "vid", F.xxhash64("dataset", "band", "key").alias("g"), *names), threshold, block), "buckets")
    whole = rows.filter(F.col("c") <= block).withColumns({"cell": F.lit(0).cast("bigint"), "i": F.lit(0), "j": F.lit(0)})
    # written vectors are far smaller than in memory, so their table must not be taken for one to broadcast
    vectors = reps.select("dataset", "vid", "w", "u").hint("merge")
    crowded = rows.filter(F.col("c") > block)
    if crowded.limit(1).count():  # nothing to cut otherwise
        whole = whole.unionByName(_cut(crowded.join(vectors.drop("w").hint("merge"), ["dataset", "vid"]), ["dataset", "set"], threshold, block))
    met = staged(whole.select("dataset", "vid", F.xxhash64("set", "cell", "i", "j").alias("g")), "groups")
    return met.join(vectors, ["dataset", "vid"])


def _sets(keyed: DataFrame, threshold: float, block: int) -> DataFrame:
    """(dataset, vid, set, c): members of each bucket ``g`` by the set that sketches in ``most_signs`` reach connect,
    with the set's size; members without another are left out. A bucket over ``HELD`` blocks is one set."""
    most, held_most = most_signs(threshold), HELD * block

    def split(t: pa.Table) -> pa.RecordBatch | None:
        vid = t.column("vid").to_numpy()
        s = [t.column(f"s{k}").to_numpy().view(np.uint64) for k in range(SKETCH // 64)]
        n = len(vid)
        near = np.zeros((n, (n + 7) // 8), np.uint8)
        for lo in range(0, n, 128):
            apart = sum(np.bitwise_count(w[lo:lo + 128, None] ^ w[None]).astype(np.uint16) for w in s)
            near[lo:lo + 128] = np.packbits(apart <= most, axis=1)
        label = np.where(np.bitwise_count(near).sum(1) > 1, -1, np.arange(n))
        for i in np.flatnonzero(label < 0):
            if label[i] < 0:
                front = np.array([i])
                while len(front):  # all that the set's newest members reach
                    label[front] = i
                    reached = np.unpackbits(np.bitwise_or.reduce(near[front], axis=0), count=n).astype(bool)
                    front = np.flatnonzero(reached & (label < 0))
        size = np.bincount(label, minlength=n)[label]
        low = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(low, label, vid)
        keep = np.flatnonzero(size > 1)
        if not len(keep):
            return None
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (t.column("dataset").to_numpy(zero_copy_only=False)[keep], vid[keep],
                                                                 t.column("g").to_numpy()[keep], low[label][keep], size[keep])], out)

    def passed(b: pa.RecordBatch) -> pa.RecordBatch:
        same = np.full(b.num_rows, np.iinfo(np.int64).min)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(same), pa.array(np.full(b.num_rows, held_most + 1))], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, at = [], 0, None
        for b in batches:
            g = b.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)] if len(g) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if g[lo] != at:
                    if 1 < n <= held_most and (done := split(pa.Table.from_batches(held))) is not None:
                        yield done
                    held, n, at = [], 0, g[lo]
                held.append(b.slice(lo, hi - lo))
                n += hi - lo
                if n > held_most:  # from here on the bucket's rows go on as they come
                    yield from map(passed, held)
                    held = []
        if 1 < n <= held_most and (done := split(pa.Table.from_batches(held))) is not None:
            yield done

    out = ["dataset", "vid", "g", "low", "c"]
    sets = keyed.repartition("g").sortWithinPartitions("g").mapInArrow(run, "dataset string, vid bigint, g bigint, low bigint, c bigint")
    return sets.select("dataset", "vid", F.xxhash64("g", "low").alias("set"), "c")


def _cut(rows: DataFrame, bucket: list[str], threshold: float, block: int) -> DataFrame:
    """Members of crowded sets (columns ``bucket``) by ring cell and pair of blocks."""
    pivots = rows.groupBy(*bucket).agg(*[
        F.min(F.struct(F.xxhash64("vid", F.lit(p)).alias("h"), F.col("u"))).alias(f"p{p}") for p in range(PIVOTS)])
    width = math.acos(min(1.0, threshold)) * (1 + 1e-9) + 1e-9  # wider than any similar pair's angle, rounding included
    ring = [F.floor(F.acos(F.greatest(F.least(dot("u", F.col(f"p{p}.u")), F.lit(1.0)), F.lit(-1.0))) / width).alias(f"r{p}") for p in range(PIVOTS)]
    out = salted_join(rows, pivots, bucket, ["vid"], hot_rows=64 * block).select(*bucket, "vid", "c", *ring)
    for p in range(PIVOTS):  # a vector in ring r is also a member of r + 1
        out = out.withColumn(f"r{p}", F.explode(F.array(F.col(f"r{p}"), F.col(f"r{p}") + 1)))
    out = out.withColumn("cell", F.xxhash64(*[f"r{p}" for p in range(PIVOTS)])).select(*bucket, "vid", "c", "cell")
    cell = [*bucket, "cell"]
    sizes = out.groupBy(*cell).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("m"))
    out = salted_join(out, sizes, cell, ["vid"], hot_rows=64 * block)
    mine = F.pmod(F.xxhash64("vid", F.lit(29)), F.col("m")).cast("int")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda j: (F.col("m") == 1) | (j != mine)))
    return (out.select("*", mine.alias("a"), other.alias("b"))
            .select(*bucket, "vid", "c", "cell", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")))


def per_group(rows: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """``compare(datasets, vids, weights, vectors)`` for every group of ``rows``; it returns columns in the
    order of ``schema``. Groups stream through the tasks one after another."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(held)
        if t.num_rows < 2:
            return None
        vid, ds = t.column("vid").to_numpy(), np.array(t.column("dataset").to_pylist(), dtype=object)
        x = t.column("u").combine_chunks().flatten().to_numpy().reshape(len(vid), -1)
        columns = compare(ds, vid, t.column("w").to_numpy(), x)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names) if len(columns[0]) else None

    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for b in batches:
            g = b.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)] if len(g) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and g[lo] != at:
                    if (out := flush(held)) is not None:
                        yield out
                    held = []
                held.append(b.slice(lo, hi - lo))
                at = g[lo]
        if held and (out := flush(held)) is not None:
            yield out

    return rows.repartition("g").sortWithinPartitions("g").select("g", "dataset", "vid", "w", "u").mapInArrow(run, schema)


def _cosines(ds: np.ndarray, vid: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of all pairs of a group, -2 for a vector with itself and across datasets."""
    s = x @ x.T
    s[(vid[:, None] == vid) | (ds[:, None] != ds)] = -2
    return s


def similar_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges (dataset, src, dst) that connect exactly what pairs of cosine >= ``threshold`` connect:
    per group a star for each locally connected set, so at most one edge per row and group."""

    def stars(ds, vid, w, x):
        near = _cosines(ds, vid, x) >= threshold
        label = np.arange(len(vid))
        while True:
            low = np.minimum(label, np.where(near, label, len(vid)).min(1))
            if (low == label).all():
                break
            label = low
        hit = np.flatnonzero(label != np.arange(len(vid)))
        return ds[hit], vid[hit], vid[label[hit]]

    return per_group(rows, stars, "dataset string, src bigint, dst bigint").distinct()


def near_duplicates(points: DataFrame, threshold: float = 0.95, vec: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Statements by near-duplicate class, per dataset: (dataset, commentId, classId, class_size).

    Two statements whose vectors have a cosine of ``threshold`` or more are linked, a class is what links
    connect, ``classId`` its smallest id. Every statement with a usable vector returns a row."""
    members, reps = representatives(points, vec)
    label = connected(similar_links(bucket_rows(reps, threshold, block), threshold))
    named = (reps.select("dataset", "h1", "h2", "vid", "w").join(label.withColumnRenamed("node", "vid"), ["dataset", "vid"], "left")
             .select("dataset", "h1", "h2", "w", F.coalesce("label", "vid").alias("classId")))
    size = named.groupBy("dataset", "classId").agg(F.sum("w").alias("class_size"))
    named = salted_join(named, size, ["dataset", "classId"], ["h1"])
    return (salted_join(members, named, ["dataset", "h1", "h2"], ["commentId"])
            .select("dataset", "commentId", "classId", "class_size"))


def core_distances(reps: DataFrame, rows: DataFrame, radius: float, min_samples: int) -> DataFrame:
    """(dataset, vid, core): the cosine distance within which a vector has ``min_samples`` statements,
    itself and its equals among them; only vectors that reach them within ``radius``.

    A group passes on each vector's ``min_samples`` nearest at most: if any group fills that list the
    vector's count is reached, else the lists together are complete."""

    def nearest(ds, vid, w, x):
        d = 1 - _cosines(ds, vid, x)
        few = min(min_samples, len(vid))
        at = np.argpartition(d, few - 1, axis=1)[:, :few]
        gap = np.take_along_axis(d, at, 1)
        row, col = np.nonzero(gap <= radius)
        other = at[row, col]
        return ds[row], vid[row], vid[other], w[other], np.maximum(gap[row, col], 0)

    found = per_group(rows, nearest, "dataset string, vid bigint, other bigint, w bigint, d double")
    lists = (found.groupBy("dataset", "vid", "other").agg(F.min("d").alias("d"), F.any_value("w").alias("w"))
             .groupBy("dataset", "vid").agg(F.sort_array(F.collect_list(F.struct("d", "other", "w"))).alias("near")))
    start = F.struct(F.col("w").alias("n"), F.when(F.col("w") >= min_samples, F.lit(0.0)).alias("core"))
    walked = F.aggregate("near", start, lambda a, x: F.struct(
        (a["n"] + x["w"]).alias("n"), F.coalesce(a["core"], F.when(a["n"] + x["w"] >= min_samples, x["d"])).alias("core")))
    return (reps.select("dataset", "vid", "w").join(lists, ["dataset", "vid"], "left")
            .select("dataset", "vid", F.when(F.col("near").isNull(), start).otherwise(walked)["core"].alias("core"))
            .filter("core is not null"))


#: Vectors to a side of a square of pairs, and vectors of either side that are compared at once.
SIDE = 32_768
ROWS_AT_ONCE, COLUMNS_AT_ONCE = 1024, 4096


def all_pairs_cost_less(reps: DataFrame, threshold: float) -> bool:
    """Whether comparing all pairs once is less work than the bands, by the sizes of two bands' buckets."""
    n = reps.count()
    bits, bands = bits_and_bands(n, threshold)
    if n / 2 <= bands * ROW_COST:
        return True

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, -1)
            for band in range(2):
                planes = np.random.default_rng([17, band]).standard_normal((x.shape[1], bits))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(b.num_rows, band, np.int32)), pa.array((x @ planes > 0) @ power)], ["dataset", "band", "key"])

    sizes = reps.select("dataset", "u").mapInArrow(keys, "dataset string, band int, key bigint").groupBy("dataset", "band", "key").count()
    met = sizes.agg(F.sum(F.col("count").cast("double") ** 2)).first()[0] / (2 * n)
    return n / 2 <= bands * (ROW_COST + met)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (of each node its set's smallest) after the sets with labels ``a`` and ``b`` are joined."""
    up = np.arange(len(label))
    while len(a):
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(up, hi, lo)
        while not (up[up] == up).all():
            up = up[up]
        a, b = up[lo], up[hi]
        apart = a != b
        a, b = a[apart], b[apart]
    return up[label]


def _linked(x: np.ndarray, y: np.ndarray, label: np.ndarray, at: int, threshold: float) -> np.ndarray:
    """``label`` of the nodes of both sides (``y``'s from ``at``) after all pairs of cosine >= ``threshold`` are joined."""
    for lo in range(0, len(x), ROWS_AT_ONCE):
        for c in range(0, len(y), COLUMNS_AT_ONCE):
            one, two = label[lo:min(lo + ROWS_AT_ONCE, len(x))], label[at + c:at + min(c + COLUMNS_AT_ONCE, len(y))]
            if one.min() == one.max() == two.min() == two.max():
                continue  # all joined
            i, j = np.nonzero((x[lo:lo + ROWS_AT_ONCE] @ y[c:c + COLUMNS_AT_ONCE].T >= threshold) & (one[:, None] != two))
            if len(i):
                label = _unite(label, one[i], two[j])
    return label


class Block:
    """Vectors of a dataset's block: ids (ascending), numbers of statements, unit vectors, and labels of linked sets."""

    def __init__(self, data: bytes, size: int, whole: bool):
        (vid, w, x, shape, label), raw = load(size, data)
        self.vid, self.w, self.label = vid, w, label
        x = np.frombuffer(raw, np.int16 if whole else np.float64).reshape(shape).astype(np.float64)
        self.u = x * (1 / np.sqrt(np.einsum("ij,ij->i", x, x)))[:, None]

    @staticmethod
    def packed(vid: np.ndarray, w: np.ndarray, x: np.ndarray, threshold: float | None) -> tuple[int, bytes, bool]:
        whole = bool((np.abs(x) < 2**15).all() and (x == np.rint(x)).all())  # counts of hashed words are small whole numbers
        label = np.arange(len(vid))
        if threshold is not None:
            u = x * (1 / np.sqrt(np.einsum("ij,ij->i", x, x)))[:, None]
            label = _linked(u, u, label, 0, threshold)
        raw = x.astype(np.int16 if whole else np.float64).tobytes()
        return *dump([vid, w, np.zeros(0, np.int64), np.array(x.shape), label], raw), whole


def vector_blocks(reps: DataFrame, side: int, threshold: float | None = None) -> DataFrame:
    """(dataset, block, m, size, data, whole): each dataset's vectors in ``m`` blocks of about ``side``, written once; with
    ``threshold`` a block also says which of its vectors are linked."""
    sizes = reps.groupBy("dataset").agg(F.ceil(F.count("*") / F.lit(side)).cast("int").alias("m"))
    rows = (reps.join(per_dataset(sizes), "dataset").select("dataset", F.pmod(F.xxhash64("vid", F.lit(31)), F.col("m")).cast("int").alias("block"), "m", "vid", "w", "v")
            .repartition("dataset", "block").sortWithinPartitions("dataset", "block", "vid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            vid = t.column("vid").to_numpy()
            size, data, whole = Block.packed(vid, t.column("w").to_numpy(), t.column("v").combine_chunks().flatten().to_numpy().reshape(len(vid), -1), threshold)
            one = lambda x, kind: pa.array([x], kind)
            return pa.RecordBatch.from_arrays([one(at[0], pa.string()), one(at[1], pa.int32()), one(t.column("m")[0].as_py(), pa.int32()), one(size, pa.int32()),
                                               one(data, pa.binary()), one(whole, pa.bool_())], ["dataset", "block", "m", "size", "data", "whole"])

        held, at = [], None
        for b in batches:
            names, blocks = b.column(0).to_pylist(), b.column(1).to_numpy()
            cuts = [0, *(i for i in range(1, b.num_rows) if blocks[i] != blocks[i - 1] or names[i] != names[i - 1]), b.num_rows] if b.num_rows else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and (names[lo], blocks[lo]) != at:
                    yield flush()
                    held = []
                at = (names[lo], blocks[lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            yield flush()

    return staged(rows.mapInArrow(run, "dataset string, block int, m int, size int, data binary, whole boolean"), "vector-blocks", 1)


def squares(blocks: DataFrame, compare: Callable[[str, int, Block, int, Block | None], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``compare(dataset, i, block i, j, block j)`` for every two blocks i < j of a dataset and (block j is None) for each alone; a square
    of pairs is one task's, which holds two blocks."""
    many = blocks.select("dataset", "m").distinct().agg(F.sum(F.col("m").cast("bigint") * (F.col("m") + 1) / 2)).first()[0]
    other = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    met = (blocks.select("dataset", "block", "size", "data", "whole", other.alias("other"))
           .select("dataset", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "size", "whole", "data")
           .repartition(max(1, min(int(many or 1), 4096)), "dataset", "i", "j").sortWithinPartitions("dataset", "i", "j", "block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            for k in range(b.num_rows):
                dataset, i, j, block, size, whole = (b.column(c)[k].as_py() for c in range(6))
                own = Block(b.column(6)[k].as_py(), size, whole)
                if i == j:
                    yield from compare(dataset, i, own, j, None)
                elif block == i:
                    last = (dataset, i, j, own)
                elif last and last[:3] == (dataset, i, j):  # a block without vectors has no row
                    yield from compare(dataset, i, last[3], j, own)
                    last = None

    return met.mapInArrow(run, schema)


class Nearest:
    """Of each vector the cosines of its ``k`` nearest so far (descending, over ``floor``) and their numbers of statements."""

    def __init__(self, n: int, k: int, floor: float):
        self.s, self.w, self.k = np.full((n, k), floor), np.zeros((n, k), np.int64), k

    def see(self, lo: int, s: np.ndarray, w: np.ndarray) -> None:
        """Cosines ``s`` of the vectors from ``lo`` with others of ``w`` statements."""
        k, own = self.k, slice(lo, lo + len(s))
        hit = s > self.s[own, -1:]
        n = np.count_nonzero(hit)
        if not n:
            return
        if n > 32 * len(s) and s.shape[1] > k:
            at = np.argpartition(s, -k, axis=1)[:, -k:]
            row, new, weight = np.arange(len(s)), np.take_along_axis(s, at, 1), w[at]
        else:
            r, c = np.nonzero(hit)
            value = s[r, c]
            order = np.lexsort((-value, r))
            r, c, value = r[order], c[order], value[order]
            first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            row = r[first]
            rank = np.arange(len(r)) - np.repeat(first, np.diff(first, append=len(r)))
            best = rank < k
            place = np.repeat(np.arange(len(first)), np.diff(first, append=len(r)))[best]
            new, weight = np.full((len(first), k), -2.0), np.zeros((len(first), k), np.int64)
            new[place, rank[best]], weight[place, rank[best]] = value[best], w[c[best]]
        both, of = np.concatenate([self.s[own][row], new], axis=1), np.concatenate([self.w[own][row], weight], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :k]
        self.s[lo + row], self.w[lo + row] = np.take_along_axis(both, order, 1), np.take_along_axis(of, order, 1)


def core_by_squares(reps: DataFrame, radius: float, min_samples: int, side: int) -> DataFrame:
    """``core_distances`` from all pairs. A square passes on its vectors' few nearest, packed by block."""
    schema = "dataset string, block int, size int, data binary"
    floor = 1 - radius - 1e-9

    def nearest(dataset: str, i: int, x: Block, j: int, y: Block | None) -> Iterator[pa.RecordBatch]:
        other = y or x
        sides = [Nearest(len(b.vid), min_samples, floor) for b in ([x, y] if y else [x])]
        for lo in range(0, len(x.vid), ROWS_AT_ONCE):
            for c in range(0, len(other.vid), COLUMNS_AT_ONCE):
                s = x.u[lo:lo + ROWS_AT_ONCE] @ other.u[c:c + COLUMNS_AT_ONCE].T
                if y is None:  # not a vector with itself
                    same = np.arange(max(lo, c), min(lo + s.shape[0], c + s.shape[1]))
                    s[same - lo, same - c] = -2
                sides[0].see(lo, s, other.w[c:c + COLUMNS_AT_ONCE])
                if y:
                    sides[1].see(c, s.T, x.w[lo:lo + ROWS_AT_ONCE])
        for block, b, near in zip((i, j), (x, y), sides):
            keep = (near.w > 0) & (1 - near.s <= radius)
            r, k = np.nonzero(keep)
            own = [b.vid, b.w] if y is None else [r[:0], r[:0]]
            size, data = dump([*own, r, np.maximum(1 - near.s[r, k], 0), near.w[r, k]])
            yield pa.RecordBatch.from_arrays([pa.array([dataset], pa.string()), pa.array([block], pa.int32()), pa.array([size], pa.int32()),
                                              pa.array([data], pa.binary())], ["dataset", "block", "size", "data"])

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(4))))
        for (dataset, _), own in groupby(rows, key=lambda r: r[:2]):
            vid, w, row, d, n = (np.concatenate(c) for c in zip(*(load(size, data)[0] for _, _, size, data in own)))
            order = np.lexsort((d, row))
            row, d, n = row[order], d[order], n[order]
            total = np.cumsum(n)
            first = np.searchsorted(row, row)
            reached = w[row] + total - (total[first] - n[first]) >= min_samples if len(row) else np.zeros(0, bool)
            core = np.where(w >= min_samples, 0.0, np.nan)
            hit, at = np.unique(row[reached], return_index=True)
            hit, at = hit[w[hit] < min_samples], np.flatnonzero(reached)[at][w[hit] < min_samples]
            core[hit] = d[at]
            known = np.flatnonzero(~np.isnan(core))
            yield pa.RecordBatch.from_arrays([pa.array([dataset] * len(known), pa.string()), pa.array(vid[known]), pa.array(core[known])], ["dataset", "vid", "core"])

    found = squares(vector_blocks(reps, side), nearest, schema)
    return (found.repartition("dataset", "block").sortWithinPartitions("dataset", "block")
            .mapInArrow(cores, "dataset string, vid bigint, core double"))


def links_by_squares(reps: DataFrame, threshold: float, side: int) -> DataFrame:
    """``similar_links`` from all pairs: a star per linked set of a block, and a link for each two sets of two blocks that meet."""
    blocks = vector_blocks(reps, side, threshold)

    def links(dataset: str, i: int, x: Block, j: int, y: Block | None) -> Iterator[pa.RecordBatch]:
        vid = x.vid if y is None else np.concatenate([x.vid, y.vid])
        old = x.label if y is None else np.concatenate([x.label, len(x.vid) + y.label])
        label = old if y is None else _linked(x.u, y.u, old, len(x.vid), threshold)
        at = np.flatnonzero(label != np.arange(len(vid)) if y is None else (old == np.arange(len(vid))) & (label != old))
        yield pa.RecordBatch.from_arrays([pa.array([dataset] * len(at), pa.string()), pa.array(vid[at]), pa.array(vid[label[at]])], ["dataset", "src", "dst"])

    return squares(blocks, links, "dataset string, src bigint, dst bigint")


def density_clusters(points: DataFrame, radius: float, min_samples: int = 4, vec: str = "embedding",
                     min_size: int | None = None, block: int = BLOCK) -> DataFrame:
    """H3: density clusters with outliers, per dataset: (dataset, commentId, topicId, core).

    Core points have ``min_samples`` statements (themselves included) within cosine distance
    ``radius``; core points within ``radius`` of each other are one cluster. Clusters under
    ``min_size`` (default ``min_cluster_size`` of the dataset's usable vectors), points that are no core point and
    rows without a usable vector are -1. Topics are numbered 0.. by size desc, then smallest
    id. ``core`` is the core distance, null for other points."""
    members, reps = representatives(points, vec)
    if all_pairs_cost_less(reps, 1 - radius):
        n, short, long = reps.agg(F.count("*"), F.min(F.size("u")), F.max(F.size("u"))).first()
        if short != long:
            raise ValueError(f"vectors have {short} to {long} components")
        side = min(SIDE, max(block, -(-n // 8)))  # some tasks also for few vectors
        core = staged(core_by_squares(reps, radius, min_samples, side), "core")
        links = links_by_squares(reps.join(core.select("dataset", "vid"), ["dataset", "vid"], "left_semi"), 1 - radius, side)
    else:
        rows = bucket_rows(reps, 1 - radius, block)
        core = staged(core_distances(reps, rows, radius, min_samples), "core")
        links = similar_links(rows.join(core.select("dataset", "vid"), ["dataset", "vid"], "left_semi"), 1 - radius)
    label = connected(links)
    cored = (reps.select("dataset", "h1", "h2", "vid", "w").join(core, ["dataset", "vid"])
             .join(label.withColumnRenamed("node", "vid"), ["dataset", "vid"], "left")
             .select("dataset", "h1", "h2", "w", "core", F.coalesce("label", "vid").alias("label")))
    n = reps.groupBy("dataset").agg(F.sum("w").alias("n"))
    least = F.lit(min_size) if min_size is not None else min_cluster_size("n")
    sizes = (cored.groupBy("dataset", "label").agg(F.sum("w").alias("size"))
             .join(per_dataset(n), "dataset").filter(F.col("size") >= least))
    # a cluster's label is its smallest core id
    order = Window.partitionBy("dataset").orderBy(F.desc("size"), "label")
    ids = sizes.select("dataset", "label", (F.row_number().over(order) - 1).cast("int").alias("topicId"))
    named = salted_join(cored, ids, ["dataset", "label"], ["h1"], "left").select("dataset", "h1", "h2", "core", "topicId")
    got = salted_join(members, named, ["dataset", "h1", "h2"], ["commentId"], "left").select("dataset", "commentId", "topicId", "core")
    every = points.select("dataset", F.col("commentId").cast("bigint").alias("commentId"))
    return (every.join(got, ["dataset", "commentId"], "left")
            .select("dataset", "commentId", F.coalesce("topicId", F.lit(-1)).alias("topicId"), "core"))

"""Embedding-space topic operators.

Vectors are ``array<float>`` columns. Means and sums of vectors are MLlib
``Summarizer`` aggregates (whole vectors, map-side combine, never one row per
dimension). Work is O(points x topics); no step compares all pairs of points.
Tables per topic (centroids, cluster sums) are broadcast only where their
size has been checked; beyond that they are joined by a salted join, so a
dataset holding a third of all points still spreads over many tasks.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.functions.exprs import min_cluster_size
from polyvox.functions.vectors import cosine, dot, normalize, sq_dist
from polyvox.operators.connected import connected
from polyvox.operators.embed import reduced
from polyvox.operators.skew import per_dataset, salted_join
from polyvox.sources.store import staged

# Centroid tables up to this many numbers are sent to every task (64 MB of doubles).
BROADCAST_NUMBERS = 8_000_000


def centroids(assign: DataFrame, vec: str = "embedding", topic: str = "topicId") -> DataFrame:
    """H12 part: mean vector of each non-outlier topic -> (dataset, topic,
    centroid array<double>, size)."""
    pts = assign.filter((F.col(topic) >= 0) & F.col(vec).isNotNull())
    return (pts.groupBy("dataset", topic)
            .agg(Summarizer.mean(array_to_vector(vec)).alias("__m"), F.count("*").alias("size"))
            .select("dataset", topic, vector_to_array("__m").alias("centroid"), "size"))


def centroids_long(assign: DataFrame, vec: str = "embedding", topic: str = "topicId") -> DataFrame:
    """Centroids in long form (dataset, topic, dim, value)."""
    return centroids(assign, vec, topic).select("dataset", topic, F.posexplode("centroid").alias("dim", "value"))


def per_dataset_array(df: DataFrame, name: str, *fields: str) -> DataFrame:
    """One row per dataset holding ``struct(fields...)`` of all its rows,
    sorted. Used for per-dataset centroid / cluster tables (one row per topic)."""
    return (df.groupBy("dataset")
            .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name)))


def attach(points: DataFrame, arrays: DataFrame) -> DataFrame:
    """Give every point its dataset's array row. Salted on dataset, so a
    dataset with a third of all points is still spread over many tasks."""
    return salted_join(points, arrays, ["dataset"], spread_by=["commentId"])


def reassign_by_embedding(assign: DataFrame, cents: DataFrame, vec: str = "embedding",
                          topic: str = "topicId") -> DataFrame:
    """D14 + H12: rows with topic -1 and a vector take the topic whose
    centroid is most cosine-similar (ties: lowest id). Assigned rows never
    move; rows without a vector stay -1. Adds ``similarity`` (NULL when the
    row did not move). Each outlier is compared with its dataset's centroid
    array in one expression (no points x centroids shuffle)."""
    out = assign.filter((F.col(topic) == -1) & F.col(vec).isNotNull()).select("dataset", "commentId", vec)
    arr = per_dataset_array(cents.withColumnRenamed(topic, "t"), "__cs", "t", "centroid")
    best = (attach(out, arr)
            .select("dataset", "commentId", F.array_max(F.transform(
                "__cs", lambda x: F.struct(cosine(F.col(vec), x["centroid"]).alias("sim"),
                                           (-x["t"]).alias("neg_t")))).alias("__b")))
    return (assign.join(best, ["dataset", "commentId"], "left")
            .withColumn(topic, F.coalesce(-F.col("__b.neg_t"), F.col(topic)).cast("int"))
            .withColumn("similarity", F.col("__b.sim"))
            .drop("__b"))


def topic_similarity(cents: DataFrame, topic: str = "topicId") -> DataFrame:
    """Cosine similarity of every pair of topic centroids in a dataset
    (the result itself is topics squared)."""
    a = cents.select("dataset", F.col(topic).alias("topic_a"), F.col("centroid").alias("__a"))
    b = cents.select("dataset", F.col(topic).alias("topic_b"), F.col("centroid").alias("__b"))
    return (a.join(b, "dataset").filter(F.col("topic_a") != F.col("topic_b"))
            .select("dataset", "topic_a", "topic_b", cosine("__a", "__b").alias("similarity")))


def silhouette(points: DataFrame, vec: str = "embedding", topic: str = "topicId") -> DataFrame:
    """Cosine silhouette per cluster and for the dataset, in O(n x k).

    With unit vectors u and cluster sums S_c (n_c members), the mean cosine
    distance from u to cluster c is (n_c - u.S_c)/n_c, and to the other
    members of its own cluster (n_a - u.S_a)/(n_a - 1). Outliers (-1) count
    as a cluster (survey Q19). Singleton clusters and points at distance 0 from their own and
    the next cluster score 0; zero vectors take no part.
    Returns (dataset, topic, size, silhouette, overall)."""
    pts = (points.filter(F.col(vec).isNotNull())
           .select("dataset", "commentId", F.col(topic).alias("__t"), normalize(vec).alias("__u"))
           .filter(F.col("__u").isNotNull()))
    sums = (pts.groupBy("dataset", F.col("__t").alias("c")).agg(Summarizer.sum(array_to_vector("__u")).alias("__s"))
            .select("dataset", "c", vector_to_array("__s").alias("S")))
    sizes = pts.groupBy("dataset", F.col("__t").alias("c")).agg(F.count("*").alias("n"))
    arr = per_dataset_array(sums.join(sizes, ["dataset", "c"]), "__k", "c", "n", "S")
    t = F.col("__t")
    dists = F.transform("__k", lambda x: F.struct(
        x["c"].alias("c"), x["n"].alias("n"),
        F.when(x["c"] == t, F.try_divide(x["n"] - dot("__u", x["S"]), x["n"] - 1))
        .otherwise((x["n"] - dot("__u", x["S"])) / x["n"]).alias("d")))
    per_pt = attach(pts, arr).select("dataset", "commentId", t, dists.alias("__ds"))
    own = F.get(F.filter("__ds", lambda x: x["c"] == t), 0)
    b = F.array_min(F.transform(F.filter("__ds", lambda x: x["c"] != t), lambda x: x["d"]))
    most = F.greatest(own["d"], b)
    s = per_pt.select("dataset", t, F.when((own["n"] <= 1) | (most == 0), F.lit(0.0)).otherwise(
        F.try_divide(b - own["d"], most)).alias("__s"))
    per_cluster = (s.groupBy("dataset", F.col("__t").alias(topic))
                   .agg(F.count("*").alias("size"), F.avg("__s").alias("silhouette")))
    overall = s.groupBy("dataset").agg(F.avg("__s").alias("overall"))
    return per_cluster.join(per_dataset(overall), "dataset")


def _ckpt(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder (survives executor loss)."""
    return staged(df, "cluster")


def _centroid_arrays(cents: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]] | None:
    """Centroids by dataset as arrays, or None if the table is too large to send to tasks."""
    rows, dims = cents.agg(F.count("*"), F.max(F.size("__m"))).first()
    if rows * (dims or 0) > BROADCAST_NUMBERS:
        return None
    out: dict[str, list] = {}
    for r in sorted(cents.collect(), key=lambda r: (r["dataset"], r["__c"])):
        out.setdefault(r["dataset"], []).append((r["__c"], r["__m"]))
    return {d: (np.array([c for c, _ in v]), np.array([m for _, m in v], dtype=np.float64)) for d, v in out.items()}


def _nearest(pts: DataFrame, cents: DataFrame) -> DataFrame:
    """(dataset, commentId, __u, __c, __d2): each unit vector with its nearest centroid (ties:
    lowest id). Small centroid tables go to the tasks as matrices; others are joined on."""
    arrays = _centroid_arrays(cents)
    if arrays is None:
        arr = per_dataset_array(cents, "__cs", "__c", "__m")
        best = F.array_min(F.transform("__cs", lambda x: F.struct(
            sq_dist("__u", x["__m"]).alias("d2"), x["__c"].alias("c"))))
        return attach(pts, arr).select("dataset", "commentId", "__u", best["c"].alias("__c"), best["d2"].alias("__d2"))
    shared = pts.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, d2 = np.full(b.num_rows, -1, np.int32), np.full(b.num_rows, np.inf)
            for _, at, _, own, dist in _compared(b, shared.value):
                c[at], d2[at] = own, dist
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c), pa.array(d2)], ["dataset", "commentId", "__u", "__c", "__d2"])

    return pts.select("dataset", "commentId", "__u").mapInArrow(
        run, "dataset string, commentId bigint, __u array<double>, __c int, __d2 double")


def _compared(b: pa.RecordBatch, arrays: dict) -> Iterator[tuple]:
    """Per dataset of a batch (dataset, ..., __u): its name, rows, vectors, nearest centroids (ties: lowest id) and squared distances."""
    d = b.column(0).dictionary_encode()
    code, names = d.indices.to_numpy(), d.dictionary.to_pylist()
    vecs = b.column(b.num_columns - 1)
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(b.num_rows, -1) if b.num_rows and len(flat) else np.zeros((b.num_rows, 0))
    for i, name in enumerate(names):
        at = np.flatnonzero(code == i)
        ids, m = arrays[name]
        own = x[at]
        dist = np.maximum((own ** 2).sum(1)[:, None] + (m ** 2).sum(1) - 2 * own @ m.T, 0)
        near = dist.argmin(1)
        yield name, at, own, ids[near], dist[np.arange(len(at)), near]


def _means(pts: DataFrame, arrays: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(dataset, __c, __n, __v): sum and number of the vectors nearest to each centroid that has any. A task returns
    one sum per centroid, so no vector leaves it."""
    shared = pts.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for name, _, x, own, _ in _compared(b, shared.value):
                ids, m = shared.value[name]
                total, n = sums.setdefault(name, (np.zeros(m.shape), np.zeros(len(ids), np.int64)))
                where = np.searchsorted(ids, own)
                order = np.argsort(where, kind="stable")
                cut = np.flatnonzero(np.diff(where[order], prepend=-1))
                total[where[order][cut]] += np.add.reduceat(x[order], cut, axis=0)
                n += np.bincount(where, minlength=len(ids))
        for name, (total, n) in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(shared.value[name][0][at], pa.int32()), pa.array(n[at]),
                                              pa.array(list(total[at]), pa.list_(pa.float64()))], ["dataset", "__c", "__n", "__s"])

    parts = pts.select("dataset", "__u").mapInArrow(run, "dataset string, __c int, __n bigint, __s array<double>")
    return (parts.groupBy("dataset", "__c").agg(Summarizer.sum(array_to_vector("__s")).alias("__v"), F.sum("__n").alias("__n"))
            .select("dataset", "__c", "__n", vector_to_array("__v").alias("__v")))


def kmeans_topics(points: DataFrame, vec: str = "embedding", max_iter: int | None = None,
                  tol: float = 1e-6, outlier_distance: float | None = None,
                  k: int | None = None, link_distance: float | None = None) -> DataFrame:
    """H3 (re-aimed): density-style topic clusters with outliers, per dataset.

    Micro-clusters come from Lloyd k-means on unit vectors, for all datasets
    at once: k per dataset is n / min_cluster_size (or ``k``); seeds are the
    k points with the smallest hash of their id; each round assigns points to
    the nearest centroid and re-averages until none moves by more than
    ``tol``; a caller's ``max_iter`` stops it earlier, with a warning. Unit vectors
    are written once, centroids each round.
    With ``link_distance``, micro-clusters of min_cluster_size points or more
    whose centroids are within that cosine distance are one topic
    (connected components), so topics need not be round.
    Points farther than ``outlier_distance`` (cosine distance) from their
    centroid, topics under min_cluster_size(n) and rows without a usable
    vector (null or zero) become -1; topics are numbered 0.. by size desc,
    then smallest member id. Returns (dataset, commentId, topicId).
    """
    return _topics(_rounds(points, vec, max_iter, tol, k), outlier_distance, link_distance)


def _rounds(points: DataFrame, vec: str = "embedding", max_iter: int | None = None, tol: float = 1e-6,
            k: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The Lloyd rounds of ``kmeans_topics``: (unit vectors, each dataset's numbers, final centroids, each vector's centroid)."""
    rows = points.filter(F.col(vec).isNotNull()).select("dataset", "commentId", normalize(vec).alias("__u"))
    rows = _ckpt(rows)
    pts = rows.filter(F.col("__u").isNotNull())
    n = pts.groupBy("dataset").agg(F.count("*").alias("n"))
    kk = n.select("dataset", "n", min_cluster_size("n").alias("__mcs"),
                  (F.lit(k) if k else F.greatest(F.floor(F.col("n") / min_cluster_size("n")), F.lit(1)))
                  .cast("int").alias("__k"))
    most = kk.agg(F.max("__k")).first()[0] or 0
    w = Window.partitionBy("dataset").orderBy(F.xxhash64("commentId"), "commentId")
    # a constant bound lets Spark cut each dataset before the shuffle
    seeds = (pts.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most)
             .join(kk, "dataset").filter(F.col("__r") <= F.col("__k"))
             .select("dataset", (F.col("__r") - 1).cast("int").alias("__c"), F.col("__u").alias("__m")))
    cents = _ckpt(seeds)
    arrays = _centroid_arrays(cents)  # their number and length stay the same
    settled = False
    for _ in count() if max_iter is None else range(max_iter):
        # clusters that lost all members keep their old centroid
        if arrays is None:
            new = (_nearest(pts, cents).groupBy("dataset", "__c").agg(Summarizer.mean(array_to_vector("__u")).alias("__v"))
                   .select("dataset", "__c", vector_to_array("__v").alias("__new")))
            new = _ckpt(cents.join(new, ["dataset", "__c"], "left")
                        .select("dataset", "__c", F.coalesce("__new", "__m").alias("__m"),
                                sq_dist("__m", F.coalesce("__new", "__m")).alias("__shift")))
            shift = new.agg(F.max("__shift")).first()[0]
            cents = new.drop("__shift")
        else:
            moved = {d: (ids, m.copy()) for d, (ids, m) in arrays.items()}
            for r in _means(pts, arrays).collect():
                ids, m = moved[r["dataset"]]
                m[np.searchsorted(ids, r["__c"])] = np.array(r["__v"]) / r["__n"]
            shift = max((float(((m - arrays[d][1]) ** 2).sum(1).max()) for d, (_, m) in moved.items()), default=None)
            arrays = moved
        if shift is None or shift <= tol:
            settled = True
            break
    if arrays:
        rows_of = [(d, int(c), v.tolist()) for d, (ids, m) in arrays.items() for c, v in zip(ids, m, strict=True)]
        cents = _ckpt(pts.sparkSession.createDataFrame(rows_of, "dataset string, __c int, __m array<double>"))
    if not settled:
        warnings.warn(f"k-means centroids still moved after {max_iter} rounds (squared shift {shift:.3g})", stacklevel=3)

    return rows, kk, cents, _ckpt(_nearest(pts, cents).drop("__u"))


def _topics(found: tuple[DataFrame, DataFrame, DataFrame, DataFrame], outlier_distance: float | None, link_distance: float | None) -> DataFrame:
    """The topics of ``kmeans_topics`` from its rounds: outliers, linked micro-clusters, numbers."""
    rows, kk, cents, a = found
    if outlier_distance is not None:
        # unit vectors: squared L2 = 2 * cosine distance
        a = a.withColumn("__c", F.when(F.col("__d2") > 2 * outlier_distance, F.lit(-1)).otherwise(F.col("__c")))
    if link_distance is not None:
        dense = (a.filter("__c >= 0").groupBy("dataset", "__c").agg(F.count("*").alias("__size"))
                 .join(kk, "dataset").filter("__size >= __mcs").select("dataset", "__c"))
        heads = cents.join(dense, ["dataset", "__c"]).select("dataset", F.col("__c").alias("topicId"), F.col("__m").alias("centroid"))
        sim = topic_similarity(heads).filter(F.col("similarity") >= 1 - link_distance)
        merged = components(sim.select("dataset", F.col("topic_a").alias("src"), F.col("topic_b").alias("dst")),
                            heads.select("dataset", F.col("topicId").alias("node")))
        a = (a.join(merged.withColumnRenamed("node", "__c"), ["dataset", "__c"], "left")
             .withColumn("__c", F.coalesce("label", "__c")).drop("label"))
    sizes = (a.filter(F.col("__c") >= 0).groupBy("dataset", "__c")
             .agg(F.count("*").alias("__size"), F.min("commentId").alias("__first"))
             .join(kk.select("dataset", "__mcs"), "dataset").filter(F.col("__size") >= F.col("__mcs")))
    order = Window.partitionBy("dataset").orderBy(F.desc("__size"), "__first")
    ids = sizes.select("dataset", "__c", (F.row_number().over(order) - 1).cast("int").alias("topicId"))
    none = F.lit(-1).alias("topicId")
    return (a.join(ids, ["dataset", "__c"], "left")
            .select("dataset", "commentId", F.coalesce("topicId", F.lit(-1)).alias("topicId"))
            .unionByName(rows.filter(F.col("__u").isNull()).select("dataset", "commentId", none)))


def components(edges: DataFrame, nodes: DataFrame, max_iter: int = 100) -> DataFrame:
    """Connected components: ``nodes(dataset, node)`` with the smallest node that
    ``edges(dataset, src, dst)`` connect them to -> (dataset, node, label)."""
    found = connected(edges, max_iter)
    return (nodes.join(found, ["dataset", "node"], "left")
            .select("dataset", "node", F.coalesce("label", "node").alias("label")))


def reduce_topics(assign: DataFrame, cents: DataFrame, threshold: float = 0.9,
                  topic: str = "topicId") -> DataFrame:
    """H4: merge topics whose centroids have cosine >= ``threshold``
    (connected components over topic pairs), then renumber 0.. by size desc.
    Outliers stay -1. Returns ``assign`` with new topic ids."""
    sim = topic_similarity(cents, topic).filter(F.col("similarity") >= threshold)
    edges = sim.select("dataset", F.col("topic_a").alias("src"), F.col("topic_b").alias("dst"))
    nodes = cents.select("dataset", F.col(topic).alias("node"))
    comp = components(edges, nodes)
    merged = (assign.join(comp.withColumnRenamed("node", topic), ["dataset", topic], "left")
              .withColumn("__m", F.when(F.col(topic) >= 0, F.col("label")).otherwise(F.lit(-1))))
    sizes = (merged.filter(F.col("__m") >= 0).groupBy("dataset", "__m")
             .agg(F.count("*").alias("__n")))
    order = Window.partitionBy("dataset").orderBy(F.desc("__n"), "__m")
    ids = sizes.select("dataset", "__m", (F.row_number().over(order) - 1).cast("int").alias("__new"))
    return (merged.join(ids, ["dataset", "__m"], "left")
            .withColumn(topic, F.coalesce("__new", F.lit(-1)).cast("int"))
            .drop("__m", "__new", "label"))


def topic_sizes(assign: DataFrame, topic: str = "topicId") -> DataFrame:
    """E22 + E23: size of every topic (outliers -1 included) with the run
    stats of its dataset: comments, topics (excl. -1), outliers, largest."""
    sizes = assign.groupBy("dataset", topic).agg(F.count("*").alias("size"))
    stats = sizes.groupBy("dataset").agg(
        F.sum("size").cast("bigint").alias("n_comments"),
        F.count_if(F.col(topic) >= 0).alias("n_topics"),
        F.coalesce(F.sum(F.when(F.col(topic) == -1, F.col("size"))), F.lit(0)).cast("bigint")
        .alias("n_outliers"),
        F.max(F.when(F.col(topic) >= 0, F.col("size"))).alias("largest"))
    return sizes.join(stats, "dataset")


def sweep(points: DataFrame, settings: list[dict], vec: str = "embedding") -> DataFrame:
    """One row per dataset and clustering setting with what came out of it.

    A setting holds any of ``kmeans_topics``' k, outlier_distance, link_distance
    and max_iter, and ``dims``, principal components to reduce vectors to first
    (fit on all rows given). The driver only walks the list; each run is a
    distributed job whose assignment is checkpointed. Returns (dataset,
    setting, params, n_comments, n_topics, n_outliers, largest, silhouette);
    silhouette is NULL where there is one cluster only. Settings that differ in distances only
    share their rounds."""
    rows = points.select("dataset", "commentId", F.col(vec).alias("embedding"))
    runs, vectors, rounds = [], {None: rows}, {}
    for i, s in enumerate(settings):
        own = dict(s)
        dims = own.pop("dims", None) or None
        if dims not in vectors:
            vectors[dims] = _ckpt(reduced(rows, dims))
        pts = vectors[dims]
        distances = own.pop("outlier_distance", None), own.pop("link_distance", None)
        same = dims, *sorted(own.items())
        if same not in rounds:
            rounds[same] = _rounds(pts, **own)
        a = _ckpt(_topics(rounds[same], *distances))
        sil = silhouette(a.join(pts, ["dataset", "commentId"])).select("dataset", F.col("overall").alias("silhouette")).distinct()
        text = ", ".join(f"{k}={v}" for k, v in sorted(s.items()))
        runs.append(topic_sizes(a).select("dataset", "n_comments", "n_topics", "n_outliers", "largest").distinct()
                    .join(sil, "dataset", "left")
                    .select("dataset", F.lit(i).alias("setting"), F.lit(text).alias("params"), "n_comments", "n_topics",
                            "n_outliers", "largest", "silhouette"))
    return reduce(DataFrame.unionByName, runs)

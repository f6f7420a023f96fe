"""Merge tree of a dataset's topics by average linkage, in rounds on Spark.

Average linkage may merge every two topics that are each other's nearest at once: a merged
topic is never nearer to a third than the nearer of its parts was, so the merges are those that one
merge at a time would make. The table of topic pairs holds sums of leaf cosines; merging is
relabelling both ends and summing, and the mean cosine of two nodes is their sum over the
product of their sizes. Pairs without a common term are not stored (their cosine is 0). No task holds
a topic-by-topic matrix; a round is a few joins and aggregates over the pairs left. Weights are packed
by term (``packed``) once; cosines and names are summed in the task of a term's bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyvox.operators import packed as P
from polyvox.operators.skew import per_dataset
from polyvox.sources.store import staged

NAME_TERMS = 5


#: Pairs of topics with a common term that are multiplied at once.
PRODUCTS = 1_000_000
#: Buckets of a file, so that a reader holds few at once.
ROWS_PER_FILE = 16


def by_term(weights: DataFrame) -> DataFrame:
    """``weights(dataset, t, term, weight)`` packed and written once, each bucket of terms a row: all topics of a term are in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dataset, bucket, rows in P.by_bucket(batches):
            terms, code, topics, weight = P.merged([P.part(size, data) for _, _, size, data in rows])
            order = np.argsort(code, kind="stable")
            many = np.bincount(code, minlength=len(terms))
            yield P.dealt(dataset, terms, np.full(len(terms), bucket, np.int32), np.cumsum(many) - many, many, [topics[order], weight[order]], 0)

    packed = P.packed_values(weights.filter("dataset is not null"), "weight", "t", P.buckets(weights.sparkSession))
    return staged(P.met(packed).mapInArrow(run, P.SCHEMA), "weights-by-term", ROWS_PER_FILE)


def topic_products(packed: DataFrame) -> DataFrame:
    """(dataset, a, b, s): sum of products of the weights of every two topics a <= b with a common term (a = b: the square
    of its length). A bucket's products are summed in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dataset, size, data in zip(*(b.column(k).to_pylist() for k in range(3))):
                _, many, topics, weight = P.part(size, data)
                names, of = np.unique(topics, return_inverse=True)
                last, n = np.cumsum(many), len(names)
                pairs = np.repeat(last, many) - np.arange(len(topics))  # an entry with itself and those of its term after it
                sums: dict[int, float] = {}
                ends = np.cumsum(pairs)
                lo = 0
                while lo < len(topics):
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PRODUCTS, side="right")))
                    left = np.repeat(np.arange(lo, hi), pairs[lo:hi])
                    right = P.spans(np.arange(lo, hi), pairs[lo:hi])
                    x, y = of[left], of[right]
                    key, back = np.unique(np.minimum(x, y) * n + np.maximum(x, y), return_inverse=True)
                    twice = np.where((x == y) & (left != right), 2.0, 1.0)  # a topic's term in two rows
                    for k, v in zip(key.tolist(), np.bincount(back, weights=twice * weight[left] * weight[right]).tolist()):
                        sums[k] = sums.get(k, 0.0) + v
                    lo = hi
                key = np.array(list(sums), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([dataset] * len(key), pa.string()), pa.array(names[key // n], pa.int32()),
                                                  pa.array(names[key % n], pa.int32()), pa.array(list(sums.values()), pa.float64())], ["dataset", "a", "b", "s"])

    out = packed.select("dataset", "size", "data").mapInArrow(run, "dataset string, a int, b int, s double")
    return out.groupBy("dataset", "a", "b").agg(F.sum("s").alias("s"))


def leaf_cosines(products: DataFrame) -> DataFrame:
    """(dataset, a, b, s): cosine of every two topics a < b with a common term, from ``topic_products``."""
    square = products.filter("a = b AND s > 0")
    of = lambda x: square.select("dataset", F.col("a").alias(x), F.col("s").alias(f"s{x}"))
    return (products.filter("a < b").join(of("a"), ["dataset", "a"]).join(of("b"), ["dataset", "b"])
            .select("dataset", "a", "b", (F.col("s") / F.sqrt(F.col("sa") * F.col("sb"))).alias("s")).filter("s > 0"))


def node_terms(packed: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(dataset, id, term, weight): of each node (dataset, id, members) its ``k`` terms with the largest sums of weights over its
    topics in every bucket; so no row is made per node and term. The tree, an entry per node and topic of it, goes to every bucket."""
    tree = nodes.groupBy("dataset").agg(F.collect_list(F.struct("id", "members")).alias("tree"))

    def best(ids: list[int], members: list[list[int]], part: P.Part) -> Iterator[tuple]:
        code = np.repeat(np.arange(len(part.terms)), part.many)
        order = np.argsort(part.topics, kind="stable")
        topics, code, weight = part.topics[order], code[order], part.values[order]
        for id_, own in zip(ids, members):
            own = np.array(own)
            lo, hi = np.searchsorted(topics, own), np.searchsorted(topics, own, side="right")
            at = P.spans(lo, hi - lo)
            if not len(at):
                continue
            if 4 * len(at) < len(part.terms):
                term, back = np.unique(code[at], return_inverse=True)
                total = np.bincount(back, weights=weight[at])
            else:
                term = np.flatnonzero(np.bincount(code[at], minlength=len(part.terms)))
                total = np.bincount(code[at], weights=weight[at], minlength=len(part.terms))[term]
            total = np.round(total, 9)
            some = np.flatnonzero(total >= np.partition(total, -k)[-k]) if len(total) > k else np.arange(len(total))
            names = part.terms.take(pa.array(term[some])).to_pylist()
            yield from ((id_, name, x) for x, name in sorted(zip(total[some].tolist(), names), key=lambda r: (-r[0], r[1]))[:k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                nodes_of = b.column(3)[i].as_py()
                rows = list(best([r["id"] for r in nodes_of], [r["members"] for r in nodes_of], P.part(b.column(1)[i].as_py(), b.column(2)[i].as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()),
                                                  pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64())],
                                                 ["dataset", "id", "term", "weight"])

    met = packed.select("dataset", "size", "data").join(per_dataset(tree), "dataset")
    return met.mapInArrow(run, "dataset string, id int, term string, weight double")


def _nearest_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes that are each other's nearest (ties: lower first topic, then lower second), with
    what is known of both: (dataset, a, b, distance, left, right)."""
    known = F.struct("n", "height", "members")
    of = lambda x: nodes.select("dataset", F.col("node").alias(x), known.alias(f"of_{x}"))
    sized = nodes.select("dataset", F.col("node"), "n")
    d = (pairs.join(sized.toDF("dataset", "a", "na"), ["dataset", "a"]).join(sized.toDF("dataset", "b", "nb"), ["dataset", "b"])
         .withColumn("distance", F.greatest(1 - F.col("s") / (F.col("na") * F.col("nb")), F.lit(0.0))))
    best = (d.select("dataset", F.explode(F.array("a", "b")).alias("node"), F.struct("distance", "a", "b").alias("p"))
            .groupBy("dataset", "node").agg(F.min("p").alias("p")))
    mutual = best.groupBy("dataset", "p").agg(F.count("*").alias("k")).filter("k = 2").select("dataset", "p.*")
    return mutual.join(of("a"), ["dataset", "a"]).join(of("b"), ["dataset", "b"])


def merges(cosines: DataFrame, topics: DataFrame) -> DataFrame:
    """Every merge of every dataset's tree: (dataset, a, na, b, nb, height, members).

    A node is named by its smallest topic and its number of topics. Heights don't fall towards
    the root. Nodes that share no term with any other are joined last, at distance 1, in order of
    their smallest topic."""
    nodes = staged(topics.select("dataset", F.col("t").alias("node"), F.lit(1).alias("n"), F.lit(0.0).alias("height"),
                                 F.array("t").alias("members")), "nodes")
    pairs, found = staged(cosines, "pairs"), []
    while True:
        got = _nearest_pairs(pairs, nodes).select(
            "dataset", "a", F.col("of_a.n").alias("na"), "b", F.col("of_b.n").alias("nb"),
            F.greatest("distance", "of_a.height", "of_b.height").alias("height"),
            F.array_sort(F.concat("of_a.members", "of_b.members")).alias("members"))
        got = staged(got, "merges")
        if got.isEmpty():
            break
        found.append(got)
        ends = got.select("dataset", F.explode(F.array("a", "b")).alias("node"), "a")
        to = lambda x: ends.select("dataset", F.col("node").alias(x), F.col("a").alias(f"to_{x}"))
        moved = (pairs.join(to("a"), ["dataset", "a"], "left").join(to("b"), ["dataset", "b"], "left")
                 .select("dataset", F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"), "s").filter("a <> b"))
        pairs = staged(moved.groupBy("dataset", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")), "pairs")
        made = got.select("dataset", F.col("a").alias("node"), (F.col("na") + F.col("nb")).alias("n"), "height", "members")
        nodes = staged(nodes.join(ends.select("dataset", "node"), ["dataset", "node"], "left_anti").unionByName(made), "nodes")
    # what is left has no pair; one row per node of a dataset
    before = Window.partitionBy("dataset").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    rest = (nodes.withColumns({"a": F.first("node").over(before), "na": F.sum("n").over(before),
                               "seen": F.flatten(F.collect_list("members").over(before))}).filter("a is not null")
            .select("dataset", "a", F.col("na").cast("int").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb"), F.lit(1.0).alias("height"),
                    F.array_sort(F.concat("seen", "members")).alias("members")))
    return reduce(DataFrame.unionByName, found, rest)


def hierarchy(weights: DataFrame, topic: str = "topicId") -> DataFrame:
    """Binary merge tree of each dataset's topics: (dataset, Parent_ID, Parent_Name, Topics,
    Child_Left_ID, Child_Left_Name, Child_Right_ID, Child_Right_Name, Distance).

    Distance is the mean over leaf pairs of 1 - cosine of their c-TF-IDF vectors and doesn't fall. New ids
    go on from the largest topic id in order of (Distance, number of topics, smallest topic);
    the left child has the smaller id. A node's name is the five terms with the largest sum of weights over all its topics."""
    w = weights.filter(F.col(topic) >= 0).select("dataset", F.col(topic).cast("int").alias("t"), "term", "weight")
    packed = by_term(w)
    products = staged(topic_products(packed), "products")
    topics = products.filter("a = b").select("dataset", F.col("a").alias("t"))
    tree = staged(merges(leaf_cosines(products), topics), "tree")
    top = topics.groupBy("dataset").agg(F.max("t").alias("top"))
    order = Window.partitionBy("dataset").orderBy("height", F.col("na") + F.col("nb"), "a")  # a row per topic
    numbered = staged(tree.withColumn("rank", F.row_number().over(order)).join(top, "dataset")
                      .withColumn("id", (F.col("top") + F.col("rank")).cast("int")), "numbered")
    leaves = topics.select("dataset", F.col("t").alias("node"), F.lit(1).alias("n"), F.col("t").alias("id"), F.array("t").alias("members"))
    inner = numbered.select("dataset", F.col("a").alias("node"), (F.col("na") + F.col("nb")).alias("n"), "id", "members")
    nodes = leaves.unionByName(inner)
    terms = node_terms(packed, nodes.select("dataset", "id", "members"), NAME_TERMS)
    best = Window.partitionBy("dataset", "id").orderBy(F.desc("weight"), "term")
    names = (terms.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= NAME_TERMS).groupBy("dataset", "id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]), "_").alias("name")))
    child = staged(nodes.join(names, ["dataset", "id"]).select("dataset", "node", "n", F.struct("id", "name").alias("c")), "named")
    side = lambda x: child.toDF("dataset", x, f"n{x}", f"c{x}")
    own = names.select("dataset", "id", F.col("name").alias("Parent_Name"))
    low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
    return (numbered.join(side("a"), ["dataset", "a", "na"]).join(side("b"), ["dataset", "b", "nb"]).join(own, ["dataset", "id"])
            .select("dataset", F.col("id").alias("Parent_ID"), "Parent_Name", F.col("members").alias("Topics"),
                    low["id"].alias("Child_Left_ID"), low["name"].alias("Child_Left_Name"),
                    high["id"].alias("Child_Right_ID"), high["name"].alias("Child_Right_Name"), F.col("height").alias("Distance")))

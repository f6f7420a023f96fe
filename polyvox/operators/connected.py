"""Connected components by alternating star steps.

A large-star step links every larger neighbour of a node to the node's smallest neighbour, a
small-star step does the same for the smaller ones; both keep connectivity, and after about
log(n) rounds each component is a star around its smallest node, however long its paths were.
Nodes with very many edges are split by ``salted_join``; edges are written and reread every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.operators.skew import salted_join
from polyvox.sources.store import staged

KEY = ["dataset", "u"]


def _least(e: DataFrame) -> DataFrame:
    return e.groupBy(*KEY).agg(F.min("v").alias("m"))


def connected(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Components of undirected ``edges(dataset, src, dst)``: (dataset, node, label), label being the
    component's smallest node. Nodes without an edge to another node are absent. Raises if
    ``max_rounds`` don't suffice."""
    e = staged(edges.filter("src <> dst").select("dataset", F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges")
    seen = _state(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select("dataset", F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both).withColumn("m", F.least("u", "m"))
        large = (salted_join(both, low, KEY, ["v"]).filter("v > u AND v <> m")
                 .select("dataset", F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        pair = lambda a: F.struct(F.col(a).alias("u"), F.col("m").alias("v"))
        small = (salted_join(large, _least(large), KEY, ["v"])
                 .select("dataset", F.explode(F.array(pair("u"), pair("v"))).alias("p")))
        e = staged(small.select("dataset", "p.u", "p.v").filter("u <> v").distinct(), "edges")
        now = _state(e)
        if now == seen:
            star = e.select("dataset", F.col("u").alias("node"), F.col("v").alias("label"))
            return star.unionByName(e.select("dataset", F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(e: DataFrame) -> tuple:
    """Two independent digests and the number of edges: equal states mean nothing moved."""
    return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(dataset, u, v))"), F.expr("bit_xor(xxhash64(v, u, dataset))")).first())

"""Distributed ranks, whole sentences, Markdown blocks, source fallback and plug-ins."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from polyvox.functions import argdown as A
from polyvox.functions.exprs import first_sentence
from polyvox.operators import arguments as AR
from polyvox.operators import embed as EM
from polyvox.operators import maprender as M
from polyvox.operators import moderation as MO
from polyvox.operators import select as C
from polyvox.operators.rank import running
from polyvox.sources import io


@pytest.fixture()
def many_partitions(spark):
    """Spark would put these few rows into one partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranks_and_sums_span_partitions(spark, many_partitions):
    rng = random.Random(1)
    rows = [("big" if i % 7 else "small", rng.randrange(40), i, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, id int, w bigint").repartition(6)
    ranked = running(df, ["g"], [F.desc("x"), "id"], "r")
    want = {}
    for g in ("big", "small"):
        want |= {r[2]: k for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1)}
    assert {r["id"]: r["r"] for r in ranked.collect()} == want
    # one dataset's ranks come from many tasks
    parts = df.repartitionByRange("g", F.desc("x"), "id").select("g", F.spark_partition_id().alias("p")).filter("g = 'big'").distinct()
    assert parts.count() > 1
    sums = running(df, ["g"], ["id"], "s", "w").filter("g = 'big'").orderBy("id").collect()
    assert [r["s"] for r in sums] == np.cumsum([r[3] for r in rows if r[0] == "big"]).tolist()
    assert running(df.filter("1 = 0"), ["g"], ["id"], "s").count() == 0


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.97, 1.0])
def test_quantiles_stay_exact(spark, many_partitions, q):
    rng = random.Random(2)
    rows = [(d, rng.choice([rng.random(), 0.5, 1.0])) for d, n in (("a", 500), ("b", 7), ("c", 1)) for _ in range(n)] + [("a", None)]
    got = {r["d"]: r["__t"] for r in C.group_quantile(spark.createDataFrame(rows, "d string, v double"), ["d"], "v", q).collect()}
    assert got == {d: pytest.approx(np.quantile([v for e, v in rows if e == d and v is not None], q)) for d in "abc"}


SENTENCES = [("Dr. Smith and Prof. Lee agree. The rest waits.", "Dr. Smith and Prof. Lee agree."), ("About 3.5 km of road! Then more", "About 3.5 km of road!"),
             ("\n\n led by newlines. x", "led by newlines."), ("no end at all", "no end at all"), ("first line\nsecond.", "first line"),
             ("e.g. trees, i.e. shade? Yes.", "e.g. trees, i.e. shade?"), ("", ""), ("   ", ""), ("v1.2.3 is out. ok", "v1.2.3 is out."), (None, None)]


def test_first_sentence_is_whole(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SENTENCES)], "i int, s string")
    got = {r["i"]: r["f"] for r in df.select("i", first_sentence("s").alias("f")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(SENTENCES)}


def test_markdown_blocks(spark):
    df = spark.createDataFrame([("d", "body")], "dataset string, b string")
    r = df.select(A.markdown(F.col("b")).alias("m"), A.markdown(F.col("b"), as_map=True).alias("p")).first()
    assert r.m == "```argdown\n" + A.FRONT_MATTER + "body\n\n```\n" and r.p.startswith("```argdown-map\n===\n")
    lines = M._row(df, 1, F.lit("x\n"))
    got = [x["text"] for x in M.fenced(lines).orderBy("section").collect()]
    assert got == ["```argdown-map\n", "x\n", "\n```\n"]


def test_comments_come_from_parquet_where_written(spark, tmp):
    raw, data = f"{tmp}/raw", f"{tmp}/data"
    for d, text in (("one", "raw one"), ("two", "raw two")):
        os.makedirs(f"{raw}/{d}")
        with open(f"{raw}/{d}/comments.csv", "w") as fh:
            fh.write(f"timestamp,datetime,comment-id,author-id,agrees,disagrees,moderated,comment-body\n1,x,5,9,2,1,1,{text}\n")
    texts = lambda **kw: sorted(r["commentText"] for r in io.load_comments(spark, data, raw, **kw).collect())
    assert texts() == ["raw one", "raw two"] and texts(datasets=["two"]) == ["raw two"]
    one = io.load_comments(spark, data, raw, ["one"]).withColumn("commentText", F.lit("kept")).withColumn("embedding", F.array(F.lit(1.0)))
    io.write_table(one, data, "comments")
    assert texts() == ["kept", "raw two"] and texts(datasets=["one"]) == ["kept"] and texts(datasets=["two"]) == ["raw two"]
    assert "embedding" not in io.load_comments(spark, data, raw).columns


def test_plugged_in_models_run(spark):
    docs = spark.createDataFrame([("d", i, "word " * i) for i in range(20)], "dataset string, commentId bigint, commentText string")
    vecs = EM.encode_with(docs, lambda texts: np.array([[len(t), 1.0] for t in texts]), model="length")
    assert {(r["commentId"], tuple(r["embedding"]), r["model"]) for r in vecs.collect()} == {(i, (5.0 * i, 1.0), "length") for i in range(20)}

    def label(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"commentId": b["commentId"], "classification": ["ACCEPT" if len(t) > 20 else "UNSURE" for t in b["commentText"]]})
    got = MO.score_with(docs, label, "commentId bigint, classification string")
    assert got.filter("classification = 'ACCEPT'").count() == 15

    args = spark.createDataFrame([("d", 1, 0, "t", "word"), ("d", 1, 1, "u", "no")],
                                 "dataset string, topicId int, argumentId bigint, argumentTitle string, argumentContent string")
    pairs = AR.pair_prompts(docs.withColumn("topicId", F.lit(1)), args)

    def relate(b: pd.DataFrame) -> pd.DataFrame:
        return b[["commentId", "argumentId"]].assign(relationship=["SUPPORT" if "ARGUMENT: t. word" in p else "UNRELATED" for p in b["prompt"]])
    got = AR.score_pairs_with(pairs, relate, "commentId bigint, argumentId bigint, relationship string", partitions=3)
    assert {(r["argumentId"], r["relationship"], r["n"]) for r in got.groupBy("argumentId", "relationship").agg(F.count("*").alias("n")).collect()} \
        == {(0, "SUPPORT", 20), (1, "UNRELATED", 20)}


def test_refute_needs_a_negation_on_one_side(spark):
    s = spark.createDataFrame([("d", 1, 1, "we need the new bridge"), ("d", 1, 2, "we never need the new bridge"), ("d", 1, 3, "trees")],
                              "dataset string, topicId int, commentId bigint, commentText string")
    a = spark.createDataFrame([("d", 1, 0, "we need the new bridge")], "dataset string, topicId int, argumentId bigint, argumentContent string")
    got = {r["commentId"]: (r["relationship"], r["reasoning"]) for r in AR.correlate(s, a).collect()}
    assert got == {1: ("SUPPORT", "REASON: shares 5 of 5 words"), 2: ("REFUTE", "REASON: shares 5 of 5 words"), 3: ("UNRELATED", None)}

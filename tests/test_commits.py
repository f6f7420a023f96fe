"""Commit records: whole writes or none, repeats, empty results, replacing what is being read."""

import os

import pytest
from pyspark.sql import functions as F

from polyvox.plans import tasks
from polyvox.sources import commits, io

T = "dataset string, v int"


def rows(spark, root):
    return sorted((r["dataset"], r["v"]) for r in io.read_table(spark, root, "t").collect())


def failing(spark):
    """A table whose last rows can't be computed."""
    return spark.range(100, numPartitions=4).select(
        F.when(F.col("id") < 50, "x").otherwise("y").alias("dataset"),
        F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("int").alias("v"))


@pytest.mark.parametrize("add", [False, True])
def test_failed_write_leaves_nothing_and_can_be_repeated(spark, tmp, add):
    write = io.append_table if add else io.write_table
    with pytest.raises(Exception, match="killed"):
        write(failing(spark), tmp, "t", run="r0")
    assert not io.exists(spark, f"{tmp}/t")
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, tmp, "t")
    io.write_table(spark.createDataFrame([("x", 1), ("z", 2)], T), tmp, "t", run="r1")
    with pytest.raises(Exception, match="killed"):
        write(failing(spark), tmp, "t", run="r2")
    assert rows(spark, tmp) == [("x", 1), ("z", 2)]
    # all rows written, driver lost before the record
    spark.createDataFrame([("x", 7)], T).write.partitionBy("dataset").parquet(f"{tmp}/t/rows/run=r3")
    assert rows(spark, tmp) == [("x", 1), ("z", 2)]
    for _ in range(3):  # the same run again, more than once
        write(spark.createDataFrame([("x", 8), ("x", 9)], T), tmp, "t", run="r3")
    kept = [("x", 1), ("x", 8), ("x", 9), ("z", 2)] if add else [("x", 8), ("x", 9), ("z", 2)]
    assert rows(spark, tmp) == kept


def test_empty_datasets_are_empty_commits(spark, tmp):
    io.write_table(spark.createDataFrame([("x", 1), ("2024-01-01", 2), ("007", 3)], T), tmp, "t")
    assert rows(spark, tmp) == [("007", 3), ("2024-01-01", 2), ("x", 1)]  # names stay text
    worked = spark.createDataFrame([("x",), ("007",)], "dataset string")
    io.write_table(spark.createDataFrame([("007", 4)], T), tmp, "t", worked)
    assert rows(spark, tmp) == [("007", 4), ("2024-01-01", 2)]
    io.append_table(spark.createDataFrame([("x", 5)], T), tmp, "t")
    assert rows(spark, tmp) == [("007", 4), ("2024-01-01", 2), ("x", 5)]
    io.write_table(spark.createDataFrame([], T), tmp, "t", spark.createDataFrame([("x",), ("007",), ("2024-01-01",)], "dataset string"))
    assert rows(spark, tmp) == [] and io.read_table(spark, tmp, "t").columns == ["v", "dataset"]
    got = {(r["seq"], r["dataset"]): (r["replaces"], r["n"]) for r in commits.records(spark, f"{tmp}/t").collect()}
    assert got[2, "x"] == (True, 0) and got[2, "007"] == (True, 1) and got[3, "x"] == (False, 1) and len(got) == 9


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp):
    io.write_table(spark.createDataFrame([("x", i) for i in range(5)] + [("y", 9)], T), tmp, "t")
    before = io.read_table(spark, tmp, "t")
    io.write_table(before.filter("dataset = 'x'").withColumn("v", F.col("v") * 10), tmp, "t")
    assert rows(spark, tmp) == [("x", 10 * i) for i in range(5)] + [("y", 9)]
    assert sorted(r["v"] for r in before.collect()) == [0, 1, 2, 3, 4, 9]  # a reader that had begun
    assert commits.vacuum(spark, f"{tmp}/t") == []  # y still comes from the first write
    io.write_table(io.read_table(spark, tmp, "t"), tmp, "t")
    assert len(commits.vacuum(spark, f"{tmp}/t")) == 2 and len(os.listdir(f"{tmp}/t/rows")) == 1
    assert rows(spark, tmp) == [("x", 10 * i) for i in range(5)] + [("y", 9)]


def test_columns_of_the_newest_write_and_plain_folders(spark, tmp):
    io.write_table(spark.createDataFrame([("x", 1), ("y", 2)], T), tmp, "t")
    io.write_table(spark.createDataFrame([("x", 3, "w")], T + ", w string"), tmp, "t")
    assert {tuple(r) for r in io.read_table(spark, tmp, "t").select("dataset", "v", "w").collect()} == {("x", 3, "w"), ("y", 2, None)}
    with pytest.raises(ValueError, match="columns differ"):
        io.append_table(spark.createDataFrame([("x", 3)], T), tmp, "t")
    spark.createDataFrame([("x", 1)], T).write.partitionBy("dataset").parquet(f"{tmp}/plain")
    assert io.exists(spark, f"{tmp}/plain") and io.read_table(spark, tmp, "plain").count() == 1
    with pytest.raises(ValueError, match="without commit records"):
        io.append_table(spark.createDataFrame([(1, "x")], "v int, dataset string"), tmp, "plain")


def test_resumed_and_repeated_task_runs(spark, tmp):
    """A run repeated under its name changes nothing; a resumed one adds only topics without arguments."""
    text = "the new bridge needs lights and more trees near the river number {}"
    summary = spark.createDataFrame([("d", "topic", "City"), ("e", "topic", "Town")], "dataset string, key string, value string")
    comments = spark.createDataFrame([("d", t, 10 * t + i, text.format(i), 9, 1, 0.9, 1) for t in (0, 1) for i in range(8)],
        "dataset string, topicId int, commentId int, commentText string, agrees int, disagrees int, agreeability double, moderated int")
    ctx = tasks.Context(raw_root=tmp, data_root=tmp, options={"run": "first"})
    io.write_table(summary, tmp, "summary")
    io.write_table(comments.filter("topicId = 0"), tmp, "comments_topics")
    read = lambda: sorted(map(str, io.read_table(spark, tmp, "arguments").collect()))
    assert tasks.run(spark, ["generate", "generate"], ctx) == {"generate": "ok"}
    first = read()
    assert first and len(commits.records(spark, f"{tmp}/arguments").select("run").distinct().collect()) == 1
    assert commits.records(spark, f"{tmp}/arguments").filter("dataset = 'e' and n = 0").count() == 1
    io.write_table(comments, tmp, "comments_topics")
    ctx = tasks.Context(raw_root=tmp, data_root=tmp, options={"run": "second", "resume": True})
    assert tasks.run(spark, ["generate", "generate"], ctx) == {"generate": "ok"}
    assert set(first) < set(read()) and io.read_table(spark, tmp, "arguments").select("topicId").distinct().count() == 2

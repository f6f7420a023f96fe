"""L1: the running tally equals the batch tally of what has arrived, at every point."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from polyvox.operators.votes import comment_tally, latest_vote
from polyvox.streaming import votes as SV

LOG = "dataset string, commentId bigint, voterId bigint, vote int, ts timestamp, event_id bigint"


def votes(n, seed):
    """Re-votes, passes, repeated stands, equal timestamps and votes that arrive late."""
    rng = random.Random(seed)
    return [(rng.choice("ab"), rng.randrange(4), rng.randrange(12), rng.choice([1, 1, -1, 0]), rng.randrange(60), i) for i in range(n)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "dataset string, commentId bigint, voterId bigint, vote int, s bigint, event_id bigint")
    return df.select("dataset", "commentId", "voterId", "vote", F.timestamp_seconds("s").alias("ts"), "event_id")


def batch_tally(spark, rows):
    latest = latest_vote(frame(spark, rows), ["ts", "event_id"])
    return {tuple(r) for r in comment_tally(latest).select("dataset", "commentId", "agrees", "disagrees").collect()}


@pytest.fixture()
def running(spark, tmp):
    path = f"{tmp}/log-{uuid.uuid4().hex}"
    first = frame(spark, votes(1, 0)).filter("1 = 0")
    stream = spark.readStream.schema(first.schema).parquet(f"{path}/chunk=*")
    return path, stream, f"{tmp}/tally"


def now(tally):
    return {tuple(r) for r in tally.current().collect()}


def test_tally_follows_every_prefix(spark, running):
    path, stream, base = running
    log, chunks = [], [votes(80, 1), votes(80, 2), [("a", 0, 1, 1, -5, 900)], votes(60, 3)]  # the third is a late vote alone
    for i, chunk in enumerate(chunks):
        frame(spark, chunk).coalesce(2).write.parquet(f"{path}/chunk={i}")
        log += chunk
        tally = SV.RunningTally(stream, ["ts", "event_id"], base)  # a new run resumes from its checkpoints
        tally.advance()
        assert now(tally) == batch_tally(spark, log)
    tally.advance()  # nothing new
    assert now(tally) == batch_tally(spark, log)
    # a voter who changed their mind leaves the old side
    changes = spark.read.parquet(f"{base}/changes").select("agrees", "disagrees").collect()
    assert {(-1, 1), (1, -1), (1, 0), (0, 1)} == {tuple(r) for r in changes}


@pytest.mark.parametrize("which", ["changes", "tally"])
def test_a_repeated_batch_counts_once(spark, running, which):
    path, stream, base = running
    log = []
    for i in range(2):
        chunk = votes(50, 10 + i)
        frame(spark, chunk).coalesce(1).write.parquet(f"{path}/chunk={i}")
        log += chunk
        tally = SV.RunningTally(stream, ["ts", "event_id"], base)
        tally.advance()
    # as if the driver had died after writing the last batch, before noting that it was done
    commits = f"{base}/{which}-checkpoint/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (f"{commits}/{last}", f"{commits}/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    tally = SV.RunningTally(stream, ["ts", "event_id"], base)
    tally.advance()
    assert now(tally) == batch_tally(spark, log)


def test_empty_log(spark, running):
    path, stream, base = running
    frame(spark, votes(5, 0)).filter("1 = 0").write.parquet(f"{path}/chunk=0")
    tally = SV.RunningTally(stream, ["ts", "event_id"], base)
    assert tally.current().count() == 0
    tally.advance()
    assert tally.current().count() == 0

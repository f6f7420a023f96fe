"""L1: the votes of many voters are kept in few groups, whose calls don't grow with the voters (F16)."""

import random

from pyspark.sql import functions as F

from polyvox.operators.votes import comment_tally, latest_vote
from polyvox.streaming import votes as SV


def test_votes_are_kept_by_groups(spark, tmp):
    rng = random.Random(16)
    some = lambda values: rng.choice([*values, None])
    rows = [("a", v % 7, v, rng.choice([1, -1]), v % 50, v) for v in range(6000)]
    odd = [(rng.choice("ab"), some(range(3)), some(range(9)), rng.choice([1, -1, 0, None]), some(range(1 << 53, (1 << 53) + 4)), i) for i in range(6000, 6400)]
    schema = "dataset string, commentId bigint, voterId bigint, vote int, s bigint, event_id bigint"
    log = spark.createDataFrame(rows + odd, schema).select(*[c for c in ("dataset", "commentId", "voterId", "vote", "event_id")], F.timestamp_micros("s").alias("ts"))
    for i in range(2):
        log.filter(f"event_id % 2 = {i}").coalesce(1).write.parquet(f"{tmp}/log/chunk={i}")
    stream = SV.file_stream(spark, f"{tmp}/log", log.schema)
    query = (SV.vote_changes(stream, ["ts", "event_id"]).writeStream.format("parquet").option("path", f"{tmp}/changes")
             .option("checkpointLocation", f"{tmp}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    kept = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert len(kept) >= 2 and max(kept) <= 2 * SV.VOTE_GROUPS < 2 * 6000 and max(kept) < 6000
    got = spark.read.parquet(f"{tmp}/changes").groupBy("dataset", "commentId").agg(F.sum("agrees"), F.sum("disagrees"))
    want = comment_tally(latest_vote(log, ["ts", "event_id"])).select("dataset", "commentId", "agrees", "disagrees")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}

"""Structured Streaming forms of the vote operators (L1, L2).

* L1, running tally: keyed state holds each voter's latest vote and turns every
  change of mind into a change record (old vote out, new vote in); a second
  streaming aggregate sums the records, so a re-vote retracts the vote before.

* L1: latest vote per (comment, voter) as a streaming aggregate. ``max`` of
  (time, tie-break, vote) is order-free, so any micro-batch split gives
  the batch E1 result. State lives in the state store (RocksDB provider when
  none is configured); output goes through an idempotent ``foreachBatch``
  sink, one folder per batch id, so a replayed batch overwrites itself.
* L2: votes per comment per event-time window with a watermark; append
  mode emits a window once the watermark passes it, late votes are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from polyvox.session import checkpoint_dir
from polyvox.sources.io import exists

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _prefer_rocksdb(spark: SparkSession) -> None:
    key = "spark.sql.streaming.stateStore.providerClass"
    try:
        if not spark.conf.get(key, None):
            spark.conf.set(key, ROCKSDB)
    except Exception:  # noqa: BLE001 - already fixed by a running query
        pass


def stage_log(log: DataFrame, path: str, ts: str = "ts", chunks: int = 4, files: int = 1) -> str:
    """Write a batch log as ``chunks`` time-ordered groups of exactly ``files`` files
    under ``path`` (simulated arrival order for a file stream). Chunk bounds are
    ``chunks - 1`` approximate quantiles of ``ts`` (a handful of values).

    Read it with ``files_per_trigger=files``: a micro-batch is then a whole
    chunk. Were a chunk spread over several batches, its first file would move
    the watermark past the rows of its other files, and they would be dropped.
    Raises if a chunk has too few rows for its files."""
    spark = log.sparkSession
    epoch = F.unix_micros(F.col(ts).cast("timestamp"))
    qs = log.select(F.percentile_approx(epoch, [i / chunks for i in range(1, chunks)], 10000)
                    .alias("q")).first()["q"] if chunks > 1 else []
    bounds = [None, *sorted(set(qs or [])), None]
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (epoch >= lo)
        if hi is not None:
            cond = cond & (epoch < hi)
        part = f"{path}/chunk={i:04d}"
        log.filter(cond).repartition(files).write.parquet(part)
        found = spark.read.parquet(part).select(F.input_file_name()).distinct().count()
        if found != files:
            raise ValueError(f"chunk {i} has rows for {found} of {files} files")
    return path


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(f"{path}/chunk=*"))


def latest_vote_stream(log: DataFrame, order: list[str],
                       keys: tuple[str, ...] = ("dataset", "commentId", "voterId"),
                       ts: str = "ts") -> DataFrame:
    """L1: streaming E1 (passes dropped first, as in the batch rule)."""
    last = F.max(F.struct(*[F.col(c) for c in order], F.col("vote").alias("__vote")))
    return (log.filter(F.col("vote") != 0).groupBy(*keys).agg(last.alias("__last"))
            .select(*keys, F.col("__last.__vote").alias("vote"),
                    F.col(f"__last.{ts}").alias("timestamp")))


def window_counts(log: DataFrame, ts: str = "ts", size: str = "1 day",
                  watermark: str | None = None) -> DataFrame:
    """L2 (and its batch twin without ``watermark``): agrees / disagrees /
    passes per comment per event-time window."""
    src = log
    if watermark is not None:
        # watermarks need TIMESTAMP, not TIMESTAMP_NTZ
        src = src.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    w = F.window(ts, size)
    out = (src.groupBy("dataset", w.alias("w"), "commentId")
           .agg(F.count_if(F.col("vote") == 1).alias("agrees"),
                F.count_if(F.col("vote") == -1).alias("disagrees"),
                F.count_if(F.col("vote") == 0).alias("passes")))
    return out.select("dataset", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      "commentId", "agrees", "disagrees", "passes")


CHANGES = "dataset string, commentId bigint, agrees int, disagrees int"


#: Groups that the voters' votes of a dataset are kept in. A checkpoint belongs to its number; a group holds about 40
#: bytes per voter and comment, all of which are read and written when a vote of the group arrives.
VOTE_GROUPS = 4096


def vote_changes(log: DataFrame, order: list[str], groups: int = VOTE_GROUPS) -> DataFrame:
    """L1, first level: change records ``(dataset, commentId, agrees, disagrees)`` with -1, 0 or 1.

    Kept per (dataset, commentId, voterId) is the latest vote so far and its place in ``order`` (the
    timestamp, then integer tie-breaks; null comes first). A vote that comes later in the stream but earlier in
    that order changes nothing, nor does one that repeats the voter's stand; passes don't count. Votes are kept by
    ``groups`` hashed groups of (commentId, voterId), sorted arrays that a batch's votes are merged into, so a
    batch costs a call per group and not one per voter and comment."""
    ids = {"c": F.col("commentId"), "v": F.col("voterId")}
    places = {"o0": F.unix_micros(F.col(order[0]).cast("timestamp")), **{f"o{i}": F.col(c) for i, c in enumerate(order[1:], 1)}}
    given = {k: v.cast("bigint") for k, v in (ids | places).items()}
    # pandas would turn whole numbers with nulls into floats: a number and whether there is one
    cols = [c for k, v in given.items() for c in (F.coalesce(v, F.lit(0)).alias(k), v.isNotNull().cast("byte").alias(f"{k}_set"))]
    kind = np.dtype([*[f for k in given for f in ((k, np.int64), (f"{k}_set", np.int8))], ("vote", np.int32)])
    key = [f for k in ids for f in (f"{k}_set", k)]
    ranked = [*key, *[f for k in places for f in (f"{k}_set", k)], "vote"]

    def arrived(b: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(b), kind)
        for f in kind.names:
            out[f] = b[f].to_numpy()
        return out

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = bytes(state.get[0]) if state.exists else b""
        old = np.frombuffer(kept, kind)
        rows = np.concatenate([old, *map(arrived, batches)])
        at = np.lexsort([rows[f] for f in reversed(ranked)])
        rows, stood = rows[at], np.where(at < len(old), rows["vote"][at], 0).astype(np.int64)
        if not len(rows):
            return
        new = np.ones(len(rows), bool)  # where the next voter or comment begins
        new[1:] = np.logical_or.reduce([rows[f][1:] != rows[f][:-1] for f in key])
        latest = rows[np.append(new[1:], True)]
        was, now = np.add.reduceat(stood, np.flatnonzero(new)), latest["vote"]
        if latest.tobytes() != kept:
            state.update((latest.tobytes(),))
        moved = now != was
        if moved.any():
            was, now, of = was[moved], now[moved], latest[moved]
            yield pd.DataFrame({"dataset": [group[0]] * len(of), "commentId": pd.arrays.IntegerArray(of["c"].copy(), of["c_set"] == 0),
                                "agrees": (now == 1).astype(np.int32) - (was == 1), "disagrees": (now == -1).astype(np.int32) - (was == -1)})

    return (log.filter("vote <> 0").select("dataset", F.pmod(F.xxhash64("commentId", "voterId"), F.lit(groups)).alias("group"), *cols,
                                           F.col("vote").cast("int").alias("vote"))
            .groupBy("dataset", "group")
            .applyInPandasWithState(step, CHANGES, "votes binary", "append", GroupStateTimeout.NoTimeout))


class RunningTally:
    """L1: agrees and disagrees per comment, kept up to date by two streaming queries.

    The first writes change records to a log of files that only lists files of completed batches, so a
    repeated batch adds nothing; the second sums them per comment (update mode) into one folder per batch,
    which a repeated batch overwrites. Both resume from their checkpoints under ``base``."""

    def __init__(self, votes: DataFrame, order: list[str], base: str):
        self.votes, self.order, self.base = votes, order, base.rstrip("/")
        self.spark = votes.sparkSession

    def advance(self) -> None:
        """Take in every vote that has arrived."""
        _prefer_rocksdb(self.spark)
        changes = (vote_changes(self.votes, self.order).writeStream.outputMode("append").format("parquet")
                   .option("path", f"{self.base}/changes").option("checkpointLocation", f"{self.base}/changes-checkpoint")
                   .trigger(availableNow=True).start())
        changes.awaitTermination()
        log = self.spark.readStream.schema(CHANGES).parquet(f"{self.base}/changes")
        sums = log.groupBy("dataset", "commentId").agg(F.sum("agrees").alias("agrees"), F.sum("disagrees").alias("disagrees"))

        def sink(df: DataFrame, batch_id: int) -> None:
            df.write.mode("overwrite").parquet(f"{self.base}/tally/batch={batch_id}")

        tally = (sums.writeStream.outputMode("update").foreachBatch(sink)
                 .option("checkpointLocation", f"{self.base}/tally-checkpoint").trigger(availableNow=True).start())
        tally.awaitTermination()

    def current(self) -> DataFrame:
        """The tally as of the last ``advance``: each comment's sums from the last batch that changed them."""
        schema = "dataset string, commentId bigint, agrees bigint, disagrees bigint, batch bigint"
        if not exists(self.spark, f"{self.base}/tally"):
            return self.spark.createDataFrame([], schema).drop("batch")
        return (self.spark.read.schema(schema).parquet(f"{self.base}/tally").groupBy("dataset", "commentId")
                .agg(F.max_by(F.struct("agrees", "disagrees"), "batch").alias("r")).select("dataset", "commentId", "r.*"))


def run_available(stream: DataFrame, name: str, mode: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a streaming query over all available input (``availableNow``) into
    an idempotent per-batch parquet sink in the checkpoint folder and return
    the result as a batch DataFrame.

    ``complete`` mode: the last batch holds the whole result; ``append``
    mode: the union of all batches; ``update`` mode: a batch holds only the keys
    that changed, and the last row of each of ``keys`` counts."""
    spark = stream.sparkSession
    _prefer_rocksdb(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/polyvox-streams/{name}"
    out = f"{base}/out"
    last = {"id": None}

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last["id"] = batch_id

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if last["id"] is None:  # nothing new: earlier batches of a restarted query are the result
        if not exists(spark, out):
            return spark.createDataFrame([], stream.schema)
    done = spark.read.parquet(out)
    if mode == "complete":
        done = done.filter(F.col("batch") == done.agg(F.max("batch")).first()[0])
    if mode == "update":
        rest = [c for c in stream.columns if c not in keys]
        newest = F.max_by(F.struct(*rest), "batch").alias("__r")
        return done.groupBy(*keys).agg(newest).select(*keys, "__r.*").select(*stream.columns)
    return done.drop("batch")


def participation(votes_log: DataFrame, ts: str = "ts", size: str = "1 day") -> DataFrame:
    """Per dataset and day: votes, distinct voters, running total of votes.
    The running sum is over the (small) daily table."""
    from pyspark.sql import Window
    daily = (votes_log.groupBy("dataset", F.window(ts, size).alias("w"))
             .agg(F.count("*").alias("votes"), F.count_distinct("voterId").alias("voters"))
             .select("dataset", F.col("w.start").cast("timestamp_ntz").alias("day"), "votes", "voters"))
    w = Window.partitionBy("dataset").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("votes_to_date", F.sum("votes").over(w).cast("bigint"))

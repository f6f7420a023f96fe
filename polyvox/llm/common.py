"""Helpers shared by the operators: distinct texts, staged tables, batches, components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polyvox.session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    root = re.sub(r"^file:/+", "file:///", checkpoint_dir(spark).rstrip("/"))
    if ":" not in root:
        root = f"file://{root}"
    return f"{root}/llm-{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and scan it: lineage ends there, so a
    lost executor re-reads files instead of repeating the work before."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_id(col: str | Column = "text") -> Column:
    """128-bit identity of a text (null counts as empty)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unhex(F.md5(F.coalesce(c, F.lit("")).cast("binary")))


def distinct_texts(docs: DataFrame, extra: Column | None = None) -> DataFrame:
    """One row per distinct text: ``tid, text, copies, min_id``.

    Exact copies meet in a sorted aggregate with map-side combine, so a text
    held by a third of all rows costs one row per map task, not one per copy.
    ``min_id`` is the smallest doc_id (null if all are null). ``extra`` adds a
    column ``extra`` with that expression's value for the smallest doc_id.
    """
    d = docs.select(text_id().alias("tid"), F.coalesce("text", F.lit("")).alias("text"),
                    F.col("doc_id").cast("long").alias("__id"),
                    *([extra.alias("__extra")] if extra is not None else []))
    aggs = [F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"),
            F.min("__id").alias("min_id")]
    if extra is not None:
        aggs.append(F.min_by("__extra", F.coalesce("__id", F.lit(2**63 - 1))).alias("extra"))
    return d.groupBy("tid").agg(*aggs)


def hash_sample(df: DataFrame, rows: int, total: int, *cols: str) -> DataFrame:
    """About ``rows`` of ``total`` rows of ``df``: those whose hash of ``cols`` lies lowest.
    A filter, so nothing is sorted or moved; deterministic for equal data."""
    share = min(1.0, rows / max(1, total))
    return df if share >= 1 else df.filter(F.pmod(F.xxhash64(*cols), F.lit(1 << 31)) < int(share * (1 << 31)))


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string/binary Arrow array and its n + 1 offsets (from 0), no copies per row."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    big = arr.type in (pa.large_string(), pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64 if big else np.int32)
    off = off[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def small_parts(batches: Iterator[pa.RecordBatch], text: int = -1, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with at most ``limit`` bytes in string column ``text`` (one row at
    least), so that per-word lists stay small however long the texts of a batch are."""
    for b in batches:
        _, off = text_buffer(b.column(text))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield b.slice(at, end - at)
            at = end


def whole_groups(batches: Iterator[pa.RecordBatch], key: str,
                 target_rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by ``key``.

    A table holds at least ``target_rows`` rows (but for the last) plus the
    rest of its last group, so memory is bounded by the target and one group.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < target_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t.column(key).combine_chunks()
        # the last group may go on in the next batch: cut before it
        last, lo, hi = keys[len(keys) - 1], 0, len(keys) - 1
        while lo < hi:  # first row of the last group, by bisection (keys are sorted)
            mid = (lo + hi) // 2
            if keys[mid] == last:
                hi = mid
            else:
                lo = mid + 1
        if lo:
            yield t.slice(0, lo)
            rest = pa.Table.from_batches(t.slice(lo).to_batches()).combine_chunks()
            held, rows = rest.to_batches(), rest.num_rows
        else:
            held = t.to_batches()
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: ``node, root``, root
    being the smallest node of the component. Nodes without an edge are absent.

    Alternates large-star and small-star steps (each keeps connectivity and
    moves every node towards its component's minimum) until the edge set no
    longer changes; a component of n nodes needs about log(n) rounds. Raises
    if ``max_rounds`` don't suffice rather than return a partial result.
    """
    e = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                             F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _digest(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("p"))
        e = staged(small.select("p.u", "p.v").filter("u <> v").distinct(), "edges")
        now = _digest(e)
        if now == seen:
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _digest(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"),
              F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
    return tuple(r)

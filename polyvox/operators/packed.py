"""Terms dealt by hash, many to a row.

A shuffled or written row per (topic, term) is several times as long as the term itself. Here the terms of a
block that fall into one bucket are one row: their text, the topics of each and a value per topic, compressed
together. Every bucket of a dataset is one task's, so all topics of a term meet there, as after a shuffle by
(dataset, term). There are ``PER_TASK`` buckets to a shuffle partition; a task holds one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

#: Buckets to a shuffle partition.
PER_TASK = 4
#: Words or rows that are packed at once in a task.
PACKED = 1_000_000
#: Rows of a batch that leaves a task.
BATCH = 100_000

#: ``of`` names the block that asks (``termblocks``), ``kind`` what the row holds.
SCHEMA = "dataset string, bucket int, kind int, of bigint, size int, data binary"
_FIELDS = pa.schema([("dataset", pa.string()), ("bucket", pa.int32()), ("kind", pa.int32()), ("of", pa.int64()), ("size", pa.int32()),
                     ("data", pa.binary())])


class Part(NamedTuple):
    """Distinct terms, of each the number of its entries, and the entries' topics and values."""

    terms: pa.Array
    many: np.ndarray
    topics: np.ndarray
    values: np.ndarray


def buckets(spark: SparkSession) -> int:
    return PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _planes(a: np.ndarray) -> bytes:
    """The first byte of every number, then the second, ...: bytes that are alike lie together."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def dump(arrays: list[np.ndarray], text: bytes = b"") -> tuple[int, bytes]:
    """Arrays of numbers and a text as (size, compressed bytes). Few fractions differ, so they are stored once each."""
    flat: list[np.ndarray] = []
    for a in arrays:
        flat += np.unique(a, return_inverse=True) if a.dtype == np.float64 else [a]
    flat = [a if a.dtype == np.float64 else a.astype(np.int64) for a in flat]
    head = np.array([len(arrays), *(a.dtype == np.float64 for a in arrays), *map(len, flat)], np.int64)
    raw = b"".join([head.tobytes(), *map(_planes, flat), text])
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def load(size: int, data: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = pa.decompress(data, size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    coded = np.frombuffer(raw, np.int64, n, 8)
    lens = np.frombuffer(raw, np.int64, n + int(coded.sum()), 8 + 8 * n).tolist()
    at = 8 * (1 + n + len(lens))
    out: list[np.ndarray] = []

    def column(k: int, kind: type) -> np.ndarray:
        nonlocal at
        a = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * k, at).reshape(8, k).T).view(kind).ravel()
        at += 8 * k
        return a
    i = 0
    for c in coded.tolist():
        first = column(lens[i], np.float64 if c else np.int64)
        out.append(first[column(lens[i + 1], np.int64)] if c else first)
        i += 1 + c
    return out, raw[at:]


def text_of(terms: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets (from 0) and bytes of an array of strings."""
    if terms.offset or terms.type != pa.string():
        terms = pa.concat_arrays([terms.cast(pa.string()).slice(0, 0), terms.cast(pa.string())])
    _, offsets, data = terms.buffers()
    n = len(terms)
    at = np.frombuffer(offsets, np.int32, n + 1) if n else np.zeros(1, np.int32)
    return at, memoryview(data) if data is not None else memoryview(b"")


def strings(lens: np.ndarray, text: bytes) -> pa.Array:
    offsets = np.zeros(len(lens) + 1, np.int32)
    np.cumsum(lens, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets), pa.py_buffer(text))


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64) if len(words) else np.zeros(0, np.uint64)


def pair_bucket(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a term by its words' hashes (0 for no second word)."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return ((x >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def term_bucket(terms: pa.Array, n: int) -> np.ndarray:
    """``pair_bucket`` of terms as text."""
    if not len(terms):
        return np.zeros(0, np.int32)
    parts = pc.split_pattern(terms, " ", max_splits=1)
    size = pc.list_value_length(parts).to_numpy().astype(np.int64)
    d = parts.flatten().dictionary_encode()
    h = word_hashes(d.dictionary)[d.indices.to_numpy()]
    start = np.cumsum(size) - size
    return pair_bucket(h[start], np.where(size == 2, h[start + size - 1], np.uint64(0)), n)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of runs of ``size`` from ``start``, one run after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def dealt(dataset: str | None, terms: pa.Array, bucket: np.ndarray, start: np.ndarray, many: np.ndarray, entries: list[np.ndarray],
          kind: int, of: int | None = None) -> pa.RecordBatch:
    """A row per bucket: its terms, of each the number of entries (from ``start``), and the entries."""
    order = np.argsort(bucket, kind="stable")
    own, m = bucket[order], many[order]
    at, text = text_of(terms.take(pa.array(order)))
    lens, entry = np.diff(at), spans(start[order], m)
    ends = np.append(0, np.cumsum(m))
    held = [e[entry] if len(e) else e for e in entries]
    cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)] if len(own) else [0]
    rows = [dump([lens[lo:hi], m[lo:hi], *(e[ends[lo]:ends[hi]] for e in held)], bytes(text[at[lo]:at[hi]])) for lo, hi in zip(cuts[:-1], cuts[1:])]
    k = len(rows)
    return pa.RecordBatch.from_arrays([pa.array([dataset] * k, pa.string()), pa.array(own[cuts[:-1]], pa.int32()), pa.array([kind] * k, pa.int32()),
                                       pa.array([of] * k, pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], schema=_FIELDS)


def by_dataset(t: pa.Table) -> Iterator[tuple[str | None, pa.Table]]:
    d = t.column("dataset").combine_chunks().dictionary_encode(null_encoding="encode")
    if len(d.dictionary) == 1:
        yield d.dictionary[0].as_py(), t
        return
    code = d.indices.to_numpy()
    for k, name in enumerate(d.dictionary.to_pylist()):
        yield name, t.take(pa.array(np.flatnonzero(code == k)))


def held(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], np.ndarray], most: int) -> Iterator[pa.Table]:
    """Tables of rows whose sizes sum to about ``most``."""
    rows: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        ends = np.cumsum(size(b))
        lo, before = 0, 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, before + most - n, side="right")))
            rows.append(b.slice(lo, hi - lo))
            n += int(ends[hi - 1]) - before
            before, lo = int(ends[hi - 1]), hi
            if n >= most or lo < b.num_rows:
                yield pa.Table.from_batches(rows)
                rows, n = [], 0
    if rows:
        yield pa.Table.from_batches(rows)


def paired(toks: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of words as (distinct words, number of each word, its row, places of words with a neighbour to the right)."""
    size = pc.fill_null(pc.list_value_length(toks), 0).to_numpy()
    d = toks.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(toks)), size)
    return d.dictionary, d.indices.to_numpy().astype(np.int64), row, np.flatnonzero(row[1:] == row[:-1])


def pair_terms(words: pa.Array, left: np.ndarray, right: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")


def packed_counts(words: DataFrame, topic: str, n: int, kind: int = 0) -> DataFrame:
    """Counts of the words and pairs of neighbours in ``words(dataset, topic, toks)`` by topic."""

    def block(dataset: str | None, t: pa.Table) -> pa.RecordBatch:
        found, c, row, first = paired(t.column("toks").combine_chunks())
        topics, of = np.unique(t.column("topic").to_numpy(), return_inverse=True)
        wide = len(found) + 1
        key = np.concatenate([c * wide * len(topics) + of[row], (c[first] * wide + c[first + 1] + 1) * len(topics) + of[row[first]]])
        key, count = np.unique(key, return_counts=True)
        term = key // len(topics)
        start = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(key) else np.zeros(0, np.int64)
        many = np.diff(start, append=len(key))
        left, right = term[start] // wide, term[start] % wide - 1
        one = right < 0
        order = np.concatenate([np.flatnonzero(one), np.flatnonzero(~one)])
        terms = pa.concat_arrays([found.take(pa.array(left[one])), pair_terms(found, left[~one], right[~one])])
        h = word_hashes(found)
        b = pair_bucket(h[left], np.where(one, np.uint64(0), h[right]), n)
        return dealt(dataset, terms, b[order], start[order], many[order], [topics[key % len(topics)], count], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in held(batches, lambda b: pc.fill_null(pc.list_value_length(b.column(2)), 0).to_numpy(), PACKED):
            for dataset, own in by_dataset(t):
                yield block(dataset, own)

    return words.select("dataset", F.col(topic).cast("bigint").alias("topic"), "toks").filter("topic is not null and size(toks) > 0").mapInArrow(run, SCHEMA)


def packed_values(rows: DataFrame, value: str, topic: str | None, n: int, kind: int = 0) -> DataFrame:
    """(dataset, topic, term, value) rows by bucket of the term; without ``topic`` a term's own value."""

    def block(dataset: str | None, t: pa.Table) -> pa.RecordBatch:
        d = t.column("term").combine_chunks().dictionary_encode()
        code = d.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        many = np.bincount(code, minlength=len(d.dictionary))
        entries = [t.column(k).to_numpy()[order] for k in ("topic", "value")]
        return dealt(dataset, d.dictionary, term_bucket(d.dictionary, n), np.cumsum(many) - many, many, entries, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in held(batches, lambda b: np.ones(b.num_rows, np.int64), PACKED):
            for dataset, own in by_dataset(t):
                yield block(dataset, own)

    of = F.col(topic).cast("bigint") if topic else F.lit(0).cast("bigint")
    return (rows.select("dataset", of.alias("topic"), "term", F.col(value).cast("double").alias("value"))
            .filter("topic is not null and term is not null and value is not null").mapInArrow(run, SCHEMA))


def part(size: int, data: bytes) -> Part:
    (lens, many, topics, values), text = load(size, data)
    return Part(strings(lens, text), many, topics, values)


def merged(parts: list[Part]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of all parts, and the entries' term numbers, topics and values."""
    d = pa.concat_arrays([p.terms for p in parts]).dictionary_encode()
    code = np.repeat(d.indices.to_numpy(), np.concatenate([p.many for p in parts]))
    return d.dictionary, code, np.concatenate([p.topics for p in parts]), np.concatenate([p.values for p in parts])


def met(rows: DataFrame) -> DataFrame:
    """All rows of a dataset's bucket in one task, one after the other, by ``kind``."""
    return rows.repartition("dataset", "bucket").sortWithinPartitions("dataset", "bucket", "kind")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, int, Iterator[tuple]]]:
    """(dataset, bucket, rows (kind, of, size, data)) of rows that ``met`` has ordered."""
    rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(5)), b.column(5)))
    for (dataset, bucket), own in groupby(rows, key=lambda r: r[:2]):
        yield dataset, bucket, ((r[2], r[3], r[4], r[5].as_py()) for r in own)


def summed_counts(packed: DataFrame, schema: StructType, topic: str, sums: bool) -> DataFrame:
    """(dataset, topic, term, n) from ``packed_counts``; with ``sums`` also ``term_total``, the term's count in all topics, and
    ``term_first``, true in one row of each term."""
    fields = [schema["dataset"], schema[topic], StructField("term", StringType()), StructField("n", LongType())]
    fields += [StructField("term_total", LongType()), StructField("term_first", BooleanType())] if sums else []
    names = [f.name for f in fields]
    wide = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16(), "tinyint": pa.int8()}[schema[topic].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dataset, _, rows in by_bucket(batches):
            terms, code, topics, n = merged([part(size, data) for _, _, size, data in rows])
            names_of, of = np.unique(topics, return_inverse=True)
            key, back = np.unique(code.astype(np.int64) * len(names_of) + of, return_inverse=True)
            count = np.zeros(len(key), np.int64)
            np.add.at(count, back, n)
            code = key // len(names_of)
            total = np.zeros(len(terms), np.int64)
            np.add.at(total, code, count)
            first = np.append(True, code[1:] != code[:-1])
            for lo in range(0, len(key), BATCH):
                s = slice(lo, lo + BATCH)
                own = code[s]
                cols = [pa.array([dataset] * len(own), pa.string()), pa.array(names_of[key[s] % len(names_of)], wide), terms.take(pa.array(own)),
                        pa.array(count[s])]
                cols += [pa.array(total[own]), pa.array(first[s])] if sums else []
                yield pa.RecordBatch.from_arrays(cols, names)

    return met(packed).mapInArrow(run, StructType(fields))


"""Operator 8: BPE encoding and decoding through a distinct-word table.

Texts are split into words where they are read. A block of texts becomes one
row of word numbers (positions) and, per word bucket, a row of its distinct
words. Words meet by bucket, where each distinct word is encoded once; the
ids go back to their block and are joined to the word numbers by position.
Decoding joins ids to their pieces. So only distinct words of blocks are
shuffled, never all words, and no bucket depends on a frequent word: a word
counts once per block.

The split follows the tokenizer file (NFC, lower case, the file's split
pattern; its special tokens are cut out first); texts of plain Latin
characters take a fast path with the same rules, all others the library's
own normalizer and pre-tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from polyvox.llm.common import small_parts, whole_groups
from polyvox.llm.token_counts import byte_alphabet

BLOCK_CHARS = 32 << 20   # characters of text per block (a longer text is a block of its own)
ID_BLOCK_CHARS = 8 << 20  # the same where ids and texts are returned, which take a task several times the memory of digests
BUCKETS = 256            # word buckets at least
BUCKET_CHARS = 1 << 30   # one more bucket for each so many characters of text: an encoding task's share stays the same
MAX_KNOWN_WORDS = 500_000
_TO_CHAR = {b: c for c, b in byte_alphabet().items()}


def _of_category(first: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0xA1, 0x250) if unicodedata.category(chr(c))[0] == first)


_LETTER = "a-z" + _of_category("L")
_NUMBER = "0-9" + _of_category("N")
# The alternatives of the tokenizer file's split pattern.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*")


class Words:
    """Splits texts as the tokenizer of ``data`` (a tokenizer JSON) does."""

    def __init__(self, data: str):
        self.tok = Tokenizer.from_str(data)
        spec = json.loads(data)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex")
        if kinds != ["NFC", "Replace", "Lowercase"] or split != _PATTERN:
            raise ValueError("this tokenizer file splits text in another way")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = {s: self.tok.token_to_id(s) for s in special}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.back = byte_alphabet()

    def split(self, text: str) -> list[str]:
        if self.cut and "<|" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _LATIN.fullmatch(text):
            return _SPLIT.findall(text.lower())
        pieces = self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(text))
        return [bytes(self.back[c] for c in p).decode("utf-8") for p, _ in pieces]

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for t in self.tok.model.tokenize("".join(_TO_CHAR[b] for b in word.encode("utf-8")))]


def _bucket(words: list[str], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(w) for w in words), dtype=np.int64, count=len(words)) % buckets


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False, buckets: int | None = None, block_chars: int | None = None) -> DataFrame:
    """Per row: ``doc_id, n_tokens`` and ``ids, decoded``, or with ``digests`` their
    SHA-256 values ``ids_sha256`` (decimal ids joined by a space), ``decoded_sha256``.

    Null text counts as empty (no ids, empty decoded text); rows stay one for
    one, repeated rows and null ids too; other columns are ignored. The
    tokenizer file is read by the driver and broadcast (bounded by the file).
    """
    spark = docs.sparkSession
    block_chars = block_chars or (BLOCK_CHARS if digests else ID_BLOCK_CHARS)
    if buckets is None:
        buckets = max(BUCKETS, (docs.agg(F.sum(F.length(text_col))).first()[0] or 0) // BUCKET_CHARS)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    # key: bucket or block; kind 0: distinct words of a bucket, 1: ids of a bucket, 2: word numbers of a block
    schema = "key long, kind int, block long, bucket int, words array<string>, data binary, doc_ids array<long>, ends array<long>"
    names = ["key", "kind", "block", "bucket", "words", "data", "doc_ids", "ends"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    arrow = pa.schema(list(zip(names, types, strict=True)))

    def rows(items: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*items, strict=True), types, strict=True)], schema=arrow)

    def split(batches: Iterator[pa.RecordBatch], codes: bool) -> Iterator[pa.RecordBatch]:
        """Blocks' word numbers (``codes``) or their distinct words by bucket."""
        w = Words(shared.value)
        index: dict[str, int] = {}
        parts: list[np.ndarray] = []
        ends, ids, chars, total, mark = [], [], 0, 0, xxhash.xxh3_64()

        def block() -> Iterator[pa.RecordBatch]:
            own = list(index)
            where = _bucket(own, buckets)
            order = np.argsort(where, kind="stable")
            number = mark.intdigest() >> 1
            if codes:
                place = np.empty(len(own), dtype=np.uint32)
                place[order] = np.arange(len(own), dtype=np.uint32)
                data = place[np.concatenate(parts)] if total else np.zeros(0, np.uint32)
                planes = np.concatenate([(data >> s & 0xFF).astype(np.uint8) for s in (0, 8, 16, 24)])
                yield rows([(number, 2, number, total, None, pa.compress(planes, codec="zstd", asbytes=True), ids, ends)])
                return
            cut = np.searchsorted(where[order], np.arange(buckets + 1))
            for k in range(buckets):
                part = [own[i] for i in order[cut[k]:cut[k + 1]]]
                if part:
                    yield rows([(k, 0, number, k, part, None, None, None)])

        for b in small_parts(batches):
            words: list[str] = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words += w.split(t)
                ids.append(d)
                ends.append(total + len(words))
                chars += len(t)
                mark.update(f"{d}:{len(t)}:")
                mark.update(t.encode("utf-8", "surrogatepass"))
            if words:
                code, uniq = pd.factorize(np.array(words, dtype=object))
                known = np.array([index.setdefault(u, len(index)) for u in uniq], dtype=np.uint32)
                if codes:
                    parts.append(known[code])
                total += len(words)
            if chars >= block_chars:
                yield from block()
                index, parts, ends, ids, chars, total = {}, [], [], [], 0, 0
        if ids:
            yield from block()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = None
        known: dict[str, bytes] = {}
        for b in batches:
            for i in range(b.num_rows):
                w = w or Words(shared.value)
                if len(known) > MAX_KNOWN_WORDS:
                    known.clear()
                got = []
                for word in b.column(4)[i].as_py():
                    e = known.get(word)
                    if e is None:
                        e = known[word] = np.array(w.ids(word), dtype=np.uint32).tobytes()
                    got.append(e)
                lens = np.array([len(e) // 4 for e in got], dtype=np.uint32)
                payload = np.concatenate([np.array([len(got)], np.uint32), lens, np.frombuffer(b"".join(got), np.uint32)])
                block, bucket = b.column(2)[i].as_py(), b.column(3)[i].as_py()
                yield rows([(block, 1, block, bucket, None, pa.compress(payload.tobytes(), codec="zstd", asbytes=True)
                             + len(payload).to_bytes(8, "little"), None, None)])

    out = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
           else "doc_id long, n_tokens long, ids array<int>, decoded string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Words(shared.value).tok
        piece = {i: p for p, i in tok.get_vocab(with_added_tokens=True).items()}
        for t in whole_groups(batches, "block", 1):
            block = t.column("block").to_numpy()
            for a, z in zip(*_runs(block), strict=True):
                yield from _joined(t.slice(a, z - a), piece, digests)

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # texts are split twice: once for words, once for word numbers, which then move only once.
    # A block's name is a digest of its texts, so words can only meet the numbers they belong to.
    words = base.mapInArrow(partial(split, codes=False), schema)
    numbers = base.mapInArrow(partial(split, codes=True), schema)
    ids = words.repartition("key").mapInArrow(encode, schema).unionByName(numbers)
    return ids.repartition("block").sortWithinPartitions("block", "kind", "bucket").mapInArrow(join, out)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])


def _joined(t: pa.Table, piece: dict[int, str], digests: bool) -> Iterator[pa.RecordBatch]:
    """One block: its ids by bucket order, then its word numbers (rows sorted by kind, bucket).

    A block that was repeated (equal rows read in two tasks) has each row twice.
    """
    kinds = t.column("kind").to_numpy()
    buckets = t.column("bucket").to_numpy()
    encoded: list[list[int]] = []
    last = -1
    for i in np.flatnonzero(kinds == 1):
        if buckets[i] == last:
            continue
        last = buckets[i]
        raw = t.column("data")[int(i)].as_py()
        n = int.from_bytes(raw[-8:], "little")
        a = np.frombuffer(pa.decompress(raw[:-8], 4 * n, codec="zstd", asbytes=True), dtype=np.uint32)
        stop = np.cumsum(a[1:1 + a[0]], dtype=np.int64)
        flat = a[1 + int(a[0]):].tolist()
        encoded += [flat[x:y] for x, y in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True)]
    lens = np.array([len(e) for e in encoded], dtype=np.int64)
    id_text = [" ".join(map(str, e)) for e in encoded] if digests else []
    decoded = [" ".join([piece[x] for x in e]) for e in encoded]
    for i in np.flatnonzero(kinds == 2):
        n = int(buckets[i])
        p = np.frombuffer(pa.decompress(t.column("data")[int(i)].as_py(), 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
        codes = p[0].astype(np.uint32)  # plane by plane: all four widened at once take five times the memory of the numbers
        for k in (1, 2, 3):
            codes |= p[k].astype(np.uint32) << np.uint32(8 * k)
        if n and int(codes.max()) >= len(encoded):
            raise RuntimeError("words of a block are missing")
        ends, doc_ids = t.column("ends")[int(i)].as_py(), t.column("doc_ids")[int(i)].as_py()
        for lo in range(0, len(ends), 1000):
            cols: tuple[list, list, list] = ([], [], [])
            for k in range(lo, min(lo + 1000, len(ends))):
                own = codes[ends[k - 1] if k else 0:ends[k]]
                number = own.tolist()
                cols[0].append(int(lens[own].sum()))
                text = " ".join([decoded[c] for c in number])
                if digests:
                    cols[1].append(hashlib.sha256(" ".join([id_text[c] for c in number]).encode()).hexdigest())
                    cols[2].append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                else:
                    cols[1].append([x for c in number for x in encoded[c]])
                    cols[2].append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[lo:lo + 1000], pa.int64()), pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], pa.string() if digests else pa.list_(pa.int32())), pa.array(cols[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"])

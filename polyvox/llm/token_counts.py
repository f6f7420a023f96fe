"""Operator 2: token counts by a linear longest-match automaton.

Greedy longest-match-first word pieces are counted in one pass over a word's
bytes. The vocabulary is a trie (pieces that start a word below one root,
pieces that go on inside a word below another). Every node has a failure
link to the node reached after the pieces that greedy matching must output
when the next byte doesn't fit, and the *number* of those pieces, so no
piece is ever built (linear-time longest match with failure links).

Words are maximal runs without white space, each led by a space as in the
pieces of a byte-level
vocabulary. Counts depend on the word alone, so each task keeps a bounded
table of words it has counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import small_parts

MAX_KNOWN_WORDS = 300_000
WORD_START = " "


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    characters stand for themselves, the rest are numbered from U+0100 on."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> list[bytes]:
    """Byte strings of a byte-level vocabulary file (``model.vocab`` of a tokenizer JSON)."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"] for t in data.get("added_tokens", [])}
    alpha = byte_alphabet()
    return [bytes(alpha[c] for c in piece) for piece in data["model"]["vocab"]
            if piece not in special and all(c in alpha for c in piece)]


class LongestMatch:
    """Trie with failure links and popped-piece counts.

    Pieces beginning with ``start`` may only open a word, all others only
    continue one. ``count(word)`` is the number of greedy pieces of
    ``start + word``, or 1 (the unknown piece) where greedy matching gets stuck.
    """

    OPEN, INSIDE = 0, 1

    def __init__(self, pieces: list[bytes], start: bytes = WORD_START.encode()):
        self.start = start
        self.step: dict[int, int] = {}
        depth_order = [[self.OPEN, self.INSIDE]]
        piece_at = {}
        n = 2
        for p in pieces:
            if not p:
                continue
            u = self.OPEN if p.startswith(start) else self.INSIDE
            for d, c in enumerate(p):
                k = u << 8 | c
                v = self.step.get(k)
                if v is None:
                    v = self.step[k] = n
                    n += 1
                    if len(depth_order) < d + 2:
                        depth_order.append([])
                    depth_order[d + 1].append((u, c, v))
                u = v
            piece_at[u] = True
        self.fail = np.full(n, -1, dtype=np.int64)
        self.pops = np.zeros(n, dtype=np.int64)
        for level in depth_order[1:]:
            for u, c, v in level:
                if v in piece_at:  # the node is a piece: popping it leaves the inside root
                    self.fail[v], self.pops[v] = self.INSIDE, 1
                    continue
                z, popped = int(self.fail[u]), int(self.pops[u])
                while z >= 0 and (z << 8 | c) not in self.step:
                    popped += int(self.pops[z])
                    z = int(self.fail[z])
                if z >= 0:
                    self.fail[v], self.pops[v] = self.step[z << 8 | c], popped
        self.fail, self.pops = self.fail.tolist(), self.pops.tolist()

    def count(self, word: bytes) -> int:
        step, fail, pops = self.step, self.fail, self.pops
        u, n = self.OPEN, 0
        for c in self.start + word:
            k = u << 8 | c
            while k not in step:
                n += pops[u]
                u = fail[u]
                if u < 0:
                    return 1
                k = u << 8 | c
            u = step[k]
        while u != self.INSIDE:  # the word's end fits no node: pop what is pending
            n += pops[u]
            u = fail[u]
            if u < 0:
                return 1
        return n


def greedy_count(pieces: set[bytes], word: bytes, start: bytes = WORD_START.encode()) -> int:
    """Brute force for tests: build the longest piece again and again."""
    rest, n = start + word, 0
    while rest:
        for k in range(len(rest), 0, -1):
            p = rest[:k]
            if p in pieces and p.startswith(start) == (n == 0):
                break
        else:
            return 1
        rest, n = rest[k:], n + 1
    return n


def token_counts(docs: DataFrame, pieces: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, n_tokens, n_chars`` of its whole text.

    A null text counts as empty: no words, no tokens. Rows are kept one for
    one (repeated rows and null ids too); other columns are ignored. The
    vocabulary is broadcast: its size is that of the vocabulary file.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = LongestMatch(shared.value)
        known: dict[str, int] = {}
        for b in small_parts(batches):
            words: list[str] = []
            ends, chars = [0], []
            for t in b.column(1).to_pylist():
                words += t.split()
                ends.append(len(words))
                chars.append(len(t))
            codes, uniq = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, int), [])
            if len(known) > MAX_KNOWN_WORDS:
                known.clear()
            per = np.zeros(len(uniq), dtype=np.int64)
            for i, w in enumerate(uniq):
                n = known.get(w)
                if n is None:
                    n = known[w] = auto.count(w.encode("utf-8", "surrogatepass"))
                per[i] = n
            total = np.concatenate([[0], np.cumsum(per[codes])]).astype(np.int64)
            ends = np.array(ends, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n_words": pa.array(np.diff(ends)),
                "n_tokens": pa.array(total[ends[1:]] - total[ends[:-1]]), "n_chars": pa.array(chars, pa.int64())})

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_chars long"))

"""Documents' terms met with the topic model by blocks of documents.

A join of every document's terms with the topics that have them makes a row per (document, term, topic).
Here documents stay in blocks of about ``BLOCK_WORDS`` words: a block is written once, its terms as numbers, and
only its distinct terms are sent to the model, packed by bucket (``packed``), and their topics and weights come back
packed. Products and sums are taken in the block's task, so what comes out is a row per (document, topic).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.operators import packed as P
from polyvox.operators.skew import per_topic
from polyvox.sources.store import staged

#: Words (or counted terms) of a block; a longer document is a block of its own.
BLOCK_WORDS = 250_000
#: Products that are held at once in a task.
PRODUCTS = 1_000_000
#: Blocks of a file, so that a reader holds few at once.
BLOCKS_PER_FILE = 4
#: Terms that are looked up in a bucket of the model at once.
ASKED = 500_000

# terms: distinct words (or terms), numbered 0..; left, right: the distinct pairs of them, numbered from there on
_BLOCK = ("block bigint, dataset string, terms array<string>, left array<int>, right array<int>, docs array<bigint>, topics array<bigint>, "
          "ends array<int>, codes array<int>, pairs array<int>, shares array<double>")
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]
_TYPES = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
          pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())]


def term_model(weights: DataFrame, idf: DataFrame, topic: str = "topicId", unit: bool = False) -> DataFrame:
    """The model packed by buckets of its terms: each term's topics and their weights (kind 0), with ``unit`` as shares of
    the length of the topic's vector, and each term's idf (kind 1)."""
    w = weights.select("dataset", F.col(topic).alias("__t"), "term", "weight")
    if unit:
        norm = w.groupBy("dataset", "__t").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("__tn"))
        # written, so that its size is known beforehand and the weights don't move to it
        w = w.join(per_topic(staged(norm, "lengths")), ["dataset", "__t"]).withColumn("weight", F.col("weight") / F.col("__tn"))
    n = P.buckets(weights.sparkSession)
    return P.packed_values(w, "weight", "__t", n, 0).unionByName(P.packed_values(idf, "idf", None, n, 1))


def _row(number: int, dataset: str, **lists: pa.Array | np.ndarray) -> pa.RecordBatch:
    """A block as one row."""
    cols = [pa.array([number], _TYPES[0]), pa.array([dataset], _TYPES[1])]
    for name, t in zip(_NAMES[2:], _TYPES[2:], strict=True):
        v = lists.get(name)
        if v is None:
            cols.append(pa.nulls(1, t))
        else:
            own = (v if isinstance(v, pa.Array) else pa.array(v)).cast(t.value_type)
            cols.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
    return pa.RecordBatch.from_arrays(cols, _NAMES)


def _first(*keys: pa.ChunkedArray) -> np.ndarray:
    """Where a run of equal ``keys`` (none null) begins."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        a = k.combine_chunks()
        new[1:] |= pc.not_equal(a.slice(1), a.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(new)


def counted_blocks(dterms: DataFrame, topic: str | None = None) -> DataFrame:
    """Blocks of documents' counted terms as they are read, from rows of ``doc_terms`` or of ``doc_words``, with ``topic`` each
    document under its topic. A document that is read in two parts is in two blocks; sums over blocks make it whole."""
    own = F.col(topic).cast("bigint") if topic else F.lit(None).cast("bigint")
    keys = ["dataset", F.col("commentId").cast("bigint").alias("commentId"), own.alias("topic")]
    known = dterms.filter("dataset IS NOT NULL")
    if "toks" in dterms.columns:
        rows, block, size = known.filter(F.size("toks") > 0).select(*keys, "toks"), _of_words, lambda b: pc.list_value_length(b.column(3)).to_numpy()
    else:
        rows, block, size = known.select(*keys, "term", "n", "total"), _of_terms, lambda b: np.ones(b.num_rows, np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for t in P.held(batches, size, BLOCK_WORDS):
            cuts = [*_first(t.column("dataset")).tolist(), t.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = t.slice(lo, hi - lo).combine_chunks()
                yield _row(number, part.column("dataset")[0].as_py(), **block(part))
                number += 1

    return staged(rows.mapInArrow(pack, _BLOCK), "term-blocks", BLOCKS_PER_FILE)


def _of_terms(t: pa.Table) -> dict:
    d = t.column("term").combine_chunks().dictionary_encode()
    id_ = t.column("commentId").combine_chunks()
    at = _first(pa.chunked_array([pc.fill_null(id_, 0)]), pa.chunked_array([id_.is_null()]), pa.chunked_array([pc.fill_null(t.column("topic"), -1).combine_chunks()]))
    share = t.column("n").to_numpy() / t.column("total").to_numpy()
    return {"terms": d.dictionary, "docs": id_.take(pa.array(at)), "topics": t.column("topic").combine_chunks().take(pa.array(at)),
            "ends": np.append(at[1:], t.num_rows), "codes": d.indices, "shares": share}


def _numbered(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ``n`` words and the number of each given one, from ``n`` on."""
    key, number = np.unique(left * n + right, return_inverse=True)
    return key // max(n, 1), key % max(n, 1), number + n


def _of_words(t: pa.Table) -> dict:
    words, c, row, first = P.paired(t.column("toks").combine_chunks())
    left, right, pair = _numbered(c[first], c[first + 1], len(words))
    wide = len(words) + len(left)
    key, n = np.unique(np.concatenate([row * wide + c, row[first] * wide + pair]), return_counts=True)
    of, size = key // wide, np.bincount(row, minlength=t.num_rows)
    return {"terms": words, "left": left, "right": right, "docs": t.column("commentId").combine_chunks(), "topics": t.column("topic").combine_chunks(),
            "ends": np.cumsum(np.bincount(of, minlength=t.num_rows)), "codes": key % wide, "shares": n / (2 * size - 1)[of]}


def word_blocks(words: DataFrame) -> DataFrame:
    """Blocks of documents' words in order (dataset, commentId, words) and of their pairs of neighbours. Rows of one id
    are in one block, next to each other."""

    def block(number: int, t: pa.Table) -> pa.RecordBatch:
        found, c, row, first = P.paired(pc.split_pattern(t.column("words").combine_chunks(), " "))
        left, right, pair = _numbered(c[first], c[first + 1], len(found))
        pairs = np.full(len(c), -1, np.int32)
        pairs[first] = pair
        return _row(number, t.column("dataset")[0].as_py(), terms=found, left=left, right=right, docs=t.column("commentId").combine_chunks(),
                    ends=np.cumsum(np.bincount(row, minlength=t.num_rows)), codes=c, pairs=pairs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for b in batches:
            lens, lo = b.column(3).to_pylist(), 0
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                if last is not None and key != last and (size >= BLOCK_WORDS or key[0] != last[0]):
                    if i > lo:
                        held.append(b.slice(lo, i - lo))
                    yield block(number, pa.Table.from_batches(held))
                    held, size, lo, number = [], 0, i, number + 1
                size, last = size + lens[i], key
            if lo < b.num_rows:
                held.append(b.slice(lo))
        if held:
            yield block(number, pa.Table.from_batches(held))

    # a text of words with blanks between moves in half the bytes of an array; words hold no blank
    rows = (words.filter("dataset IS NOT NULL AND commentId IS NOT NULL AND size(words) > 0")
            .select("dataset", F.col("commentId").cast("bigint").alias("commentId"), F.array_join("words", " ").alias("words"), F.size("words").alias("n"))
            .repartition("dataset", "commentId").sortWithinPartitions("dataset", "commentId"))
    return staged(rows.mapInArrow(pack, _BLOCK), "word-blocks", BLOCKS_PER_FILE)


class Met:
    """A block's terms in the model: ``place`` of each number (-1: not in the model), ``idf``, weights by topic."""

    def __init__(self, terms: int, answers: list[list[np.ndarray]]):
        at, self.idf, self.size, flat, self.weight = (np.concatenate(c) for c in zip(*answers))
        self.place = np.full(terms, -1, np.int64)
        self.place[at] = np.arange(len(at))
        self.start = np.cumsum(self.size) - self.size
        self.topics, self.topic = np.unique(flat, return_inverse=True)

    def of_topic(self, place: np.ndarray, topic: np.ndarray) -> np.ndarray:
        """Where the weight of a term in a topic (place in ``topics``) is, -1 if it has none."""
        n = len(self.topics)
        key = np.repeat(np.arange(len(self.size)), self.size) * n + self.topic  # a term's topics are in order
        want = place * n + topic
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        return np.where((topic >= 0) & (key[at] == want), at, -1)

    def products(self, group: np.ndarray, place: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, topic, sum of w times the topic's weight) for groups (ascending) and topics that share a term."""
        if not len(group):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        size = self.size[place]
        rep = np.repeat(np.arange(len(group)), size)
        flat = self.start[place][rep] + np.arange(len(rep)) - (np.cumsum(size) - size)[rep]
        n, low = len(self.topics), int(group[0])
        key = (group[rep] - low) * n + self.topic[flat]
        value = w[rep] * self.weight[flat]
        if (int(group[-1]) - low + 1) * n <= 4 * PRODUCTS:
            total = np.bincount(key, weights=value)
            key = np.flatnonzero(np.bincount(key))
            total = total[key]
        else:
            key, back = np.unique(key, return_inverse=True)
            total = np.bincount(back, weights=value)
        return key // n + low, key % n, total

    def per_part(self, entries: int) -> int:
        """How many of ``entries`` terms are multiplied at once."""
        return max(1, int(PRODUCTS / max(1.0, len(self.weight) / max(1, len(self.size)))))


def _asked(blocks: DataFrame, n: int, own: bool) -> DataFrame:
    """Every block's distinct terms by bucket (kind 2). A term's first entry is its number in the block; with ``own`` the topics
    of the documents that have it follow."""

    def entries(number: np.ndarray, codes: np.ndarray, ends: np.ndarray, topics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, of = np.unique(topics, return_inverse=True)
        key = np.unique(codes.astype(np.int64) * len(names) + np.repeat(of, np.diff(ends, prepend=0)))
        term = np.concatenate([number, key // len(names)])
        order = np.argsort(term, kind="stable")
        return np.concatenate([number, names[key % len(names)]])[order], np.bincount(term, minlength=len(number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, left, right = (b.column(k)[i].values for k in (2, 3, 4))
                bucket = P.term_bucket(words, n)
                terms = words
                if left is not None and len(left):
                    left, right, h = left.to_numpy(), right.to_numpy(), P.word_hashes(words)
                    bucket = np.concatenate([bucket, P.pair_bucket(h[left], h[right], n)])
                    terms = pa.concat_arrays([words, P.pair_terms(words, left, right)])
                held = number = np.arange(len(terms))
                many = np.ones(len(terms), np.int64)
                if own:
                    held, many = entries(number, *(b.column(k)[i].values.to_numpy() for k in (5, 6, 7)))
                yield P.dealt(b.column(1)[i].as_py(), terms, bucket, np.cumsum(many) - many, many, [held, held[:0]], 2, b.column(0)[i].as_py())

    return blocks.select("block", "dataset", "terms", "left", "right", *(["codes", "ends", "topics"] if own else [])).mapInArrow(run, P.SCHEMA)


def _answers(dealt: DataFrame) -> DataFrame:
    """Per block and bucket the numbers of the terms that the model has, their idf, topics and weights (those asked for, if any)."""

    def found(parts: dict[int, list[P.Part]]) -> tuple:
        terms, code, _, value = P.merged(parts[1])
        idf = np.zeros(len(terms))
        idf[code] = value
        own, code, topics, weight = P.merged(parts[0])
        to = pc.fill_null(pc.index_in(own, value_set=terms), -1).to_numpy()[code]
        order = np.lexsort((topics, to))
        order = order[np.searchsorted(to[order], 0):]
        to, topics = to[order].astype(np.int64), topics[order]
        names, of = np.unique(topics, return_inverse=True)
        return terms, idf, np.bincount(to, minlength=len(terms)), topics, weight[order], names, to * len(names) + of

    def reply(model: tuple, asked: list[tuple[int, P.Part]]) -> pa.RecordBatch:
        terms, idf, size, topics, weight, names, key = model
        start = np.cumsum(size) - size
        at = pc.fill_null(pc.index_in(pa.concat_arrays([p.terms for _, p in asked]), value_set=terms), -1).to_numpy().astype(np.int64)
        lo, out = 0, []
        for of, p in asked:
            own = at[lo:lo + len(p.terms)]
            lo += len(p.terms)
            first = np.cumsum(p.many) - p.many
            if len(p.topics) == len(p.terms):  # all topics
                many = np.where(own >= 0, size[own], 0)
                entry = P.spans(start[own], many)
            else:
                term, want = np.repeat(np.arange(len(own)), p.many - 1), np.delete(p.topics, first)
                name = np.minimum(np.searchsorted(names, want), len(names) - 1)
                want = np.where((own[term] >= 0) & (names[name] == want), own[term] * len(names) + name, -1)
                entry = np.minimum(np.searchsorted(key, want), len(key) - 1)
                entry, many = entry[key[entry] == want], np.bincount(term[key[entry] == want], minlength=len(own))
            hit = np.flatnonzero(many)
            if len(hit):
                out.append((of, *P.dump([p.topics[first[hit]], idf[own[hit]], many[hit], topics[entry], weight[entry]])))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["of", "size", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, rows in P.by_bucket(batches):
            parts: dict[int, list[P.Part]] = {0: [], 1: []}
            model, asked, n = None, [], 0
            for kind, of, size, data in rows:
                p = P.part(size, data)
                if kind < 2:
                    parts[kind].append(p)
                elif parts[0] and parts[1]:
                    model = model or found(parts)
                    asked.append((of, p))
                    n += len(p.terms)
                    if n >= ASKED:
                        yield reply(model, asked)
                        asked, n = [], 0
            if asked:
                yield reply(model, asked)

    return P.met(dealt).mapInArrow(run, "of bigint, size int, data binary")


def scores(blocks: DataFrame, model: DataFrame, score: Callable[[dict, Met], Iterator[tuple]], topic: str, squares: bool = False) -> DataFrame:
    """(dataset, commentId, topic, score): ``score`` of each block and its terms in the model, summed per document, with
    ``squares`` a second sum (``square``), for which documents ask for the weights of their own topic only. A term comes once per block, so no term is a hot key."""
    answers = _answers(model.unionByName(_asked(blocks, P.buckets(blocks.sparkSession), squares)))
    lists = ["topics", "ends", "codes", "pairs", "shares"]
    own = blocks.select("block", "dataset", "docs", *lists)
    sums = ["score", "square"] if squares else ["score"]
    schema = pa.schema([("dataset", pa.string()), ("commentId", pa.int64()), ("t", pa.int32()), *((k, pa.float64()) for k in sums)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            block = {c: left.column(c).combine_chunks().flatten() for c in ("docs", *lists)}
            docs = block["docs"]
            block = {c: a.to_numpy(zero_copy_only=False) for c, a in block.items()}
            dataset = left.column("dataset")[0].as_py()
            terms = 1 + max((int(block[c].max()) for c in ("codes", "pairs") if len(block[c])), default=-1)
            met = Met(terms, [P.load(size, data)[0] for size, data in zip(right.column("size").to_pylist(), right.column("data").to_pylist())])
            for row, t, *s in score(block, met):
                parts.append(pa.table([pa.array([dataset] * len(row), pa.string()), docs.take(pa.array(row)),
                                       pa.array(met.topics[t].astype(np.int32)), *(pa.array(x, pa.float64()) for x in s)], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    out = own.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(run, "dataset string, commentId bigint, t int, " + ", ".join(f"{k} double" for k in sums))
    return out.groupBy("dataset", "commentId", F.col("t").alias(topic)).agg(*[F.sum(k).alias(k) for k in sums])


def whole_text_scores(block: dict, met: Met) -> Iterator[tuple]:
    """Per document and topic the sum of sqrt(share of the term) * idf * weight."""
    run = np.repeat(np.arange(len(block["ends"])), np.diff(block["ends"], prepend=0))
    place = met.place[block["codes"]]
    at = np.flatnonzero(place >= 0)
    step = met.per_part(len(at))
    for lo in range(0, len(at), step):
        own = at[lo:lo + step]
        w = np.sqrt(block["shares"][own]) * met.idf[place[own]]
        g, t, s = met.products(run[own], place[own], w)
        yield g, t, s


def own_topic_scores(block: dict, met: Met) -> Iterator[tuple]:
    """Per document and its topic the sums of d * weight and of d * d, d = sqrt(share of the term) * idf."""
    n, ends = len(block["ends"]), block["ends"]
    at = np.minimum(np.searchsorted(met.topics, block["topics"]), len(met.topics) - 1)
    own = np.where(met.topics[at] == block["topics"], at, -1)
    run = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    place = met.place[block["codes"]]
    known = np.flatnonzero(place >= 0)
    where = met.of_topic(place[known], own[run[known]])
    known, where = known[where >= 0], where[where >= 0]
    d = np.sqrt(block["shares"][known]) * met.idf[place[known]]
    dot, square = (np.bincount(run[known], weights=x, minlength=n) for x in (d * met.weight[where], d * d))
    seen = np.flatnonzero(np.bincount(run[known], minlength=n))
    yield seen, own[seen], dot[seen], square[seen]


def window_scores(size: int, stride: int, min_similarity: float) -> Callable[[dict, Met], Iterator[tuple]]:
    """Per document and topic (weights of unit length) the sum over windows of their cosines, if at least ``min_similarity``.
    Windows of one id that start alike are one window."""

    def score(block: dict, met: Met) -> Iterator[tuple]:
        ends, ids = block["ends"].astype(np.int64), block["docs"]
        length = np.diff(ends, prepend=0)
        many = (np.maximum(length - (size - 1), 1) - 1) // stride + 1
        row = np.repeat(np.arange(len(ends)), many)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * stride
        doc = np.cumsum(np.append(False, ids[1:] != ids[:-1]))[row]
        key = doc * (int(length.max()) + 1) + start
        order = np.argsort(key, kind="stable")
        row, start, doc, key = row[order], start[order], doc[order], key[order]
        window = np.cumsum(np.append(False, key[1:] != key[:-1]))
        step = max(1, met.per_part(0) // (2 * size - 1))
        terms = len(met.place)
        for first in range(0, int(window[-1]) + 1, step):
            lo, hi = np.searchsorted(window, [first, first + step])
            r, s, win = row[lo:hi], start[lo:hi], window[lo:hi] - first
            base, left = ends[r] - length[r] + s, length[r] - s
            n = int(win[-1]) + 1
            keys, total = [], np.zeros(n)
            for codes, reach in ((block["codes"], size), (block["pairs"], size - 1)):
                for j in range(reach):
                    ok = left > j + (codes is block["pairs"])
                    code = codes[base[ok] + j].astype(np.int64)
                    total += np.bincount(win[ok], minlength=n)
                    known = met.place[code] >= 0
                    keys.append(win[ok][known] * terms + code[known])
            found, count = np.unique(np.concatenate(keys), return_counts=True)
            g, place = found // terms, met.place[found % terms]
            w = np.sqrt(count / total[g]) * met.idf[place]
            norm = np.sqrt(np.bincount(g, weights=w * w, minlength=n))
            g, t, dot = met.products(g, place, w)
            cosine = dot / norm[g]
            near = np.flatnonzero(cosine >= min_similarity)
            of = np.zeros(n, np.int64)
            of[win] = doc[lo:hi]
            if len(near):
                pair, back = np.unique(of[g[near]] * len(met.topics) + t[near], return_inverse=True)
                where = np.zeros(int(doc[-1]) + 1, np.int64)
                where[doc] = row
                yield where[pair // len(met.topics)], pair % len(met.topics), np.bincount(back, weights=cosine[near])

    return score

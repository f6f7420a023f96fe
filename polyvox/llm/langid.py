"""Operator 7: language identification by interpolated Kneser-Ney character models.

Training counts character n-grams of order ``ORDER`` inside words over all
training texts: each task folds its words into a bounded count table, and a
Spark aggregate sums (language, n-gram). From all of these come, per language, the
interpolated Kneser-Ney probabilities of all orders. Up to MODEL_GRAMS n-grams
they are broadcast as sorted arrays of packed n-grams (a hash for characters
outside the alphabet) with log probability and back-off weight, searched by
bisection; beyond, they are estimated and kept as tables, which the texts' n-grams join.

A text's score under a language is its mean log probability per character
(cross-entropy); the lowest cross-entropy wins, ties go to the first name. A
text is also ``rejected`` if its best cross-entropy is above the calibrated
quantile of all held-in texts of that language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import small_parts, staged, text_id

ORDER = 4
BITS = 15                 # bits per character in a packed n-gram
MODEL_GRAMS = 1_200_000   # n-grams of all languages together up to which models are broadcast
DISCOUNT = 0.75
REJECT_QUANTILE = 0.995
MAX_KNOWN_WORDS = 400_000
_FLUSH = 400_000
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = 1


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of ``^word$`` for all words in one array, and word offsets.

    Characters below U+0F00 keep their number, others are numbered on modulo the rest of the 15-bit
    range: only characters 28,928 apart share a code, none of the same script (all 20,992 of
    the CJK block differ).
    """
    text = "\x01".join(words) + "\x01" if words else ""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    cp = np.where(cp < 0xF00, cp, 0xF00 + (cp - 0xF00) % ((1 << BITS) - 0xF00))
    ends = np.flatnonzero(cp == _EDGE) + 1
    return cp, np.concatenate([[0], ends])


def _grams(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The order-ORDER n-gram that ends at each character, padded with edges at the
    word's start; the word's end edge is a character too."""
    pos = np.arange(len(cp)) - np.repeat(off[:-1], np.diff(off))
    g = cp.copy()
    for i in range(1, ORDER):
        prev = np.concatenate([np.full(i, _EDGE), cp[:-i]]) if len(cp) > i else np.full(len(cp), _EDGE)
        g |= np.where(pos >= i, prev, _EDGE) << (BITS * i)
    return g


def ngram_counts(docs: DataFrame, label: Column, text_col: str = "text") -> DataFrame:
    """``lang, gram, n`` over whole texts of rows with a label."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush(lang: str) -> pa.RecordBatch:
            part = pd.concat(held.pop(lang)).groupby(level=0).sum()
            return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(part), pa.string()),
                                               "gram": pa.array(part.index.to_numpy()), "n": pa.array(part.to_numpy())})

        for b in small_parts(batches, limit=16 << 20):
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            texts = b.column(1).to_pylist()
            for lang in np.unique(langs):
                words: list[str] = []
                for i in np.flatnonzero(langs == lang):
                    words += _WORD.findall(texts[i].lower())
                if not words:
                    continue
                own = pd.Series(words, dtype=object).value_counts(sort=False)
                cp, off = _codes(list(own.index))
                g = _grams(cp, off)
                part = pd.Series(np.repeat(own.to_numpy(), np.diff(off)), index=g).groupby(level=0).sum()
                held.setdefault(lang, []).append(part)
                size += len(part)
            if size > _FLUSH:
                held = {k: [pd.concat(v).groupby(level=0).sum()] for k, v in held.items()}
                size = sum(len(v[0]) for v in held.values())
                if size > _FLUSH // 2:
                    yield from (flush(k) for k in list(held))
                    size = 0
        yield from (flush(k) for k in list(held))

    rows = (docs.select(label.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .filter("lang is not null"))
    return (rows.mapInArrow(fold, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").cast("long").alias("n")))


@dataclass
class Model:
    """Sorted arrays of one language: per order the packed n-grams, log
    probabilities, and back-off weights of contexts."""

    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float

    def score(self, g: np.ndarray) -> np.ndarray:
        """Interpolated log probability of the last character of each packed n-gram."""
        out = np.zeros(len(g))
        todo = np.arange(len(g))
        for order in range(ORDER, 0, -1):
            q = g[todo] & ((1 << BITS * order) - 1)
            keys = self.grams[order - 1]
            i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
            hit = keys[i] == q
            out[todo[hit]] += self.logp[order - 1][i[hit]]
            todo, q = todo[~hit], q[~hit]
            if not len(todo):
                return out
            if order > 1:
                ctx = q >> BITS
                keys = self.contexts[order - 1]
                i = np.minimum(np.searchsorted(keys, ctx), len(keys) - 1)
                out[todo] += np.where(keys[i] == ctx, self.backoff[order - 1][i], 0.0)
        out[todo] += self.floor
        return out


def kneser_ney(grams: np.ndarray, counts: np.ndarray, d: float = DISCOUNT) -> Model:
    """Interpolated Kneser-Ney from top-order counts: lower orders count the
    distinct characters that precede an n-gram. ``p(c|h) = max(n(hc)-d, 0)/n(h)
    + d * types(h)/n(h) * p(c|h')``, order 1 interpolating with a uniform floor."""
    o = np.argsort(grams)
    levels: list[tuple[np.ndarray, np.ndarray]] = [(grams[o], counts[o].astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):
        upper = levels[-1][0]
        low, n = np.unique(upper & ((1 << BITS * order) - 1), return_counts=True)
        levels.append((low, n.astype(np.float64)))
    levels.reverse()
    uniform = 1.0 / (1 << BITS)
    gs, ps, cs, bs = [], [], [], []
    floor = uniform
    for order, (g, n) in enumerate(levels, 1):
        ctx = g >> BITS
        c, start = np.unique(ctx, return_index=True)
        total = np.add.reduceat(n, start)
        types = np.diff(np.append(start, len(g)))
        at = np.searchsorted(c, ctx)
        weight = d * types / total
        if order == 1:
            below = np.full(len(g), uniform)
            floor = float(weight[0] * uniform)
        else:
            below = _lower(g, order, gs, ps, cs, bs, floor)
        p = np.maximum(n - d, 0) / total[at] + weight[at] * below
        gs.append(g)
        ps.append(p)
        cs.append(c)
        bs.append(np.log(weight))
    return Model(gs, [np.log(p) for p in ps], cs, bs, float(np.log(floor)))


def _lower(g, order, gs, ps, cs, bs, floor) -> np.ndarray:
    """Probability of each n-gram's last character one order down (every suffix of a seen n-gram is seen)."""
    q = g & ((1 << BITS * (order - 1)) - 1)
    i = np.minimum(np.searchsorted(gs[-1], q), len(gs[-1]) - 1)
    return np.where(gs[-1][i] == q, ps[-1][i], floor)


def train(counts: DataFrame) -> dict[str, Model]:
    """One model per language from all its n-gram counts, on the driver."""
    return {lang: kneser_ney(p["gram"].to_numpy(), p["n"].to_numpy()) for lang, p in sorted(counts.toPandas().groupby("lang"))}


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << BITS * order) - 1))


def estimate(counts: DataFrame, names: list[str]) -> tuple[list[DataFrame], list[DataFrame], list[float]]:
    """``kneser_ney`` as tables: per order (from 1) ``gram, logp`` and ``ctx, logw``, arrays with one
    place per language (null where it hasn't seen the n-gram or context), and each language's floor.
    A context has at most 2^BITS n-grams and a suffix as many predecessors, so no key is hot."""
    levels = [counts.select("lang", "gram", F.col("n").cast("double").alias("n"))]
    for order in range(ORDER - 1, 0, -1):
        low = levels[-1].select("lang", _suffix(F.col("gram"), order).alias("gram"))
        levels.append(staged(low.groupBy("lang", "gram").agg(F.count(F.lit(1)).cast("double").alias("n")), "lang-level"))
    levels.reverse()

    def by_lang(df: DataFrame, key: str, value: str) -> DataFrame:
        held = df.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("lang", F.log(value)))).alias("m"))
        return held.select(key, F.array(*[F.col("m")[n] for n in names]).alias(f"log{value}"))

    uniform = 1.0 / (1 << BITS)
    probs, weights, below, floors = [], [], None, []
    for order, level in enumerate(levels, 1):
        level = level.withColumn("ctx", F.shiftright("gram", BITS))
        total = F.sum("n")
        ctx = staged(level.groupBy("lang", "ctx").agg(total.alias("total"), (DISCOUNT * F.count(F.lit(1)) / total).alias("w")), "lang-contexts")
        g = level.join(ctx, ["lang", "ctx"])
        if below is None:
            first = {r[0]: r[1] for r in ctx.select("lang", "w").collect()}
            floors = [float(np.log(first[n] * uniform)) for n in names]
            g = g.withColumn("below", F.lit(uniform))
        else:
            g = g.withColumn("low", _suffix(F.col("gram"), order - 1)).join(below, ["lang", "low"])
        p = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total") + F.col("w") * F.col("below")
        g = staged(g.select("lang", "gram", p.alias("p")), "lang-probabilities")
        below = g.select("lang", F.col("gram").alias("low"), F.col("p").alias("below"))
        probs.append(by_lang(g, "gram", "p"))
        weights.append(by_lang(ctx, "ctx", "w"))
    return probs, weights, floors


def _text_grams(docs: DataFrame) -> DataFrame:
    """``tid, gram, n`` of each distinct text, and a row of gram -1 with its ``letters``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches, limit=1 << 20):
            row, grams, n = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                words = _WORD.findall(t.lower())
                g, k = np.unique(_grams(*_codes(words)), return_counts=True) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                row.append(np.full(len(g) + 1, i))
                grams.append(np.append(g, -1))
                n.append(np.append(k, sum(len(w) + 1 for w in words if any(map(str.isalpha, w)))))
            if row:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(row))), pa.array(np.concatenate(grams)),
                                                  pa.array(np.concatenate(n))], ["tid", "gram", "n"])

    rows = docs.select(text_id().alias("tid"), "text").mapInArrow(run, "tid binary, gram long, n long")
    return rows.groupBy("tid", "gram").agg(F.max("n").alias("n"))


def _scored_by_join(docs: DataFrame, counts: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """``_scored`` for models of any size: the texts' distinct n-grams meet the tables of
    every order, and their scores are summed per text."""
    probs, weights, floors = estimate(counts, names)
    held = staged(_text_grams(docs), "lang-text-grams")
    df = held.filter("gram >= 0").select("gram").distinct()
    for order in range(ORDER, 0, -1):
        own = _suffix(F.col("gram"), order)
        p = probs[order - 1].select(F.col("gram").alias("k"), F.col("logp").alias(f"p{order}"))
        df = df.withColumn("k", own).join(p if order > 1 else F.broadcast(p), "k", "left").drop("k")
        if order > 1:
            w = weights[order - 1].select(F.col("ctx").alias("k"), F.col("logw").alias(f"w{order}"))
            df = df.withColumn("k", F.shiftright(own, BITS)).join(w if order > 2 else F.broadcast(w), "k", "left").drop("k")
    each = []
    for j, floor in enumerate(floors):
        x = F.coalesce(F.get("p1", F.lit(j)), F.lit(floor))
        for order in range(2, ORDER + 1):
            x = F.coalesce(F.get(f"p{order}", F.lit(j)), F.coalesce(F.get(f"w{order}", F.lit(j)), F.lit(0.0)) + x)
        each.append(x.alias(f"s{j}"))
    scores = staged(df.select("gram", *each), "lang-gram-scores")
    sums = (held.filter("gram >= 0").join(scores, "gram").groupBy("tid")
            .agg(F.array(*[F.sum(F.col("n") * F.col(f"s{j}")) for j in range(len(names))]).alias("s")))
    letters = held.filter("gram < 0").select("tid", F.col("n").alias("letters"))
    per = letters.join(sums, "tid", "left").select(
        "tid", "letters", F.when(F.col("letters") > 0, F.transform("s", lambda x: -x / F.col("letters"))).alias("nll"))
    return docs.select(*keep, text_id().alias("tid")).join(per, "tid").select(*keep, "letters", "nll")


def _scored(docs: DataFrame, models: dict[str, Model], keep: list[str]) -> DataFrame:
    """``keep`` columns, ``letters`` and ``nll`` (mean negative log probability per
    character, one per language in name order; null without letters)."""
    spark = docs.sparkSession
    names = sorted(models)
    shared = spark.sparkContext.broadcast([models[n] for n in names])
    fields = [docs.schema[c] for c in keep]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", letters long, nll array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value
        known: dict[str, int] = {}
        table = np.zeros((0, len(langs)))
        for b in small_parts(batches):
            words: list[str] = []
            ends = [0]
            for t in b.column(len(keep)).to_pylist():
                words += _WORD.findall(t.lower())
                ends.append(len(words))
            codes, uniq = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), np.array([], dtype=object))
            if len(known) > MAX_KNOWN_WORDS:
                known, table = {}, np.zeros((0, len(langs)))
            fresh = [w for w in uniq if w not in known]
            if fresh:
                cp, off = _codes(fresh)
                g = _grams(cp, off)
                gu, back = np.unique(g, return_inverse=True)
                per = np.stack([np.add.reduceat(m.score(gu)[back], off[:-1]) for m in langs], axis=1)
                known.update(zip(fresh, range(len(table), len(table) + len(fresh)), strict=True))
                table = np.concatenate([table, per])
            at = np.array([known[w] for w in uniq], dtype=np.int64)
            size = np.array([len(w) + 1 if w.isalpha() or any(map(str.isalpha, w)) else 0 for w in uniq], dtype=np.int64)
            ends = np.array(ends)
            n = np.concatenate([[0], np.cumsum(size[codes])])
            n = n[ends[1:]] - n[ends[:-1]]
            cols = []
            for j in range(len(langs)):
                s = np.concatenate([[0.0], np.cumsum(table[at, j][codes])]) if len(at) else np.zeros(1)
                cols.append(s[ends[1:]] - s[ends[:-1]])
            nll = -np.stack(cols, axis=1) / np.maximum(n, 1)[:, None]
            lists = pa.array([list(map(float, r)) if k else None for r, k in zip(nll, n, strict=True)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(n), lists], [*keep, "letters", "nll"])

    return docs.select(*keep, "text").mapInArrow(run, ddl)


def identify(docs: DataFrame, training: Column, lang_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score, rejected, cross_entropy``.

    ``training`` marks the rows that may be learnt from (with a non-null
    language). ``lang_pred`` is a learnt language, or ``und`` for a null text,
    one without letters, or when nothing could be learnt; its score is 0.
    ``score`` is the winner's share under a softmax of log likelihoods of up to 50 characters.
    Rows stay one for one; other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~F.coalesce(training, F.lit(False))).alias("held_out"),
                       F.col(lang_col).cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts = staged(ngram_counts(base, F.when(~F.col("held_out"), F.col("lang"))), "lang-counts")
    sizes = {r[0]: r[1] for r in counts.groupBy("lang").count().collect()}
    names = sorted(sizes)
    if not names:
        return base.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("cross_entropy"))
    lang_list = F.array(*[F.lit(n) for n in names])
    keep = ["doc_id", "held_out", "lang"]
    small = sum(sizes.values()) <= MODEL_GRAMS
    s = staged(_scored(base, train(counts), keep) if small else _scored_by_join(base, counts, names, keep), "lang-scores")
    # calibration: all held-in texts of a language, cross-entropies counted at four decimals (rounded up)
    own = F.element_at("nll", F.array_position(lang_list, F.col("lang")).cast("int"))
    cal = (s.filter(~F.col("held_out") & F.col("lang").isin(names) & F.col("nll").isNotNull())
           .select("lang", (F.ceil(own * 10_000) / 10_000).alias("x")))
    cut = {r[0]: r[1] for r in cal.groupBy("lang").agg(F.percentile("x", REJECT_QUANTILE)).collect()}
    limits = F.array(*[F.lit(float(cut.get(n, np.inf))) for n in names])
    best = F.array_min("nll")
    at = F.array_position("nll", best).cast("int")
    n = F.least(F.col("letters"), F.lit(50))
    share = F.lit(1.0) / F.aggregate("nll", F.lit(0.0), lambda a, x: a + F.exp(-(x - F.array_min("nll")) * n))
    some_letters = F.col("nll").isNotNull()
    return s.select("doc_id", "held_out",
                    F.when(some_letters, F.element_at(lang_list, at)).otherwise(F.lit("und")).alias("lang_pred"),
                    F.when(some_letters, share).otherwise(F.lit(0.0)).alias("score"),
                    F.coalesce(best > F.element_at(limits, at), F.lit(True)).alias("rejected"), best.alias("cross_entropy"))

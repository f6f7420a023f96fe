"""Operator 5: benchmark decontamination as a prefix-filtered set join (DataFrame only).

Every item is cut into windows of ``size`` consecutive words (a shorter item
is one window). A window must occur whole, so its necessary prefix is one
token: its rarest word by corpus frequency. Document words join the windows
on that word alone; the word's place in the window gives the one place where
the window could start (positional bound), the document's word count must
cover it (length bound), and the words there are compared in full.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Texts are
split before case is looked at (A-Z are word characters then); the join uses
``lower``, which maps every text that agrees after A-Z folding alike, and the
comparison folds A-Z alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from polyvox.llm.common import staged, text_id

WINDOW = 13
#: Window and vocabulary tables up to this many rows are broadcast; larger ones meet in a shuffle join.
BROADCAST_ROWS = 200_000
_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order, case kept; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPLIT), "")


def fold(word: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(word, _UPPER, _LOWER)


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window, items, first, n``: distinct windows (folded words) with the items
    (as strings) that hold them. Items without words have none; repeated items count once,
    and all items of null id are one item, null."""
    w = F.transform(words(F.col("text")), fold)
    b = benchmark.select(F.col("item_id").cast("string").alias("item"), w.alias("w")).filter("size(w) > 0")
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    b = b.select("item", "w", F.explode(starts).alias("at"))
    return (b.select("item", F.slice("w", F.col("at"), F.lit(size)).alias("window"))
            .groupBy("window").agg(F.transform(F.collect_set(F.struct("item")), lambda x: x["item"]).alias("items"))
            .withColumn("n", F.size("window")))


def _checked(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def anchored(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Windows with ``anchor`` (lower-cased rarest word, ties to the first) and its 0-based ``at``.

    Frequencies are counted over all documents, for words of the benchmark
    only: documents' words meet that vocabulary and are summed before they move.
    """
    vocab = windows.select(F.explode("window").alias("word")).select(F.lower("word").alias("word")).distinct()
    vocab = staged(vocab, "decon-words")
    found = (docs.select(F.explode(words(F.col("text"))).alias("word")).select(F.lower("word").alias("word"))
             .join(_checked(vocab, vocab.count()), "word"))
    freq = found.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    each = windows.select("window", F.posexplode("window").alias("at", "raw")).select("window", "at", F.lower("raw").alias("word"))
    rare = (each.join(freq, "word", "left")
            .groupBy("window").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "at", "word")).alias("r")))
    return windows.join(rare, "window").select("window", "items", "n", F.col("r.word").alias("anchor"), F.col("r.at").alias("at"))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, tid, start, stop, items``: verified places of windows (0-based words, stop exclusive)."""
    win = staged(anchored(staged(item_windows(benchmark, size), "decon-windows"), docs), "decon-anchors")
    n_win = win.count()
    # windows of one anchor word in one row: a document word meets its key once
    keyed = win.groupBy("anchor").agg(F.collect_list(F.struct("window", "items", "n", "at")).alias("wins"))
    tokens = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("tid"), words(F.col("text")).alias("w"))
              .select("doc_id", "tid", "w", F.posexplode("w").alias("pos", "word"))
              .withColumn("anchor", F.lower("word")))
    if n_win > BROADCAST_ROWS:  # words, not whole word lists, travel to the windows
        return _shuffled(tokens, docs, win)
    hit = tokens.join(F.broadcast(keyed), "anchor")
    start = F.col("pos") - F.col("c.at")
    cand = (hit.select("doc_id", "tid", "w", "pos", F.explode("wins").alias("c"))
            .filter((start >= 0) & (start + F.col("c.n") <= F.size("w"))))
    same = F.transform(F.slice("w", start + 1, F.col("c.n")), fold) == F.col("c.window")
    return cand.filter(same).select("doc_id", "tid", start.alias("start"), (start + F.col("c.n")).alias("stop"),
                                    F.col("c.items").alias("items"))


def _shuffled(tokens: DataFrame, docs: DataFrame, win: DataFrame) -> DataFrame:
    """The same join for window tables of any size: (document, word, position) rows meet the
    windows on the anchor (AQE splits hot words), then candidates fetch their document's words."""
    slim = tokens.select("doc_id", "tid", "pos", "anchor", F.size("w").alias("len"))
    start = F.col("pos") - F.col("at")
    cand = (slim.join(win, "anchor").filter((start >= 0) & (start + F.col("n") <= F.col("len")))
            .select("tid", start.alias("start"), "n", "window", "items", "doc_id"))
    texts = docs.select(text_id().alias("tid"), words(F.col("text")).alias("w")).dropDuplicates(["tid"])
    same = F.transform(F.slice("w", F.col("start") + 1, F.col("n")), fold) == F.col("window")
    return cand.join(texts, "tid").filter(same).select("doc_id", "tid", "start", (F.col("start") + F.col("n")).alias("stop"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts words inside any occurrence; a row is contaminated if
    n_hit > 0 and 20 * n_hit >= n_words. Null or empty text: no words, not
    contaminated. Items of null id contaminate like others; together they count as one
    in ``n_items`` and are left out of ``items_sha256``. Rows stay one for one: repeated rows get equal results and a
    null doc_id is a key like any other. Other columns are ignored.
    """
    occ = occurrences(docs, benchmark, size)
    key = ["doc_id", "tid"]
    spans = occ.groupBy(*key, "start").agg(F.max("stop").alias("stop"), F.flatten(F.collect_set("items")).alias("items"))
    spans = staged(spans, "decon-spans")
    before = F.max("stop").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = (spans.select(*key, "start", "stop", before.alias("seen"))
               .withColumn("new", F.greatest(F.col("stop") - F.greatest("start", F.coalesce("seen", F.lit(0))), F.lit(0)))
               .groupBy(*key).agg(F.sum("new").cast("long").alias("n_hit")))
    items = (spans.select(*key, F.explode("items").alias("item")).distinct()
             .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("ids"), F.count(F.lit(1)).alias("n_items"))
             .select(*key, "n_items", F.array_join("ids", ",").alias("ids")))
    hits = covered.join(items, (covered["tid"] == items["tid"]) & covered["doc_id"].eqNullSafe(items["doc_id"])).select(
        covered["doc_id"].alias("h_id"), covered["tid"].alias("h_tid"), "n_hit", "n_items", "ids")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("tid"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.lit(0).cast("long")
    n_hit = F.coalesce("n_hit", none)
    return (base.join(hits, (base["tid"] == hits["h_tid"]) & base["doc_id"].eqNullSafe(hits["h_id"]), "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
                    F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "tid"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    occ = contamination(docs, benchmark, size).filter("contaminated").select(
        F.col("doc_id").alias("__d"), F.col("tid").alias("__t")).distinct()
    same = [F.col("doc_id").cast("long").eqNullSafe(F.col("__d")), text_id() == F.col("__t")]
    return docs.join(occ, reduce(Column.__and__, same), "left_anti")

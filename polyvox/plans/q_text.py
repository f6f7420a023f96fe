"""Topic text queries: terms, c-TF-IDF, keywords, representative documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyvox.operators import text as T
from polyvox.operators.select import not_rejected
from polyvox.plans.catalog import query
from polyvox.plans.oracle import VIEWS
from polyvox.sources.adapters import Fixture
from polyvox.sources.store import materialize, staged

_TOKS = r"regexp_extract_all(lower(commentText), '[\p{L}\p{N}_]{2,}')"


def text_views(p: str, source: str) -> None:
    """Register the SQL twin of the text model over ``source`` (a query with
    dataset, commentId, topicId, commentText) as views fx_{p}_toks ... fx_{p}_dweights."""
    VIEWS[f"fx_{p}_toks"] = f"""
SELECT dataset, commentId, topicId, {_TOKS} AS toks FROM ({source})"""
    VIEWS[f"fx_{p}_stop"] = f"""
SELECT dataset, list(word) AS stop FROM (
  SELECT w.dataset, w.word FROM (
    SELECT dataset, word, count(*) AS df
    FROM (SELECT dataset, unnest(list_distinct(toks)) AS word FROM fx_{p}_toks)
    GROUP BY dataset, word) w
  JOIN (SELECT dataset, count(*) AS n FROM fx_{p}_toks GROUP BY dataset) d USING (dataset)
  WHERE w.df >= d.n * {T.MAX_DF}
  UNION
  SELECT 'fixture' AS dataset, word
  FROM (SELECT unnest(string_split_regex(lower('Fixture discussion'), '[^\\p{{L}}\\p{{N}}_]+')) AS word)
  WHERE length(word) > 0)
GROUP BY dataset"""
    VIEWS[f"fx_{p}_dterms"] = f"""
WITH k AS (
  SELECT t.dataset, t.commentId, t.topicId,
         list_filter(t.toks, lambda w: NOT list_contains(coalesce(s.stop, []), w)) AS toks
  FROM fx_{p}_toks t LEFT JOIN fx_{p}_stop s ON t.dataset = s.dataset),
x AS (
  SELECT dataset, commentId, topicId,
         unnest(list_concat(toks, list_transform(range(1, len(toks)),
                                                 lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
  FROM k)
SELECT dataset, commentId, topicId, term, count(*) AS n FROM x
GROUP BY dataset, commentId, topicId, term"""
    VIEWS[f"fx_{p}_tterms"] = f"""
SELECT dataset, topicId, term, CAST(sum(n) AS BIGINT) AS n FROM fx_{p}_dterms WHERE topicId >= 0
GROUP BY dataset, topicId, term"""
    VIEWS[f"fx_{p}_idf"] = f"""
SELECT f.dataset, f.term, ln(1 + a.A / f.f) AS idf
FROM (SELECT dataset, term, sum(n) AS f FROM fx_{p}_tterms GROUP BY dataset, term) f
JOIN (SELECT dataset, floor(avg(tot)) AS A
      FROM (SELECT dataset, topicId, sum(n) AS tot FROM fx_{p}_tterms GROUP BY dataset, topicId)
      GROUP BY dataset) a USING (dataset)"""
    VIEWS[f"fx_{p}_ctfidf"] = f"""
SELECT t.dataset, t.topicId, t.term, sqrt(t.n / s.tot) * i.idf AS weight
FROM fx_{p}_tterms t
JOIN (SELECT dataset, topicId, sum(n) AS tot FROM fx_{p}_tterms GROUP BY dataset, topicId) s
  ON t.dataset = s.dataset AND t.topicId = s.topicId
JOIN fx_{p}_idf i ON t.dataset = i.dataset AND t.term = i.term"""
    VIEWS[f"fx_{p}_dweights"] = f"""
SELECT d.dataset, d.commentId, d.topicId, d.term, d.n,
       sqrt(d.n / s.tot) * i.idf AS dweight
FROM fx_{p}_dterms d
JOIN (SELECT dataset, commentId, sum(n) AS tot FROM fx_{p}_dterms GROUP BY dataset, commentId) s
  ON d.dataset = s.dataset AND d.commentId = s.commentId
JOIN fx_{p}_idf i ON d.dataset = i.dataset AND d.term = i.term"""


text_views("src", "SELECT dataset, commentId, topicId, commentText FROM fx_comments WHERE moderated >= 0")


def model(spark, sf_dir, reused=False):
    """Documents' words, c-TF-IDF weights and idf over the not-rejected statements,
    grouped by their topic. With ``reused`` (several steps read weights or idf) the counts are written."""
    f = Fixture(spark, sf_dir)
    # the vectoriser's words are written once and counted by every later step: terms take ten times their size
    words = materialize(spark, sf_dir, "doc_words_src", lambda: T.doc_words(
        not_rejected(f.comments), T.title_stop_words(f.summary), max_df=T.MAX_DF), base=False)
    counts = T.topic_term_counts(words, sums=True)
    weights, idf = T.ctfidf(staged(counts, "term-counts") if reused else counts, totals=staged(T.topic_totals(words), "totals"))
    return f, words, weights, idf


def doc_terms(spark, sf_dir):
    """Terms of the not-rejected statements' documents, written once."""
    f = Fixture(spark, sf_dir)
    return f, materialize(spark, sf_dir, "doc_terms_src", lambda: T.doc_terms(
        not_rejected(f.comments), T.title_stop_words(f.summary), max_df=T.MAX_DF), base=False)


@query("topic_terms", "H5 H6", "SELECT * FROM fx_src_tterms")
def q_topic_terms(spark, sf_dir):
    _, words, _, _ = model(spark, sf_dir)
    return T.topic_term_counts(words).withColumn("n", F.col("n").cast("bigint"))


@query("ctfidf", "H7", """
SELECT dataset, topicId, term, round(weight, 6) AS weight FROM fx_src_ctfidf""")
def q_ctfidf(spark, sf_dir):
    _, _, weights, _ = model(spark, sf_dir)
    return weights.withColumn("weight", F.round("weight", 6))


@query("topic_keywords", "H8 H10", """
SELECT dataset, topicId, term, round(weight, 6) AS weight, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId ORDER BY weight DESC, term) AS rank
  FROM fx_src_ctfidf) WHERE rank <= 10""")
def q_topic_keywords(spark, sf_dir):
    _, _, weights, _ = model(spark, sf_dir)
    return T.top_terms(weights, 10).withColumn("weight", F.round("weight", 6))


@query("representative_docs", "H11", """
WITH dn AS (SELECT dataset, commentId, sqrt(sum(dweight * dweight)) AS dn FROM fx_src_dweights
            GROUP BY dataset, commentId),
tn AS (SELECT dataset, topicId, sqrt(sum(weight * weight)) AS tn FROM fx_src_ctfidf
       GROUP BY dataset, topicId),
dot AS (SELECT d.dataset, d.topicId, d.commentId, sum(d.dweight * w.weight) AS dot
        FROM fx_src_dweights d JOIN fx_src_ctfidf w
          ON d.dataset = w.dataset AND d.topicId = w.topicId AND d.term = w.term
        WHERE d.topicId >= 0 GROUP BY d.dataset, d.topicId, d.commentId),
s AS (SELECT dot.dataset, dot.topicId, dot.commentId, dot.dot / (dn.dn * tn.tn) AS score
      FROM dot JOIN dn ON dot.dataset = dn.dataset AND dot.commentId = dn.commentId
      JOIN tn ON dot.dataset = tn.dataset AND dot.topicId = tn.topicId)
SELECT dataset, topicId, commentId, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId ORDER BY round(score, 9) DESC, commentId) AS rank
  FROM s) WHERE rank <= 3""")
def q_representative_docs(spark, sf_dir):
    _, words, weights, idf = model(spark, sf_dir, reused=True)
    return T.representative_docs(words, weights, idf, 3)

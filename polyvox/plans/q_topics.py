"""Topic-model queries over the embeddings-based assignment and the text model."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyvox.operators import cluster as K
from polyvox.operators import hierarchy as HI
from polyvox.operators import embed as EM
from polyvox.operators import text as T
from polyvox.operators import similar as S
from polyvox.operators import topics as TP
from polyvox.operators.select import not_rejected
from polyvox.operators.skew import few
from polyvox.plans.catalog import query
from polyvox.plans.oracle import VIEWS
from polyvox.plans.q_text import model as text_model
from polyvox.plans.q_text import text_views
from polyvox.sources.adapters import OUTLIER_LABEL, Fixture
from polyvox.sources.store import materialize, staged

VIEWS["fx_assign"] = f"""
SELECT c.dataset, c.commentId, e.embedding,
       CAST(CASE WHEN e.label IS NULL OR e.label >= {OUTLIER_LABEL} THEN -1 ELSE e.label END
            AS INTEGER) AS topicId
FROM fx_comments c LEFT JOIN embeddings e ON c.commentId = e.vec_id
WHERE c.moderated >= 0"""

VIEWS["fx_cent_long"] = """
SELECT dataset, topicId, dim, avg(x) AS value FROM (
  SELECT dataset, topicId, unnest(range(len(embedding))) AS dim, unnest(embedding) AS x
  FROM fx_assign WHERE topicId >= 0 AND embedding IS NOT NULL)
GROUP BY dataset, topicId, dim"""

VIEWS["fx_cent"] = """
SELECT dataset, topicId, list(value ORDER BY dim) AS centroid FROM fx_cent_long
GROUP BY dataset, topicId"""


def _dot(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)))")


def _cos(a: str, b: str) -> str:
    return f"({_dot(a, b)} / (sqrt({_dot(a, a)}) * sqrt({_dot(b, b)})))"


VIEWS["fx_h12"] = f"""
WITH s AS (
  SELECT o.dataset, o.commentId, c.topicId AS t, {_cos('o.embedding', 'c.centroid')} AS sim
  FROM fx_assign o JOIN fx_cent c ON o.dataset = c.dataset
  WHERE o.topicId = -1 AND o.embedding IS NOT NULL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, commentId
                                                  ORDER BY sim DESC, t) AS rn FROM s)
      WHERE rn = 1)
SELECT a.dataset, a.commentId, a.embedding, CAST(coalesce(b.t, a.topicId) AS INTEGER) AS topicId,
       b.sim AS similarity
FROM fx_assign a LEFT JOIN b ON a.dataset = b.dataset AND a.commentId = b.commentId"""

text_views("h12", """SELECT h.dataset, h.commentId, h.topicId, c.commentText FROM fx_h12 h
JOIN fx_comments c ON h.dataset = c.dataset AND h.commentId = c.commentId""")


def fx(spark, sf_dir) -> Fixture:
    return Fixture(spark, sf_dir)


@query("topic_sizes", "E22 E23", """
WITH s AS (SELECT dataset, topicId, count(*) AS size FROM fx_assign GROUP BY dataset, topicId)
SELECT s.*, st.n_comments, st.n_topics, st.n_outliers, st.largest
FROM s JOIN (
  SELECT dataset, CAST(sum(size) AS BIGINT) AS n_comments, count_if(topicId >= 0) AS n_topics,
         CAST(coalesce(sum(CASE WHEN topicId = -1 THEN size END), 0) AS BIGINT) AS n_outliers,
         max(CASE WHEN topicId >= 0 THEN size END) AS largest
  FROM s GROUP BY dataset) st USING (dataset)""")
def q_topic_sizes(spark, sf_dir):
    return K.topic_sizes(fx(spark, sf_dir).assignment)


@query("topic_centroids", "H12 (centroids)", """
SELECT dataset, topicId, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM fx_cent_long""")
def q_topic_centroids(spark, sf_dir):
    return (K.centroids_long(fx(spark, sf_dir).assignment)
            .withColumn("value", F.round("value", 6)))


@query("reassign_by_embedding", "D14 H12", """
SELECT dataset, commentId, topicId, round(similarity, 6) AS similarity FROM fx_h12""")
def q_reassign_embedding(spark, sf_dir):
    a = fx(spark, sf_dir).assignment
    out = K.reassign_by_embedding(a, K.centroids(a))
    return out.select("dataset", "commentId", "topicId", F.round("similarity", 6).alias("similarity"))


def _h12(spark, sf_dir):
    """(fixture, assignment after H12, its documents' words, the written counts of their terms, idf and weights)."""
    f = fx(spark, sf_dir)
    a = K.reassign_by_embedding(f.assignment, K.centroids(f.assignment)).select("dataset", "commentId", "topicId")
    a = staged(a, "assigned")  # a few bytes a document; unless they are very many texts don't move to them
    docs = few(a).join(f.comments.select("dataset", "commentId", "commentText"), ["dataset", "commentId"])
    words = materialize(spark, sf_dir, "doc_words_h12", lambda: T.doc_words(
        docs, T.title_stop_words(f.summary), max_df=T.MAX_DF), base=False)
    weights, idf = T.ctfidf(staged(T.topic_term_counts(words, sums=True), "term-counts"), totals=staged(T.topic_totals(words), "totals"))
    return f, a, words, weights, idf


@query("reassign_by_terms", "H13 H14", """
WITH o AS (SELECT dataset, commentId FROM fx_h12 WHERE topicId = -1),
s AS (
  SELECT d.dataset, d.commentId, w.topicId AS t, sum(d.dweight * w.weight) AS s
  FROM fx_h12_dweights d JOIN o ON d.dataset = o.dataset AND d.commentId = o.commentId
  JOIN fx_h12_ctfidf w ON d.dataset = w.dataset AND d.term = w.term
  GROUP BY d.dataset, d.commentId, w.topicId),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, commentId
                                                  ORDER BY s DESC, t) AS rn
                     FROM s WHERE s > 0) WHERE rn = 1)
SELECT h.dataset, h.commentId,
       CAST(CASE WHEN h.topicId = -1 THEN coalesce(b.t, -1) ELSE h.topicId END AS INTEGER) AS topicId
FROM fx_h12 h LEFT JOIN b ON h.dataset = b.dataset AND h.commentId = b.commentId""")
def q_reassign_terms(spark, sf_dir):
    _, a, words, weights, idf = _h12(spark, sf_dir)
    out = T.reassign_by_terms(a, words, weights, idf)
    return out.select("dataset", "commentId", "topicId")


@query("reassign_by_windows", "H13 (windows of 4, stride 1)", """
WITH o AS (SELECT dataset, commentId FROM fx_h12 WHERE topicId = -1),
k AS (SELECT t.dataset, t.commentId, list_filter(t.toks, lambda w: NOT list_contains(coalesce(s.stop, []), w)) AS w
      FROM fx_h12_toks t JOIN o USING (dataset, commentId) LEFT JOIN fx_h12_stop s ON t.dataset = s.dataset),
x AS (SELECT dataset, commentId, s, w[s:s + 3] AS w FROM (
  SELECT dataset, commentId, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM k WHERE len(w) > 0)),
n AS (SELECT dataset, commentId, s, term, count(*) AS n FROM (
  SELECT dataset, commentId, s, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM x)
  GROUP BY ALL),
d AS (SELECT n.dataset, n.commentId, n.s, n.term, sqrt(n.n / t.tot) * i.idf AS wt
      FROM n JOIN (SELECT dataset, commentId, s, sum(n) AS tot FROM n GROUP BY ALL) t USING (dataset, commentId, s)
      JOIN fx_h12_idf i ON i.dataset = n.dataset AND i.term = n.term),
c AS (SELECT p.dataset, p.commentId, p.s, p.topicId, dot / (dn * tn) AS cos
      FROM (SELECT d.dataset, d.commentId, d.s, w.topicId, sum(d.wt * w.weight) AS dot
            FROM d JOIN fx_h12_ctfidf w ON d.dataset = w.dataset AND d.term = w.term GROUP BY ALL) p
      JOIN (SELECT dataset, commentId, s, sqrt(sum(wt * wt)) AS dn FROM d GROUP BY ALL) a USING (dataset, commentId, s)
      JOIN (SELECT dataset, topicId, sqrt(sum(weight * weight)) AS tn FROM fx_h12_ctfidf GROUP BY ALL) b USING (dataset, topicId)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, commentId ORDER BY round(s, 9) DESC, t) AS rn
  FROM (SELECT dataset, commentId, topicId AS t, sum(cos) AS s FROM c WHERE cos >= 0.1 GROUP BY ALL)) WHERE rn = 1)
SELECT h.dataset, h.commentId, CAST(CASE WHEN h.topicId = -1 THEN coalesce(b.t, -1) ELSE h.topicId END AS INTEGER) AS topicId
FROM fx_h12 h LEFT JOIN b ON h.dataset = b.dataset AND h.commentId = b.commentId""")
def q_reassign_windows(spark, sf_dir):
    _, a, words, weights, idf = _h12(spark, sf_dir)
    return T.reassign_by_distributions(a, words, None, weights, idf).select("dataset", "commentId", "topicId")


@query("topic_similarity", "H16", f"""
SELECT a.dataset, a.topicId AS topic_a, b.topicId AS topic_b,
       round({_cos('a.centroid', 'b.centroid')}, 6) AS similarity
FROM fx_cent a JOIN fx_cent b ON a.dataset = b.dataset AND a.topicId <> b.topicId""")
def q_topic_similarity(spark, sf_dir):
    return (K.topic_similarity(K.centroids(fx(spark, sf_dir).assignment))
            .withColumn("similarity", F.round("similarity", 6)))


@query("silhouette", "H17", """
WITH p AS (SELECT dataset, commentId, topicId, CAST(embedding AS DOUBLE[]) AS v
           FROM fx_assign WHERE embedding IS NOT NULL),
per AS (
  SELECT a.dataset, a.commentId, a.topicId AS ta, b.topicId AS tb,
         avg(1 - list_cosine_similarity(a.v, b.v)) AS md
  FROM p a JOIN p b ON a.dataset = b.dataset AND a.commentId <> b.commentId
  GROUP BY a.dataset, a.commentId, a.topicId, b.topicId),
ab AS (SELECT dataset, commentId, ta, max(CASE WHEN ta = tb THEN md END) AS a,
              min(CASE WHEN ta <> tb THEN md END) AS b
       FROM per GROUP BY dataset, commentId, ta),
n AS (SELECT dataset, topicId, count(*) AS n FROM p GROUP BY dataset, topicId),
s AS (SELECT ab.dataset, ab.ta AS topicId,
             CASE WHEN n.n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s
      FROM ab JOIN n ON ab.dataset = n.dataset AND ab.ta = n.topicId)
SELECT c.dataset, c.topicId, c.size, round(c.silhouette, 6) AS silhouette,
       round(o.overall, 6) AS overall
FROM (SELECT dataset, topicId, count(*) AS size, avg(s) AS silhouette FROM s
      GROUP BY dataset, topicId) c
JOIN (SELECT dataset, avg(s) AS overall FROM s GROUP BY dataset) o USING (dataset)""")
def q_silhouette(spark, sf_dir):
    s = K.silhouette(fx(spark, sf_dir).assignment)
    return (s.withColumn("silhouette", F.round("silhouette", 6))
            .withColumn("overall", F.round("overall", 6)))


@query("linked_micro_clusters", "H3 (k-means micro-clusters linked by distance and size, outlier rule)")
def q_linked_micro_clusters(spark, sf_dir):
    f = fx(spark, sf_dir)
    pts = f.assignment.select("dataset", "commentId", "embedding")
    return K.kmeans_topics(pts, outlier_distance=0.6, link_distance=0.2)


def _signed_views(name: str, ngram: int, dims: int) -> None:
    """Twin of ``signed_embeddings`` of the not rejected statements, and ``{name}_pairs``, all pairs' cosines."""
    VIEWS[name] = f"""
SELECT dataset, commentId, v FROM (
  SELECT dataset, commentId, list(coalesce(x, 0) ORDER BY i) AS v
  FROM (SELECT dataset, commentId, i, x FROM (SELECT DISTINCT dataset, commentId FROM {name}_x) CROSS JOIN range({dims}) r(i)
        LEFT JOIN {name}_x USING (dataset, commentId, i)) GROUP BY dataset, commentId)
WHERE list_sum(list_transform(v, lambda a: a * a)) > 0"""
    VIEWS[f"{name}_x"] = f"""
SELECT dataset, commentId, ('0x' || h[1:4])::INTEGER % {dims} AS i,
       sum(CASE WHEN ('0x' || h[5:5])::INTEGER % 2 = 1 THEN 1 ELSE -1 END)::DOUBLE AS x
FROM (SELECT dataset, commentId, md5(array_to_string(t[k:k + {ngram - 1}], ' ')) AS h
      FROM (SELECT dataset, commentId, t, unnest(range(1, len(t) - {ngram - 2})) AS k
            FROM (SELECT dataset, commentId, regexp_extract_all(lower(commentText), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t
                  FROM fx_comments WHERE moderated >= 0) WHERE len(t) >= {ngram}))
GROUP BY ALL"""
    VIEWS[f"{name}_unit"] = f"""
SELECT dataset, commentId, list_transform(v, lambda a: a / sqrt(list_sum(list_transform(v, lambda b: b * b)))) AS u FROM {name}"""
    VIEWS[f"{name}_pairs"] = f"""
SELECT a.dataset, a.commentId AS a, b.commentId AS b, list_dot_product(a.u, b.u) AS cos
FROM {name}_unit a JOIN {name}_unit b ON a.dataset = b.dataset AND a.commentId <> b.commentId"""


NEAR = 0.87       # cosine of near-duplicate statements
RADIUS = 0.13     # cosine distance between neighbours of a dense region
_signed_views("fx_words2", 2, 128)
_signed_views("fx_words1", 1, 64)


@query("near_duplicate_comments", "X1 (H1)", f"""
SELECT * FROM (WITH RECURSIVE link AS MATERIALIZED (SELECT dataset, a, b FROM fx_words2_pairs WHERE cos >= {NEAR}),
reach(dataset, node, label) AS (
  SELECT dataset, commentId, commentId FROM fx_words2
  UNION SELECT r.dataset, l.b, r.label FROM reach r JOIN link l ON r.dataset = l.dataset AND r.node = l.a),
c AS (SELECT dataset, node, min(label) AS classId FROM reach GROUP BY dataset, node)
SELECT dataset, node AS commentId, classId, count(*) OVER (PARTITION BY dataset, classId) AS class_size FROM c)""")
def q_near_duplicate_comments(spark, sf_dir):
    """Near-duplicate classes of the not rejected statements by their word-pair vectors."""
    docs = not_rejected(fx(spark, sf_dir).comments)
    return S.near_duplicates(EM.signed_embeddings(docs, ngram=2, dims=128), threshold=NEAR)


@query("density_clusters", "H3 (core points)", f"""
SELECT * FROM (WITH RECURSIVE link AS MATERIALIZED (SELECT dataset, a, b, cos FROM fx_words1_pairs WHERE cos >= {1 - RADIUS}),
core AS MATERIALIZED (
  SELECT dataset, a AS node, max(CASE WHEN k = 3 THEN 1 - cos END) AS core
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset, a ORDER BY cos DESC) AS k FROM link)
  GROUP BY dataset, a HAVING count(*) >= 3),
strong AS MATERIALIZED (SELECT l.* FROM link l JOIN core x ON (x.dataset, x.node) = (l.dataset, l.a) JOIN core y ON (y.dataset, y.node) = (l.dataset, l.b)),
reach(dataset, node, label) AS (
  SELECT dataset, node, node FROM core
  UNION SELECT r.dataset, l.b, r.label FROM reach r JOIN strong l ON r.dataset = l.dataset AND r.node = l.a),
c AS (SELECT dataset, node, min(label) AS label FROM reach GROUP BY dataset, node),
n AS (SELECT dataset, count(*) AS n FROM fx_words1 GROUP BY dataset),
s AS (SELECT dataset, label, row_number() OVER (PARTITION BY dataset ORDER BY count(*) DESC, label) - 1 AS id
      FROM c JOIN n USING (dataset) GROUP BY dataset, label, n.n HAVING count(*) >= greatest(floor(n.n / 50), 4))
SELECT m.dataset, m.commentId, coalesce(s.id, -1)::INTEGER AS topicId, CASE WHEN core.core IS NOT NULL THEN round(greatest(core.core, 0), 6) END AS core
FROM (SELECT dataset, commentId FROM fx_comments WHERE moderated >= 0) m
LEFT JOIN core ON (core.dataset, core.node) = (m.dataset, m.commentId)
LEFT JOIN c ON (c.dataset, c.node) = (m.dataset, m.commentId) LEFT JOIN s ON (s.dataset, s.label) = (c.dataset, c.label))""")
def q_density_clusters(spark, sf_dir):
    """Dense regions of the not rejected statements' word vectors; the rest are outliers."""
    docs = not_rejected(fx(spark, sf_dir).comments).select("dataset", "commentId", "commentText")
    pts = docs.select("dataset", "commentId").join(EM.signed_embeddings(docs, ngram=1, dims=64), ["dataset", "commentId"], "left")
    return S.density_clusters(pts, radius=RADIUS, min_samples=4).withColumn("core", F.round("core", 6))


@query("topic_reduction", "H4", f"""
SELECT * FROM (WITH RECURSIVE e AS (
  SELECT a.dataset, a.topicId AS x, b.topicId AS y FROM fx_cent a JOIN fx_cent b
    ON a.dataset = b.dataset AND a.topicId <> b.topicId AND {_cos('a.centroid', 'b.centroid')} >= 0.2),
r AS (SELECT dataset, topicId AS node, topicId AS label FROM fx_cent
      UNION SELECT r.dataset, e.y, r.label FROM r JOIN e ON r.dataset = e.dataset AND r.node = e.x),
c AS (SELECT dataset, node, min(label) AS label FROM r GROUP BY dataset, node),
n AS (SELECT a.dataset, c.label, count(*) AS n FROM fx_assign a
      JOIN c ON a.dataset = c.dataset AND a.topicId = c.node GROUP BY a.dataset, c.label),
i AS (SELECT dataset, label, row_number() OVER (PARTITION BY dataset ORDER BY n DESC, label) - 1 AS id FROM n)
SELECT a.dataset, a.commentId, CAST(coalesce(i.id, -1) AS INTEGER) AS topicId
FROM fx_assign a LEFT JOIN c ON a.dataset = c.dataset AND a.topicId = c.node
LEFT JOIN i ON c.dataset = i.dataset AND c.label = i.label)""")
def q_topic_reduction(spark, sf_dir):
    a = fx(spark, sf_dir).assignment
    return K.reduce_topics(a, K.centroids(a), threshold=0.2).select("dataset", "commentId", "topicId")


@query("topic_hierarchy", "H15")
def q_topic_hierarchy(spark, sf_dir):
    _, _, weights, _ = text_model(spark, sf_dir)
    return HI.hierarchy(weights)


@query("pca_coords", "H2 H18 I21")
def q_pca_coords(spark, sf_dir):
    return EM.pca_coords(fx(spark, sf_dir).assignment, k=3)


@query("clustering_sweep", "H19")
def q_clustering_sweep(spark, sf_dir):
    pts = fx(spark, sf_dir).assignment
    return K.sweep(pts, [{"outlier_distance": 0.6, "link_distance": 0.2}, {"outlier_distance": 0.6}, {"k": 10, "dims": 8}])


@query("document_map", "H22")
def q_document_map(spark, sf_dir):
    """Statements with a vector on two principal components, with their source topic and its
    ancestors in the merge tree."""
    f, _, weights, _ = text_model(spark, sf_dir, reused=True)
    labels = TP.headings(T.top_terms(weights, 10), T.title_stop_words(f.summary))
    return TP.document_map(not_rejected(f.comments), EM.pca_coords(f.assignment, k=2), HI.hierarchy(weights), labels)


@query("hash_embeddings", "H1 M3")
def q_hash_embeddings(spark, sf_dir):
    return EM.hash_embeddings(not_rejected(fx(spark, sf_dir).comments))


@query("mmr_keywords", "H9")
def q_mmr_keywords(spark, sf_dir):
    _, _, weights, _ = text_model(spark, sf_dir, reused=True)
    return TP.mmr_keywords(weights)


@query("topic_headings", "J6 C16 H21", """
WITH k AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId ORDER BY weight DESC, term) AS rank
  FROM fx_h12_ctfidf) WHERE rank <= 10),
h AS (SELECT dataset, topicId, string_agg(term, ' ' ORDER BY rank) FILTER (WHERE rank <= 2) AS Heading,
             string_agg(term, ', ' ORDER BY rank) FILTER (WHERE rank <= 5) AS Title
      FROM k GROUP BY dataset, topicId)
SELECT t.dataset, t.topicId AS Topic,
       CASE WHEN t.topicId = -1 THEN 'Outliers' ELSE coalesce(Heading, 'Topic ' || t.topicId) END AS Heading,
       CASE WHEN t.topicId = -1 THEN 'Outliers' ELSE coalesce(Title, 'Topic ' || t.topicId) END AS Title
FROM (SELECT DISTINCT dataset, topicId FROM fx_h12) t
LEFT JOIN h ON t.dataset = h.dataset AND t.topicId = h.topicId""")
def q_topic_headings(spark, sf_dir):
    """Headings of the embedding topics; statements without a vector are the outliers."""
    f, a, _, weights, _ = _h12(spark, sf_dir)
    return TP.headings(T.top_terms(weights, 10), T.title_stop_words(f.summary), topics=a)


@query("comments_with_topics", "H20 D2", """
SELECT c.dataset, c.commentId, c.authorId, c.moderated, c.agrees, c.disagrees, h.topicId
FROM fx_comments c LEFT JOIN fx_h12 h ON c.dataset = h.dataset AND c.commentId = h.commentId""")
def q_comments_with_topics(spark, sf_dir):
    """The new topic assignment written back to all statements; rejected ones have none."""
    f = fx(spark, sf_dir)
    a = K.reassign_by_embedding(f.assignment, K.centroids(f.assignment))
    out = TP.replace_columns(f.comments, a, ["dataset", "commentId"], ["topicId"])
    return out.select("dataset", "commentId", "authorId", "moderated", "agrees", "disagrees", "topicId")


@query("topic_info", "H10 H21", """
WITH k AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, topicId ORDER BY weight DESC, term) AS rank
  FROM fx_src_ctfidf) WHERE rank <= 10),
g AS (SELECT dataset, topicId, string_agg(term, ', ' ORDER BY rank) AS Representation,
             string_agg(term, ' ' ORDER BY rank) FILTER (WHERE rank <= 2) AS Heading,
             string_agg(term, ', ' ORDER BY rank) FILTER (WHERE rank <= 5) AS Title
      FROM k GROUP BY dataset, topicId),
d AS (SELECT dataset, topicId, least(3, count(DISTINCT commentId)) AS n_docs FROM fx_src_dterms
      WHERE topicId >= 0 GROUP BY dataset, topicId),
s AS (SELECT dataset, topicId, count(*) AS n FROM fx_comments WHERE moderated >= 0 GROUP BY dataset, topicId)
SELECT s.dataset, s.topicId AS Topic, s.n AS Count, g.Representation, CAST(d.n_docs AS INTEGER) AS n_docs,
       g.Title, g.Heading
FROM s LEFT JOIN g ON s.dataset = g.dataset AND s.topicId = g.topicId
LEFT JOIN d ON s.dataset = d.dataset AND s.topicId = d.topicId""")
def q_topic_info(spark, sf_dir):
    f, words, weights, idf = text_model(spark, sf_dir, reused=True)
    nr = not_rejected(f.comments)
    sizes = K.topic_sizes(nr.select("dataset", "commentId", "topicId"))
    kw = T.top_terms(weights, 10)
    rep = T.representative_docs(words, weights, idf, 3)
    labels = TP.headings(kw, T.title_stop_words(f.summary))
    info = TP.topic_info(sizes, kw, rep, f.comments, labels)
    return info.select("dataset", "Topic", "Count", F.array_join("Representation", ", ")
                       .alias("Representation"), F.size("Representative_Docs").alias("n_docs"),
                       "Title", "Heading")

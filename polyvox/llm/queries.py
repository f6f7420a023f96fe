"""Registered queries of the operators (``opN_<name>``), and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyvox.llm import (bpe, decontaminate, langid, ngram_join, pii, ptolemy, spann, suffix_dedup, token_counts, toxicity, url_aliases,
                         vector_codes, warc)
from polyvox.sources.tables import table

#: Where the public tokenizers' files lie; a caller may point elsewhere.
TOKENIZERS = "/opt/tokenizers"
WORDPIECE_VOCABULARY = "byte_bpe_50k.json"
BPE_TOKENIZER = "word_bpe_49k.json"


def crc_mod(n: int) -> F.Column:
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = F.raise_error(F.concat(F.lit("damaged payload in "), "file")).cast("boolean")
    return (warc.roundtrip(spark, table(spark, sf_dir, "pages")).filter(F.coalesce("verified", F.lit(True)) | damaged)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_vocabulary(f"{TOKENIZERS}/{WORDPIECE_VOCABULARY}")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), pieces)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spann.nearest(table(spark, sf_dir, "embeddings"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tid")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod(5) != 0)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), crc_mod(4) != 2)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{BPE_TOKENIZER}", digests=True)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digests=True)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_aliases.judged(table(spark, sf_dir, "pages"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ptolemy.clustered(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_warc, op2_token_counts, op3_nearest, op4_personal_data, op5_decontamination, op6_toxicity,
             op7_language, op8_bpe, op9_suffix_dedup, op10_ngram_join, op11_vector_codes, op12_url_filter, op13_centroids, pipeline]
    return {f.__name__: f for f in found}


# --- SQL -------------------------------------------------------------------

# base32 of a hex digest, 5 bits a character: 20 bytes are 32 characters
OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v, 1), '' ORDER BY i) AS payload_digest
  FROM (SELECT hex, i,
          ((('0x' || substr(hex, 1 + (5 * i) // 4, CASE WHEN i = 31 THEN 2 ELSE 3 END))::BIGINT
            << CASE WHEN i = 31 THEN 4 ELSE 0 END) >> (7 - (5 * i) % 4)) & 31 AS v
        FROM (SELECT DISTINCT hex FROM p), range(32) t(i))
  GROUP BY hex),
k AS (SELECT hex, max(page_id) AS kept FROM p GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM p JOIN k USING (hex) JOIN bits USING (hex)
"""

# the contract's rule by comparing every document window with every item window by equality
CONTAMINATION_CTES = r"""
dw AS (SELECT doc_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
bw AS (SELECT item_id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
docwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, item_id FROM docwin d JOIN win USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
"""
OP5_SQL = "WITH " + CONTAMINATION_CTES.format(docs="documents") + """
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# every part against every entry, two rounds written out
_OP11_ROUND = """
a{k} AS MATERIALIZED (
  SELECT r, part, min({{'d': d, 'e': entry}}) AS best
  FROM (SELECT p.r, p.part, c.entry,
          coalesce(list_sum(list_transform(list_zip(p.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::BIGINT AS d
        FROM p JOIN c{k} c USING (part))
  GROUP BY r, part)"""
_OP11_NEW = """
m{k} AS (
  SELECT part, entry, list((t - ((t % n) + n) % n) // n ORDER BY i)::BIGINT[] AS s
  FROM (SELECT p.part, best.e AS entry, i, sum(p.s[i]) AS t, count(*) AS n
        FROM p JOIN a{k} USING (r, part), unnest(range(1, len(p.s) + 1)) AS u(i) GROUP BY ALL)
  GROUP BY part, entry),
c{next} AS MATERIALIZED (SELECT part, entry, coalesce(m.s, c.s) AS s FROM c{k} c LEFT JOIN m{k} m USING (part, entry))"""
OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS s
  FROM v, unnest(range(16)) AS t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, s FROM p WHERE r <= 64),""" + ",".join(
    _OP11_ROUND.format(k=k) + ("," + _OP11_NEW.format(k=k, next=k + 1) if k < 2 else "") for k in range(3)) + """,
codes AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a2 GROUP BY r),
books AS (SELECT sha256(string_agg(s[i]::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
          FROM c2, unnest(range(1, len(s) + 1)) AS u(i))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN codes USING (r), books
"""

# every page's rule by comparing all rules; components by reachability; links without "." and ".." segments
OP12_SQL = r"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
links AS (
  SELECT url, origin, CASE
           WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(' ' || attr_rel || ' ', '(?i)\scanonical\s') THEN attr_href
           WHEN regexp_matches(tag, '(?is)^<meta') AND regexp_matches(attr_equiv, '(?i)^\s*refresh\s*$')
           THEN nullif(regexp_extract(attr_content, '(?is)^[\s0-9.]*[;,\s]\s*url\s*=\s*["'']?([^"'']*)', 1), '') END AS raw
  FROM (SELECT url, tag, regexp_extract(url, '(?i)^https?://[^/?#]*', 0) AS origin,
          {rel} AS attr_rel, {href} AS attr_href, {equiv} AS attr_equiv, {content} AS attr_content
        FROM (SELECT url, unnest(regexp_extract_all(html,
                '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<(?:link|meta)\b[^>]*>')) AS tag
              FROM pages WHERE url IS NOT NULL)
        WHERE regexp_matches(tag, '(?is)^<(link|meta)'))),
targets AS (
  SELECT url AS src, origin, trim(replace(raw, '&amp;', '&'), ' ') AS t FROM links WHERE raw IS NOT NULL),
edges AS (
  SELECT DISTINCT {src} AS a, {dst} AS b
  FROM (SELECT src, CASE
          WHEN regexp_matches(t, '(?i)^https?://') THEN t
          WHEN regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*:') OR origin = '' THEN NULL
          WHEN starts_with(t, '//') THEN regexp_extract(origin, '^[^:]*:') || t
          WHEN t = '' OR starts_with(t, '#') THEN src
          WHEN starts_with(t, '?') THEN regexp_extract(src, '(?s)^[^?#]*') || t
          WHEN starts_with(t, '/') THEN origin || t
          ELSE origin || coalesce(nullif(regexp_extract(regexp_extract(substr(src, len(origin) + 1), '(?s)^[^?#]*'), '(?s)^.*/'), ''), '/') || t
          END AS dst FROM targets) WHERE dst IS NOT NULL),
reach(a, b) AS (
  SELECT a, a FROM (SELECT a FROM edges UNION SELECT b FROM edges)
  UNION SELECT r.a, e.b FROM reach r JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON r.b = e.a),
urls AS (SELECT DISTINCT u, {host} AS host, {path} AS path
         FROM (SELECT u, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS tail
               FROM (SELECT url AS u FROM pages UNION SELECT a FROM reach))),
judged AS (
  SELECT u, arg_max(h || p, (len(h || p), verdict = 'allow', len(h))) AS rule,
         arg_max(verdict, (len(h || p), verdict = 'allow', len(h))) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY u),
bad AS (SELECT DISTINCT r.a FROM reach r JOIN judged j ON j.u = r.b WHERE j.verdict = 'block')
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.a IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM pages JOIN urls ON urls.u IS NOT DISTINCT FROM pages.url LEFT JOIN judged ON judged.u = pages.url
LEFT JOIN bad ON bad.a = {page}
"""


def _duck_attribute(name: str) -> str:
    value = rf"""(?is)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return f"CASE WHEN regexp_matches(tag, '{value}') THEN " + " || ".join(f"regexp_extract(tag, '{value}', {i})" for i in (1, 2, 3)) + " END"


def _duck_identity(u: str) -> str:
    u = f"regexp_replace({u}, '(?s)#.*$', '')"
    head = f"regexp_extract({u}, '(?s)^[^:/?#]*://[^/?#]*')"
    return f"{_duck_lower(head)} || substr({u}, len({head}) + 1)"


def _duck_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP12_SQL = OP12_SQL.format(
    rel=_duck_attribute("rel"), href=_duck_attribute("href"), equiv=_duck_attribute("http-equiv"), content=_duck_attribute("content"),
    src=_duck_identity("src"), dst=_duck_identity("dst"), page=_duck_identity("pages.url"),
    host=_duck_lower("regexp_extract(tail, '^[^/?#]*')"), path="regexp_extract(tail, '^[^/?#]*([^?#]*)', 1)")

# every vector against every centroid, three rounds written out
_OP13_ROUND = """
a{k} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT v.r, c.c, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{k} c)
  GROUP BY r)"""
_OP13_NEW = """
m{k} AS (
  SELECT c, list((t - ((t % n) + n) % n) // n ORDER BY i)::BIGINT[] AS q
  FROM (SELECT best.c AS c, i, sum(v.q[i]) AS t, count(*) AS n FROM v JOIN a{k} USING (r), unnest(range(1, 65)) AS u(i) GROUP BY ALL)
  GROUP BY c),
c{next} AS MATERIALIZED (SELECT c, coalesce(m.q, o.q) AS q FROM c{k} o LEFT JOIN m{k} m USING (c))"""
OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) AS r,
         list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT (r - 1)::INTEGER AS c, q FROM v WHERE r <= 16 AND vec_id IS NOT NULL),""" + ",".join(
    _OP13_ROUND.format(k=k) + ("," + _OP13_NEW.format(k=k, next=k + 1) if k < 3 else "") for k in range(4)) + """
SELECT vec_id, best.c AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.q, ',')) AS centroid_sha256
FROM v JOIN a3 USING (r) JOIN c3 ON c3.c = best.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op5_decontamination": OP5_SQL, "op11_vector_codes": OP11_SQL, "op12_url_filter": OP12_SQL,
            "op13_centroids": OP13_SQL}

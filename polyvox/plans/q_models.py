"""Model-assisted queries with deterministic default scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyvox.functions.exprs import ABBREVIATED, SENTENCE, bounded_int, choice, first_line, first_phrase, first_tokens
from polyvox.operators import arguments as AR
from polyvox.operators import select as C
from polyvox.operators import text as T
from polyvox.plans.catalog import query
from polyvox.plans.oracle import VIEWS
from polyvox.plans.q_text import doc_terms
from polyvox.sources.adapters import Fixture
from polyvox.sources.tables import table

_TOK = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"

VIEWS["fx_agreeable"] = """
SELECT c.* FROM fx_comments c
JOIN (SELECT dataset, quantile_cont(agreeability, 0.1) AS t FROM fx_comments
      WHERE moderated = 1 GROUP BY dataset) q USING (dataset)
WHERE c.moderated = 1 AND c.agreeability >= q.t"""


@query("statement_lines", "J8 I5", """
SELECT dataset, topicId, commentId,
       CAST(commentId AS VARCHAR) || '. ' || commentText || ' ('
       || coalesce(CAST(CAST(floor(agrees * 100 / nullif(agrees + disagrees, 0)) AS INTEGER) AS VARCHAR),
                   'n/a') || '% voters agree)' AS line
FROM fx_agreeable""")
def q_statement_lines(spark, sf_dir):
    return AR.statement_lines(C.agreeable_comments(Fixture(spark, sf_dir).comments))


# twin of first_sentence
_SENTENCE = (f"replace(trim(regexp_replace(regexp_extract(regexp_replace(p.commentText, '{ABBREVIATED}', '\\1' || chr(1), 'g'), "
             f"'{SENTENCE}', 1), '\\s+$', '')), chr(1), '.')")


@query("generate_arguments", "J7 J8 I6 F5", """
WITH n AS (SELECT dataset, topicId, count(*) AS n FROM fx_agreeable GROUP BY dataset, topicId),
p AS (
  SELECT x.*, n.n FROM (
    SELECT a.*, row_number() OVER (PARTITION BY dataset, topicId
                                   ORDER BY agreeability DESC, agrees DESC, commentId) AS rk
    FROM fx_agreeable a) x JOIN n USING (dataset, topicId)
  WHERE x.rk <= CASE WHEN n.n <= 1 THEN 0 ELSE CAST(ceil(ln(n.n) * 2) AS INTEGER) END),
t AS (
  SELECT dataset, commentId, string_agg(term, ' ' ORDER BY tr) AS title FROM (
    SELECT d.dataset, d.commentId, d.term,
           row_number() OVER (PARTITION BY d.dataset, d.commentId
                              ORDER BY round(d.dweight, 9) DESC, d.term) AS tr
    FROM fx_src_dweights d
    WHERE EXISTS (SELECT 1 FROM p WHERE p.dataset = d.dataset AND p.commentId = d.commentId))
  WHERE tr <= 3 GROUP BY dataset, commentId)
SELECT p.dataset, p.topicId, CAST(p.rk - 1 AS BIGINT) AS argumentId,
       coalesce(t.title, '') AS argumentTitle,
       {SENT} AS argumentContent,
       'AREA: ' || coalesce(t.title, '') || ' | PROBLEMS: ' || {SENT} AS thoughts,
       p.commentId AS sourceCommentId
FROM p LEFT JOIN t ON p.dataset = t.dataset AND p.commentId = t.commentId""".replace("{SENT}", _SENTENCE))
def q_generate_arguments(spark, sf_dir):
    f, dterms = doc_terms(spark, sf_dir)
    agreeable = C.agreeable_comments(f.comments)
    return AR.generate_arguments(agreeable, T.doc_weights_of(dterms, AR.argument_sources(agreeable)))


@query("correlate_pairs", "J9 J10 D7 E8", f"""
WITH s AS (SELECT dataset, topicId, commentId,
                  list_distinct({_TOK.format('commentText')}) AS ws FROM fx_agreeable),
a AS (SELECT dataset, topicId, argumentId,
             list_distinct({_TOK.format('argumentContent')}) AS wa FROM fx_arguments),
p AS (SELECT s.dataset, s.topicId, s.commentId, a.argumentId,
             len(list_intersect(s.ws, a.wa)) AS inter, least(len(s.ws), len(a.wa)) AS sm,
             list_has_any(s.ws, {AR.NEGATIONS!r}) <> list_has_any(a.wa, {AR.NEGATIONS!r}) AS flip
      FROM s JOIN a ON s.dataset = a.dataset AND s.topicId = a.topicId),
q AS (SELECT *, CAST(inter AS DOUBLE) / nullif(sm, 0) AS score,
             coalesce(CAST(inter AS DOUBLE) / nullif(sm, 0) >= {AR.SUPPORT_OVERLAP}, false) AS related
      FROM p)
SELECT dataset, commentId, topicId, argumentId,
       CASE WHEN related AND flip THEN 'REFUTE' WHEN related THEN 'SUPPORT' ELSE 'UNRELATED' END
         AS relationship,
       round(score, 6) AS score,
       CASE WHEN related THEN 'REASON: shares ' || CAST(inter AS VARCHAR) || ' of '
                              || CAST(sm AS VARCHAR) || ' words' END AS reasoning
FROM q""")
def q_correlate_pairs(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return AR.correlate(C.agreeable_comments(f.comments), f.arguments)


def _first_tokens_sql(s: str, n: int) -> str:
    return f"array_to_string(string_split_regex(trim({s}), '\\s+')[1:{n}], ' ')"


_FIRST_WORD = "string_split_regex(trim(text), '\\s+')[1]"


@query("parse_model_output", "I17 I18 I19 I20 M2", f"""
SELECT conv_id, turn,
       {_first_tokens_sql("split_part(text, chr(10), 1)", 50)} AS line,
       {_first_tokens_sql("string_split_regex(text, '[\\n.]')[1]", 20)} AS phrase,
       CASE WHEN upper(trim({_FIRST_WORD})) IN ('SUPPORT', 'REFUTE', 'UNRELATED')
            THEN upper(trim({_FIRST_WORD})) END AS choice,
       CASE WHEN TRY_CAST(trim({_FIRST_WORD}) AS INTEGER) BETWEEN 0 AND 100
            THEN TRY_CAST(trim({_FIRST_WORD}) AS INTEGER) END AS number
FROM conversations WHERE role = 'assistant'""")
def q_parse_model_output(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    word = F.get(F.split(F.trim("text"), r"\s+"), 0)
    return conv.filter(F.col("role") == "assistant").select(
        "conv_id", "turn",
        first_tokens(first_line("text"), 50).alias("line"),
        first_tokens(first_phrase("text"), 20).alias("phrase"),
        choice(word, ["SUPPORT", "REFUTE", "UNRELATED"]).alias("choice"),
        bounded_int(word, 0, 100).alias("number"))


@query("pair_prompts", "J9 (prompt column) D7", """
WITH p AS (
  SELECT s.dataset, s.topicId, a.argumentId, s.commentId,
         'ARGUMENT: ' || a.argumentTitle || '. ' || a.argumentContent || chr(10) || 'COMMENT: ' || s.commentText || chr(10)
         || 'THOUGHT: how they relate' || chr(10) || 'RELATIONSHIP: SUPPORT, REFUTE or UNRELATED' || chr(10)
         || 'REASON: unless unrelated' || chr(10) AS prompt
  FROM fx_agreeable s JOIN fx_arguments a ON s.dataset = a.dataset AND s.topicId = a.topicId)
SELECT dataset, topicId, argumentId, commentId, length(prompt) AS chars, md5(prompt) AS prompt_md5 FROM p""")
def q_pair_prompts(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    p = AR.pair_prompts(C.agreeable_comments(f.comments), f.arguments)
    return p.select("dataset", "topicId", "argumentId", "commentId", F.length("prompt").alias("chars"), F.md5("prompt").alias("prompt_md5"))


def _prompts_sql(context: int) -> str:
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY dataset, topicId ORDER BY agreeability DESC, agrees DESC, commentId) AS rk,
                  count(*) OVER (PARTITION BY dataset, topicId) AS n FROM fx_agreeable),
p AS (
  SELECT dataset, topicId, CAST((rk - 1) // {context} AS INTEGER) AS part,
         'Topic: Fixture discussion' || chr(10) || 'Name ' || CASE WHEN n <= 1 THEN 0 ELSE CAST(ceil(ln(n) * 2) AS INTEGER) END
         || ' areas of concern. For each write:' || chr(10) || 'AREA:' || chr(10) || 'PROBLEMS:' || chr(10) || 'SOLUTIONS:' || chr(10)
         || 'ARGUMENT: one sentence' || chr(10) || 'TITLE: three words' || chr(10) || chr(10)
         || string_agg(CAST(commentId AS VARCHAR) || '. ' || commentText || ' ('
            || coalesce(CAST(CAST(floor(agrees * 100 / nullif(agrees + disagrees, 0)) AS INTEGER) AS VARCHAR), 'n/a')
            || '% voters agree)', chr(10) ORDER BY rk) AS prompt
  FROM r GROUP BY dataset, topicId, n, (rk - 1) // {context})
SELECT dataset, topicId, part, length(prompt) AS chars, md5(prompt) AS prompt_md5 FROM p"""


def _prompts(spark, sf_dir, context: int):
    f = Fixture(spark, sf_dir)
    p = AR.argument_prompts(C.agreeable_comments(f.comments), f.summary, context)
    return p.select("dataset", "topicId", "part", F.length("prompt").alias("chars"), F.md5("prompt").alias("prompt_md5"))


@query("argument_prompts", "J7 J8 (prompt column, all statements)", _prompts_sql(50))
def q_argument_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir, 50)


@query("argument_prompt_parts", "J7 J8 (prompt column for a small context)", _prompts_sql(8))
def q_argument_prompt_parts(spark, sf_dir):
    return _prompts(spark, sf_dir, 8)

"""Queries over the text path: preparation, markdown structure, parts, fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import text as T
from docweave.operators import long_split as LS
from docweave.operators import markdown as M
from docweave.operators.documents import prepare
from docweave.operators.fanout import fan_out_languages
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.sources import testdata as D

BUDGET = D.TEST_BUDGET
TARGETS = ("en", "es", "zh")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(D.md_docs(spark, sf_dir), "md")


def split(p: DataFrame, keys) -> DataFrame:
    """Split prepared documents; the raw markdown length bounds the body length."""
    return M.split_parts(p, keys, "body", BUDGET, size_hint=F.length("md"))


def split_branches(p: DataFrame, keys):
    return M.split_parts_branches(p, keys, "body", BUDGET, size_hint=F.length("md"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(prepared(spark, sf_dir), "doc_id")


# --- PRJ-1 ----------------------------------------------------------------
# Raw input with Windows / old-Mac line ends: doc_id%3=1 → CRLF, doc_id%3=2 → CR.
_RAW_SPARK = ("CASE WHEN doc_id%3=1 THEN replace(text, '\\n', '\\r\\n') "
              "WHEN doc_id%3=2 THEN replace(text, '\\n', '\\r') ELSE text END")
_RAW_SQL = ("CASE WHEN doc_id%3=1 THEN replace(text, chr(10), chr(13)||chr(10)) "
            "WHEN doc_id%3=2 THEN replace(text, chr(10), chr(13)) ELSE text END")


@register("text_normalized", "PRJ-1", sql=f"""
SELECT doc_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars, t = text AS same_as_source
FROM (SELECT doc_id, text, regexp_replace({_RAW_SQL}, '\\r\\n?', chr(10), 'g') AS t FROM documents)
""")
def q_text_normalized(spark, sf_dir):
    docs = D.documents(spark, sf_dir)
    t = T.normalize_newlines(F.expr(_RAW_SPARK))
    return docs.select("doc_id", t.alias("text"), T.n_chars(t).alias("n_chars"),
                       (t == F.col("text")).alias("same_as_source"))


# --- PRJ-2 ----------------------------------------------------------------
@register("local_text_removed", "PRJ-2", sql=f"""
WITH {D.MD_DOCS_CTE}
SELECT doc_id, t AS text, t <> md AS changed
FROM (SELECT doc_id, md, regexp_replace(md, {S.q(T.LOCAL_TEXT_RE)}, '', 'g') AS t FROM md_docs)
""")
def q_local_text_removed(spark, sf_dir):
    md = D.md_docs(spark, sf_dir)
    t = T.remove_local_text("md")
    return md.select("doc_id", t.alias("text"), (t != F.col("md")).alias("changed"))


# --- PRJ-3 ----------------------------------------------------------------
@register("frontmatter_split", "PRJ-3", sql=f"""
WITH {S.prepared_cte()}
SELECT doc_id, has_fm, frontmatter, body FROM prepared
""")
def q_frontmatter_split(spark, sf_dir):
    return prepared(spark, sf_dir).select("doc_id", "has_fm", "frontmatter", "body")


# --- PRJ-8 ----------------------------------------------------------------
@register("token_estimate", "PRJ-8", sql=f"""
WITH {S.prepared_cte()}
SELECT doc_id, CAST(length(body) AS BIGINT) AS n_chars, length(body) / 4.0 AS est_tokens,
       CAST(floor(length(body) / 4.0) AS BIGINT) AS est_tokens_int,
       length(body) <= {4 * BUDGET} AS fits_budget
FROM prepared
""")
def q_token_estimate(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return p.select("doc_id", T.n_chars("body").alias("n_chars"),
                    T.est_tokens("body").alias("est_tokens"),
                    F.floor(T.est_tokens("body")).cast("bigint").alias("est_tokens_int"),
                    (F.length("body") <= 4 * BUDGET).alias("fits_budget"))


# --- STR-1 ----------------------------------------------------------------
@register("md_lines", "STR-1", sql=f"""
WITH {S.prepared_cte()}, {S.lines_cte()}
SELECT doc_id, line_no, line FROM lines
""")
def q_md_lines(spark, sf_dir):
    return M.explode_lines(prepared(spark, sf_dir), "doc_id", "body")


def _classified(spark, sf_dir):
    return M.classify_lines(M.explode_lines(prepared(spark, sf_dir), "doc_id", "body"), "doc_id")


# --- STR-2 ----------------------------------------------------------------
@register("md_code_lines", "STR-2,WIN-1", sql=f"""
WITH {S.prepared_cte()}, {S.lines_cte()}, {S.sections_cte()}
SELECT doc_id, line_no, is_fence, in_code FROM cls
""")
def q_md_code_lines(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "line_no", "is_fence", "in_code")


# --- STR-3 ----------------------------------------------------------------
@register("md_line_classes", "STR-3", sql=f"""
WITH {S.prepared_cte()}, {S.lines_cte()}, {S.sections_cte()}
SELECT doc_id, line_no, is_table, is_list, is_blank, header_level FROM cls
""")
def q_md_line_classes(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "line_no", "is_table", "is_list",
                                             "is_blank", "header_level")


# --- STR-4 ----------------------------------------------------------------
@register("md_sections", "STR-4,WIN-2,WIN-3", sql=f"""
WITH {S.prepared_cte()}, {S.lines_cte()}, {S.sections_cte()}
SELECT doc_id, line_no, header_level, section_no FROM sec
""")
def q_md_sections(spark, sf_dir):
    return (M.assign_sections(_classified(spark, sf_dir), "doc_id")
            .select("doc_id", "line_no", "header_level", "section_no"))


# --- STR-5 ----------------------------------------------------------------
@register("md_section_text", "STR-5", sql=f"""
WITH {S.prepared_cte()}, {S.lines_cte()}, {S.sections_cte()}
SELECT doc_id, section_no, string_agg(line, chr(10) ORDER BY line_no) AS text,
       CAST(length(string_agg(line, chr(10) ORDER BY line_no)) AS BIGINT) AS n_chars
FROM sec GROUP BY doc_id, section_no
""")
def q_md_section_text(spark, sf_dir):
    return M.section_texts(M.assign_sections(_classified(spark, sf_dir), "doc_id"), "doc_id")


# --- STR-7 ----------------------------------------------------------------
@register("md_paragraphs", "STR-7", sql=f"""
WITH {S.prepared_cte()},
long_docs AS (SELECT doc_id, body FROM prepared WHERE length(body) > {4 * BUDGET}),
{S.lines_cte('long_docs')}, {S.sections_cte()}, {S.pieces_cte()}
SELECT doc_id, section_no, para_no, grp, text, n FROM pieces
""")
def q_md_paragraphs(spark, sf_dir):
    p = prepared(spark, sf_dir)
    long_docs = p.where(F.length("body") > 4 * BUDGET)
    lines = M.explode_lines(long_docs, "doc_id", "body")
    secs = M.assign_sections(M.classify_lines(lines, "doc_id"), "doc_id")
    return M.pieces(M.line_pieces(secs, "doc_id", BUDGET), "doc_id")


# --- STR-6 / STR-8 / WIN-6 -------------------------------------------------
@register("doc_parts", "STR-6,STR-8,WIN-6", sql=f"""
WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()}
SELECT doc_id, part_no, text, n_chars, est_tokens FROM parts
""")
def q_doc_parts(spark, sf_dir):
    return parts(spark, sf_dir)


# --- STR-8 for documents that aren't one row ---------------------------------
@register("doc_parts_long", "STR-8", sql=f"""
WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()}
SELECT doc_id, part_no, text, n_chars, est_tokens FROM parts
""")
def q_doc_parts_long(spark, sf_dir):
    p = prepared(spark, sf_dir)
    short = p.where(F.length("body") <= 4 * BUDGET).select("doc_id", F.lit(1).cast("bigint").alias("part_no"), F.col("body").alias("text"))
    lines = M.explode_lines(p.where(F.length("body") > 4 * BUDGET), "doc_id", "body")
    return M.with_sizes(short.unionByName(LS.split_lines(lines, "doc_id", BUDGET)))


# --- STR-9 ----------------------------------------------------------------
@register("part_sizes", "STR-9", sql=f"""
WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()}
SELECT doc_id, count(*) AS n_parts, sum(n_chars) AS part_chars, max(n_chars) AS max_part_chars,
       CAST(max(floor(est_tokens)) AS BIGINT) AS max_part_tokens
FROM parts GROUP BY doc_id
""")
def q_part_sizes(spark, sf_dir):
    return (parts(spark, sf_dir).groupBy("doc_id")
            .agg(F.count("*").alias("n_parts"), F.sum("n_chars").alias("part_chars"),
                 F.max("n_chars").alias("max_part_chars"),
                 F.max(F.floor("est_tokens")).cast("bigint").alias("max_part_tokens")))


# --- STR-10 ---------------------------------------------------------------
@register("reassembled_docs", "STR-10,PRJ-4", sql=f"""
WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()},
joined AS (SELECT doc_id, string_agg(text, chr(10)||chr(10) ORDER BY part_no) AS text FROM parts GROUP BY doc_id)
SELECT j.doc_id,
       CASE WHEN p.frontmatter IS NOT NULL AND p.frontmatter <> '' THEN p.frontmatter||chr(10)||chr(10)||j.text
            ELSE j.text END AS text,
       CAST(length(j.text) AS BIGINT) AS body_chars
FROM joined j JOIN prepared p ON p.doc_id = j.doc_id
""")
def q_reassembled_docs(spark, sf_dir):
    p = prepared(spark, sf_dir)
    joined = M.reassemble(split(p, "doc_id"), "doc_id")
    return (joined.join(p.select("doc_id", "frontmatter"), "doc_id")
            .select("doc_id", T.restore_frontmatter("frontmatter", "text").alias("text"),
                    T.n_chars("text").alias("body_chars")))


# --- JOIN-2 (flagship) ----------------------------------------------------
FANOUT_SQL = f"""
WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()},
langs AS (SELECT unnest(['en', 'es', 'zh']) AS target_lang)
SELECT d.source, l.target_lang, count(DISTINCT p.doc_id) AS n_docs, count(*) AS n_parts,
       sum(p.n_chars) AS part_chars, sum(p.est_tokens) AS est_tokens
FROM parts p JOIN prepared d ON d.doc_id = p.doc_id, langs l
GROUP BY d.source, l.target_lang
"""


def doc_language_fanout(spark, sf_dir, targets=TARGETS):
    """Flagship: split once per document, fan the per-part counters out to the
    target languages, aggregate per (source, language). ``n_docs`` counts first
    parts, so no per-document pre-aggregation (and no extra exchange) is needed."""
    p = prepared(spark, sf_dir)
    prt = split(p, ["doc_id", "source"]).select("source", "part_no", "n_chars", "est_tokens")
    fan = fan_out_languages(prt, targets)
    return (fan.groupBy("source", "target_lang")
            .agg(F.sum(F.when(F.col("part_no") == 1, 1).otherwise(0)).cast("bigint").alias("n_docs"),
                 F.count("*").alias("n_parts"), F.sum("n_chars").alias("part_chars"),
                 F.sum("est_tokens").alias("est_tokens")))


register("doc_language_fanout", "JOIN-2", sql=FANOUT_SQL)(doc_language_fanout)

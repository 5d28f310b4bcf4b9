"""Queries on the reply side: routing, reply clean-up and join, documents out,
token and run accounting, validation parsing, reports and pair checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docweave.functions import text as T
from docweave.operators import frontmatter as FM
from docweave.operators import markdown as M
from docweave.operators import memory as MEM
from docweave.operators import responses as RS
from docweave.operators import structure as ST
from docweave.operators import validation as V
from docweave.operators.flow import target_blocks
from docweave.operators.pairs import pair_outputs
from docweave.operators.routing import BINARY_PROBE_BYTES, CUT_1, CUT_2, CUT_3, is_binary, route
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.plans.request_queries import FM_REPLY_SPARK, FM_REPLY_SQL, clean_field_sql, fm_fields_sql, yaml_scalar_sql
from docweave.plans.text_queries import BUDGET, TARGETS, prepared, split
from docweave.sources import testdata as D
from docweave.session import checkpoint_dir, materialize
from docweave.sinks.files import write_documents
from docweave.sinks.report import report_pieces
from docweave.sources.config import TEST_GLOSSARY

GL = TEST_GLOSSARY
_TLIST = "[" + ", ".join(f"'{t}'" for t in TARGETS) + "]"
N = BINARY_PROBE_BYTES


# ---------------------------------------------------------------------------
# Routing (FLT-1, FLT-2, FLT-3)

def routed(spark, sf_dir):
    f = D.file_rows(spark, sf_dir)
    return f.select("doc_id", "rel_path", "content",
                    is_binary(F.col("content")).alias("is_binary"),
                    route(F.col("rel_path"), F.col("content"), True).alias("action_full"),
                    route(F.col("rel_path"), F.col("content"), False).alias("action_incremental"))


_BIN_SQL = f"""CASE WHEN octet_length(content) > {N} THEN try(decode(content[1:{N} -
      CASE WHEN regexp_matches(hex(content[{N - 2}:{N}]), {S.q(CUT_1)}) THEN 1
           WHEN regexp_matches(hex(content[{N - 2}:{N}]), {S.q(CUT_2)}) THEN 2
           WHEN regexp_matches(hex(content[{N - 2}:{N}]), {S.q(CUT_3)}) THEN 3 ELSE 0 END])) IS NULL
    ELSE try(decode(content)) IS NULL END"""


def _route_sql(path: str) -> str:
    return (f"CASE WHEN NOT (ends_with({path}, '.md') OR ends_with({path}, '.mdx')) OR is_binary THEN 'copy' "
            f"WHEN try(decode(content)) IS NULL THEN 'failed' ELSE 'translate' END")


ROUTED_CTE = f"""{D.MD_DOCS_CTE},
fr AS ({D.FILE_ROWS_SQL}),
rt AS (SELECT doc_id, rel_path, content, {_BIN_SQL} AS is_binary FROM fr),
routed AS (SELECT *, {_route_sql('rel_path')} AS action_full, {_route_sql('lower(rel_path)')} AS action_incremental FROM rt)"""


@register("binary_files", "FLT-1", sql=f"""WITH {ROUTED_CTE}
SELECT rel_path, CAST(octet_length(content) AS BIGINT) AS n_bytes, is_binary FROM routed
""")
def q_binary_files(spark, sf_dir):
    return routed(spark, sf_dir).select("rel_path", F.length("content").cast("bigint").alias("n_bytes"),
                                        "is_binary")


@register("route_files", "FLT-2,FLT-3", sql=f"""WITH {ROUTED_CTE}
SELECT rel_path, action_full, action_incremental FROM routed
""")
def q_route_files(spark, sf_dir):
    return routed(spark, sf_dir).select("rel_path", "action_full", "action_incremental")


# ---------------------------------------------------------------------------
# Requests of translate-routed documents and their replies

def translate_docs(spark, sf_dir):
    """Prepared documents routed ``translate`` (full run). Routing is a
    property of the row itself, so it is a filter, not a join."""
    p = prepared(spark, sf_dir)
    content = D.file_content(F.col("doc_id"), F.col("md"))
    return p.where(route(F.col("rel_path"), content, True) == "translate")


def body_requests(spark, sf_dir):
    parts = split(translate_docs(spark, sf_dir), ["doc_id", "rel_path"])
    fan = parts.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    return fan.select("doc_id", "rel_path", "lang", "part_no", "text",
                      F.concat_ws(":", F.lit("body"), "rel_path", "lang", F.col("part_no").cast("string"))
                      .alias("request_id"), F.col("text").alias("user_prompt"))


def doc_frontmatter(spark, sf_dir):
    """Frontmatter of documents routed to the model, rebuilt per target language; no reply where doc_id % 11 = 0, an error where % 13 = 0."""
    docs = translate_docs(spark, sf_dir).where("has_fm").select("doc_id", "rel_path", "frontmatter")
    fields = materialize(FM.fields(docs, ["doc_id", "rel_path"]), "fields")
    fan = fields.where("translatable and doc_id % 11 <> 0").withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    replies = fan.select(F.concat_ws(":", F.lit("frontmatter"), "rel_path", "lang", F.col("ord").cast("string")).alias("request_id"),
                         F.expr(FM_REPLY_SPARK).alias("content"), F.when(F.col("doc_id") % 13 == 0, F.lit("timeout")).alias("error"))
    return target_blocks(docs.select("rel_path", "frontmatter"), fields, replies, TARGETS)


def joined_replies(spark, sf_dir):
    req = body_requests(spark, sf_dir)
    return RS.join_responses(req.drop("text"), D.responses_for(req))


_REQ_SQL = f"""WITH RECURSIVE {ROUTED_CTE},
{S.prepared_cte()[len(D.MD_DOCS_CTE) + 2:].replace('FROM md_docs', 'FROM md_docs WHERE doc_id IN (SELECT doc_id FROM routed WHERE action_full = ' + "'translate'" + ')', 1)},
{S.parts_cte()},
fp AS (SELECT p.doc_id, d.rel_path, l.lang, p.part_no, p.text,
              'body:' || d.rel_path || ':' || l.lang || ':' || CAST(p.part_no AS VARCHAR) AS request_id
       FROM parts p JOIN prepared d ON d.doc_id = p.doc_id CROSS JOIN (SELECT unnest({_TLIST}) AS lang) l),
resp AS (SELECT request_id,
                CASE WHEN doc_id % 13 = 0 THEN NULL ELSE {D.REPLY_SQL} END AS content,
                CAST(floor(length(text) / 4 + 50) AS INT) AS prompt_tokens,
                CAST(floor(length(text) / 4) AS INT) AS completion_tokens,
                CASE WHEN doc_id % 13 = 0 THEN 'timeout' END AS error
         FROM fp WHERE doc_id % 11 <> 0),
j0 AS (SELECT fp.*, r.content, r.prompt_tokens AS pt, r.completion_tokens AS ct, r.error,
              r.content IS NOT NULL AND r.error IS NULL AS ok
       FROM fp LEFT JOIN resp r ON r.request_id = fp.request_id),
joined AS (SELECT doc_id, rel_path, lang, part_no, request_id,
                  CASE WHEN ok THEN 'translated' ELSE 'fallback_source' END AS status,
                  CASE WHEN ok THEN {S.clean_reply_sql('content')} ELSE text END AS text,
                  CAST(CASE WHEN ok THEN pt ELSE 0 END AS BIGINT) AS prompt_tokens,
                  CAST(CASE WHEN ok THEN ct ELSE 0 END AS BIGINT) AS completion_tokens,
                  CAST(CASE WHEN ok THEN pt + ct ELSE 0 END AS BIGINT) AS tokens
           FROM j0)"""


@register("responses_clean", "RSP-1", sql=f"""{_REQ_SQL}
SELECT request_id, content, {S.clean_reply_sql('content')} AS cleaned FROM resp WHERE content IS NOT NULL
""")
def q_responses_clean(spark, sf_dir):
    r = D.responses_for(body_requests(spark, sf_dir)).where(F.col("content").isNotNull())
    return r.select("request_id", "content", T.clean_reply("content").alias("cleaned"))


@register("responses_joined", "JOIN-5,SRC-6", sql=f"""{_REQ_SQL}
SELECT request_id, status, text, prompt_tokens, completion_tokens, tokens FROM joined
""")
def q_responses_joined(spark, sf_dir):
    return joined_replies(spark, sf_dir).select("request_id", "status", "text", "prompt_tokens",
                                                "completion_tokens", "tokens")


@register("translated_docs", "SNK-1,STR-10,PRJ-4", sql=f"""{_REQ_SQL},
docs AS (SELECT lang, rel_path, string_agg(text, chr(10) || chr(10) ORDER BY part_no) AS body,
                count(*) AS n_parts, CAST(sum(CASE WHEN status = 'fallback_source' THEN 1 ELSE 0 END) AS BIGINT) AS n_fallback,
                CAST(sum(tokens) AS BIGINT) AS tokens
         FROM joined GROUP BY lang, rel_path),
{fm_fields_sql()},
nv AS (SELECT doc_id, ord, key, kind, entry, CASE WHEN translatable AND doc_id % 11 <> 0 AND doc_id % 13 <> 0
              THEN {clean_field_sql(FM_REPLY_SQL)} ELSE value END AS new_value FROM fields2),
built AS (SELECT doc_id, '---' || chr(10) || string_agg(CASE WHEN kind IN ('other', 'block') THEN entry
                 ELSE key || ': ' || {yaml_scalar_sql('new_value', 'kind')} END || chr(10), '' ORDER BY ord) || '---' AS block
          FROM nv GROUP BY doc_id)
SELECT d.lang, d.rel_path, 'output/' || d.lang || '/' || d.rel_path AS output_path,
       CASE WHEN p.frontmatter IS NOT NULL AND p.frontmatter <> '' THEN coalesce(b.block, p.frontmatter) || chr(10) || chr(10) || d.body
            ELSE d.body END AS text,
       d.n_parts, d.n_fallback, d.tokens
FROM docs d JOIN prepared p ON p.rel_path = d.rel_path LEFT JOIN built b ON b.doc_id = p.doc_id
""")
def q_translated_docs(spark, sf_dir):
    docs = RS.assemble_documents(joined_replies(spark, sf_dir), doc_frontmatter(spark, sf_dir))
    return docs.select("lang", "rel_path", F.concat_ws("/", F.lit("output"), "lang", "rel_path").alias("output_path"),
                       "text", "n_parts", "n_fallback", "tokens")


@register("tokens_by_language", "AGG-1,RSP-2", sql=f"""{_REQ_SQL}
SELECT lang, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
       CAST(sum(tokens) AS BIGINT) AS total_tokens
FROM joined GROUP BY ROLLUP (lang)
""")
def q_tokens_by_language(spark, sf_dir):
    return RS.tokens_by_language(joined_replies(spark, sf_dir))


@register("tokens_by_document", "AGG-4", sql=f"""{_REQ_SQL}
SELECT rel_path, lang, CAST(sum(tokens) AS BIGINT) AS tokens FROM joined GROUP BY rel_path, lang
""")
def q_tokens_by_document(spark, sf_dir):
    return (joined_replies(spark, sf_dir).groupBy("rel_path", "lang")
            .agg(F.sum("tokens").cast("bigint").alias("tokens")))


@register("copied_docs", "SNK-2", sql=f"""WITH {ROUTED_CTE}
SELECT l.lang, r.rel_path, 'output/' || l.lang || '/' || r.rel_path AS output_path,
       CAST(octet_length(r.content) AS BIGINT) AS n_bytes, sha256(r.content) AS sha256
FROM routed r CROSS JOIN (SELECT unnest({_TLIST}) AS lang) l WHERE r.action_full = 'copy'
""")
def q_copied_docs(spark, sf_dir):
    c = routed(spark, sf_dir).where(F.col("action_full") == "copy")
    fan = c.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    return fan.select("lang", "rel_path", F.concat_ws("/", F.lit("output"), "lang", "rel_path").alias("output_path"),
                      F.length("content").cast("bigint").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


@register("run_summary", "AGG-2", sql=f"""{_REQ_SQL},
fb AS (SELECT rel_path, lang, max(CASE WHEN status = 'fallback_source' THEN 1 ELSE 0 END) AS any_fb
       FROM joined GROUP BY rel_path, lang)
SELECT l.lang, count(*) AS n_files,
       CAST(sum(CASE WHEN r.action_full <> 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS n_success,
       CAST(sum(CASE WHEN r.action_full = 'copy' THEN 1 ELSE 0 END) AS BIGINT) AS n_copied,
       CAST(sum(CASE WHEN r.action_full = 'translate' THEN 1 ELSE 0 END) AS BIGINT) AS n_translated,
       CAST(sum(CASE WHEN r.action_full = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
       CAST(sum(coalesce(fb.any_fb, 0)) AS BIGINT) AS n_with_fallback
FROM routed r CROSS JOIN (SELECT unnest({_TLIST}) AS lang) l
LEFT JOIN fb ON fb.rel_path = r.rel_path AND fb.lang = l.lang
GROUP BY l.lang
""")
def q_run_summary(spark, sf_dir):
    r = routed(spark, sf_dir).select("rel_path", "action_full")
    fan = r.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    fb = (joined_replies(spark, sf_dir).groupBy("rel_path", "lang")
          .agg(F.max(F.when(F.col("status") == "fallback_source", 1).otherwise(0)).alias("any_fb")))
    a = F.col("action_full")
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return (fan.join(fb, ["rel_path", "lang"], "left").groupBy("lang")
            .agg(F.count("*").alias("n_files"), cnt(a != "failed").alias("n_success"),
                 cnt(a == "copy").alias("n_copied"), cnt(a == "translate").alias("n_translated"),
                 cnt(a == "failed").alias("n_failed"),
                 F.sum(F.coalesce("any_fb", F.lit(0))).cast("bigint").alias("n_with_fallback")))


@register("run_counters", "AGG-1,AGG-2,AGG-3", sql=f"""{_REQ_SQL},
docs AS (SELECT lang, rel_path, count(*) AS n_parts, sum(CASE WHEN status = 'fallback_source' THEN 1 ELSE 0 END) AS n_fallback, sum(tokens) AS tokens
         FROM joined GROUP BY lang, rel_path)
SELECT lang, count(*) AS n_documents, CAST(sum(CASE WHEN n_fallback > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_with_fallback, CAST(sum(n_parts) AS BIGINT) AS n_parts,
       CAST(sum(n_fallback) AS BIGINT) AS n_fallback, CAST(sum(tokens) AS BIGINT) AS tokens
FROM docs GROUP BY lang
""")
def q_run_counters(spark, sf_dir):
    """The run's counters, observed while its documents are written."""
    docs = RS.assemble_documents(joined_replies(spark, sf_dir), doc_frontmatter(spark, sf_dir))
    return write_documents(docs, f"{checkpoint_dir(spark).rstrip('/')}/documents/{uuid.uuid4().hex}", TARGETS)


@register("failed_files", "AGG-3", sql=f"""WITH {ROUTED_CTE},
att AS (SELECT l.lang, r.rel_path, r.action_incremental, count(*) OVER (PARTITION BY l.lang) AS attempts
        FROM routed r CROSS JOIN (SELECT unnest({_TLIST}) AS lang) l)
SELECT lang, rel_path, attempts FROM att WHERE action_incremental = 'failed'
""")
def q_failed_files(spark, sf_dir):
    """Failed paths per language as rows (a list per language would gather a
    whole language in one task) with the attempts of that language
    (files x 1, skipped ones included)."""
    r = routed(spark, sf_dir).select("rel_path", "action_incremental")
    fan = r.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    attempts = fan.groupBy("lang").agg(F.count("*").alias("attempts"))
    failed = fan.where(F.col("action_incremental") == "failed").select("lang", "rel_path")
    return failed.join(F.broadcast(attempts), "lang").select("lang", "rel_path", "attempts")


# ---------------------------------------------------------------------------
# Validation

def _val_parsed(spark, sf_dir):
    return V.parse_issues(D.validation_replies(spark, sf_dir))


_VAL_SQL = f"""rep AS ({D.VALIDATION_REPLIES_SQL}),
rep2 AS (SELECT *, coalesce(try(json_valid(content)), false) AS jv FROM rep),
rep3 AS (SELECT *, CASE WHEN jv THEN json_type(content) END AS top,
                CASE WHEN jv THEN json_type(content, '$.issues') END AS it FROM rep2),
el AS (SELECT rel_path, lang, file_path, content, CAST(unnest(range(CAST(json_array_length(content, '$.issues') AS BIGINT))) AS BIGINT) AS pos
       FROM rep3 WHERE top = 'OBJECT' AND it = 'ARRAY'),
el2 AS (SELECT *, json_extract(content, '$.issues[' || CAST(pos AS VARCHAR) || ']') AS e FROM el),
el3 AS (SELECT *, json_type(e) = 'OBJECT'
                  AND (json_type(e, '$.original') IS NULL OR json_type(e, '$.original') = 'VARCHAR')
                  AND (json_type(e, '$.translated') IS NULL OR json_type(e, '$.translated') = 'VARCHAR')
                  AND (json_type(e, '$.reason') IS NULL OR json_type(e, '$.reason') = 'VARCHAR') AS ok
        FROM el2),
good AS (SELECT rel_path, lang FROM el3 GROUP BY rel_path, lang HAVING bool_and(ok)),
parsed AS (SELECT el3.rel_path, el3.lang, el3.file_path, el3.pos,
                  coalesce(e ->> '$.original', '') AS original, coalesce(e ->> '$.translated', '') AS translated,
                  coalesce(e ->> '$.reason', '') AS reason
           FROM el3 JOIN good ON good.rel_path = el3.rel_path AND good.lang = el3.lang),
{S.glossary_cte()},
flt AS (SELECT p.*,
          EXISTS (SELECT 1 FROM g WHERE g.lang = p.lang AND contains(lower(p.original), lower(g.term))
                   AND contains(lower(p.translated), lower(g.rendering)))
          AND (contains(lower(p.reason), 'глоссари') OR contains(lower(p.reason), 'словар') OR contains(lower(p.reason), 'термин'))
            AS glossary_fp,
          p.original = '' OR p.translated = '' OR p.reason = '' OR length(p.original) < 3 OR length(p.translated) < 3
            AS incomplete
        FROM parsed p),
kept AS (SELECT lang, file_path, pos, original, translated, reason FROM flt WHERE NOT glossary_fp AND NOT incomplete)"""


@register("issues_parsed", "RSP-3,SET-1", sql=f"""WITH {_VAL_SQL}
SELECT rel_path, lang, pos, original, translated, reason FROM parsed
""")
def q_issues_parsed(spark, sf_dir):
    return _val_parsed(spark, sf_dir).select("rel_path", "lang", "pos", "original", "translated", "reason")


def _kept(spark, sf_dir):
    f = V.filter_issues(_val_parsed(spark, sf_dir), GL)
    return f.where("keep").select("lang", "file_path", "pos", "original", "translated", "reason")


@register("issues_filtered", "FLT-4,RSP-4,JOIN-7", sql=f"""WITH {_VAL_SQL}
SELECT lang, file_path, pos, original, translated, reason FROM kept
""")
def q_issues_filtered(spark, sf_dir):
    return _kept(spark, sf_dir)


@register("issue_false_positives", "FLT-4", sql=f"""WITH {_VAL_SQL}
SELECT lang, count(*) AS n_parsed, CAST(sum(CASE WHEN glossary_fp THEN 1 ELSE 0 END) AS BIGINT) AS n_glossary_fp,
       CAST(sum(CASE WHEN incomplete THEN 1 ELSE 0 END) AS BIGINT) AS n_incomplete,
       CAST(sum(CASE WHEN NOT glossary_fp AND NOT incomplete THEN 1 ELSE 0 END) AS BIGINT) AS n_kept
FROM flt GROUP BY lang
""")
def q_issue_false_positives(spark, sf_dir):
    f = V.filter_issues(_val_parsed(spark, sf_dir), GL)
    cnt = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return f.groupBy("lang").agg(F.count("*").alias("n_parsed"), cnt(F.col("glossary_fp")).alias("n_glossary_fp"),
                                 cnt(F.col("incomplete")).alias("n_incomplete"), cnt(F.col("keep")).alias("n_kept"))


@register("validation_report", "AGG-5,SNK-3", sql=f"""WITH {_VAL_SQL},
files AS (SELECT lang, count(*) AS total_files FROM rep GROUP BY lang),
iss AS (SELECT lang, count(*) AS total_issues,
               CAST(sum(length(original) + length(translated) + length(reason)) AS BIGINT) AS issue_chars,
               min(file_path) AS first_file, max(file_path) AS last_file
        FROM kept GROUP BY lang)
SELECT f.lang, f.total_files, CAST(coalesce(i.total_issues, 0) AS BIGINT) AS total_issues,
       CAST(coalesce(i.issue_chars, 0) AS BIGINT) AS issue_chars, i.first_file, i.last_file
FROM files f LEFT JOIN iss i ON i.lang = f.lang
""")
def q_validation_report(spark, sf_dir):
    files = D.validation_replies(spark, sf_dir).select("lang")
    return V.report(files, _kept(spark, sf_dir))


@register("reply_issue_memory", "RSP-3,FLT-4,FLT-5,SET-2,SNK-4", sql=f"""WITH {_VAL_SQL},
full_ AS (SELECT lang, file_path, pos, {S.strip('original')} AS original, {S.strip('translated')} AS translated,
                 {S.strip('reason')} AS reason FROM kept),
once AS (SELECT *, row_number() OVER (PARTITION BY lang, original, translated ORDER BY file_path, pos) AS rn
         FROM full_ WHERE original <> '' AND translated <> '' AND reason <> ''),
known AS (SELECT lang, max(seq) AS top FROM ({D.ISSUES_SQL}) GROUP BY lang)
SELECT o.lang, CAST(coalesce(k.top, -1) + row_number() OVER (PARTITION BY o.lang ORDER BY o.file_path, o.pos) AS BIGINT) AS seq,
       o.original, o.translated, o.reason
FROM (SELECT * FROM once WHERE rn = 1) o LEFT JOIN known k ON k.lang = o.lang
""")
def q_reply_issue_memory(spark, sf_dir):
    """Replies to memory rows: parse, filter, complete rows, exact de-dup in
    reply order, numbers after those of the memory."""
    rows = MEM.complete_for_memory(_kept(spark, sf_dir))
    arrival = F.struct("file_path", "pos")
    once = rows.groupBy("lang", "original", "translated").agg(F.min_by(F.struct("file_path", "pos", "reason"), arrival).alias("r"))
    return MEM.append_memory(D.issues(spark, sf_dir), once.select("lang", "original", "translated", "r.*"), ["file_path", "pos"])


@register("validation_token_stats", "AGG-6", sql=f"""WITH rep AS ({D.VALIDATION_REPLIES_SQL})
SELECT lang, CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens, count(*) AS validated_files,
       sum(prompt_tokens + completion_tokens) / nullif(count(*), 0) AS avg_tokens
FROM rep GROUP BY lang
""")
def q_validation_token_stats(spark, sf_dir):
    return V.token_stats(D.validation_replies(spark, sf_dir))


@register("issue_samples", "ORD-3", sql=f"""WITH {_VAL_SQL}
SELECT * FROM (SELECT lang, file_path, pos, original, translated, reason,
                      row_number() OVER (PARTITION BY lang ORDER BY file_path, pos) AS sample_no FROM kept)
WHERE sample_no <= 5
""")
def q_issue_samples(spark, sf_dir):
    return V.samples(_kept(spark, sf_dir))


# ---------------------------------------------------------------------------
# Pair checks (QA-1 on source vs translated documents, QA-2 on pairs)

def _parity_sql() -> str:
    parts = []
    mism = []
    for name, pat in V.PARITY_PATTERNS.items():
        a = f"CAST(len(regexp_extract_all(s.src, {S.q(pat)})) AS BIGINT)"
        b = f"CAST(len(regexp_extract_all(t.text, {S.q(pat)})) AS BIGINT)"
        parts += [f"{a} AS src_{name}", f"{b} AS out_{name}"]
        mism.append(f"{a} <> {b}")
    return ", ".join(parts) + ", " + " OR ".join(mism) + " AS mismatch"


@register("structure_parity", "QA-1", sql=f"""{_REQ_SQL},
docs AS (SELECT lang, rel_path, string_agg(text, chr(10) || chr(10) ORDER BY part_no) AS text FROM joined GROUP BY lang, rel_path),
s AS (SELECT rel_path, body AS src FROM prepared)
SELECT t.lang, t.rel_path, {_parity_sql()}
FROM docs t JOIN s ON s.rel_path = t.rel_path
""")
def q_structure_parity(spark, sf_dir):
    docs = RS.assemble_documents(joined_replies(spark, sf_dir)).select("lang", "rel_path", F.col("text").alias("translated"))
    src = prepared(spark, sf_dir).select("rel_path", F.col("body").alias("original"))
    return V.structure_parity(docs.join(src, "rel_path"))


@register("structure_diff", "QA-1", sql=f"""{_REQ_SQL},
docs AS (SELECT lang, rel_path, string_agg(text, chr(10) || chr(10) ORDER BY part_no) AS text FROM joined GROUP BY lang, rel_path),
cd AS (SELECT d.lang, d.rel_path, {ST.codes_sql('p.body')} AS a, {ST.codes_sql('d.text')} AS b FROM docs d JOIN prepared p ON p.rel_path = d.rel_path),
fd AS (SELECT *, CASE WHEN a <> b THEN coalesce(
         list_position(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(length(a), length(b))) END AS f FROM cd)
SELECT lang, rel_path, CAST(length(a) AS BIGINT) AS n_src, CAST(length(b) AS BIGINT) AS n_out, CAST(f AS BIGINT) AS first_diff,
       CASE WHEN f < length(a) THEN a[f + 1] END AS src_block, CASE WHEN f < length(b) THEN b[f + 1] END AS out_block,
       CAST(CASE WHEN f IS NULL THEN 0 WHEN f >= least(length(a), length(b)) THEN abs(length(a) - length(b)) ELSE levenshtein(substr(a, f + 1), substr(b, f + 1)) END AS BIGINT) AS n_edits
FROM fd
""")
def q_structure_diff(spark, sf_dir):
    docs = RS.assemble_documents(joined_replies(spark, sf_dir)).select("lang", "rel_path", F.col("text").alias("translated"))
    src = prepared(spark, sf_dir).select("rel_path", F.col("body").alias("original"))
    return ST.structure_diff(docs.join(src, "rel_path"))


@register("report_order", "SNK-3", sql=f"""WITH {_VAL_SQL},
files AS (SELECT lang, count(*) AS total_files FROM rep GROUP BY lang),
n AS (SELECT lang, count(*) AS total FROM kept GROUP BY lang),
line AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY file_path, pos) AS k, file_path, pos,
                '    ' || to_json(struct_pack(file_path := file_path, original := original, translated := translated, reason := reason)) AS item FROM kept),
pieces AS (SELECT lang, k, file_path, pos, CASE WHEN k = 1 THEN item ELSE ',' || chr(10) || item END AS piece FROM line
  UNION ALL SELECT f.lang, 0, NULL, NULL, '{{' || chr(10) || '  "language":"' || f.lang || '",' || chr(10) || '  "total_files": ' || total_files || ',' || chr(10)
    || '  "total_issues": ' || coalesce(total, 0) || ',' || chr(10) || '  "issues": [' || CASE WHEN total > 0 THEN chr(10) ELSE '' END FROM files f LEFT JOIN n USING (lang)
  UNION ALL SELECT f.lang, coalesce(total, 0) + 1, NULL, NULL, CASE WHEN total > 0 THEN chr(10) || '  ]' ELSE ']' END || chr(10) || '}}' FROM files f LEFT JOIN n USING (lang))
SELECT lang, CAST(k AS BIGINT) AS k, file_path, pos, sha256(piece) AS piece_sha256,
       CAST(coalesce(sum(octet_length(encode(piece))) OVER (PARTITION BY lang ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at
FROM pieces
""")
def q_report_order(spark, sf_dir):
    """The places of all pieces in each language's report document."""
    files = D.validation_replies(spark, sf_dir).select("lang")
    return report_pieces(files, _kept(spark, sf_dir)).select("lang", "k", "file_path", "pos", F.sha2("piece", 256).alias("piece_sha256"), "at")


@register("glossary_violations", "QA-2", sql=f"""WITH {S.glossary_cte()},
p AS (SELECT t.rel_path, t.lang, o.original, t.translated FROM ({D.OUTPUTS_SQL}) t JOIN ({D.ORIGINALS_SQL}) o ON o.rel_path = t.rel_path)
SELECT p.rel_path, p.lang, count(g.term) AS n_violations, coalesce(string_agg(g.term, ',' ORDER BY g.ord), '') AS terms
FROM p LEFT JOIN g ON g.lang = p.lang AND contains(lower(p.original), lower(g.term)) AND NOT contains(lower(p.translated), lower(g.rendering))
GROUP BY p.rel_path, p.lang
""")
def q_glossary_violations(spark, sf_dir):
    pairs = pair_outputs(D.originals(spark, sf_dir), D.outputs(spark, sf_dir))
    return V.glossary_violations(pairs.select("rel_path", "lang", "original", "translated"), GL)

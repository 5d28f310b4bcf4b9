"""Queries on the request side: glossary hits, earlier terms, memory prompts,
rendering / frontmatter / validation requests, output paths, pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.operators import frontmatter as FM
from docweave.operators import glossary as G
from docweave.operators import markdown as M
from docweave.operators import memory as MEM
from docweave.operators import requests as R
from docweave.operators.pairs import pair_outputs
from docweave.operators.routing import output_paths
from docweave.operators.term_match import match_terms
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.plans.text_queries import BUDGET, TARGETS, prepared, split, split_branches
from docweave.sources import testdata as D
from docweave.sources.config import LANG_DIRS, TEST_GLOSSARY, TEST_LANGUAGES

GL = TEST_GLOSSARY
_TLIST = "[" + ", ".join(f"'{t}'" for t in TARGETS) + "]"


def keyed_parts(spark, sf_dir):
    return split(prepared(spark, sf_dir), ["doc_id", "rel_path"])


_PARTS_WITH = f"WITH RECURSIVE {S.prepared_cte()}, {S.parts_cte()}, {S.glossary_cte()}, {S.langs_cte(TARGETS)}"


# --- JOIN-3 -----------------------------------------------------------------
@register("glossary_hits", "JOIN-3,SRC-3", sql=f"""{_PARTS_WITH}
SELECT p.doc_id, p.part_no, l.lang AS target_lang, count(g.term) AS n_terms,
       coalesce(string_agg(g.term, ',' ORDER BY g.ord), '') AS terms
FROM parts p CROSS JOIN langs l LEFT JOIN g ON g.lang = l.lang AND contains(p.text, g.term)
GROUP BY p.doc_id, p.part_no, l.lang
""")
def q_glossary_hits(spark, sf_dir):
    fan = keyed_parts(spark, sf_dir).withColumn(
        "target_lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    h = G.hits("text", "target_lang", GL)
    return fan.select("doc_id", "part_no", "target_lang", F.size(h).cast("bigint").alias("n_terms"),
                      F.array_join(F.transform(h, lambda x: x["term"]), ",").alias("terms"))


# --- WIN-4 ------------------------------------------------------------------
def with_earlier(spark, sf_dir):
    short, packed = split_branches(prepared(spark, sf_dir), ["doc_id", "rel_path"])
    return G.earlier_terms_split(short, packed, ["doc_id", "rel_path"], GL)


@register("terms_seen_before", "WIN-4", sql=f"""{_PARTS_WITH}, {S.earlier_cte()}
SELECT doc_id, part_no, lang AS target_lang, coalesce(earlier_terms, '') AS earlier_terms FROM eb
""")
def q_terms_seen_before(spark, sf_dir):
    e = with_earlier(spark, sf_dir)
    fan = e.withColumn("target_lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    g = GL.array()
    with_tr = F.filter("earlier", lambda t: F.exists(g, lambda x: (x["term"] == t)
                                                   & (x["lang"] == F.col("target_lang"))))
    return fan.select("doc_id", "part_no", "target_lang", F.array_join(with_tr, ",").alias("earlier_terms"))


# --- JOIN-3, a glossary of the corpus' own size -------------------------------
@register("glossary_hits_large", "JOIN-3", sql=f"""WITH t AS ({D.TERMS_SQL})
SELECT d.doc_id, count(t.term) AS n_terms, coalesce(string_agg(t.term, ',' ORDER BY t.term), '') AS terms
FROM documents d LEFT JOIN t ON contains(d.text, t.term) GROUP BY d.doc_id
""")
def q_glossary_hits_large(spark, sf_dir):
    docs = D.documents(spark, sf_dir).select("doc_id", "text")
    found = match_terms(docs, ["doc_id"], D.corpus_terms(spark, sf_dir))
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_terms"), F.array_join("found", ",").alias("terms"))


# --- WIN-4 with failed parts --------------------------------------------------
# Parts whose reply failed: those with a length that leaves a remainder of the language's own.
_FAILED = "length(text) % 17 = CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 1 ELSE 2 END"


@register("terms_after_failures", "WIN-4", sql=f"""{_PARTS_WITH}, {S.earlier_cte()},
ft AS (SELECT p.doc_id, p.part_no, l.lang FROM parts p CROSS JOIN langs l WHERE {_FAILED}),
ff AS (SELECT th.doc_id, l.lang, th.term, th.ord, min(th.part_no) AS first_part FROM th CROSS JOIN langs l
       WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.doc_id = th.doc_id AND ft.part_no = th.part_no AND ft.lang = l.lang) GROUP BY ALL),
fg AS (SELECT ff.* FROM ff JOIN g ON g.term = ff.term AND g.lang = ff.lang)
SELECT p.doc_id, p.part_no, l.lang AS target_lang, coalesce(string_agg(fg.term, ',' ORDER BY fg.first_part, fg.ord), '') AS earlier_terms
FROM parts p CROSS JOIN langs l LEFT JOIN fg ON fg.doc_id = p.doc_id AND fg.lang = l.lang AND fg.first_part < p.part_no
GROUP BY p.doc_id, p.part_no, l.lang
""")
def q_terms_after_failures(spark, sf_dir):
    parts = keyed_parts(spark, sf_dir).select("doc_id", "part_no", "text")
    fan = parts.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
    failed = fan.where(F.expr(_FAILED)).select("doc_id", "part_no", "lang")
    e = G.earlier_terms(parts, ["doc_id"], GL, failed=failed, targets=TARGETS)
    g = GL.array()
    with_tr = F.filter("earlier", lambda t: F.exists(g, lambda x: (x["term"] == t) & (x["lang"] == F.col("lang"))))
    return e.select("doc_id", "part_no", F.col("lang").alias("target_lang"), F.array_join(with_tr, ",").alias("earlier_terms"))


# --- WIN-5 ------------------------------------------------------------------
@register("recent_improvements", "WIN-5", sql=f"""WITH {S.memory_cte(D.ISSUES_SQL)}
SELECT lang, seq, idx, complete FROM rec2
""")
def q_recent_improvements(spark, sf_dir):
    return MEM.recent_improvements(D.issues(spark, sf_dir)).select("lang", "seq", "idx", "complete")


# --- AGG-8 ------------------------------------------------------------------
@register("improvements_prompt", "AGG-8", sql=f"""WITH {S.memory_cte(D.ISSUES_SQL)}
SELECT lang, improvements_block FROM ib
""")
def q_improvements_prompt(spark, sf_dir):
    return MEM.improvements_blocks(D.issues(spark, sf_dir))


# --- REQ-1 / SNK-5 / AGG-7 / PRJ-10 / SRC-4 / JOIN-4 -------------------------
def req_sql_select() -> str:
    from docweave.operators.glossary import EARLIER_TERMS_HEADING, GLOSSARY_HEADING
    system = (f"l.system_prompt || coalesce(gb.glossary_block, {S.q(GLOSSARY_HEADING)}) || "
              f"CASE WHEN eb.earlier_lines IS NOT NULL THEN {S.q(EARLIER_TERMS_HEADING)} || eb.earlier_lines ELSE '' END"
              f" || coalesce(ib.improvements_block, '')")
    return f"""SELECT request_id, kind, rel_path, lang, part_no, field, system_prompt, user_prompt,
       sha256(lang || chr(1) || system_prompt || chr(1) || user_prompt) AS cache_key
FROM (
  SELECT 'body:' || d.rel_path || ':' || l.lang || ':' || CAST(p.part_no AS VARCHAR) AS request_id,
         'body' AS kind, d.rel_path, l.lang, p.part_no, CAST(NULL AS VARCHAR) AS field,
         {system} AS system_prompt, p.text AS user_prompt
  FROM parts p JOIN prepared d ON d.doc_id = p.doc_id CROSS JOIN langs l
  LEFT JOIN gb ON gb.lang = l.lang LEFT JOIN ib ON ib.lang = l.lang
  LEFT JOIN eb ON eb.doc_id = p.doc_id AND eb.part_no = p.part_no AND eb.lang = l.lang)"""


@register("body_requests", "REQ-1,SNK-5,AGG-7,PRJ-10,SRC-4,JOIN-4", sql=f"""{_PARTS_WITH},
{S.gblock_cte()}, {S.memory_cte(D.ISSUES_SQL)}, {S.earlier_cte()}
{req_sql_select()}
""")
def q_body_requests(spark, sf_dir):
    parts = with_earlier(spark, sf_dir)
    return (R.body_requests(parts, spark, TARGETS, TEST_LANGUAGES, GL, D.issues(spark, sf_dir))
            .select("request_id", "kind", "rel_path", "lang", "part_no", "field", "system_prompt",
                    "user_prompt", "cache_key"))


# --- EXT-1 ------------------------------------------------------------------
@register("request_dedup", "EXT-1", sql=f"""{_PARTS_WITH},
{S.gblock_cte()}, {S.memory_cte(D.ISSUES_SQL)}, {S.earlier_cte()},
reqs AS ({req_sql_select()})
SELECT lang, count(*) AS n_requests, count(DISTINCT cache_key) AS n_unique,
       count(*) - count(DISTINCT cache_key) AS n_saved
FROM reqs GROUP BY lang
""")
def q_request_dedup(spark, sf_dir):
    r = q_body_requests(spark, sf_dir)
    return (r.groupBy("lang").agg(F.count("*").alias("n_requests"),
                                  F.countDistinct("cache_key").alias("n_unique"))
            .withColumn("n_saved", F.col("n_requests") - F.col("n_unique")))


# --- PRJ-5 ------------------------------------------------------------------
def fm_fields_sql() -> str:
    b = "yb"
    return f"""fmd AS (
  SELECT doc_id, rel_path, {S.strip('frontmatter')} AS s FROM prepared WHERE frontmatter IS NOT NULL
),
fmd2 AS (
  SELECT doc_id, rel_path, CASE WHEN instr(s, '---') > 0
           THEN substr(s, 1, instr(s, '---') - 1) || substr(s, instr(s, '---') + 3) ELSE s END AS s FROM fmd
),
fmd3 AS (
  SELECT doc_id, rel_path,
         CASE WHEN instr(reverse(s), '---') > 0
              THEN {S.strip("substr(s, 1, length(s) - instr(reverse(s), '---') - 2)")} ELSE s END AS {b}
  FROM fmd2
),
fl0 AS (
  SELECT doc_id, rel_path, CAST(unnest(range(len(a))) AS BIGINT) AS ord, unnest(a) AS line
  FROM (SELECT doc_id, rel_path, string_split({b}, chr(10)) AS a FROM fmd3)
),
fla AS (
  SELECT *, regexp_matches(line, {S.q(FM.KEY_LINE_RE)}) AS is_key,
         regexp_matches(line, {S.q(FM.CONTINUED_RE)}) AS continued, regexp_matches(line, {S.q(FM.IDLE_RE)}) AS idle FROM fl0
),
flb AS (SELECT *, sum(CASE WHEN is_key THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS no FROM fla),
flc AS (SELECT *, bool_or(NOT (is_key OR (continued AND (no > 0 OR idle)))) OVER (PARTITION BY doc_id) AS bad FROM flb),
fld AS (
  SELECT doc_id, rel_path, bad, CASE WHEN bad THEN 1 ELSE no END AS no, min(ord) AS ord, bool_or(NOT is_key AND NOT idle) AS more,
         string_agg(line, chr(10) ORDER BY ord) AS entry, arg_min(line, ord) AS head
  FROM flc WHERE bad OR no > 0 GROUP BY ALL
),
fl1 AS (
  SELECT doc_id, rel_path, ord, bad, more, entry,
         CASE WHEN bad THEN '' ELSE regexp_extract(head, {S.q(FM.KEY_LINE_RE)}, 1) END AS key,
         CASE WHEN bad THEN '' ELSE {S.strip(f"regexp_extract(head, {S.q(FM.KEY_LINE_RE)}, 2)")} END AS raw
  FROM fld
),
fl2 AS (
  SELECT *, CAST(min(ord) OVER (PARTITION BY doc_id, key) AS BIGINT) AS ord0,
         row_number() OVER (PARTITION BY doc_id, key ORDER BY ord DESC) AS rn,
         CASE WHEN regexp_matches(raw, {S.q(FM.QUOTE_RE)}) THEN raw ELSE regexp_replace(raw, {S.q(FM.COMMENT_RE)}, '') END AS plain
  FROM fl1
),
fields AS (
  SELECT doc_id, rel_path, ord0 AS ord, key, raw, entry,
    CASE WHEN bad THEN 'block' WHEN more THEN 'other'
         WHEN regexp_matches(plain, {S.q(FM.NULL_RE)}) THEN 'null'
         WHEN regexp_matches(plain, {S.q(FM.DQ_RE)}) THEN
           CASE WHEN contains(regexp_replace(regexp_extract(plain, {S.q(FM.DQ_RE)}, 1), {S.q(FM.ESCAPE_RE)}, '', 'g'), '\\')
                THEN 'other' ELSE 'string' END
         WHEN regexp_matches(plain, {S.q(FM.SQ_RE)}) THEN 'string'
         WHEN regexp_matches(plain, {S.q(FM.QUOTE_RE)}) THEN 'other'
         WHEN regexp_matches(plain, {S.q(FM.INT_RE)}) THEN 'int'
         WHEN regexp_matches(plain, {S.q(FM.FLOAT_RE)}) THEN 'float'
         WHEN regexp_matches(plain, {S.q(FM.BOOL_RE)}) THEN 'bool'
         WHEN regexp_matches(plain, {S.q(FM.DATE_RE)}) THEN 'date'
         WHEN starts_with(plain, '[') OR starts_with(plain, '{{') OR starts_with(plain, '|') OR starts_with(plain, '>')
           OR starts_with(plain, '&') OR starts_with(plain, '*') OR starts_with(plain, '!') THEN 'other'
         ELSE 'string' END AS kind,
    CASE WHEN regexp_matches(plain, {S.q(FM.DQ_RE)})
           THEN regexp_replace(regexp_extract(plain, {S.q(FM.DQ_RE)}, 1), {S.q(FM.ESCAPE_RE)}, '\\1', 'g')
         WHEN regexp_matches(plain, {S.q(FM.SQ_RE)}) THEN replace(regexp_extract(plain, {S.q(FM.SQ_RE)}, 1), '''''', '''')
         ELSE plain END AS value
  FROM fl2 WHERE rn = 1
),
fields2 AS (SELECT *, kind = 'string' AND {S.strip('value')} <> '' AS translatable FROM fields)"""


@register("frontmatter_fields", "PRJ-5", sql=f"""WITH {S.prepared_cte()}, {fm_fields_sql()}
SELECT doc_id, ord, key, raw, kind, value, translatable FROM fields2
""")
def q_frontmatter_fields(spark, sf_dir):
    return (FM.fields(prepared(spark, sf_dir), ["doc_id", "rel_path"])
            .select("doc_id", "ord", "key", "raw", "kind", "value", "translatable"))


# --- REQ-2 ------------------------------------------------------------------
def _fm_req_sql() -> str:
    head, tail = R.FRONTMATTER_PROMPT.split("{lang}")
    return f"""SELECT request_id, kind, rel_path, lang, part_no, field, system_prompt, user_prompt,
       sha256(lang || chr(1) || system_prompt || chr(1) || user_prompt) AS cache_key
FROM (
  SELECT 'frontmatter:' || f.rel_path || ':' || l.lang || ':' || CAST(f.ord AS VARCHAR) AS request_id,
         'frontmatter' AS kind, f.rel_path, l.lang, CAST(NULL AS BIGINT) AS part_no, f.key AS field,
         {S.q(head)} || l.lang || {S.q(tail)} || coalesce(gb.glossary_block, {S.q(G.GLOSSARY_HEADING)})
           || coalesce(ib.improvements_block, '')
           AS system_prompt,
         f.value AS user_prompt
  FROM fields2 f CROSS JOIN (SELECT unnest({_TLIST}) AS lang) l
  LEFT JOIN gb ON gb.lang = l.lang LEFT JOIN ib ON ib.lang = l.lang
  WHERE f.translatable)"""


@register("frontmatter_requests", "REQ-2", sql=f"""WITH {S.prepared_cte()}, {fm_fields_sql()},
{S.glossary_cte()}, {S.gblock_cte()}, {S.memory_cte(D.ISSUES_SQL)}
{_fm_req_sql()}
""")
def q_frontmatter_requests(spark, sf_dir):
    f = FM.fields(prepared(spark, sf_dir), ["doc_id", "rel_path"])
    return (R.frontmatter_requests(f, spark, TARGETS, GL, D.issues(spark, sf_dir))
            .select("request_id", "kind", "rel_path", "lang", "part_no", "field", "system_prompt",
                    "user_prompt", "cache_key"))


# --- PRJ-6 / PRJ-7 ----------------------------------------------------------
# Simulated model replies for each translatable field, by doc_id % 5:
# prefixed, fenced, quoted, two-line, plain.
FM_REPLY_SPARK = ("CASE doc_id % 5 WHEN 0 THEN concat('TRANSLATED TEXT: ', value) "
                   "WHEN 1 THEN concat('```yaml\\n', value, '\\n```') WHEN 2 THEN concat('\"', value, '\"') "
                   "WHEN 3 THEN concat(value, '\\nsecond line') ELSE value END")
FM_REPLY_SQL = ("CASE doc_id % 5 WHEN 0 THEN 'TRANSLATED TEXT: ' || value "
                 "WHEN 1 THEN '```yaml' || chr(10) || value || chr(10) || '```' WHEN 2 THEN '\"' || value || '\"' "
                 "WHEN 3 THEN value || chr(10) || 'second line' ELSE value END")


def clean_field_sql(x: str) -> str:
    from docweave.functions.text import REPLY_PREFIXES
    pref = " OR ".join(f"starts_with(lower({x}), {S.q(p)})" for p in REPLY_PREFIXES)
    v = f"CASE WHEN {pref} THEN {S.strip(f'substr({x}, instr({x}, {S.q(":")}) + 1)')} ELSE {x} END"
    v = f"regexp_replace({v}, '\\A```[^\\n]*\\n', '')"
    v = f"regexp_replace({v}, '\\n```(\\n?)\\z', '\\1')"
    v = f"regexp_replace({v}, '\\A[\"'']+|[\"'']+\\z', '', 'g')"
    return S.strip(f"replace({v}, chr(10), ' ')")


@register("frontmatter_clean", "PRJ-6", sql=f"""WITH {S.prepared_cte()}, {fm_fields_sql()}
SELECT doc_id, ord, reply, {clean_field_sql('reply')} AS cleaned
FROM (SELECT doc_id, ord, {FM_REPLY_SQL} AS reply FROM fields2 WHERE translatable)
""")
def q_frontmatter_clean(spark, sf_dir):
    f = FM.fields(prepared(spark, sf_dir), ["doc_id", "rel_path"]).where("translatable")
    r = f.select("doc_id", "ord", F.expr(FM_REPLY_SPARK).alias("reply"))
    return r.withColumn("cleaned", FM.clean_value(F.col("reply")))


def yaml_scalar_sql(v: str, kind: str) -> str:
    nq = " OR ".join([
        f"{v} = ''", f"regexp_matches({v}, {S.q(FM.NULL_RE)})", f"regexp_matches({v}, {S.q(FM.INT_RE)})",
        f"regexp_matches({v}, {S.q(FM.FLOAT_RE)})",
        f"regexp_matches({v}, {S.q(FM.BOOL_RE)})",
        f"regexp_matches({v}, {S.q(FM.DATE_RE)})", f"contains({v}, ': ')", f"contains({v}, ' #')",
        f"ends_with({v}, ':')", f"regexp_matches({v}, {S.q(r'^[-?:,\[\]{}#&*!|>' + chr(39) + chr(34) + r'%@`]')})",
        f"regexp_matches({v}, '^\\s|\\s$')"])
    return (f"CASE WHEN {kind} = 'string' THEN CASE WHEN {nq} THEN '''' || replace({v}, '''', '''''') || '''' "
            f"ELSE {v} END WHEN {kind} = 'null' THEN 'null' ELSE {v} END")


@register("frontmatter_rebuilt", "PRJ-7,PRJ-4", sql=f"""WITH {S.prepared_cte()}, {fm_fields_sql()},
nv AS (SELECT doc_id, ord, key, kind, entry,
              CASE WHEN translatable THEN {clean_field_sql(FM_REPLY_SQL)} ELSE value END AS new_value FROM fields2)
SELECT doc_id, '---' || chr(10) || string_agg(CASE WHEN kind IN ('other', 'block') THEN entry
        ELSE key || ': ' || {yaml_scalar_sql('new_value', 'kind')} END || chr(10), '' ORDER BY ord) || '---' AS frontmatter
FROM nv GROUP BY doc_id
""")
def q_frontmatter_rebuilt(spark, sf_dir):
    f = FM.fields(prepared(spark, sf_dir), ["doc_id", "rel_path"])
    nv = f.withColumn("new_value", F.when(F.col("translatable"), FM.clean_value(F.expr(FM_REPLY_SPARK)))
                      .otherwise(F.col("value")))
    return FM.rebuild(nv, ["doc_id"])


# --- PRJ-9 ------------------------------------------------------------------
_LD = "CASE l.lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_DIRS.items()) + " END"


@register("output_paths", "PRJ-9", sql=f"""WITH {D.MD_DOCS_CTE}
SELECT d.rel_path, l.lang, 'output/' || l.lang || '/' || d.rel_path AS full_run_path,
       CASE WHEN {_LD} IS NULL THEN NULL ELSE {_LD} || '/' || d.rel_path END AS incremental_path,
       {_LD} IS NULL AS unknown_language
FROM md_docs d CROSS JOIN (SELECT unnest(['en', 'es', 'zh', 'fr']) AS lang) l
""")
def q_output_paths(spark, sf_dir):
    files = D.md_docs(spark, sf_dir).select("rel_path")
    return output_paths(files, ("en", "es", "zh", "fr"))


# --- JOIN-1 -----------------------------------------------------------------
@register("output_pairs", "JOIN-1,SRC-2", sql=f"""
SELECT t.rel_path, t.lang, o.original, t.translated
FROM ({D.OUTPUTS_SQL}) t JOIN ({D.ORIGINALS_SQL}) o ON o.rel_path = t.rel_path
""")
def q_output_pairs(spark, sf_dir):
    return pair_outputs(D.originals(spark, sf_dir), D.outputs(spark, sf_dir)) \
        .select("rel_path", "lang", "original", "translated")


# --- REQ-3 ------------------------------------------------------------------
def _val_user_sql() -> str:
    slots = {"{original}": "o.original", "{lang}": "t.lang", "{translated}": "t.translated",
             "{file_path}": "t.file_path"}
    return " || ".join(slots.get(p, S.q(p)) for p in R.validation_user_parts())


@register("validation_requests", "REQ-3", sql=f"""WITH {S.glossary_cte()}, {S.langs_cte(TARGETS)}, {S.gblock_cte()},
t AS (SELECT *, 'output/' || lang || '/' || rel_path AS file_path FROM ({D.OUTPUTS_SQL})),
o AS ({D.ORIGINALS_SQL})
SELECT request_id, kind, rel_path, lang, system_prompt, user_prompt,
       sha256(lang || chr(1) || system_prompt || chr(1) || user_prompt) AS cache_key
FROM (
  SELECT 'validate:' || t.rel_path || ':' || t.lang AS request_id, 'validate' AS kind, t.rel_path, t.lang,
         l.validation_prompt || chr(10) || coalesce(gb.glossary_block, {S.q(G.GLOSSARY_HEADING)}) || {S.q(R.VALIDATION_TAIL)}
           AS system_prompt,
         {_val_user_sql()} AS user_prompt
  FROM t JOIN o ON o.rel_path = t.rel_path JOIN langs l ON l.lang = t.lang LEFT JOIN gb ON gb.lang = t.lang)
""")
def q_validation_requests(spark, sf_dir):
    pairs = pair_outputs(D.originals(spark, sf_dir), D.outputs(spark, sf_dir))
    pairs = pairs.withColumn("file_path", F.concat_ws("/", F.lit("output"), "lang", "rel_path"))
    return R.validation_requests(pairs, spark, TEST_LANGUAGES, GL, TARGETS)

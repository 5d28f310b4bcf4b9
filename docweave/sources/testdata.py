"""Inputs derived from the driver tables by expressions both Spark and DuckDB
evaluate identically (see FIXTURES.md §2). Every derived input grows with the
tables it comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import read_table

# Markdown view over ``documents``: with line number i from 0, first match wins:
# i%5=4 empty line, i%17=6 a fence line, i%3=0 a header of level 1+(doc_id+i)%3,
# i%7=3 a list item, else the line. doc_id%3=0 adds frontmatter (whole first line as
# title; doc_id%2=0: also a list, a map, a block scalar with the whole last line, a
# comment, escapes and a non-ASCII key), doc_id%5=0 a LOCAL TEXT block after it.
MD_EXPR = r"""concat(
 CASE WHEN doc_id%3=0 THEN concat('---\ntitle: ', split(text,'\n',-1)[0], '\nlang: ', lang, '\n',
   CASE WHEN doc_id%2=0 THEN concat('tags:\n- alpha\n- beta\nsummary: >\n  ', element_at(split(text,'\n',-1), -1),
     '\nавтор: Иван  # note\nquoted: "a \\"q\\" b"\nnested:\n  k: v\n') ELSE '' END, '---\n\n') ELSE '' END,
 CASE WHEN doc_id%5=0 THEN concat('{/* LOCAL TEXT START */}\nnote ', doc_id, '\n{/* Local Text End */}') ELSE '' END,
 array_join(transform(split(text,'\n',-1), (l,i) -> CASE WHEN i%5=4 THEN '' WHEN i%17=6 THEN '```'
   WHEN i%3=0 THEN concat(repeat('#', CAST(1+(doc_id+i)%3 AS INT)),' ',l) WHEN i%7=3 THEN concat('- ',l) ELSE l END), '\n'))"""

MD_SQL = r"""(CASE WHEN doc_id%3=0 THEN '---'||chr(10)||'title: '||string_split(text,chr(10))[1]||chr(10)||'lang: '||lang||chr(10)||
 (CASE WHEN doc_id%2=0 THEN 'tags:'||chr(10)||'- alpha'||chr(10)||'- beta'||chr(10)||'summary: >'||chr(10)||'  '||string_split(text,chr(10))[-1]
   ||chr(10)||'автор: Иван  # note'||chr(10)||'quoted: "a \"q\" b"'||chr(10)||'nested:'||chr(10)||'  k: v'||chr(10) ELSE '' END)
 ||'---'||chr(10)||chr(10) ELSE '' END)
||(CASE WHEN doc_id%5=0 THEN '{/* LOCAL TEXT START */}'||chr(10)||'note '||doc_id||chr(10)||'{/* Local Text End */}' ELSE '' END)
||array_to_string(list_transform(string_split(text,chr(10)), lambda l, i: CASE WHEN (i-1)%5=4 THEN '' WHEN (i-1)%17=6 THEN '```'
   WHEN (i-1)%3=0 THEN repeat('#', CAST(1+(doc_id+i-1)%3 AS INT))||' '||l WHEN (i-1)%7=3 THEN '- '||l ELSE l END), chr(10))"""

# File extensions by doc_id % 4 for the derived file tree.
EXT_BY_MOD4 = (".md", ".mdx", ".MD", ".png")

# Default split budget for the derived corpus (tokens; 4 characters each).
TEST_BUDGET = 150


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source, lang, rel_path, md)``; rel_path ``source/doc_id.ext``."""
    ext = F.element_at(F.array(*[F.lit(e) for e in EXT_BY_MOD4]),
                       (F.col("doc_id") % 4 + 1).cast("int"))
    return (documents(spark, sf_dir)
            .select("doc_id", "source", "lang",
                    F.concat_ws("", F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                                ext).alias("rel_path"),
                    F.expr(MD_EXPR).alias("md")))


REL_PATH_SQL = ("source||'/'||CAST(doc_id AS VARCHAR)||"
                "(CASE doc_id%4 WHEN 0 THEN '.md' WHEN 1 THEN '.mdx' WHEN 2 THEN '.MD' ELSE '.png' END)")

MD_DOCS_CTE = f"""md_docs AS (
  SELECT doc_id, source, lang, {REL_PATH_SQL} AS rel_path, {MD_SQL} AS md FROM documents
)"""


# A glossary of the corpus' own size: its words of ten lower-case letters or more.
TERM_RE = "[a-zà-ÿ]{10,}"
TERMS_SQL = f"SELECT DISTINCT unnest(regexp_extract_all(text, '{TERM_RE}')) AS term FROM documents"


def corpus_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit(TERM_RE), F.lit(0))).alias("term")).distinct()


# ---------------------------------------------------------------------------
# Issues derived from documents (issue memory and validation inputs).
# Reason templates by (doc_id + line) % 4 (one Russian glossary reason,
# two near-identical English ones, one blank).
REASONS = ("термин переведён не по глоссарию",
           "the meaning of the sentence is lost in rendering",
           "meaning of the sentence is lost in the rendering",
           "")

TARGET_BY_MOD3 = ("en", "es", "zh")

# One issue per line of every document (whole texts, every line): original
# = line k, translated = the next line (cyclic), reason by (doc_id + k) % 4,
# seq = doc_id * 10000000 + k (arrival order: document, then line).
LINE_SEQ = 10_000_000

ISSUES_SQL = """SELECT (CASE doc_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'es' ELSE 'zh' END) AS lang,
       source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS file_path,
       CAST(doc_id * {seq} + k AS BIGINT) AS seq, lines[k + 1] AS original,
       lines[(k + 1) % len(lines) + 1] AS translated,
       ([{reasons}])[(doc_id + k) % 4 + 1] AS reason
FROM (SELECT doc_id, source, lines, unnest(range(len(lines))) AS k
      FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents))""".format(
    seq=LINE_SEQ, reasons=", ".join("'" + r + "'" for r in REASONS))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(lang, file_path, seq, original, translated, reason)``, one per line
    of every document."""
    d = documents(spark, sf_dir).select("doc_id", "source", F.split("text", "\n", -1).alias("lines"))
    # Each line paired with the next one (cyclic) before exploding, so an
    # exploded row carries two lines, not its document's whole line array.
    nxt = F.concat(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), F.slice("lines", 1, 1))
    lines = (d.select("doc_id", "source", F.posexplode(F.arrays_zip(F.col("lines").alias("o"), nxt.alias("t")))
                      .alias("k", "p"))
             .select("doc_id", "source", "k", F.col("p.o").alias("original"), F.col("p.t").alias("translated")))
    k = F.col("k")
    return lines.select(
        F.element_at(F.array(*[F.lit(t) for t in TARGET_BY_MOD3]), (F.col("doc_id") % 3 + 1).cast("int")).alias("lang"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_path"),
        (F.col("doc_id") * LINE_SEQ + k).cast("bigint").alias("seq"),
        "original",
        "translated",
        F.element_at(F.array(*[F.lit(r) for r in REASONS]), ((F.col("doc_id") + k) % 4 + 1).cast("int")).alias("reason"))


# ---------------------------------------------------------------------------
# Original / translated pairs from conversations: a user turn is the original
# file ``conv/<conv_id>/<turn>.md``; the assistant turn right after it is its
# rendering (language by conv_id % 3).
def originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select(
        F.format_string("conv/%d/%d.md", "conv_id", "turn").alias("rel_path"),
        "conv_id", "turn", F.col("text").alias("original"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "assistant").select(
        F.format_string("conv/%d/%d.md", "conv_id", F.col("turn") - 1).alias("rel_path"),
        F.expr("element_at(array('en','es','zh'), CAST(conv_id % 3 + 1 AS INT))").alias("lang"),
        F.col("text").alias("translated"))


ORIGINALS_SQL = ("SELECT printf('conv/%d/%d.md', conv_id, turn) AS rel_path, conv_id, turn, text AS original "
                 "FROM conversations WHERE role = 'user'")
OUTPUTS_SQL = ("SELECT printf('conv/%d/%d.md', conv_id, turn - 1) AS rel_path, "
                    "(CASE conv_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'es' ELSE 'zh' END) AS lang, "
                    "text AS translated FROM conversations WHERE role = 'assistant'")


# ---------------------------------------------------------------------------
# Simulated model replies for body parts (by doc_id % 4: prefixed, fenced,
# trailing fence, plain); no reply for doc_id % 11 = 0, an error reply for
# doc_id % 13 = 0.
REPLY_SPARK = ("CASE doc_id % 4 WHEN 0 THEN concat('Translated text: ', text) "
               "WHEN 1 THEN concat('```markdown\\n', text, '\\n```') "
               "WHEN 2 THEN concat(text, '\\n```\\n') ELSE text END")
REPLY_SQL = ("CASE doc_id % 4 WHEN 0 THEN 'Translated text: ' || text "
             "WHEN 1 THEN '```markdown' || chr(10) || text || chr(10) || '```' "
             "WHEN 2 THEN text || chr(10) || '```' || chr(10) ELSE text END")


def responses_for(parts_fanned: DataFrame) -> DataFrame:
    """Replies for ``(doc_id, rel_path, lang, part_no, text)`` rows."""
    rid = F.concat_ws(":", F.lit("body"), "rel_path", "lang", F.col("part_no").cast("string"))
    err = (F.col("doc_id") % 13 == 0)
    return (parts_fanned.where(F.col("doc_id") % 11 != 0)
            .select(rid.alias("request_id"),
                    F.when(err, F.lit(None).cast("string")).otherwise(F.expr(REPLY_SPARK)).alias("content"),
                    (F.length("text") / 4 + 50).cast("int").alias("prompt_tokens"),
                    (F.length("text") / 4).cast("int").alias("completion_tokens"),
                    F.when(err, F.lit("timeout")).alias("error")))


# ---------------------------------------------------------------------------
# Simulated validation replies per conversation pair (whole texts), by (conv_id + turn) % 9.
VREASONS = ("термин переведён не по глоссарию", "glossary term is wrong", "смысл искажён")

VREPLY_SPARK = """CASE (conv_id + turn) % 9
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '[]'
  WHEN 2 THEN '{}'
  WHEN 3 THEN '{"issues": null}'
  WHEN 4 THEN concat('{"issues": [', to_json(named_struct('original', original, 'translated', translated, 'reason', vr)), ', {"original": null, "translated": "abc", "reason": "x"}]}')
  WHEN 5 THEN concat('{"issues": [', to_json(named_struct('original', original, 'translated', translated, 'reason', vr)), ', 5]}')
  WHEN 6 THEN concat('{"issues": [', to_json(named_struct('translated', translated, 'reason', vr)), ']}')
  ELSE concat('{"issues": [', to_json(named_struct('file_path', 'x.md', 'original', original, 'translated', translated, 'reason', vr)),
              ', ', to_json(named_struct('original', CAST(turn % 10 AS STRING), 'translated', translated, 'reason', 'short original')),
              ', ', to_json(named_struct('original', translated, 'translated', original, 'reason', vr)), ']}')
END"""

VREPLY_SQL = """CASE (conv_id + turn) % 9
  WHEN 0 THEN 'not json'
  WHEN 1 THEN '[]'
  WHEN 2 THEN '{}'
  WHEN 3 THEN '{"issues": null}'
  WHEN 4 THEN '{"issues": [' || to_json(struct_pack(original := original, translated := translated, reason := vr)) || ', {"original": null, "translated": "abc", "reason": "x"}]}'
  WHEN 5 THEN '{"issues": [' || to_json(struct_pack(original := original, translated := translated, reason := vr)) || ', 5]}'
  WHEN 6 THEN '{"issues": [' || to_json(struct_pack(translated := translated, reason := vr)) || ']}'
  ELSE '{"issues": [' || to_json(struct_pack(file_path := 'x.md', original := original, translated := translated, reason := vr))
       || ', ' || to_json(struct_pack(original := CAST(turn % 10 AS VARCHAR), translated := translated, reason := 'short original'))
       || ', ' || to_json(struct_pack(original := translated, translated := original, reason := vr)) || ']}'
END"""

VR_SPARK = "element_at(array({}), CAST(conv_id % 3 + 1 AS INT))".format(", ".join("'" + r + "'" for r in VREASONS))
VR_SQL = "([{}])[conv_id % 3 + 1]".format(", ".join("'" + r + "'" for r in VREASONS))


def validation_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(rel_path, lang, file_path, content, prompt_tokens, completion_tokens)``
    one per validated pair."""
    o, t = originals(spark, sf_dir), outputs(spark, sf_dir)
    p = t.join(o, "rel_path").withColumn("vr", F.expr(VR_SPARK))
    return p.select("rel_path", "lang",
                    F.concat_ws("/", F.lit("output"), "lang", "rel_path").alias("file_path"),
                    F.expr(VREPLY_SPARK).alias("content"),
                    (F.length("original") / 4).cast("int").alias("prompt_tokens"),
                    (F.length("translated") / 4 + 7).cast("int").alias("completion_tokens"))


VALIDATION_REPLIES_SQL = f"""SELECT rel_path, lang, 'output/' || lang || '/' || rel_path AS file_path,
       {VREPLY_SQL} AS content,
       CAST(floor(length(original) / 4) AS INT) AS prompt_tokens,
       CAST(floor(length(translated) / 4 + 7) AS INT) AS completion_tokens
FROM (SELECT t.*, o.conv_id, o.turn, o.original, {VR_SQL} AS vr
      FROM ({OUTPUTS_SQL}) t JOIN ({ORIGINALS_SQL}) o ON o.rel_path = t.rel_path)"""


# ---------------------------------------------------------------------------
# File rows with bytes: text files are the UTF-8 of ``md``; .png files get a
# PNG signature in front; doc_id % 9 = 0 appends an invalid byte (binary when
# within the 8192-byte probe, an undecodable text file after it).
def file_content(doc_id, md):
    body = F.encode(md, "UTF-8")
    return (F.when(doc_id % 4 == 3, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), body))
            .when(doc_id % 9 == 0, F.concat(body, F.unhex(F.lit("FF"))))
            .otherwise(body))


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    md = md_docs(spark, sf_dir)
    return md.select("doc_id", "rel_path", file_content(F.col("doc_id"), F.col("md")).alias("content"))


FILE_ROWS_SQL = f"""SELECT doc_id, rel_path,
  CASE WHEN doc_id % 4 = 3 THEN unhex('89504E470D0A1A0A') || encode(md)
       WHEN doc_id % 9 = 0 THEN encode(md) || unhex('FF') ELSE encode(md) END AS content
FROM md_docs"""


# ---------------------------------------------------------------------------
# Two corpus snapshots (manifests) for change detection: the old one lacks
# doc_id % 10 = 0, the new one lacks doc_id % 10 = 1; the new one changes the
# text where doc_id % 7 = 0 and moves the file where doc_id % 13 = 0. Paths of
# doc_id % 17 = 0 contain blanks (quoted in change lines).
_MPATH = ("CASE WHEN doc_id % 17 = 0 THEN concat(source, '/my doc ', CAST(doc_id AS STRING), '.md') "
          "ELSE concat(source, '/', CAST(doc_id AS STRING), '.md') END")
_MPATH_SQL = ("CASE WHEN doc_id % 17 = 0 THEN source || '/my doc ' || CAST(doc_id AS VARCHAR) || '.md' "
              "ELSE source || '/' || CAST(doc_id AS VARCHAR) || '.md' END")


def manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = documents(spark, sf_dir)
    old = d.where(F.col("doc_id") % 10 != 0).select(F.expr(_MPATH).alias("path"),
                                                    F.sha2("text", 256).alias("sha256"))
    new_text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" (rev)"))).otherwise(F.col("text"))
    new_path = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("moved/"), F.expr(_MPATH))).otherwise(F.expr(_MPATH))
    new = d.where(F.col("doc_id") % 10 != 1).select(new_path.alias("path"), F.sha2(new_text, 256).alias("sha256"))
    return old, new


OLD_MANIFEST_SQL = f"SELECT {_MPATH_SQL} AS path, sha256(text) AS sha256 FROM documents WHERE doc_id % 10 <> 0"
NEW_MANIFEST_SQL = (f"SELECT CASE WHEN doc_id % 13 = 0 THEN 'moved/' || ({_MPATH_SQL}) ELSE {_MPATH_SQL} END AS path, "
                    f"sha256(CASE WHEN doc_id % 7 = 0 THEN text || ' (rev)' ELSE text END) AS sha256 "
                    f"FROM documents WHERE doc_id % 10 <> 1")



def snapshot_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The documents of the two snapshots: ``(path, md)``; ``md`` is the markdown view, with `` (rev)`` at its end where the text changed."""
    d = md_docs(spark, sf_dir).select("doc_id", "source", "md")
    old = d.where(F.col("doc_id") % 10 != 0).select(F.expr(_MPATH).alias("path"), "md")
    new_md = F.when(F.col("doc_id") % 7 == 0, F.concat("md", F.lit(" (rev)"))).otherwise(F.col("md"))
    new_path = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("moved/"), F.expr(_MPATH))).otherwise(F.expr(_MPATH))
    return old, d.where(F.col("doc_id") % 10 != 1).select(new_path.alias("path"), new_md.alias("md"))


def snapshot_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(path, text)`` of the two snapshots, whose sha256 the manifests have."""
    d = documents(spark, sf_dir)
    old = d.where(F.col("doc_id") % 10 != 0).select(F.expr(_MPATH).alias("path"), "text")
    new_text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" (rev)"))).otherwise(F.col("text"))
    new_path = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("moved/"), F.expr(_MPATH))).otherwise(F.expr(_MPATH))
    return old, d.where(F.col("doc_id") % 10 != 1).select(new_path.alias("path"), new_text.alias("text"))


OLD_TEXTS_SQL = f"SELECT {_MPATH_SQL} AS path, text FROM documents WHERE doc_id % 10 <> 0"
NEW_TEXTS_SQL = (f"SELECT CASE WHEN doc_id % 13 = 0 THEN 'moved/' || ({_MPATH_SQL}) ELSE {_MPATH_SQL} END AS path, "
                 f"CASE WHEN doc_id % 7 = 0 THEN text || ' (rev)' ELSE text END AS text FROM documents WHERE doc_id % 10 <> 1")

# Both snapshots as one ``md_docs``: the old one with even ids, the new one with odd ids.
SNAPSHOT_DOCS_CTE = f"""md_docs AS (
  SELECT id AS doc_id, source, lang, path AS rel_path, md FROM (
    SELECT doc_id * 2 AS id, source, lang, {_MPATH_SQL} AS path, {MD_SQL} AS md FROM documents WHERE doc_id % 10 <> 0
    UNION ALL
    SELECT doc_id * 2 + 1, source, lang, CASE WHEN doc_id % 13 = 0 THEN 'moved/' || ({_MPATH_SQL}) ELSE {_MPATH_SQL} END,
           {MD_SQL} || CASE WHEN doc_id % 7 = 0 THEN ' (rev)' ELSE '' END FROM documents WHERE doc_id % 10 <> 1)
)"""

# Change lines rendered from a diff, as ``git status --porcelain`` prints them
# at the root of repository ``book`` whose documents live under ``docs/``;
# a third of the lines belong to another tree (``i18n/``) or carry no repo
# prefix.
REPO_NAME = "book"
TARGET_SUBDIR = "docs"
_RP = ("(CASE length(path) % 3 WHEN 0 THEN 'book/docs/' WHEN 1 THEN 'docs/' ELSE 'book/i18n/' END)")


def _q(expr: str) -> str:
    return f"CASE WHEN instr({expr}, ' ') > 0 THEN concat('\"', {expr}, '\"') ELSE {expr} END"


CHANGE_LINE_SPARK = f"""CASE status
  WHEN 'added' THEN concat('?? ', {_q(f"concat({_RP}, path)")})
  WHEN 'modified' THEN concat(' M ', {_q(f"concat({_RP}, path)")})
  WHEN 'deleted' THEN concat(' D ', {_q(f"concat({_RP}, path)")})
  WHEN 'renamed_to' THEN concat(' D ', {_q(f"concat({_RP}, path)")})
  WHEN 'renamed_from' THEN concat('R  ', {_q(f"concat({_RP.replace('path', 'other_path')}, other_path)")}, ' -> ',
                                  {_q(f"concat({_RP}, path)")})
END"""


def _qs(expr: str) -> str:
    return f"CASE WHEN instr({expr}, ' ') > 0 THEN '\"' || {expr} || '\"' ELSE {expr} END"


CHANGE_LINE_SQL = f"""CASE status
  WHEN 'added' THEN '?? ' || {_qs(f"({_RP} || path)")}
  WHEN 'modified' THEN ' M ' || {_qs(f"({_RP} || path)")}
  WHEN 'deleted' THEN ' D ' || {_qs(f"({_RP} || path)")}
  WHEN 'renamed_to' THEN ' D ' || {_qs(f"({_RP} || path)")}
  WHEN 'renamed_from' THEN 'R  ' || {_qs(f"({_RP.replace('path', 'other_path')} || other_path)")} || ' -> '
                                 || {_qs(f"({_RP} || path)")}
END"""

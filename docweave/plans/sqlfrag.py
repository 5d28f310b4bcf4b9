"""DuckDB SQL fragments for the oracle side of every query.

They restate each rule in plain SQL (windows, string_agg, one recursive CTE
for the packing fold) so that the driver can compare Spark's answer with an
independent engine. Regexes use the same explicit whitespace class as the
Spark side (RE2 and Java agree on it).
"""

from __future__ import annotations

from docweave.functions.text import BLANK_RE, LOCAL_TEXT_RE, STRIP_RE
from docweave.operators.markdown import HEADER_LEVEL_RE, HEADER_RE, LIST_RE
from docweave.sources.testdata import MD_DOCS_CTE, TEST_BUDGET

NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_RE)}, '', 'g')"


def blank(x: str) -> str:
    return f"regexp_matches({x}, {q(BLANK_RE)})"


def prepared_cte(budget: int = TEST_BUDGET) -> str:
    """md_docs → prepared(doc_id, source, lang, rel_path, md, clean, has_fm, frontmatter, body)."""
    return f"""{MD_DOCS_CTE},
cleaned AS (
  SELECT *, regexp_replace(regexp_replace(md, '\\r\\n?', {NL}, 'g'), {q(LOCAL_TEXT_RE)}, '', 'g') AS clean
  FROM md_docs
),
fm_pos AS (
  SELECT *, CASE WHEN starts_with(clean, '---') AND instr(substr(clean, 4), '---') > 0
                 THEN instr(substr(clean, 4), '---') + 3 ELSE 0 END AS fm_end
  FROM cleaned
),
prepared AS (
  SELECT doc_id, source, lang, rel_path, md, clean, fm_end > 0 AS has_fm,
         CASE WHEN fm_end > 0 THEN substr(clean, 1, fm_end + 2) END AS frontmatter,
         CASE WHEN fm_end > 0 THEN {strip('substr(clean, fm_end + 3)')} ELSE clean END AS body
  FROM fm_pos
)"""


def lines_cte(src: str = "prepared", text: str = "body", name: str = "lines") -> str:
    return f"""{name} AS (
  SELECT doc_id, CAST(unnest(range(len(a))) AS BIGINT) AS line_no, unnest(a) AS line
  FROM (SELECT doc_id, string_split({text}, {NL}) AS a FROM {src})
)"""


def sections_cte(lines: str = "lines") -> str:
    """lines → cls (fence / classes) → sec (section_no)."""
    return f"""cls0 AS (
  SELECT *, starts_with({strip('line')}, '```') AS is_fence FROM {lines}
),
cls AS (
  SELECT *,
    CASE WHEN NOT in_code AND regexp_matches(line, {q(HEADER_RE)})
         THEN length(regexp_extract(line, {q(HEADER_LEVEL_RE)}, 1)) END AS header_level,
    NOT in_code AND starts_with({strip('line')}, '|') AND contains(substr(line, 2), '|') AS is_table,
    NOT in_code AND regexp_matches(line, {q(LIST_RE)}) AS is_list,
    {blank('line')} AS is_blank
  FROM (
    SELECT *, is_fence OR coalesce(sum(CAST(is_fence AS INT)) OVER (
        PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS in_code
    FROM cls0)
),
sec AS (
  SELECT * EXCLUDE (cut, prev_level),
         CAST(sum(cut) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section_no
  FROM (
    SELECT *, CASE WHEN header_level IS NOT NULL AND line_no > 0
                    AND (prev_level IS NULL OR header_level <= prev_level) THEN 1 ELSE 0 END AS cut
    FROM (SELECT *, last_value(header_level IGNORE NULLS) OVER (
            PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_level
          FROM cls))
)"""


def pieces_cte(budget: int = TEST_BUDGET) -> str:
    """sec → piece_lines → pieces(doc_id, section_no, para_no, grp, text, n)."""
    return f"""piece_lines AS (
  SELECT *, CAST(CASE WHEN big THEN blanks ELSE -1 END AS BIGINT) AS para_no,
            CAST(CASE WHEN big THEN section_no ELSE -1 END AS BIGINT) AS grp
  FROM (
    SELECT *, sum(CASE WHEN is_blank THEN 1 ELSE 0 END) OVER (
                PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS blanks,
              sum(length(line) + 1) OVER (PARTITION BY doc_id, section_no) - 1 > {4 * budget} AS big
    FROM sec)
  WHERE NOT (big AND is_blank)
),
pieces AS (
  SELECT doc_id, section_no, para_no, grp, string_agg(line, {NL} ORDER BY line_no) AS text,
         CAST(length(string_agg(line, {NL} ORDER BY line_no)) AS BIGINT) AS n
  FROM piece_lines GROUP BY doc_id, section_no, para_no, grp
)"""


def parts_cte(budget: int = TEST_BUDGET) -> str:
    """prepared → parts(doc_id, part_no, text, n_chars, est_tokens) via a recursive fold."""
    lim = 4 * budget
    return f"""long_docs AS (SELECT doc_id, body FROM prepared WHERE length(body) > {lim}),
{lines_cte('long_docs')},
{sections_cte()},
{pieces_cte(budget)},
pk AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section_no, para_no) AS k FROM pieces
),
fold AS (
  SELECT doc_id, k, n AS cur, grp AS g, 1 AS part_no FROM pk WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.k,
         CASE WHEN p.grp <> f.g OR f.cur + p.n > {lim} THEN p.n ELSE f.cur + p.n END,
         p.grp,
         CASE WHEN p.grp <> f.g OR f.cur + p.n > {lim} THEN f.part_no + 1 ELSE f.part_no END
  FROM fold f JOIN pk p ON p.doc_id = f.doc_id AND p.k = f.k + 1
),
long_parts AS (
  SELECT pk.doc_id, CAST(f.part_no AS BIGINT) AS part_no,
         string_agg(pk.text, {NL}||{NL} ORDER BY pk.k) AS text
  FROM pk JOIN fold f ON pk.doc_id = f.doc_id AND pk.k = f.k
  GROUP BY pk.doc_id, f.part_no
),
parts AS (
  SELECT doc_id, part_no, text, CAST(length(text) AS BIGINT) AS n_chars, length(text) / 4.0 AS est_tokens
  FROM (SELECT doc_id, CAST(1 AS BIGINT) AS part_no, body AS text FROM prepared WHERE length(body) <= {lim}
        UNION ALL SELECT * FROM long_parts)
)"""


# ---------------------------------------------------------------------------
# Glossary, languages, memory, earlier terms (oracle side of REQ-*).

def glossary_cte(glossary=None) -> str:
    from docweave.sources.config import TEST_GLOSSARY
    return f"g AS ({(glossary or TEST_GLOSSARY).values_sql()})"


def langs_cte(targets, languages=None) -> str:
    from docweave.sources.config import TEST_LANGUAGES
    return f"langs AS ({(languages or TEST_LANGUAGES).values_sql(targets)})"


def pair_line(term: str, rendering: str) -> str:
    return f"'''' || {term} || ''' -> ''' || {rendering} || '''' || chr(10)"


def gblock_cte() -> str:
    from docweave.operators.glossary import GLOSSARY_HEADING
    return (f"gb AS (SELECT lang, {q(GLOSSARY_HEADING)} || string_agg({pair_line('term', 'rendering')}, '' "
            f"ORDER BY ord) AS glossary_block FROM g GROUP BY lang)")


def memory_cte(src_sql: str, n: int = 10) -> str:
    """mem → rec2 (recent rows with idx, complete) → ib (improvements block)."""
    from docweave.operators.memory import IMPROVEMENTS_HEADING
    item = ("CAST(idx AS VARCHAR) || '. Issue: ' || reason || chr(10) || '   Original: ' || original || chr(10)"
            " || '   Incorrect translation: ' || translated || chr(10) || '   Avoid this mistake.' || chr(10) || chr(10)")
    return f"""mem AS ({src_sql}),
rec AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY seq DESC) AS rn,
               least(count(*) OVER (PARTITION BY lang), {n}) AS m FROM mem),
rec2 AS (SELECT lang, seq, original, translated, reason, CAST(m - rn + 1 AS BIGINT) AS idx,
                coalesce(original, '') <> '' AND coalesce(translated, '') <> '' AND coalesce(reason, '') <> '' AS complete
         FROM rec WHERE rn <= {n}),
ib AS (SELECT lang, {q(IMPROVEMENTS_HEADING)} || coalesce(string_agg(CASE WHEN complete THEN {item} END, '' ORDER BY idx), '')
              AS improvements_block FROM rec2 GROUP BY lang)"""


def earlier_cte(parts: str = "parts") -> str:
    """firsts(doc_id, term, ord, first_part) and fl (with lang, rendering)."""
    return f"""gt AS (SELECT term, min(ord) AS ord FROM g GROUP BY term),
th AS (SELECT p.doc_id, p.part_no, gt.term, gt.ord FROM {parts} p JOIN gt ON contains(p.text, gt.term)),
firsts AS (SELECT doc_id, term, ord, min(part_no) AS first_part FROM th GROUP BY doc_id, term, ord),
fl AS (SELECT f.doc_id, f.term, f.ord, f.first_part, g.lang, g.rendering FROM firsts f JOIN g ON g.term = f.term),
eb AS (SELECT p.doc_id, p.part_no, l.lang,
              string_agg(fl.term, ',' ORDER BY fl.first_part, fl.ord) AS earlier_terms,
              string_agg({pair_line('fl.term', 'fl.rendering')}, '' ORDER BY fl.first_part, fl.ord) AS earlier_lines
       FROM {parts} p CROSS JOIN langs l
       LEFT JOIN fl ON fl.doc_id = p.doc_id AND fl.first_part < p.part_no AND fl.lang = l.lang
       GROUP BY p.doc_id, p.part_no, l.lang)"""


def clean_reply_sql(x: str) -> str:
    """RSP-1 in DuckDB: prefix, opening fence line, closing fence."""
    from docweave.functions.text import REPLY_PREFIXES
    pref = " OR ".join(f"starts_with(lower({x}), {q(p)})" for p in REPLY_PREFIXES)
    v = f"CASE WHEN {pref} THEN {strip(f'substr({x}, instr({x}, {q(":")}) + 1)')} ELSE {x} END"
    v = f"regexp_replace({v}, '\\A```[^\\n]*\\n', '')"
    return f"regexp_replace({v}, '\\n```(\\n?)\\z', '\\1')"

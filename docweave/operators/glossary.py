"""Glossary operators: hits per text (JOIN-3), earlier terms (WIN-4), the
ordered prompt block (AGG-7) and per-pair consistency (QA-2).

The glossary is a literal array (a small configuration file), so a hit
test is one ``filter(array, contains)`` per row: no row blow-up, no join. For
glossaries kept as tables see ``term_match``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import materialize
from docweave.sources.config import Glossary

# Prompt headings.
GLOSSARY_HEADING = "\nГлоссарий терминов (русский -> целевой язык):\n"
EARLIER_TERMS_HEADING = "\nПредыдущие переводы терминов в этом документе:\n"


def _pair_line(term: Column, rendering: Column) -> Column:
    return F.concat(F.lit("'"), term, F.lit("' -> '"), rendering, F.lit("'\n"))


def hits(text: Column | str, lang: Column | str, glossary: Glossary) -> Column:
    """Glossary rows of ``lang`` whose term occurs in ``text`` (case-sensitive),
    in glossary order: ``array<struct<term,lang,rendering,ord>>``."""
    t = F.col(text) if isinstance(text, str) else text
    lg = F.col(lang) if isinstance(lang, str) else lang
    return F.array_sort(
        F.filter(glossary.array(), lambda g: (g["lang"] == lg) & t.contains(g["term"])),
        lambda a, b: F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0))


def term_hits_any_lang(text: Column | str, glossary: Glossary) -> Column:
    """Distinct terms (with ``ord``) occurring in ``text``, any language."""
    t = F.col(text) if isinstance(text, str) else text
    terms = F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(term).alias("term"))
                      for term, o in glossary.terms()]) if glossary.rows else \
        F.array().cast("array<struct<ord:int,term:string>>")
    return F.filter(terms, lambda g: t.contains(g["term"]))


def glossary_blocks(spark: SparkSession, glossary: Glossary) -> DataFrame:
    """AGG-7: ``(lang, glossary_block)`` — heading plus ``'term' -> 'rendering'``
    lines in glossary order. A language without entries gets the bare heading
    (joined with ``coalesce`` by the callers)."""
    g = glossary.df(spark)
    return (g.groupBy("lang")
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("ord", _pair_line(F.col("term"), F.col("rendering")).alias("l")))),
                lambda s: s["l"]), "").alias("_lines"))
            .select("lang", F.concat(F.lit(GLOSSARY_HEADING), F.col("_lines")).alias("glossary_block")))


def earlier_terms(parts: DataFrame, keys: list[str], glossary: Glossary,
                  text: str = "text", part_no: str = "part_no", failed: DataFrame | None = None,
                  targets: Sequence[str] = ()) -> DataFrame:
    """WIN-4: per part, the glossary terms found in parts ``1..k-1`` of the same
    document, ordered by first part then glossary order (``earlier``:
    ``array<string>`` of terms).

    A term's first part decides, so a document carries one entry per term it has, however many parts repeat it. Without
    ``failed`` the value depends only on the source text and the glossary, so parts need not be
    processed in sequence. With ``failed`` (``keys, part_no, lang``: parts whose reply failed) there is a row per part and
    language of ``targets`` (``lang``), and a failed part counts for none of the later parts in its language.
    """
    marked = materialize(parts.withColumn("_found", term_hits_any_lang(text, glossary)), "part-terms")
    hits = marked.select(*keys, F.col(part_no).alias("_p"), F.explode("_found").alias("_g"))
    of, out = list(keys), marked
    if failed is not None:
        lang = F.explode(F.array(*[F.lit(t) for t in targets])).alias("lang")
        gone = failed.select(*keys, F.col(part_no).alias("_p"), "lang")
        hits = hits.select("*", lang).join(gone, [*keys, "_p", "lang"], "left_anti")
        of, out = [*keys, "lang"], marked.select("*", lang)
    firsts = hits.groupBy(*of, "_g").agg(F.min("_p").alias("_p"))
    listed = firsts.groupBy(*of).agg(F.array_sort(F.collect_list(F.struct("_p", F.col("_g.ord").alias("ord"), F.col("_g.term").alias("term")))).alias("_firsts"))
    before = F.filter(F.coalesce("_firsts", F.array().cast("array<struct<_p:bigint,ord:int,term:string>>")), lambda x: x["_p"] < F.col(part_no))
    return out.join(listed, of, "left").withColumn("earlier", F.transform(before, lambda x: x["term"])).drop("_found", "_firsts")


def earlier_terms_split(short: DataFrame, packed: DataFrame, keys: list[str], glossary: Glossary,
                        text: str = "text", part_no: str = "part_no") -> DataFrame:
    """WIN-4 over the two branches of ``split_parts_branches``: a one-part
    document has no earlier parts."""
    empty = F.array().cast("array<string>")
    return short.withColumn("earlier", empty).unionByName(earlier_terms(packed, keys, glossary, text, part_no))


def earlier_block(earlier: Column | str, lang: Column | str, glossary: Glossary) -> Column:
    """Prompt block for the earlier terms that have a rendering in ``lang``."""
    e = F.col(earlier) if isinstance(earlier, str) else earlier
    lg = F.col(lang) if isinstance(lang, str) else lang
    g = glossary.array()
    lines = F.transform(
        e, lambda term: F.filter(g, lambda x: (x["term"] == term) & (x["lang"] == lg)))
    flat = F.flatten(lines)
    return F.when(F.size(flat) > 0, F.concat(
        F.lit(EARLIER_TERMS_HEADING),
        F.array_join(F.transform(flat, lambda x: _pair_line(x["term"], x["rendering"])), "")
    )).otherwise(F.lit(""))


def false_positive_match(original: Column, translated: Column, reason: Column, lang: Column,
                         glossary: Glossary, markers: tuple[str, ...]) -> Column:
    """FLT-4 (a): some term (lower-cased) is in ``lower(original)``, its ``lang``
    rendering (lower-cased) is in ``lower(translated)``, and ``lower(reason)``
    names one of ``markers``."""
    lo, lt, lr = F.lower(original), F.lower(translated), F.lower(reason)
    marker = F.lit(False)
    for m in markers:
        marker = marker | lr.contains(m)
    return marker & F.exists(
        glossary.array(),
        lambda g: (g["lang"] == lang) & lo.contains(F.lower(g["term"]))
        & lt.contains(F.lower(g["rendering"])))

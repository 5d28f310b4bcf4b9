"""Markdown structure as table-valued DataFrame operators (STR-1 … STR-10).

Plan shape for a corpus::

    docs ──┬─ short by size hint ────────────────────────────────┐
           └─ rest ─ posexplode(lines) ─ Exchange(hash doc key) ─┤
                     window: fences, headers, sections, blanks   │
                     group (doc, piece) ─ group (doc) ─ fold     │
                     posexplode(parts) ─────────────────────────┴─ union

Short documents never leave their scan partition. For long ones there is one
hash exchange on the document key; every later window and aggregate is
clustered by a superset of that key, so Spark plans no further exchange. A
single document is one window partition (documents are at most megabytes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import WS, is_blank

HEADER_RE = rf"(?s)^#{{1,6}}{WS}."
HEADER_LEVEL_RE = rf"^(#{{1,6}}){WS}"
LIST_RE = rf"^{WS}*[-*+]{WS}"
# Anchored prefix tests instead of strip-then-startswith: one short regex
# attempt at the line start, no scan for trailing blanks.
FENCE_RE = rf"^{WS}*```"
TABLE_RE = rf"^{WS}*\|"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def explode_lines(docs: DataFrame, keys, text: str = "body") -> DataFrame:
    """STR-1: one row per line (split on ``\\n`` only, empty lines kept).

    ``line_no`` counts from 0.
    """
    k = _keys(keys)
    return docs.select(
        *k, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def classify_lines(lines: DataFrame, keys) -> DataFrame:
    """STR-2 / STR-3: fence parity and line classes.

    * ``is_fence``: stripped line starts with a backtick fence (indented fences
      count, tilde fences do not);
    * ``in_code``: an odd number of fence lines precede it (fence lines
      themselves toggle and are code as well);
    * ``is_table``, ``is_list``, ``is_blank``: informational classes;
    * ``header_level``: 1..6 for an unindented ATX header outside code, else null.
    """
    k = _keys(keys)
    w_before = (Window.partitionBy(*k).orderBy("line_no")
                .rowsBetween(Window.unboundedPreceding, -1))
    is_fence = F.col("line").rlike(FENCE_RE)
    fences_before = F.coalesce(F.sum(is_fence.cast("int")).over(w_before), F.lit(0))
    out = (lines
           .withColumn("is_fence", is_fence)
           .withColumn("in_code", F.col("is_fence") | (fences_before % 2 == 1)))
    header = (~F.col("in_code")) & F.col("line").startswith("#") & F.col("line").rlike(HEADER_RE)
    return (out
            .withColumn("is_table", ~F.col("in_code") & F.col("line").rlike(TABLE_RE)
                        & F.col("line").substr(F.lit(2), F.lit(1 << 30)).contains("|"))
            .withColumn("is_list", ~F.col("in_code") & F.col("line").rlike(LIST_RE))
            .withColumn("is_blank", is_blank("line"))
            .withColumn("header_level",
                        F.when(header, F.length(F.regexp_extract("line", HEADER_LEVEL_RE, 1)))))


def assign_sections(classified: DataFrame, keys) -> DataFrame:
    """STR-4: ``section_no`` from 0; a header cuts when it is not the first line
    and no header was seen before or its level is <= the previous header's."""
    k = _keys(keys)
    w_before = (Window.partitionBy(*k).orderBy("line_no")
                .rowsBetween(Window.unboundedPreceding, -1))
    w_run = (Window.partitionBy(*k).orderBy("line_no")
             .rowsBetween(Window.unboundedPreceding, 0))
    prev_level = F.last("header_level", ignorenulls=True).over(w_before)
    cut = (F.col("header_level").isNotNull() & (F.col("line_no") > 0)
           & (prev_level.isNull() | (F.col("header_level") <= prev_level)))
    return (classified.withColumn("_cut", cut.cast("int"))
            .withColumn("section_no", F.sum("_cut").over(w_run).cast("bigint"))
            .drop("_cut"))


def _ordered_join(sort_col: str, text_col: str, sep: str) -> Column:
    """Join ``text_col`` of the group in ``sort_col`` order."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(sort_col, text_col))),
                    lambda s: s[text_col]),
        sep)


def section_texts(sections: DataFrame, keys) -> DataFrame:
    """STR-5: section text = its lines joined by ``\\n``."""
    k = _keys(keys)
    return (sections.groupBy(*k, "section_no")
            .agg(_ordered_join("line_no", "line", "\n").alias("text"),
                 F.min("header_level").alias("_lvl"))
            .withColumn("n_chars", F.length("text").cast("bigint"))
            .drop("_lvl"))


def line_pieces(sections: DataFrame, keys, max_tokens: int) -> DataFrame:
    """STR-7: mark each line with the piece it belongs to.

    A section whose text is longer than the budget is cut into paragraphs on
    blank lines (code fences ignored, runs collapse, blank lines dropped); every
    other section is one piece. ``grp`` is -1 for whole sections and the section
    number for paragraphs of an oversized section.
    """
    k = _keys(keys)
    limit = 4 * max_tokens
    w_sec = Window.partitionBy(*k, "section_no")
    w_run = (Window.partitionBy(*k).orderBy("line_no")
             .rowsBetween(Window.unboundedPreceding, 0))
    sec_len = F.sum(F.length("line") + 1).over(w_sec) - 1
    out = (sections
           .withColumn("_blank", is_blank("line"))
           .withColumn("_blanks", F.sum(F.col("_blank").cast("int")).over(w_run))
           .withColumn("_big", sec_len > limit))
    return (out.where(~(F.col("_big") & F.col("_blank")))
            .withColumn("para_no", F.when(F.col("_big"), F.col("_blanks")).otherwise(F.lit(-1))
                        .cast("bigint"))
            .withColumn("grp", F.when(F.col("_big"), F.col("section_no")).otherwise(F.lit(-1))
                        .cast("bigint"))
            .drop("_blank", "_blanks", "_big"))


def pieces(piece_lines: DataFrame, keys) -> DataFrame:
    """Piece text and length per ``(doc, section_no, para_no)``."""
    k = _keys(keys)
    return (piece_lines.groupBy(*k, "section_no", "para_no", "grp")
            .agg(_ordered_join("line_no", "line", "\n").alias("text"))
            .withColumn("n", F.length("text").cast("bigint")))


def pack_pieces(piece_df: DataFrame, keys, max_tokens: int) -> DataFrame:
    """STR-8 / STR-9: greedy next-fit packing per document, then explode parts.

    A new part starts at the first piece, when ``grp`` changes, or when the
    running length plus the piece's length exceeds ``4*max_tokens`` (pieces
    are never empty, so a running length > 0 means the part holds something).
    The fold only appends to the list of part starts, so its cost is linear in
    pieces plus quadratic in parts; it runs JVM-side on each document row.
    """
    k = _keys(keys)
    limit = F.lit(4 * max_tokens).cast("bigint")
    per_doc = piece_df.groupBy(*k).agg(
        F.array_sort(F.collect_list(F.struct("section_no", "para_no", "grp", "n", "text")))
        .alias("ps"))

    init = F.struct(F.lit(0).cast("bigint").alias("cur"), F.lit(-2).cast("bigint").alias("g"),
                    F.lit(0).alias("k"), F.array().cast("array<int>").alias("starts"))

    def step(acc, p):
        new = (acc["k"] == 0) | (p["grp"] != acc["g"]) | (acc["cur"] + p["n"] > limit)
        return F.when(
            new,
            F.struct(p["n"].alias("cur"), p["grp"].alias("g"), (acc["k"] + 1).alias("k"),
                     F.concat(acc["starts"], F.array(acc["k"])).alias("starts")),
        ).otherwise(
            F.struct((acc["cur"] + p["n"]).alias("cur"), p["grp"].alias("g"),
                     (acc["k"] + 1).alias("k"), acc["starts"].alias("starts")))

    folded = per_doc.withColumn("starts", F.aggregate("ps", init, step)["starts"])
    starts_next = F.concat(F.slice("starts", 2, 1 << 30), F.array(F.size("ps")))
    parts = F.transform(
        F.arrays_zip(F.col("starts").alias("s"), starts_next.alias("e")),
        lambda z: F.array_join(
            F.transform(F.slice("ps", z["s"] + 1, z["e"] - z["s"]), lambda p: p["text"]),
            "\n\n"))
    return (folded.select(*k, F.posexplode(parts).alias("part_no", "text"))
            .withColumn("part_no", (F.col("part_no") + 1).cast("bigint")))


def split_parts_branches(docs: DataFrame, keys, text: str = "body", max_tokens: int = 8000,
                         size_hint: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """STR-6 … STR-9: ``(short, packed)``, both ``(keys, part_no, text)``.

    ``short`` holds one-part documents still in their scan partitioning;
    ``packed`` comes out of the per-document aggregation, hash-partitioned by
    ``keys``, so a later window or aggregate by document needs no exchange.

    A document that fits the budget is one part, unchanged (also when empty).
    ``size_hint`` is a cheap upper bound of ``length(text)`` (e.g. the length
    of the stored raw text, since preparation only removes characters).
    Documents under the budget by the hint never leave their scan partition.
    The others are prepared once and exploded into lines for the single
    exchange; one that fits after preparation travels as a single "line",
    which the section and packing steps return unchanged. Routing on a
    derived ``length(text)`` instead would make Spark evaluate the whole
    preparation in the filter and again in the projection.
    """
    k = _keys(keys)
    limit = 4 * max_tokens
    hint = F.length(text) if size_hint is None else size_hint
    short = docs.where(hint <= limit).select(*k, F.lit(1).cast("bigint").alias("part_no"),
                                             F.col(text).alias("text"))
    rest = docs.where(hint > limit)
    body = F.col(text)
    units = F.when(F.length(body) <= limit, F.array(body)).otherwise(F.split(body, "\n", -1))
    lines = (rest.select(*k, F.posexplode(units).alias("line_no", "line"))
             .withColumn("line_no", F.col("line_no").cast("bigint")))
    secs = assign_sections(classify_lines(lines, k), k)
    packed = pack_pieces(pieces(line_pieces(secs, k, max_tokens), k), k, max_tokens)
    return short, packed


def split_parts(docs: DataFrame, keys, text: str = "body", max_tokens: int = 8000,
                size_hint: Column | None = None) -> DataFrame:
    """Both branches of :func:`split_parts_branches` with sizes:
    ``(keys, part_no, text, n_chars, est_tokens)``."""
    short, packed = split_parts_branches(docs, keys, text, max_tokens, size_hint)
    return with_sizes(short.unionByName(packed))


def with_sizes(parts: DataFrame) -> DataFrame:
    return (parts.withColumn("n_chars", F.length("text").cast("bigint"))
            .withColumn("est_tokens", F.length("text").cast("double") / 4.0))


def reassemble(parts: DataFrame, keys, text: str = "text") -> DataFrame:
    """STR-10: parts in ``part_no`` order joined by a blank line."""
    k = _keys(keys)
    return parts.groupBy(*k).agg(_ordered_join("part_no", text, "\n\n").alias("text"))

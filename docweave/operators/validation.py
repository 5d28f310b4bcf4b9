"""Validation side: parse replies into issues (RSP-3), drop false positives
(FLT-4, RSP-4), reports (AGG-5, AGG-6, ORD-3, SNK-3) and computed checks of a
pair (QA-1 structure parity, QA-2 glossary consistency)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.operators.glossary import false_positive_match
from docweave.operators.topk import top_k_per_group
from docweave.sources.config import Glossary

# Reason markers of a glossary false positive (Russian only).
FALSE_POSITIVE_MARKERS = ("глоссари", "словар", "термин")
ISSUE_FIELDS = ("original", "translated", "reason")


def _field_ok(e: Column, name: str) -> Column:
    t = F.schema_of_variant(F.variant_get(e, f"$.{name}", "variant"))
    return t.isNull() | (t == "STRING")


def parse_issues(replies: DataFrame, content: str = "content") -> DataFrame:
    """RSP-3: one row per issue ``(…, pos, original, translated, reason)``.

    All-or-nothing per reply: not JSON, not an object, ``issues`` missing /
    null / empty / not an array → no issues; any element that is not an
    object, or a field present with a non-string value → the whole reply
    yields no issues. A missing field reads as ``""``.
    """
    v = F.try_parse_json(F.col(content))
    iss = F.try_variant_get(v, "$.issues", "array<variant>")
    elem_ok = lambda e: (F.schema_of_variant(e).startswith("OBJECT")
                         & _field_ok(e, "original") & _field_ok(e, "translated") & _field_ok(e, "reason"))
    valid = (v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT") & iss.isNotNull()
             & F.forall(iss, elem_ok))
    parsed = replies.withColumn("_iss", F.when(valid, iss))
    out = parsed.select(*[c for c in replies.columns if c != content],
                        F.posexplode("_iss").alias("pos", "_e"))
    return out.select(
        *[c for c in out.columns if c not in ("_e",)],
        *[F.coalesce(F.variant_get("_e", f"$.{f}", "string"), F.lit("")).alias(f) for f in ISSUE_FIELDS]
    ).withColumn("pos", F.col("pos").cast("bigint"))


def filter_issues(issues: DataFrame, glossary: Glossary, lang: str = "lang",
                  markers: tuple[str, ...] = FALSE_POSITIVE_MARKERS) -> DataFrame:
    """FLT-4 (+ RSP-4 by the caller): adds ``glossary_fp`` (rule a),
    ``incomplete`` (rule b: a field empty, or original/translated shorter than
    3 code points) and ``keep``."""
    o, t, r = F.col("original"), F.col("translated"), F.col("reason")
    fp = false_positive_match(o, t, r, F.col(lang), glossary, markers)
    incomplete = (o == "") | (t == "") | (r == "") | (F.length(o) < 3) | (F.length(t) < 3)
    return (issues.withColumn("glossary_fp", fp).withColumn("incomplete", incomplete)
            .withColumn("keep", ~fp & ~incomplete))


def report(files: DataFrame, kept: DataFrame) -> DataFrame:
    """AGG-5: per language the number of files with a result (zero-issue
    files included), the number of kept issues and order-free checksums of
    their content. Every aggregate is partial (map-side combine), so a
    language holding a third of all issues is never gathered in one task;
    the ordered issue list itself is written by :func:`docweave.sinks.files.write_report`."""
    per_lang_files = files.groupBy("lang").agg(F.count("*").alias("total_files"))
    per_lang_issues = kept.groupBy("lang").agg(
        F.count("*").alias("total_issues"),
        F.sum(F.length("original") + F.length("translated") + F.length("reason")).cast("bigint").alias("issue_chars"),
        F.min("file_path").alias("first_file"), F.max("file_path").alias("last_file"))
    return (per_lang_files.join(per_lang_issues, "lang", "left")
            .select("lang", "total_files", F.coalesce("total_issues", F.lit(0)).cast("bigint").alias("total_issues"),
                    F.coalesce("issue_chars", F.lit(0)).cast("bigint").alias("issue_chars"),
                    "first_file", "last_file"))


def token_stats(files: DataFrame) -> DataFrame:
    """AGG-6: per language total tokens, validated files and the average
    (``null`` when no file was validated)."""
    return (files.groupBy("lang")
            .agg(F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).cast("bigint").alias("total_tokens"),
                 F.count("*").alias("validated_files"))
            .withColumn("avg_tokens", F.col("total_tokens") / F.expr("nullif(validated_files, 0)")))


def samples(kept: DataFrame, k: int = 5) -> DataFrame:
    """ORD-3: the first ``k`` issues of each language's report (salted top-k)."""
    return top_k_per_group(kept, ["lang"], [F.col("file_path"), F.col("pos")], k,
                           ["file_path", "pos"], "sample_no")


# Structural markers counted on both sides of a pair (QA-1).
PARITY_PATTERNS = {
    "details_open": r"<details>",
    "details_close": r"</details>",
    "fences": r"(?m)^[ \t]*```",
    "headers": r"(?m)^#{1,6}[ \t]",
    "imports": r"(?m)^import ",
    "links": r"\]\(",
    "jsx_tags": r"<[A-Z][A-Za-z0-9]*[^<>]*/>",
    "admonitions": r"(?m)^:::",
}


def structure_parity(pairs: DataFrame, original: str = "original", translated: str = "translated") -> DataFrame:
    """QA-1: counts of each marker in both texts and a mismatch flag."""
    cols = []
    mism = F.lit(False)
    for name, pat in PARITY_PATTERNS.items():
        jpat = "(?d)" + pat  # Java: only \n ends a line, as in RE2 and Python
        a = F.regexp_count(F.col(original), F.lit(jpat)).cast("bigint")
        b = F.regexp_count(F.col(translated), F.lit(jpat)).cast("bigint")
        cols += [a.alias(f"src_{name}"), b.alias(f"out_{name}")]
        mism = mism | (a != b)
    return pairs.select(*[c for c in pairs.columns if c not in (original, translated)], *cols,
                        mism.alias("mismatch"))


def glossary_violations(pairs: DataFrame, glossary: Glossary, lang: str = "lang") -> DataFrame:
    """QA-2: glossary terms present in the original (case-insensitive) whose
    rendering for the language is missing from the translated text."""
    lo, lt = F.lower(F.col("original")), F.lower(F.col("translated"))
    bad = F.array_sort(F.filter(
        glossary.array(),
        lambda g: (g["lang"] == F.col(lang)) & lo.contains(F.lower(g["term"]))
        & ~lt.contains(F.lower(g["rendering"]))),
        lambda a, b: F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0))
    return pairs.select(*[c for c in pairs.columns if c not in ("original", "translated")],
                        F.size(bad).cast("bigint").alias("n_violations"),
                        F.array_join(F.transform(bad, lambda g: g["term"]), ",").alias("terms"))

"""Issue memory: latest rows per language (WIN-5) and the improvements prompt
block (AGG-8); completeness filter (FLT-5) and append with sequence numbers
(SNK-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.text import strip
from docweave.operators.topk import top_k_per_group
from docweave.session import materialize

# Improvements prompt texts.
IMPROVEMENTS_HEADING = "\n\nBased on previous translation issues, pay special attention to these cases:\n"
RECENT_N = 10
#: Bytes of appended rows that are ranked together, about.
RANGE_BYTES = 32 << 20


def _s(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def recent_improvements(memory: DataFrame, n: int = RECENT_N) -> DataFrame:
    """WIN-5: the latest ``n`` rows per language by ``seq``, numbered 1..n in
    ascending order (``idx``); ``complete`` marks rows whose three fields are
    non-empty (numbers are assigned before that test, so they may skip).

    A language is a hot group (a third of all rows), so the latest rows come
    from a salted two-stage top-k and the row count from a partial aggregate.
    The per-language counts carry no broadcast hint: their size comes from the
    data, so AQE decides from the measured size (broadcast when small).
    """
    counts = memory.groupBy("lang").agg(F.least(F.count(F.lit(1)), F.lit(n)).alias("_m"))
    recent = top_k_per_group(memory, ["lang"], [F.col("seq").desc()], n, ["seq"], "_rn")
    return (recent.join(counts, "lang")
            .withColumn("idx", (F.col("_m") - F.col("_rn") + 1).cast("bigint"))
            .withColumn("complete", (_s("original") != "") & (_s("translated") != "") & (_s("reason") != ""))
            .drop("_rn", "_m"))


# The labels of one item in the improvements block.
ITEM_ISSUE = ". Issue: "
ITEM_ORIGINAL = "\n   Original: "
ITEM_TRANSLATED = "\n   Incorrect translation: "
ITEM_END = "\n   Avoid this mistake.\n\n"


def improvements_blocks(memory: DataFrame, n: int = RECENT_N) -> DataFrame:
    """AGG-8: ``(lang, improvements_block)`` for every language with memory
    rows; the heading appears even if none of the recent rows is complete."""
    item = F.concat(
        F.col("idx").cast("string"), F.lit(ITEM_ISSUE), F.col("reason"),
        F.lit(ITEM_ORIGINAL), F.col("original"),
        F.lit(ITEM_TRANSLATED), F.col("translated"), F.lit(ITEM_END))
    r = recent_improvements(memory, n).withColumn("_item", F.when(F.col("complete"), item))
    return (r.groupBy("lang")
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("idx", F.coalesce("_item", F.lit("")).alias("t")))),
                lambda s: s["t"]), "").alias("_items"))
            .select("lang", F.concat(F.lit(IMPROVEMENTS_HEADING), F.col("_items")).alias("improvements_block")))


def complete_for_memory(issues: DataFrame) -> DataFrame:
    """FLT-5: fields stripped; rows with a blank field never reach memory."""
    out = (issues.withColumn("original", strip(_s("original")))
           .withColumn("translated", strip(_s("translated")))
           .withColumn("reason", strip(_s("reason"))))
    return out.where((F.col("original") != "") & (F.col("translated") != "") & (F.col("reason") != ""))


def append_memory(existing: DataFrame, new_rows: DataFrame, order_cols: list[str]) -> DataFrame:
    """SNK-4: new rows get ``seq = max(existing seq of the language) + 1, + 2, …``
    in arrival order (``order_cols``, which must be unique per language).

    Rows are range-partitioned by (language, order) and written, so that ranges
    are fixed; a row's rank is its number within (range, language) plus the
    counts of the language in earlier ranges (one row per range and language).
    A hot language is never ranked in one task. There are as many ranges as the rows' bytes ask for (RANGE_BYTES each).
    """
    cols = ["lang", "original", "translated", "reason"]
    rows = new_rows.select(*cols, *[c for c in order_cols if c not in cols])
    size = rows.agg(F.sum(F.lit(64) + sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in cols))).first()[0] or 0
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    ranged = materialize(
        rows.repartitionByRange(n, "lang", *order_cols).withColumn("_part", F.spark_partition_id()), "memory-ranges")
    per = ranged.groupBy("lang", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = per.select("lang", "_part", (F.sum("_n").over(Window.partitionBy("lang").orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order_cols))
    mx = existing.groupBy("lang").agg(F.max("seq").alias("_mx"))
    return (ranged.repartition(n, "lang", "_part").withColumn("_rank", rank).join(before, ["lang", "_part"]).join(mx, "lang", "left")
            .withColumn("seq", (F.coalesce("_mx", F.lit(-1)) + F.col("_before") + F.col("_rank")).cast("bigint"))
            .select("lang", "seq", "original", "translated", "reason"))

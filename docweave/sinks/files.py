"""Sinks: partitioned tables (SNK-1/2/4/5), one-file-per-row export (SNK-1,
SNK-2) and validation reports (SNK-3).

Table sinks are plain ``DataFrameWriter`` calls (task commits are atomic). The
per-row export is the ``doc_tree`` sink, whose tasks and jobs commit as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docweave.sources.tree import write_tree


def export_files(df: DataFrame, root: str, rel_col: str = "output_path", content_col: str = "content", mode: str = "append") -> None:
    """One file per row at ``root/<rel_col>``; ``content_col`` is binary or
    string (written as UTF-8). ``overwrite`` replaces the whole tree at once."""
    write_tree(df, root, rel_col, content_col, mode)


def write_documents(docs: DataFrame, path: str, targets: Sequence[str]) -> DataFrame:
    """SNK-1 with AGG-1 … AGG-3: writes ``docs`` (``lang, rel_path, text, n_parts, n_fallback, tokens``) partitioned by language and
    returns ``(lang, n_documents, n_with_fallback, n_parts, n_fallback, tokens)`` per target language, counted as the rows are written: nothing
    runs a second time for the figures, of which the driver gets one row."""
    spark = docs.sparkSession
    seen = Observation("documents")
    counted = {"n_documents": F.lit(1), "n_with_fallback": (F.col("n_fallback") > 0).cast("int"), "n_parts": F.col("n_parts"),
               "n_fallback": F.col("n_fallback"), "tokens": F.col("tokens")}
    sums = [F.sum(F.when(F.col("lang") == t, c).otherwise(0)).cast("bigint").alias(f"{name}_{i}")
            for i, t in enumerate(targets) for name, c in counted.items()]
    docs.observe(seen, *sums).write.mode("overwrite").partitionBy("lang").parquet(path)
    got = seen.get
    rows = [(t, *(int(got[f"{name}_{i}"] or 0) for name in counted)) for i, t in enumerate(targets)]
    return spark.createDataFrame(rows, "lang string, " + ", ".join(f"{name} bigint" for name in counted))


def write_report(files: DataFrame, kept: DataFrame, path: str) -> None:
    """SNK-3: ``summary/`` (one JSON row per language: ``language,
    total_files, total_issues``) and ``issues/`` (JSON lines partitioned by
    language, each file sorted by ``(file_path, pos)``; non-ASCII kept)."""
    from docweave.operators.validation import report
    summary = report(files, kept).select(F.col("lang").alias("language"), "total_files", "total_issues")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    # Range partitioning spreads a language holding most issues over many
    # tasks and leaves the files in report order.
    (kept.repartitionByRange("lang", "file_path", "pos").sortWithinPartitions("lang", "file_path", "pos")
     .select(F.col("lang").alias("language"), "file_path", "original", "translated", "reason")
     .write.mode("overwrite").partitionBy("language").json(f"{path}/issues"))

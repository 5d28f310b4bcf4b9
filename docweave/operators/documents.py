"""Per-document preparation (PRJ-1 … PRJ-4, PRJ-8): narrow, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as T


def prepare(docs: DataFrame, text: str = "md") -> DataFrame:
    """Newline normalisation, LOCAL TEXT removal, then the frontmatter split.

    Adds ``clean`` (text after PRJ-1/PRJ-2), ``has_fm``, ``frontmatter`` and
    ``body``. Runs inside the scan stage (whole-stage codegen + regex).
    """
    clean = T.remove_local_text(T.normalize_newlines(text))
    out = docs.withColumn("clean", clean)
    has, fm, body = T.frontmatter_parts("clean")
    return (out.withColumn("has_fm", has)
            .withColumn("frontmatter", fm)
            .withColumn("body", body))

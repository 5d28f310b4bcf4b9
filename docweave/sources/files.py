"""Issue-memory files (SRC-5); document trees (SRC-1, SRC-2) are read by ``tree``, the glossary (SRC-3) by ``config``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.text import WS
from docweave.sources.tree import scan_tree  # noqa: F401 - the scan's old place
from docweave.storage import Folder

MEMORY_ITEM = "array<struct<original:string,translated:string,reason:string>>"


def read_issue_memory(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-5: ``prompt_improvements_<lang>.json`` files (one JSON array each)
    → ``(lang, seq, original, translated, reason)`` with ``seq`` = array
    position. An absent, empty or non-list file yields nothing."""
    if not Folder(spark, folder).exists():
        return spark.createDataFrame([], "lang string, seq bigint, original string, translated string, reason string")
    raw = (spark.read.option("wholetext", True).text(f"{folder.rstrip('/')}/prompt_improvements_*.json")
           .select(F.col("value"), F.col("_metadata.file_name").alias("name")))
    lang = F.regexp_extract("name", r"^prompt_improvements_(.+)\.json$", 1)
    # from_json would wrap a top-level object into a one-element array; only a
    # JSON list counts as memory.
    arr = F.when(F.col("value").rlike(rf"\A{WS}*\["), F.from_json(F.col("value"), MEMORY_ITEM))
    return (raw.select(lang.alias("lang"), F.posexplode(arr).alias("seq", "r"))
            .select("lang", F.col("seq").cast("bigint"), "r.original", "r.translated", "r.reason"))


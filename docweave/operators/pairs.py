"""Original ⋈ translated pairs (JOIN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def pair_outputs(originals: DataFrame, translated: DataFrame, on: str = "rel_path") -> DataFrame:
    """Inner equi-join on the relative path: a translated file without an
    original is skipped. Both sides are large, so Spark plans a sort-merge
    join (or co-located buckets when both tables are bucketed on ``on``)."""
    return translated.join(originals, on, "inner")

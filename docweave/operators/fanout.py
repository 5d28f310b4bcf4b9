"""Language fan-out (JOIN-2) without a join operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What ``--language all`` expands to.
ALL_TARGETS = ("en", "es", "zh")


def fan_out_languages(df: DataFrame, targets: Sequence[str] = ALL_TARGETS,
                      col: str = "target_lang") -> DataFrame:
    """Every row once per target language.

    The target list is a parameter, so the product is a ``Generate`` over a
    literal array inside the scan stage: no join, no exchange, no broadcast.
    Place it after per-document work so text is split once per document.
    """
    return df.withColumn(col, F.explode(F.array(*[F.lit(t) for t in targets])))

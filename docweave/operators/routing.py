"""File routing: binary test (FLT-1), copy/translate/fail routing (FLT-2,
FLT-3), output paths (PRJ-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.sources.config import LANG_DIRS

BINARY_PROBE_BYTES = 8192


# Hex patterns of the last 1, 2 or 3 bytes of the probe when they begin a
# multi-byte sequence that the probe boundary cut (not yet an error).
CUT_1 = r"(C[2-9A-F]|D[0-9A-F]|E[0-9A-F]|F[0-4])$"
CUT_2 = r"(E[0-9A-F]|F[0-4])[89AB][0-9A-F]$"
CUT_3 = r"F[0-4][89AB][0-9A-F][89AB][0-9A-F]$"


def is_binary(content: Column) -> Column:
    """FLT-1: strict UTF-8 decoding of the first 8192 bytes fails.

    A file no longer than the probe must decode completely. For a longer one
    an unfinished multi-byte sequence cut by the probe boundary (at most 3
    trailing bytes) is dropped before the test.
    """
    n = BINARY_PROBE_BYTES
    tail = F.hex(F.substring(content, n - 2, 3))
    drop = (F.when(tail.rlike(CUT_1), 1).when(tail.rlike(CUT_2), 2).when(tail.rlike(CUT_3), 3)
            .otherwise(0))
    head = F.when(F.length(content) > n, content.substr(F.lit(1), F.lit(n) - drop)).otherwise(content)
    return ~F.is_valid_utf8(head)


def route(path: Column, content: Column, case_sensitive: bool = True) -> Column:
    """FLT-2 / FLT-3: ``copy`` if binary or not ``.md``/``.mdx``; ``failed``
    if it has no content (it could not be read), or passed the binary probe but
    is not valid UTF-8 as a whole; else ``translate``. The full run compares extensions case-sensitively, the
    incremental run case-insensitively."""
    p = path if case_sensitive else F.lower(path)
    md = p.endswith(".md") | p.endswith(".mdx")
    return (F.when(content.isNull(), F.lit("failed"))
            .when(~md | is_binary(content), F.lit("copy"))
            .when(~F.is_valid_utf8(content), F.lit("failed"))
            .otherwise(F.lit("translate")))


def output_paths(files: DataFrame, targets: Sequence[str], rel: str = "rel_path") -> DataFrame:
    """PRJ-9: full run ``output/<lang>/<rel>``; incremental run
    ``<LANG_DIRS[lang]>/<rel>``; a language without a directory fails."""
    dirs = F.create_map(*[x for k, v in LANG_DIRS.items() for x in (F.lit(k), F.lit(v))])
    fan = files.withColumn("lang", F.explode(F.array(*[F.lit(t) for t in targets])))
    d = F.element_at(dirs, F.col("lang"))
    return fan.select(rel, "lang",
                      F.concat_ws("/", F.lit("output"), "lang", rel).alias("full_run_path"),
                      F.when(d.isNotNull(), F.concat_ws("/", d, F.col(rel))).alias("incremental_path"),
                      d.isNull().alias("unknown_language"))

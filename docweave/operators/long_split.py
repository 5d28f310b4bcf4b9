"""Greedy packing (STR-8) for documents too long to be one row: rows in, rows out, pointers doubled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators import markdown as M
from docweave.session import materialize


def _successors(numbered: DataFrame, k: list[str], limit: int) -> DataFrame:
    """``(keys, i, nxt)``: the piece with which the next part begins if one begins with piece ``i``; no row where none does.

    That is the first later piece whose group is another one, or whose prefix sum passes ``limit`` beyond the sum before ``i``.
    The sums and the bounds looked for are sorted together, and the last sum met on the way down is the one.
    """
    ends = numbered.select(*k, F.col("e").alias("v"), F.lit(0).alias("probe"), "i", F.col("i").alias("j"))
    probes = numbered.select(*k, (F.col("e") - F.col("n") + limit).alias("v"), F.lit(1).alias("probe"), "i", F.lit(None).cast("bigint").alias("j"))
    down = Window.partitionBy(*k).orderBy(F.col("v").desc(), F.col("probe").desc(), F.col("i").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = ends.unionByName(probes).withColumn("past", F.min("j").over(down)).where("probe = 1").select(*k, "i", "past")
    later = Window.partitionBy(*k).orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cuts = numbered.withColumn("cut", F.min(F.when(F.col("changes"), F.col("i"))).over(later)).select(*k, "i", "cut")
    both = cuts.join(fits, [*k, "i"])
    nxt = F.least("cut", F.when(F.col("past").isNotNull(), F.greatest("past", F.col("i") + 1)))
    # a piece over the limit ends its part; past it there may be no piece
    last = numbered.groupBy(*k).agg(F.max("i").alias("top"))
    return both.select(*k, "i", nxt.alias("nxt")).where("nxt is not null").join(last, k).where("nxt <= top").drop("top")


def _starts(successors: DataFrame, firsts: DataFrame, k: list[str]) -> DataFrame:
    """Pieces with which parts begin: what the first piece leads to. After r rounds all starts under 2**r jumps away are there;
    each round writes them and the jumps twice as far."""
    jumps, starts = materialize(successors, "split-jumps"), materialize(firsts, "split-starts")
    n = starts.count()
    while True:
        grown = materialize(starts.unionByName(starts.join(jumps, [*k, "i"]).select(*k, F.col("nxt").alias("i"))).distinct(), "split-starts")
        m = grown.count()
        if m == n:
            return grown
        starts, n = grown, m
        onward = jumps.select(*k, F.col("i").alias("nxt"), F.col("nxt").alias("far"))
        jumps = materialize(jumps.join(onward, [*k, "nxt"]).select(*k, "i", F.col("far").alias("nxt")), "split-jumps")


def pack_rows(piece_df: DataFrame, keys, max_tokens: int) -> DataFrame:
    """STR-8 / STR-9, as :func:`markdown.pack_pieces`: ``(keys, part_no, text)`` from ``(keys, section_no, para_no, grp, text, n)``.

    No row, array or window state holds a document: sums and numbers run over its sorted rows, and a part's pieces are
    the most that comes together.
    """
    k = M._keys(keys)  # noqa: SLF001
    order = Window.partitionBy(*k).orderBy("section_no", "para_no")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = materialize(piece_df.withColumn("i", F.row_number().over(order).cast("bigint")).withColumn("e", F.sum("n").over(run))
                        .withColumn("changes", F.coalesce(F.col("grp") != F.lag("grp").over(order), F.lit(False))), "split-pieces")
    numbered = whole.select(*k, "i", "n", "e", "changes")
    firsts = numbered.where("i = 1").select(*k, "i")
    starts = _starts(_successors(numbered, k, 4 * max_tokens), firsts, k).withColumn("_start", F.lit(1))
    upto = Window.partitionBy(*k).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = numbered.select(*k, "i").join(starts, [*k, "i"], "left").select(*k, "i", F.count("_start").over(upto).alias("part_no"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda s: s["text"]), "\n\n")
    return whole.select(*k, "i", "text").join(parts, [*k, "i"]).groupBy(*k, "part_no").agg(text.alias("text")).select(*k, "part_no", "text")


def split_lines(lines: DataFrame, keys, max_tokens: int) -> DataFrame:
    """STR-1 … STR-9 for documents given as lines (``keys, line_no, line``), each longer than the budget: ``(keys, part_no, text)``."""
    secs = M.assign_sections(M.classify_lines(lines, keys), keys)
    return pack_rows(M.pieces(M.line_pieces(secs, keys, max_tokens), keys), keys, max_tokens)

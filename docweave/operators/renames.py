"""Renames of files that were edited as well (JOIN-9): content chunks, weighted overlap, one-to-one matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.session import materialize

#: Least share of the larger file's chunk weight that a rename keeps.
SHARE = 0.5
#: A chunk ends after a word of nine characters or more, or with its line: an edit changes the chunks that it touches and no other.
CHUNK_END = "([^ \\n\\t]{9,}[ \\t]+|\\n)"
_CUT = "\ue000"


def chunks(text: Column) -> Column:
    """The distinct chunks of a text, in which it is cut by its content alone."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(text, CHUNK_END, f"$1{_CUT}"), _CUT), lambda c: F.trim(c) != ""))


def chunks_sql(x: str) -> str:
    """:func:`chunks` in DuckDB."""
    return (f"list_distinct(list_filter(string_split(regexp_replace({x}, '{CHUNK_END}', '\\1{_CUT}', 'g'), '{_CUT}'), "
            f"lambda c: trim(c, ' ') <> ''))")


def _weighted(files: DataFrame, side: str) -> DataFrame:
    """``(side, chunk, w, total)``: a file's chunks as hashes with their lengths, and the sum."""
    rows = files.select(F.col("path").alias(side), F.explode(chunks(F.col("text"))).alias("c")).select(
        side, F.xxhash64("c").alias("chunk"), F.char_length("c").cast("long").alias("w"))
    return rows.join(rows.groupBy(side).agg(F.sum("w").alias("total")), side)


def _prefix(rows: DataFrame, side: str, common: DataFrame, share: float) -> DataFrame:
    """The rarest chunks of a file, up to where what is left weighs less than a match must share."""
    left = F.sum("w").over(Window.partitionBy(side).orderBy("n", "chunk").rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return rows.join(common, "chunk").withColumn("left", left).where(F.col("left") >= F.col("total") * F.lit(share)).select(side, "chunk")


def similar_files(deleted: DataFrame, added: DataFrame, share: float = SHARE) -> DataFrame:
    """``(old_path, new_path, score)`` of deleted and added files (``path, text``) that share ``share`` of the larger one's chunk weight.

    Files that share that much share a chunk among the rarest ones of each, so only those are joined; the score is computed from all.
    """
    old = materialize(_weighted(deleted, "old_path"), "rename-old")
    new = materialize(_weighted(added, "new_path"), "rename-new")
    common = old.select("chunk").unionByName(new.select("chunk")).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    near = _prefix(old, "old_path", common, share).join(_prefix(new, "new_path", common, share), "chunk").select("old_path", "new_path").distinct()
    near = materialize(near, "rename-near")
    both = near.join(old, "old_path").join(new.select("new_path", "chunk", F.col("total").alias("new_total")), ["new_path", "chunk"])
    score = F.sum("w") / F.greatest(F.max("total"), F.max("new_total"))
    return both.groupBy("old_path", "new_path").agg(score.alias("score")).where(F.col("score") >= share)


def one_to_one(pairs: DataFrame) -> DataFrame:
    """The greedy matching of ``(old_path, new_path, score)`` by falling score (then by paths), as rounds: a pair that is the best
    of both its files is in it. Each round is written and settles at least the best pair left."""
    best = F.struct(-F.col("score"), F.col("old_path"), F.col("new_path"))
    left, done = materialize(pairs, "rename-pairs"), None
    while not left.isEmpty():
        ranked = left.withColumn("_b", best)
        top_old = ranked.groupBy("old_path").agg(F.min("_b").alias("_b"))
        top_new = ranked.groupBy("new_path").agg(F.min("_b").alias("_b"))
        won = ranked.join(top_old, ["old_path", "_b"], "left_semi").join(top_new, ["new_path", "_b"], "left_semi")
        won = materialize(won.select("old_path", "new_path", "score"), "rename-won")
        done = won if done is None else done.unionByName(won)
        left = materialize(left.join(won.select("old_path"), "old_path", "left_anti").join(won.select("new_path"), "new_path", "left_anti"), "rename-left")
    return pairs.limit(0) if done is None else done


def renames(deleted: DataFrame, added: DataFrame, share: float = SHARE) -> DataFrame:
    """``(old_path, new_path, score)``: which added file (``path, text``) each deleted one became, at most one each.

    Equal texts are matched first, in order of their paths (a group of many copies is numbered, not paired), then the rest by falling
    similarity. A null text matches nothing; paths are distinct.
    """
    def numbered(files: DataFrame, side: str) -> DataFrame:
        key = files.where("text is not null").select(F.col("path").alias(side), F.sha2("text", 256).alias("_h"))
        return key.withColumn("_k", F.row_number().over(Window.partitionBy("_h").orderBy(side)))
    same = numbered(deleted, "old_path").join(numbered(added, "new_path"), ["_h", "_k"]).select("old_path", "new_path", F.lit(1.0).alias("score"))
    same = materialize(same, "rename-same")
    rest = lambda files, side: files.where("text is not null").join(
        same.select(F.col(side).alias("path")), "path", "left_anti")
    return same.unionByName(one_to_one(similar_files(rest(deleted, "old_path"), rest(added, "new_path"), share)))

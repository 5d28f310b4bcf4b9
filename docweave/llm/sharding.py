"""Uniform sharding by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.session import read_table

#: Rows and bytes of a block, which one task orders when a shard is permuted.
BLOCK_ROWS, BLOCK_BYTES = 1_000_000, 8 << 20


def communication_matrix(rows: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """How many rows each partition (a matrix row) sends to each shard (a column).

    Shard sizes differ by at most one. Partition by partition the counts are drawn without
    replacement from the places that are left (multivariate hypergeometric): the law of a uniform random permutation
    of all rows cut into shards.
    """
    total = int(rows.sum())
    rng = np.random.default_rng(seed)
    left = np.full(shards, total // shards, np.int64)
    left[rng.permutation(shards)[:total % shards]] += 1
    out = np.zeros((len(rows), shards), np.int64)
    for i, n in enumerate(rows):
        # one binomial-like draw per shard, from the places left in it and in those after it
        need, rest = int(n), int(left.sum())
        for j in range(shards):
            if not need:
                break
            rest -= int(left[j])
            got = _hypergeometric(rng, int(left[j]), rest, need)
            out[i, j] = got
            need -= got
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if not good:
        return 0
    if not bad:
        return draws
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    # beyond numpy's bound: inversion over all counts with a probability above double precision
    n = good + bad
    mean = draws * good / n
    reach = int(14 * (mean * (bad / n) * ((n - draws) / (n - 1))) ** 0.5) + 40
    k = np.arange(max(0, draws - bad, int(mean) - reach), min(good, draws, int(mean) + reach) + 1, dtype=np.float64)
    ratio = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    weight = np.concatenate(([0.0], np.cumsum(ratio)))
    law = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(law, rng.random() * law[-1], side="right")])


def _random(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def _bytes(rows: DataFrame) -> Column:
    """Bytes of a row's strings and binaries, and 8 for each other column."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() in ("string", "binary") else F.lit(8) for f in rows.schema]
    return sum(sizes, F.lit(0).cast("long"))


def shard(rows: DataFrame, shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All ``rows`` in shards 0 .. ``shards`` - 1: a uniform random order with counts at most one apart.

    Returns the input columns and ``shard`` (int), ``slot`` (long, gapless from 0 in each shard). Input columns of
    those names are replaced. Null values, repeated rows and hot values make no difference: a row is
    known by its place in a table written first (also the cut of the lineage: a rerun task finds the same
    places). An empty table gives no rows.

    Per partition the rows are permuted (their places alone, which then tell each row its shard) and dealt by the drawn
    counts; in the shard they are permuted again, in blocks of a random key of about ``block_rows`` rows or ``block_bytes``
    bytes, so no task orders a whole shard. The driver holds one count per partition and shard.
    """
    scratch = C.Scratch(rows.sparkSession, "shards")
    cols = [c for c in rows.columns if c not in ("shard", "slot")]
    placed = scratch.save(rows.select(*cols, F.spark_partition_id().alias("_from"), F.monotonically_increasing_id().alias("_place")), "placed", "zstd")
    found = placed.groupBy("_from").agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes(placed)).alias("b")).collect()
    counts = sorted((r["_from"], r["n"]) for r in found)
    if not counts:
        return placed.select(*cols, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)
    matrix = communication_matrix(np.array([n for _, n in counts], np.int64), shards, seed)
    ends = rows.sparkSession.createDataFrame(
        [(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(counts, matrix)], "_from int, _ends array<bigint>")
    local = F.row_number().over(Window.partitionBy("_from").orderBy(_random(seed, F.col("_place")), "_place"))
    told = placed.select("_from", "_place").withColumn("_rank", local).join(ends, "_from").select(
        "_place", F.size(F.filter("_ends", lambda e: e < F.col("_rank"))).cast("int").alias("shard"))
    blocks = max(1, -(-sum(n for _, n in counts) // (shards * block_rows)), -(-sum(r["b"] for r in found) // (shards * block_bytes)))
    keyed = placed.join(told, "_place").withColumn("_key", _random(seed + 1, F.col("_place"))).withColumn("_block", F.pmod("_key", F.lit(blocks)))
    dealt = scratch.save(keyed.select(*cols, "shard", "_block", "_key", "_place"), "dealt", "zstd")
    scratch.drop("placed")
    before = dealt.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "_block", (F.sum("n").over(Window.partitionBy("shard").orderBy("_block")) - F.col("n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("_key", "_place"))
    return dealt.withColumn("_at", inside).join(before, ["shard", "_block"]).select(
        *cols, "shard", (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents sharded with their texts; ``size`` and ``text_crc32`` are those of the text in its shard."""
    placed = shard(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Corpus pipeline: language ID, near-dedup, suffix-array dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame that run() writes as Parquet and rereads for the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import language_id, packing
from docweave.llm.common import Scratch
from docweave.llm.decontaminate import drop_contaminated
from docweave.llm.near_dedup import drop_near_duplicates
from docweave.llm.substring_dedup import remove_repeats
from docweave.session import read_table


#: Rows and bytes of an Arrow batch in the pipeline's tasks: texts are long, and buffers for 10,000 of them add up.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def _small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Sets BATCH for the session before a stage: the stage's rows are computed after it has returned."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCH.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)
    return run_stage


@_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: texts that are null, have no letter or score less than its bound go.

    Without a learned language (no labelled row) all texts with a letter stay.
    """
    return language_id.keep_identified(docs, *language_id.learn_with_bounds(docs))


def _named(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with an id in every row, and what takes the made ids away again.

    Rows without an id get distinct ones after the largest, written once so that no rerun task deals them anew.
    """
    if docs.filter("doc_id is null").isEmpty():
        return docs, lambda out: out
    kind, mark = docs.schema["doc_id"].dataType, "_no_id"
    while mark in docs.columns:
        mark += "_"
    top = docs.agg(F.max("doc_id")).first()[0]
    made = (F.lit(0 if top is None else top + 1) + F.monotonically_increasing_id()).cast("long")
    lost = Scratch(spark, "nameless").save(docs.filter("doc_id is null").withColumn("doc_id", made).withColumn(mark, F.lit(True)), "rows")
    named = docs.filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(mark, F.lit(False))
    return named.unionByName(lost), lambda out: out.withColumn("doc_id", F.when(~F.col(mark), F.col("doc_id")).cast(kind)).drop(mark)


@_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (rows without one come after all others)."""
    named, restored = _named(spark, docs)
    return restored(drop_near_duplicates(named))


@_small_batches
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of 100-byte strings, ``n_chars`` counted anew; a document of which nothing is left goes.

    The operator returns id and text; the other columns come back by ``doc_id``, which near-dedup
    left distinct. Rows without an id come after all others.
    """
    named, restored = _named(spark, docs)
    cut = remove_repeats(named).filter("n_removed = 0 or text <> ''").select(
        "doc_id", "text", F.char_length("text").cast("long").alias("n_chars"))
    joined = cut.join(named.drop("text", "n_chars").dropDuplicates(["doc_id"]), "doc_id")
    return restored(joined.select(*named.columns)).select(*docs.columns)


@_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.digest(packing.pack(docs, packing.vocabulary()))


STAGES = [("language_id", identify_language), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", suffix_dedup),
          ("decontamination", decontaminate), ("packing", pack)]

#: DuckDB has no tokenizer, suffix order or banded alignment: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs

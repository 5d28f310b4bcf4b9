"""MinHash near-duplicate detection over whole documents (circulant MinHash)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.llm import minhash as M
from docweave.session import read_table

#: 32 bands of 4 rows: a pair at similarity 0.75 is missed with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS, WIDTH, PERCENT = 32, 4, 5, 75


def text_sets(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, concatenated, and where each text's begin."""
    buf = C.lower_ascii(buf)
    starts, ends, first = C.words(buf, off)
    return C.distinct(*C.shingles(C.word_hashes(buf, starts, ends), first, width))


def _sign(width: int, bands: int, rows: int):
    @C.bounded
    def run(batches):
        for part, buf, off in C.text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), *M.signed_columns(*text_sets(buf, off, width), bands, rows)],
                                             ["id", *M.SIGNED_NAMES])
    return run


def _members(width: int):
    @C.bounded
    def run(batches):
        for part, buf, off in C.text_blocks(batches, "text"):
            yield M.member_batch(*text_sets(buf, off, width), [[x] for x in part.select(["c", "k1", "k2"]).to_pylist()])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Near-duplicate groups of documents.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``.
    A text's set: distinct ``width``-word shingles of its words (A-Z in lower
    case); fewer words: the whole sequence as one shingle; null, empty or blank
    texts: the empty set, linked with nothing. Rows with 100 * intersection >=
    ``percent`` * union are linked, confirmed on the full sets;
    ``component_id`` is the smallest id reachable, ``kept`` is ``doc_id =
    component_id``. Repeated rows each return a row; rows that share an id are one vertex.
    A row without an id is linked with nothing: its component is null, it is kept.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "near")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    signed = scratch.save(base.mapInArrow(_sign(width, bands, rows), f"id {kind}, {M.SIGNED}"), "signed")

    def set_of(ids: DataFrame) -> DataFrame:
        found = M.among(base, ids.select("id").distinct()).join(ids, "id")
        return found.select("text", "c", "k1", "k2").mapInArrow(_members(width), M.MEMBERS)

    roots = M.near_classes(signed.filter("id is not null"), set_of, scratch, percent, bands, rows)
    return signed.select("id", "n_shingles").join(roots, "id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("root", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("root", "id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest
    id (of repeated rows with that id one row); rows without an id all stay."""
    cols = docs.columns
    kept = near_duplicates(docs, **kw).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*cols).unionByName(docs.filter("doc_id is null"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))

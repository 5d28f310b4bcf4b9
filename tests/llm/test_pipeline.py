from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import language_id, packing
from docweave.session import read_table
from tests.llm import brute
from tests.llm.conftest import SHARED
from tests.llm.test_texts import plain_ids, check_pieces


def brute_pipeline(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.lang) for r in read_table(spark, sf_dir, "documents").collect()]
    known = brute.languages_kept(rows)
    docs = {k: t for k, t, _ in rows if k in known}
    root = brute.groups({k: brute.shingle_set(t) for k, t in docs.items()})
    docs = {k: t for k, t in sorted(docs.items()) if root[k] == k}
    seen, cut = set(), {}
    for k, t in docs.items():
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        out, at = [], 0
        for c in t:
            n = len(c.encode())
            if not all(gone[at:at + n]):
                out.append(c)
            at += n
        if out or not t:
            cut[k] = "".join(out)
    items = [brute.normal(r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]
    # exact passages only: near ones are checked in test_texts
    return {k: t for k, t in cut.items() if not any(i in brute.normal(t) for i in items)}


def test_pipeline_against_brute_force(spark, small_dir):
    want = brute_pipeline(spark, small_dir)
    pieces = corpus_pipeline.run(spark, small_dir).collect()
    assert {p.doc_id for p in pieces} == set(want)
    check_pieces(pieces, {k: plain_ids(t) for k, t in want.items()})


def test_rows_without_an_id_are_deduplicated(spark, nameless, small_dir):
    more = nameless.unionByName(spark.createDataFrame([(None, "Before it. " + SHARED[:200], "en", "s", 1)], nameless.schema)).withColumn("_no_id", F.lit(3))
    out = corpus_pipeline.near_dedup(spark, more, small_dir)
    assert out.columns == more.columns and out.schema["doc_id"].dataType == more.schema["doc_id"].dataType
    assert sorted((r.doc_id is None, r.text or "") for r in out.collect()) == [(False, SHARED), (True, ""), (True, "Before it. " + SHARED[:200])]
    cut = corpus_pipeline.suffix_dedup(spark, out, small_dir)
    assert cut.columns == more.columns
    assert sorted((r.doc_id is None, r.text or "", r._no_id) for r in cut.collect()) == [(False, SHARED, 3), (True, "", 3), (True, "Before it. ", 3)]


def test_stages_keep_the_columns(spark, awkward, clashing, empty, small_dir):
    for name, stage in corpus_pipeline.STAGES:
        for df in (awkward, clashing, empty):
            out = stage(spark, df, small_dir)
            if name != "packing":
                assert out.columns == df.columns, name
            assert out.count() >= 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and language_id and packing

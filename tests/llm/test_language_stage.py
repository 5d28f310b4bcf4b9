import random

from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import language_id
from tests.llm import brute
from tests.llm.conftest import DOCS


def test_stage_without_labels_keeps_texts_with_letters(spark, corpus, small_dir):
    docs = corpus[0].withColumn("lang", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(10**6, "12 34 !!", None, "s", 8), (10**6 + 1, None, None, "s", 0), (10**6 + 2, "мир", None, "s", 3)], DOCS)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(odd), small_dir)
    assert {r.doc_id for r in kept.collect()} == {k for k, r in corpus[1].items() if any(c.isalpha() for c in r.text or "")} | {10**6 + 2}


def test_stage_rejects_gibberish_beside_clean_texts(spark, corpus, small_dir):
    rng = random.Random(5)
    bad = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz      ") for _ in range(1500)) for _ in range(20)]
    bad += ["qzxj " * 300, "Это текст о погоде. " * 30, "你好世界" * 50]
    odd = spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(bad)], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, corpus[0].unionByName(odd), small_dir).collect()}
    assert kept == {k for k, r in corpus[1].items() if any(c.isalpha() for c in r.text or "")}


def test_long_texts_are_counted_in_runs(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", "a", "é1", "\n\n", "12", "日本語 テスト", "İstanbul ßtraße", "ab " * 500]
    texts += ["".join(rng.choice("abc é1\n") for _ in range(rng.randrange(60))) for _ in range(60)]
    want = [dict(brute.gram_counts(t)) for t in texts]
    for run in (1, 7, 100, 1 << 17):
        monkeypatch.setattr(language_id, "RUN_CHARS", run)
        doc, gram, count, _ = language_id.ranked_grams(texts, 3, None)
        got = [{} for _ in texts]
        for d, g, c in zip(doc.tolist(), gram.tolist(), count.tolist()):
            got[d][g] = c
        assert got == want


def test_profiles_and_bounds_come_from_every_labelled_text(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_DOCS", 1)
    docs = spark.createDataFrame([(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} ", "xx", "s", 7) for i in range(400)], DOCS)
    learned, _ = language_id.learn_with_bounds(docs)
    assert len(learned[0][1]) == language_id.PROFILE
    texts = [r.text for r in docs.filter(~language_id.held_out(F.col("doc_id"))).collect()]
    count = {}
    for t in texts:
        _, gram, n, _ = language_id.ranked_grams([t], language_id.GRAMS, None)
        for g, c in zip(gram.tolist(), n.tolist()):
            count[g] = count.get(g, 0) + c
    assert learned[0][1] == [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))][:language_id.PROFILE]

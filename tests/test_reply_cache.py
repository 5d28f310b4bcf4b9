import pandas as pd
from pyspark.sql import functions as F

from docweave.operators.flow import process_documents
from docweave.operators.reply_cache import ReplyCache
from docweave.operators.requests import cache_key, offline_replies
from docweave.sources.config import TEST_GLOSSARY, TEST_LANGUAGES

ASKED = "request_id string, lang string, system_prompt string, user_prompt string"


def asked(spark, texts, lang="en"):
    df = spark.createDataFrame([(f"{lang}:{i}", lang, "sys", t) for i, t in enumerate(texts)], ASKED)
    return df.withColumn("cache_key", cache_key(F.col("lang"), F.col("system_prompt"), F.col("user_prompt")))


def says(word):
    def fn(batch):
        bad = batch["user_prompt"].str.startswith("bad")
        return pd.DataFrame({"request_id": batch["request_id"], "content": (word + batch["user_prompt"]).where(~bad, None), "prompt_tokens": 3,
                             "completion_tokens": 2, "error": pd.Series(["no" if b else None for b in bad], index=batch.index, dtype=object)})
    return fn


def got(df):
    return {r.request_id: r.content for r in df.collect()}


def figures(cache, run):
    return {r.lang: (r.n_requests, r.n_unique, r.n_hits, r.n_calls, r.n_failed, r.prompt_tokens_spared) for r in cache.stats().where(F.col("run") == run).collect()}


def test_second_run_calls_for_new_keys_only(spark, tmp_path):
    cache = ReplyCache(spark, str(tmp_path), buckets=4)
    assert cache.stats().count() == 0
    assert got(cache.run(asked(spark, ["a", "b", "a", "bad"]), says("1:"))) == {"en:0": "1:a", "en:1": "1:b", "en:2": "1:a", "en:3": None}
    assert figures(cache, 1) == {"en": (4, 3, 0, 3, 1, 0)}
    # another object, another session: the tables are found by their path
    again = ReplyCache(spark.newSession(), str(tmp_path), buckets=999)
    assert got(again.run(asked(spark, ["b", "c", "a", "a", "bad"]), says("2:"))) == {
        "en:0": "1:b", "en:1": "2:c", "en:2": "1:a", "en:3": "1:a", "en:4": None}
    assert figures(again, 2) == {"en": (5, 4, 2, 2, 1, 9)}
    # same text, other language: another key
    assert got(cache.run(asked(spark, ["b"], "es"), says("3:"))) == {"es:0": "3:b"}
    # run 4: nothing asked
    assert got(cache.run(asked(spark, ["b"]).limit(0), says("4:"))) == {}
    cache.evict(3)  # used in runs 2 to 4
    assert sorted(r.content for r in cache.replies().collect()) == ["1:a", "1:b", "2:c", "3:b"]
    cache.evict(2)
    assert [r.content for r in cache.replies().collect()] == ["3:b"]
    assert got(cache.run(asked(spark, ["a"]), says("5:"))) == {"en:0": "5:a"}
    cache.evict(0)
    assert cache.replies().count() == 0


def test_the_table_does_not_move(spark, tmp_path):
    cache = ReplyCache(spark, str(tmp_path), buckets=8)
    cache.run(asked(spark, [f"text {i}" for i in range(50)]), says(""))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = asked(spark, ["text 7", "new"]).select("cache_key")
        found = cache.look_up(keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # the only exchange deals the run's keys into the table's buckets
        assert plan.count("Exchange") == 1 and "hashpartitioning(cache_key" in plan and ", 8)" in plan
        assert sorted((r.content or "") for r in found.collect()) == ["", "text 7"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_documents_through_the_cache(spark, tmp_path):
    docs = spark.createDataFrame([("a.md", "---\ntitle: one title\n---\n\nfirst body"), ("b.md", "second body text")], "rel_path string, md string")
    cache = ReplyCache(spark, str(tmp_path), buckets=4)

    def flow(df, call):
        out = process_documents(df, spark, ["en"], TEST_LANGUAGES, TEST_GLOSSARY, offline_replies, 100, call=call)
        return {r.rel_path: r.text for r in out.collect()}
    from docweave.operators.requests import run_requests
    want = flow(docs, run_requests)
    assert flow(docs, cache.run) == want == {"a.md": "---\ntitle: LEN:9\n---\n\nLEN:10", "b.md": "LEN:16"}
    more = docs.unionByName(spark.createDataFrame([("c.md", "a third body")], docs.schema))
    assert flow(more, cache.run) == want | {"c.md": "LEN:12"}
    assert [figures(cache, n)["en"][2:4] for n in (1, 2)] == [(0, 3), (3, 1)]

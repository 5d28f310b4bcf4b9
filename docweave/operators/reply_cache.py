"""Replies kept across runs (EXT-1): a bucketed table joined without a shuffle, with last use, eviction and figures."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.requests import RESPONSE_SCHEMA, run_requests
from docweave.session import materialize
from docweave.storage import Folder

_COLUMNS = {
    "replies": "cache_key STRING, content STRING, prompt_tokens INT, completion_tokens INT, run BIGINT",
    "uses": "cache_key STRING, run BIGINT",
}


class ReplyCache:
    """Replies by ``cache_key`` (see :func:`requests.cache_key`) under ``path``, which runs of any session may share.

    Both tables are bucketed and sorted by key, so neither moves when a run's keys are looked up: only the run's keys do, once. The
    number of buckets is fixed with the first run (at least the session's shuffle partitions, so that Spark deals the
    run's side into the table's buckets and not the other way round). A reply with an error is not kept. One run at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = Folder(spark, self.path)
        if not self._folder.exists("state"):
            wide = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
            self._note({"buckets": wide, "version": uuid.uuid4().hex, "run": 0})

    def _state(self) -> dict:
        return json.loads(self._folder.read_text("state"))

    def _note(self, state: dict) -> None:
        self._folder.write("state", json.dumps(state))

    def _table(self, kind: str, state: dict) -> str:
        """The table's name in this session's catalog, where it is entered if need be."""
        name = f"docweave_{kind}_{state['version']}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS[kind]}) USING parquet CLUSTERED BY (cache_key) SORTED BY (cache_key) "
                       f"INTO {state['buckets']} BUCKETS LOCATION '{self.path}/{state['version']}/{kind}'")
        self.spark.catalog.refreshTable(name)
        return name

    def _insert(self, rows: DataFrame, kind: str, state: dict) -> None:
        """One file per bucket and run."""
        rows.repartition(state["buckets"], "cache_key").write.insertInto(self._table(kind, state))

    def replies(self) -> DataFrame:
        """``(cache_key, content, prompt_tokens, completion_tokens, run)``, one row per key: the first run's. No exchange."""
        state = self._state()
        rest = ["run", "content", "prompt_tokens", "completion_tokens"]
        table = self.spark.table(self._table("replies", state))
        return table.groupBy("cache_key").agg(F.min(F.struct(*rest)).alias("r")).select(
            "cache_key", "r.content", "r.prompt_tokens", "r.completion_tokens", "r.run")

    def look_up(self, keys: DataFrame) -> DataFrame:
        """``keys`` (with ``cache_key``) and what is kept for them; ``run`` is null where nothing is."""
        return keys.join(self.replies(), "cache_key", "left")

    def run(self, requests: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
        """Replies of ``requests`` (``request_id, lang, system_prompt, user_prompt, cache_key``), one per request.

        Keys that are kept are answered from the table; the others go through ``fn`` (:func:`requests.run_requests`, equal ones once)
        and what succeeds is kept. A run that failed midway may be run again. The figures are in :meth:`stats`.
        """
        state = self._state()
        now = state["run"] + 1
        cols = ["request_id", "lang", "system_prompt", "user_prompt", "cache_key"]
        asked = materialize(requests.select(*cols), "cache-asked")
        found = materialize(self.look_up(asked.select("request_id", "lang", "cache_key")), "cache-found")
        hit = F.col("run").isNotNull()
        fresh = run_requests(asked, fn, only=found.where(~hit), stored=True)
        named = found.where(~hit).select("request_id", "lang", "cache_key").join(fresh, "request_id")
        named = materialize(named, "cache-fresh")
        good = F.col("error").isNull() & F.col("content").isNotNull()
        new = named.where(good).groupBy("cache_key").agg(
            F.min(F.struct("content", "prompt_tokens", "completion_tokens")).alias("r")).select("cache_key", "r.*", F.lit(now).cast("bigint").alias("run"))
        self._insert(new, "replies", state)
        used = found.where(hit).select("cache_key").union(new.select("cache_key")).distinct()
        self._insert(used.withColumn("run", F.lit(now).cast("bigint")), "uses", state)
        self._count(found, named, now)
        self._note(state | {"run": now})
        names = RESPONSE_SCHEMA.names
        return found.where(hit).withColumn("error", F.lit(None).cast("string")).select(*names).unionByName(named.select(*names))

    def _count(self, found: DataFrame, fresh: DataFrame, now: int) -> None:
        once = found.groupBy("lang", "cache_key").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("run").isNotNull()).alias("hit"), F.max("prompt_tokens").alias("p"), F.max("completion_tokens").alias("c"))
        spared = lambda c: F.sum(F.coalesce(F.col(c) * F.col("n"), F.lit(0))).cast("bigint")
        per = once.groupBy("lang").agg(
            F.sum("n").cast("bigint").alias("n_requests"), F.count(F.lit(1)).alias("n_unique"), F.sum(F.col("hit").cast("bigint")).alias("n_hits"),
            F.sum((~F.col("hit")).cast("bigint")).alias("n_calls"), spared("p").alias("prompt_tokens_spared"), spared("c").alias("completion_tokens_spared"))
        failed = fresh.where(F.col("error").isNotNull() | F.col("content").isNull()).groupBy("lang").agg(F.countDistinct("cache_key").alias("n_failed"))
        out = per.join(failed, "lang", "left").withColumn("n_failed", F.coalesce("n_failed", F.lit(0)))
        out.write.mode("overwrite").parquet(f"{self.path}/figures/run={now}")

    def stats(self) -> DataFrame:
        """Per run and language: requests, distinct keys, keys found, calls, calls that failed, tokens spared by the cache."""
        if not self._folder.names("figures"):
            return self.spark.createDataFrame([], "lang string, n_requests bigint, n_unique bigint, n_hits bigint, n_calls bigint, "
                                                  "prompt_tokens_spared bigint, completion_tokens_spared bigint, n_failed bigint, run int")
        return self.spark.read.option("basePath", f"{self.path}/figures").parquet(f"{self.path}/figures")

    def evict(self, keep_runs: int) -> None:
        """Drops the replies that none of the last ``keep_runs`` runs used (0: all). Tables are written anew beside the old ones, which
        stay until the state names the new ones; files of many runs come together by this."""
        state = self._state()
        new = state | {"version": uuid.uuid4().hex}
        last = self.spark.table(self._table("uses", state)).groupBy("cache_key").agg(F.max("run").alias("run"))
        live = materialize(last.where(F.col("run") > state["run"] - keep_runs), "cache-live")
        columns = [c.split()[0] for c in _COLUMNS["replies"].split(", ")]
        self._insert(self.replies().join(live.select("cache_key"), "cache_key", "left_semi").select(*columns), "replies", new)
        self._insert(live.select("cache_key", "run"), "uses", new)
        self._note(new)
        for kind in _COLUMNS:
            self.spark.sql(f"DROP TABLE IF EXISTS docweave_{kind}_{state['version']}")
        self._folder.delete(state["version"])

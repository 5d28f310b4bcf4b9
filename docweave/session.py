"""Session helpers: builder defaults, table loading and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "docweave",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on and the UI off.

    On a cluster the master, memory and shuffle width come from spark-submit;
    the values here only apply when nothing else set them (local runs, tests).
    """
    from pyspark import SparkConf, SparkContext
    cpus = os.environ.get("BENCH_CPUS", "8")
    defaults = {
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        "spark.driver.memory": os.environ.get("DOCWEAVE_DRIVER_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
    }
    asked = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions and str(shuffle_partitions)}
    builder = SparkSession.builder.appName(app)
    if SparkContext._active_spark_context is None:  # noqa: SLF001 - a running session keeps what it has
        given = SparkConf() if SparkContext._jvm else None  # noqa: SLF001 - spark-submit's settings
        for k, v in defaults.items():
            if not (given and given.contains(k)):
                builder = builder.config(k, v)
    for k, v in asked.items():
        if v:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where one
    machine is all there is, an unset folder becomes a scratch folder; a
    cluster without one is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is unset on {master}: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="docweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``docweave`` importable in Python workers (``mapInPandas``,
    ``foreachPartition``) even when the driver found it through ``sys.path``
    only: zip the package once and ``addPyFile`` it (distributed with the job)."""
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="docweave-pkg-"), "docweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


#: Shuffle files go when the step they belong to is written; else they stay until the driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """``spark`` with another value of one setting."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the shared
    checkpoint folder and reading it back.

    One computation (``DataFrame.checkpoint`` computes an unpersisted plan
    twice), columnar and compressed, and readable by every executor, so a lost
    executor never forces a recompute of what came before. The shuffle files of the step go when it is written.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with setting(spark, CLEAN_SHUFFLES, "true"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)

"""Validation reports as one ordered JSON document per language (SNK-3), written by many tasks at their places in it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from docweave.session import materialize, ship_package

ITEM = ("file_path", "original", "translated", "reason")


def report_pieces(files: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents' pieces, ``(lang, k, at, piece, file_path, pos)``: piece ``k`` stands at byte ``at`` of its language's document.

    ``files`` has a row per file with a result (``lang``), ``kept`` the issues (``lang, file_path, pos`` and the texts; order:
    ``file_path, pos``). ``k`` is 0 for the document's head, 1 .. n for its issues, and n + 1 for its end. A language with files but no
    issue has an empty list. Issues are range-partitioned and written; a place is the sum of the sizes before it in the partition and
    of the partitions before, so no task sees a whole document.
    """
    item = F.concat(F.lit("    "), F.to_json(F.struct(*ITEM)))
    order = ["lang", "file_path", "pos"]
    ranged = materialize(kept.select(*order, item.alias("item")).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "report-items")
    upto = Window.partitionBy("lang", "part").orderBy("file_path", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.octet_length("item").cast("long")
    per = ranged.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = per.select("lang", "part", F.coalesce(F.sum("n").over(earlier), zero).alias("n0"), F.coalesce(F.sum("bytes").over(earlier), zero).alias("b0"))
    # one row per language: bounded by the languages
    totals = files.groupBy("lang").agg(F.count(F.lit(1)).alias("total_files")).join(
        per.groupBy("lang").agg(F.sum("n").alias("total_issues"), F.sum("bytes").alias("bytes")), "lang", "full").select(
        "lang", *(F.coalesce(c, zero).alias(c) for c in ("total_files", "total_issues", "bytes")))
    some = F.col("total_issues") > 0
    named = F.to_json(F.struct(F.col("lang").alias("language")))
    head = F.concat(F.lit("{\n  "), F.substring(named, F.lit(2), F.char_length(named) - 2), F.lit(',\n  "total_files": '), F.col("total_files").cast("string"),
                    F.lit(',\n  "total_issues": '), F.col("total_issues").cast("string"), F.lit(',\n  "issues": ['), F.when(some, "\n").otherwise(""))
    totals = materialize(totals.withColumn("head", head), "report-totals")
    start = F.octet_length("head").cast("long")
    none = [F.lit(None).cast("string").alias("file_path"), F.lit(None).cast(kept.schema["pos"].dataType).alias("pos")]
    ends = totals.select("lang", zero.alias("k"), zero.alias("at"), F.col("head").alias("piece"), *none).unionByName(totals.select(
        "lang", (F.col("total_issues") + 1).alias("k"), (start + F.col("bytes") + F.greatest(F.col("total_issues") - 1, zero) * 2).alias("at"),
        F.when(some, "\n  ]\n}").otherwise("]\n}").alias("piece"), *none))
    placed = ranged.withColumn("i", F.count(F.lit(1)).over(upto)).withColumn("b", F.sum(size).over(upto) - size)
    placed = placed.join(before, ["lang", "part"]).join(totals.select("lang", start.alias("start")), "lang")
    k = F.col("n0") + F.col("i")
    # an item but the first of its document begins with the comma after the one before
    first = k == 1
    at = F.col("start") + F.col("b0") + F.col("b") + F.when(first, zero).otherwise((k - 2) * 2)
    return placed.select("lang", k.alias("k"), at.cast("long").alias("at"), F.when(first, F.col("item")).otherwise(F.concat(F.lit(",\n"), "item")).alias("piece"),
                         "file_path", "pos").unionByName(ends)


class Slices(WriterCommitMessage):
    def __init__(self, sizes: dict[str, int]):
        self.sizes = sizes


class SliceWriter(DataSourceWriter):
    """Rows ``name, at, piece``: the piece goes to byte ``at`` of the file ``name``. Files are written under a name of the job, which
    the job's commit renames once their size is what the pieces sum up to; a repeated task writes the same bytes at the same places."""

    def __init__(self, options):
        root = options["path"]
        self.root = root[len("file:"):].replace("//", "/") if root.startswith("file:") else root
        if "://" in self.root:
            raise ValueError(f"pieces can be written at their places on mounted folders only, not in {root}")
        self.job = uuid.uuid4().hex

    def _aside(self, name: str) -> str:
        if os.path.basename(name) != name or name in ("", ".", ".."):
            raise ValueError(f"not a file name: {name!r}")
        return os.path.join(self.root, f".{name}.{self.job}")

    def write(self, iterator: Iterator) -> Slices:
        os.makedirs(self.root, exist_ok=True)
        sizes, held, name, at = {}, bytearray(), None, 0

        def flush():
            if held:
                target = os.open(self._aside(name), os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    os.pwrite(target, held, at)
                finally:
                    os.close(target)
                sizes[name] = sizes.get(name, 0) + len(held)
                held.clear()
        for row in iterator:
            data = row["piece"].encode("utf-8")
            if row["name"] != name or row["at"] != at + len(held) or len(held) > 8 << 20:
                flush()
                name, at = row["name"], row["at"]
            held += data
        flush()
        return Slices(sizes)

    def commit(self, messages) -> None:
        sizes: dict[str, int] = {}
        for m in messages:
            for name, n in (m.sizes if m else {}).items():
                sizes[name] = sizes.get(name, 0) + n
        for name, n in sizes.items():
            if os.path.getsize(self._aside(name)) != n:
                raise ValueError(f"{name}: pieces of {n} bytes don't make a file of {os.path.getsize(self._aside(name))}")
        for name in sizes:
            os.replace(self._aside(name), os.path.join(self.root, name))

    def abort(self, messages) -> None:
        for name in os.listdir(self.root) if os.path.isdir(self.root) else ():
            if name.endswith(f".{self.job}"):
                os.remove(os.path.join(self.root, name))


class FileSlices(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_slices"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return SliceWriter(self.options)


def write_report_documents(files: DataFrame, kept: DataFrame, folder: str, name: str = "validation_report_{lang}.json") -> None:
    """SNK-3: one JSON document per language in ``folder`` (mounted), ``language, total_files, total_issues, issues`` with the
    issues in order, non-ASCII kept. Each task writes the pieces of its range."""
    spark = kept.sparkSession
    ship_package(spark)
    spark.dataSource.register(FileSlices)
    pieces = report_pieces(files, kept).select(F.replace(F.lit(name), F.lit("{lang}"), F.col("lang")).alias("name"), "at", "piece")
    pieces.repartitionByRange("name", "at").sortWithinPartitions("name", "at").write.format("file_slices").mode("append").save(folder)

"""Shared pieces of the training-data operators: scratch tables, Arrow batches, word and shingle hashes."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docweave.session import CLEAN_SHUFFLES, checkpoint_dir, setting, ship_package

U64 = np.uint64
#: Bytes of text that a task turns into arrays at a time (a longer text makes one block of its own).
BLOCK_BYTES = 1 << 20


class Scratch:
    """Intermediate tables under the shared folder named by ``spark.checkpoint.dir``.

    Writing a step cuts its lineage, so that a lost executor repeats one step
    only; ``drop`` deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        ship_package(spark)

    def save(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        with setting(self.spark, CLEAN_SHUFFLES, "true"):
            df.write.mode("overwrite").parquet(f"{self.root}/{name}", compression=compression)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            path.getFileSystem(conf).delete(path, True)

    def clear(self) -> None:
        """Deletes every table."""
        self.drop("")


def small_batches(spark: SparkSession, rows: int):
    """Fewer rows per Arrow batch while a step with wide rows is written."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not with every C library
        pass


#: What a module keeps in a worker from task to task: its name and what lets go of it.
KEPT: dict[str, Callable[[], None]] = {}


def bounded(run):
    """``run``, a function for mapInArrow, that gives freed memory back when its task ends, and lets go of what other modules keep
    before it begins: Spark uses a worker for later tasks and stages, and all that would add up in the workers of an executor."""
    @functools.wraps(run)
    def ending(batches):
        for module, let_go in KEPT.items():
            if module != run.__module__:
                let_go()
        try:
            yield from run(batches)
        finally:
            _give_back()
    return ending


def text_column(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null texts are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if off else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def text_blocks(batches: Iterator[pa.RecordBatch], text: str,
                block: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sub-batches of about ``block`` bytes of text: (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, off = text_column(batch.column(batch.schema.get_field_index(text)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + block, side="right")) - 1)
            yield batch.slice(i, j - i), buf[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (public splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z of UTF-8 bytes in lower case; other characters stay."""
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: starts, ends (bytes) and the
    index of each text's first word (one more than texts)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    black = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate(([False], black[:-1]))
    starts = np.flatnonzero(black & (~before | edge[:-1]))
    after = np.concatenate((black[1:], [False]))
    ends = np.flatnonzero(black & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (prefix sums of a polynomial hash)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and the index of each text's first one:
    windows of ``width`` words; with fewer words the whole sequence as one; none without words."""
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled[:max(n - k, 0)] += hashes[k:] * U64(pow(_BASE, k + 1, 1 << 64))
    rolled = mix64(rolled)
    sizes = np.diff(first)
    for t in np.flatnonzero((sizes > 0) & (sizes < width)):
        a, short = first[t], 0
        for k in range(sizes[t]):
            short += int(hashes[a + k]) * pow(_BASE, k + 1, 1 << 64)
        rolled[a] = mix64(np.array([(short + int(sizes[t])) & (1 << 64) - 1], np.uint64))[0]
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    start = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], counts)
    return rolled[at], start


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted; same form as shingles()."""
    for a, b in zip(first[:-1], first[1:]):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[first[:-1][first[:-1] < first[1:]]] = True
    count = np.concatenate(([0], np.cumsum(new)))
    return values[new], count[first]


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as signed longs of the same bits."""
    return pa.array(values.view(np.int64))

"""Hard-negative mining by a secondary-sort shuffle of pair scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.llm import vectors as V
from docweave.session import read_table

#: Rows of a block, anchors of a block, row blocks that meet one copy of an anchor block, Arrow rows (pairs of blocks) at a time.
BLOCK_ROWS, BLOCK_ANCHORS, TILE_BLOCKS, PAIRS = 8192, 256, 16, 4
#: Scores held at a time by a task.
SCORES = 1 << 20
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90


def _vectors(scale: int):
    def run(batches):
        for batch in batches:
            x, off, whole = V.integers(batch.column(2), scale)
            kept = np.flatnonzero(whole)
            sizes = np.diff(off)[kept]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            at = np.arange(ends[-1]) + np.repeat(off[kept] - ends[:-1], sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept)),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x[at].astype(np.int32)))], ["id", "label", "v"])
    return run


BLOCK = "n int, dims int, ids binary, labels binary, data binary, windows binary"


def _packed(ids, labels, rows, windows) -> pa.RecordBatch:
    """One block: rows by id, vectors padded with zeros to the longest."""
    order = np.argsort(ids, kind="stable")
    dims = max((len(r) for r in rows), default=0)
    m = np.zeros((len(rows), dims), np.int32)
    for i, j in enumerate(order):
        m[i, :len(rows[j])] = rows[j]
    parts = [ids[order].tobytes(), labels[order].tobytes(), m.tobytes(), windows[order].tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int32()), pa.array([dims], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)],
                                      ["n", "dims", "ids", "labels", "data", "windows"])


def _pack(most: int, width: int):
    """Blocks of at most ``most`` rows from ``id, label, v`` and (with a ``width``) ``windows``, the positives' scores."""
    def run(batches):
        held: list[tuple] = []
        n = 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            x, off, _ = V.rows_of(batch.column(2))
            rows = [x[a:b] for a, b in zip(off[:-1], off[1:])]
            wide = np.full((len(ids), width), -1, np.int64)
            if width:
                for i, w in enumerate(batch.column(3).to_pylist()):
                    wide[i, :len(w or ())] = w or ()
            for a in range(0, len(ids), most):
                held.append((ids[a:a + most], labels[a:a + most], rows[a:a + most], wide[a:a + most]))
                n += len(held[-1][0])
                while n >= most:
                    yield _packed(*_join(held, 0, most))
                    held = [_join(held, most, n)]
                    n -= most
        if n:
            yield _packed(*_join(held, 0, n))
    return run


def _join(held: list[tuple], a: int, b: int) -> tuple:
    rows = [r for h in held for r in h[2]]
    return tuple(np.concatenate([h[i] for h in held])[a:b] if i != 2 else rows[a:b] for i in range(4))


def _block(row: dict, side: str):
    n, dims = row[f"{side}n"], row[f"{side}dims"]
    return (np.frombuffer(row[f"{side}ids"], np.int64), np.frombuffer(row[f"{side}labels"], np.int64),
            np.frombuffer(row[f"{side}data"], np.int32).reshape(n, dims))


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; vectors of different lengths by their common components."""
    dims = min(a.shape[1], x.shape[1])
    a, x = a[:, :dims], x[:, :dims]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(dims, 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 1 << 56:
        return a.astype(np.int64) @ x.astype(np.int64).T
    raise ValueError("scores whose hundredfold is more than a long")


def _firsts(scores: np.ndarray, mask: np.ndarray, most: int) -> np.ndarray:
    """A mask of the first ``most`` rows under ``mask`` for each anchor: higher scores first, ties by place (smaller id)."""
    n = scores.shape[1]
    if n <= most:
        return mask
    out = np.zeros_like(mask)
    # the ``most``-th highest score; of those that equal it, the first places
    low = np.where(mask, scores, np.iinfo(np.int64).min)
    bar = np.partition(low, n - most, axis=1)[:, n - most][:, None]
    above = mask & (low > bar)
    even = mask & (low == bar)
    room = most - above.sum(axis=1, keepdims=True)
    out[above | (even & (np.cumsum(even, axis=1) <= room))] = True
    return out


def _candidates(positives: int, negatives: int, low: int, high: int, windows: bool):
    """Of each pair of blocks, the rows that may count: an anchor's first positives or, once those are known, the first negatives in
    each of their windows."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, a = _block(row, "a_")
                other, theirs, x = _block(row, "r_")
                wide = np.frombuffer(row["a_windows"], np.int64).reshape(len(ids), -1)
                step = max(1, SCORES // max(len(other), 1))
                for i in range(0, len(ids), step):
                    part = slice(i, i + step)
                    s = _scores(a[part], x)
                    same = labels[part][:, None] == theirs
                    if windows:
                        keep = np.zeros_like(same)
                        for w in wide[part].T:
                            held = ~same & (100 * s <= high * w[:, None]) & (low * w[:, None] <= 100 * s)
                            keep |= _firsts(s, held, negatives)
                    else:
                        keep = _firsts(s, same & (ids[part][:, None] != other), positives)
                    at, to = np.nonzero(keep)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part][at]), pa.array(s[at, to]), pa.array(other[to])], ["anchor", "score", "id"])
    return run


def _groups(batch: pa.RecordBatch):
    """Runs of equal anchors in a sorted batch: (anchor, start, end)."""
    anchors = batch.column(0).to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1, [len(anchors)])) if len(anchors) else np.zeros(1, np.int64)
    return ((int(anchors[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:]))


def _take_first(most: int):
    """The first rows of each anchor of a sorted stream; only a count is kept between batches."""
    def run(batches):
        last, seen = None, 0
        for batch in batches:
            for anchor, a, b in _groups(batch):
                seen = seen if anchor == last else 0
                last = anchor
                n = min(most - seen, b - a)
                if n > 0:
                    yield batch.slice(a, n)
                    seen += n
    return run


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _open_windows(negatives: int, low: int, high: int):
    """Rows ``anchor, score, kind, id`` in order: a positive opens its window, negatives in it are emitted with their rank, and a
    full window, or one whose lower end is passed, closes. What is kept between batches is the anchor's open windows."""
    def run(batches):
        last, windows = None, []
        for batch in batches:
            score, kind, ids = (batch.column(i).to_numpy() for i in (1, 2, 3))
            for anchor, a, b in _groups(batch):
                if anchor != last:
                    last, windows = anchor, []
                s, of, who = score[a:b], kind[a:b], ids[a:b]
                windows += [[int(who[i]), int(s[i]), 0] for i in np.flatnonzero(of == 0)]
                neg = np.flatnonzero(of == 1)
                for w in windows:
                    got = neg[(100 * s[neg] <= high * w[1]) & (low * w[1] <= 100 * s[neg])][:negatives - w[2]]
                    if len(got):
                        n = len(got)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([anchor] * n, pa.int64()), pa.array([w[0]] * n, pa.int64()), pa.array(range(w[2] + 1, w[2] + n + 1), pa.int32()),
                             pa.array(who[got]), pa.array([w[1]] * n, pa.int64()), pa.array(s[got])],
                            [f.split()[0] for f in OUT.split(", ")])
                        w[2] += n
                if b > a:
                    windows = [w for w in windows if w[2] < negatives and 100 * int(s[-1]) >= low * w[1]]
    return run


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                        low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """Hard negatives of each anchor and positive (rows ``id, label, vector``; ``is_anchor`` is a condition on ``id``).

    Components become floor(``scale`` * x); a score is the integer inner product with the anchor. An anchor's positives are its first
    ``positives`` other rows of its label, by score (ties: smaller id). For each, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * score <= high * positive_score return ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``; a positive without any returns nothing, as does an anchor without positives.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Ids and labels are integers. Repeated
    rows count each time, but an id is one anchor (its least label and vector), and rows of its id aren't its positives. Vectors of different
    lengths are compared by their common components. An empty table, or one without anchors, gives no rows. Scores of
    2**56 or more, whose hundredfold a long can't hold, fail the job.

    All rows meet all anchors in pairs of blocks, twice: the first pass keeps an anchor's first positives of each block, the
    second, with their scores known, the first negatives of each block in each window. No other row can be among the results. What is
    left is keyed by (anchor, descending score, kind, id), repartitioned by anchor and sorted within partitions, and a streaming
    iterator opens windows and emits. A copy of an anchor block goes to each tile of TILE_BLOCKS row blocks; no anchor list is broadcast.
    """
    spark = rows.sparkSession
    scratch = C.Scratch(spark, "negatives")
    base = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector").filter(
        "id is not null and label is not null and vector is not null")
    held = scratch.save(base.mapInArrow(_vectors(scale), "id long, label long, v array<int>"), "rows")
    n = held.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    tiles = max(1, min(blocks, spark.sparkContext.defaultParallelism), -(-blocks // TILE_BLOCKS))
    packed = held.repartition(blocks).mapInArrow(_pack(BLOCK_ROWS, 0), BLOCK)
    packed = scratch.save(packed.withColumn("tile", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(tiles))), "blocks")
    anchors = held.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.*")
    anchors = scratch.save(anchors, "anchors")

    def pairs(known: DataFrame, width: int) -> DataFrame:
        """Candidates of all pairs of an anchor block and a row block."""
        sides = known.mapInArrow(_pack(BLOCK_ANCHORS, width), BLOCK).withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
        a = sides.select("tile", *(F.col(c).alias(f"a_{c}") for c in sides.columns if c != "tile"))
        r = packed.select("tile", *(F.col(c).alias(f"r_{c}") for c in packed.columns if c not in ("tile", "windows")))
        return a.join(r, "tile").drop("tile").mapInArrow(
            _candidates(positives, negatives, low, high, width > 0), "anchor long, score long, id long")

    # all but the first rows of an anchor are dropped by a stream over the sorted shuffle
    first = _take_first(positives)
    with C.small_batches(spark, PAIRS):
        close = scratch.save(pairs(anchors.select("id", "label", "v"), 0), "close")
    order = ["anchor", F.col("score").desc(), "id"]
    chosen = scratch.save(close.repartition("anchor").sortWithinPartitions(*order).mapInArrow(first, close.schema), "positives")
    scores = chosen.groupBy("anchor").agg(F.collect_list("score").alias("windows"))
    wide = anchors.join(scores, F.col("id") == F.col("anchor")).select("id", "label", "v", "windows")
    with C.small_batches(spark, PAIRS):
        far = scratch.save(pairs(wide, positives), "far")
    scratch.drop("rows", "blocks", "close", "anchors")
    both = chosen.select("anchor", "score", F.lit(0).alias("kind"), "id").unionByName(far.select("anchor", "score", F.lit(1).alias("kind"), "id"))
    order = ["anchor", F.col("score").desc(), "kind", "id"]
    return both.repartition("anchor").sortWithinPartitions(*order).mapInArrow(_open_windows(negatives, low, high), OUT)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return mine_hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE_OP11 = f"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS a, r.id AS r, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM v AS a, v AS r WHERE a.id % 100 = 0),
p AS (
  SELECT a, r AS p, score AS ps FROM s WHERE same AND a <> r
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, r) <= {POSITIVES})
SELECT a AS anchor_id, p AS positive_id, row_number() OVER (PARTITION BY a, p ORDER BY score DESC, r)::INTEGER AS rank,
  r AS negative_id, ps AS positive_score, score AS negative_score
FROM p JOIN s USING (a) WHERE NOT same AND {LOW} * ps <= 100 * score AND 100 * score <= {HIGH} * ps
QUALIFY row_number() OVER (PARTITION BY a, p ORDER BY score DESC, r) <= {NEGATIVES}
"""

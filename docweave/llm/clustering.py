"""Centroid clustering: Lloyd rounds on integer vectors whose assignments use Orchard's search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common as C
from docweave.llm import vectors as V
from docweave.session import read_table

DIMS, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
#: Numbers that centroids may have in all (they go to every task).
MAX_NUMBERS = 4_000_000


class Orchard:
    """Nearest centroids by Orchard's search.

    Each centroid lists the others by distance. A search walks the list of the nearest centroid known so far: whatever lies
    strictly beyond twice the current distance can't be nearer, and ends it; a centroid not yet visited is measured, and if it is
    nearer (or as near with a smaller number) the walk goes on in its list from the start.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        k = len(centroids)
        self.apart = np.stack([((self.centroids - c) ** 2).sum(axis=1) for c in self.centroids]) if k else np.zeros((0, 0), np.int64)
        order = np.argsort(self.apart, axis=1, kind="stable")
        self.lists = order[order != np.arange(k)[:, None]].reshape(k, max(k - 1, 0))
        self.measured = 0

    def search(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row (ties: the smaller number)."""
        n, k = len(x), len(self.centroids)
        now = start.astype(np.int64)
        best = ((x - self.centroids[now]) ** 2).sum(axis=1)
        visited = np.zeros((n, k), bool)
        visited[np.arange(n), now] = True
        self.measured += n
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while True:
            walking = walking[place[walking] < k - 1]
            if not len(walking):
                return now, best
            other = self.lists[now[walking], place[walking]]
            near = self.apart[now[walking], other] <= 4 * best[walking]
            walking, other = walking[near], other[near]
            place[walking] += 1
            new = ~visited[walking, other]
            rows, other = walking[new], other[new]
            visited[rows, other] = True
            d = ((x[rows] - self.centroids[other]) ** 2).sum(axis=1)
            self.measured += len(rows)
            nearer = (d < best[rows]) | ((d == best[rows]) & (other < now[rows]))
            rows = rows[nearer]
            now[rows], best[rows], place[rows] = other[nearer], d[nearer], 0


#: Rows that a search holds at a time (a row of the visited marks has a byte per centroid).
SEARCH_ROWS = 4096


def _blocks(n: int):
    return ((i, min(i + SEARCH_ROWS, n)) for i in range(0, n, SEARCH_ROWS))


def _first(centroids: np.ndarray, dims: int, scale: int):
    def run(batches):
        search = Orchard(centroids)
        for batch in batches:
            x, off, whole = V.integers(batch.column(1), scale)
            kept = np.flatnonzero(whole & (np.diff(off) == dims))
            for a, b in _blocks(len(kept)):
                rows = kept[a:b]
                m = x[off[rows][:, None] + np.arange(dims)]
                now, _ = search.search(m, np.zeros(len(rows), np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), V.lists(m), pa.array(now.astype(np.int32))],
                                                 ["id", "v", "cluster"])
    return run


def _matrix(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    values, off, _ = V.rows_of(batch.column(1))
    m = values[off[0]:off[-1]].reshape(-1, dims).astype(np.int64)
    return m, np.asarray(batch.column(2)).astype(np.int64)


def _sums(centroids: np.ndarray | None, k: int, dims: int):
    """Rows and component sums of each cluster of a task; without centroids, of the stored clusters."""
    def run(batches):
        search = Orchard(centroids) if centroids is not None else None
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x, start = _matrix(batch, dims)
            for a, b in _blocks(len(x)):
                now = search.search(x[a:b], start[a:b])[0] if search else start[a:b]
                count += np.bincount(now, minlength=k)
                np.add.at(total, now, x[a:b])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), V.lists(total[used], np.int64)],
                                         ["cluster", "n", "total"])
    return run


def _last(centroids: np.ndarray, dims: int):
    def run(batches):
        search = Orchard(centroids)
        for batch in batches:
            x, start = _matrix(batch, dims)
            for a, b in _blocks(len(x)):
                now, best = search.search(x[a:b], start[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(now.astype(np.int32)), pa.array(best)],
                                                 ["id", "cluster", "distance"])
    return run


def cluster(rows: DataFrame, id_col: str, vector_col: str, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
            scale: int = SCALE, seed: int = 2) -> tuple[DataFrame, list[list[int]]]:
    """Clusters of the rows whose vector has ``dims`` components, none of them null or non-finite.

    Returns ``(id, cluster, distance, cluster_inertia, inertia)`` rows and the final centroids. Components become
    floor(``scale`` * x). Centroids start as the ``k`` vectors with the smallest sha256 of ``seed:id`` (all where there are fewer; ties:
    the smaller vector). A round assigns every vector to the nearest centroid (squared distance; ties: the smaller number) and
    moves each centroid that has vectors to the floor of their mean; after ``rounds`` of them vectors are assigned once more.

    Rows without an id are clustered but no centroid starts from them. Repeated rows count each time. A table without such
    vectors gives no rows and no centroids. A component over LIMIT / scale (524,288) fails the job. Other columns are ignored.

    The integer vectors are written once, with the cluster of the first round, where later searches start. A round moves
    one row of sums per cluster and task; the driver holds ``k`` x ``dims`` numbers (at most MAX_NUMBERS).
    """
    if k * max(dims, k) > MAX_NUMBERS:
        raise ValueError(f"centroids and their distances are more than {MAX_NUMBERS} numbers")
    spark = rows.sparkSession
    scratch = C.Scratch(spark, "clusters")
    base = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    whole = base.filter((F.size("v") == dims) & finite & F.col("id").isNotNull())
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    v = F.transform("v", lambda x: F.floor(x.cast("double") * scale))
    starts = whole.select(mark.alias("mark"), v.alias("v")).orderBy("mark", "v").limit(k).collect()
    kind = base.schema["id"].dataType.simpleString()
    out = f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long"
    centroids = np.array([r.v for r in starts], np.int64).reshape(len(starts), dims)
    if not starts:
        return spark.createDataFrame([], out), []

    held = scratch.save(base.mapInArrow(_first(centroids, dims, scale), f"id {kind}, v array<int>, cluster int"), "vectors")
    for r in range(rounds):
        parts = held.mapInArrow(_sums(centroids if r else None, len(centroids), dims), "cluster int, n long, total array<long>")
        means = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)]
        centroids = centroids.copy()
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *means).collect():
            centroids[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    last = scratch.save(held.mapInArrow(_last(centroids, dims), f"id {kind}, cluster int, distance long"), "assigned")
    scratch.drop("vectors")
    sums = {r.cluster: r.s for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    per = F.create_map(*(F.lit(x) for c, s in sorted(sums.items()) for x in (c, s)))
    return last.select("id", "cluster", "distance", per[F.col("cluster")].cast("long").alias("cluster_inertia"),
                       F.lit(sum(sums.values())).cast("long").alias("inertia")), centroids.tolist()


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    sha = F.get(F.array(*(F.lit(s) for s in shas)), F.col("cluster"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", sha.alias("centroid_sha256"))


def _rounds_sql() -> str:
    def assign(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT uid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT uid, c, list_sum(list_transform(list_zip(v.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, m{n} AS m)
  GROUP BY uid)"""

    def move(n: int) -> str:
        return f"""
m{n + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(w.v, m.v) AS v FROM m{n} AS m LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT c, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{n} JOIN v USING (uid), range(1, {DIMS + 1}) AS t(i) GROUP BY c, i)
    GROUP BY c) AS w USING (c))"""

    return ",".join(x for n in range(ROUNDS) for x in (assign(n), move(n))) + "," + assign(ROUNDS)


ORACLE_OP13 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v)::INTEGER - 1 AS c, v FROM v WHERE vec_id IS NOT NULL
  ORDER BY sha256('2:' || vec_id), v LIMIT {CLUSTERS}),{_rounds_sql()},
s AS (SELECT c, sum(d)::BIGINT AS s FROM a{ROUNDS} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, s AS cluster_inertia, (SELECT sum(s)::BIGINT FROM s) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (uid) JOIN s USING (c) JOIN m{ROUNDS} AS m USING (c)
"""

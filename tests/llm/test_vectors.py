import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import clustering, hard_negatives, url_filter, vectors
from docweave.llm.queries import ORACLES, QUERIES
from scripts.oracle_check import canon, duck_conn, rows_of_duck


@pytest.mark.parametrize("key", ["op11_hard_negatives", "op12_url_filters", "op13_centroid_clustering"])
def test_whole_table_equals_sql(spark, small_dir, key):
    got = QUERIES[key](spark, small_dir)
    cols, rows = rows_of_duck(duck_conn(small_dir), ORACLES[key])
    want = canon(cols, rows)
    assert len(want[1]) > 0 and canon(got.columns, got.collect()) == want


# hard negatives --------------------------------------------------------

ROWS = "id long, label int, vector array<double>, score long, anchor long, tile int, v string"
BAD = [(None, 1, [0.5], 0, 0, 0, ""), (1, None, [0.5], 0, 0, 0, ""), (2, 1, None, 0, 0, 0, ""), (3, 1, [0.5, None], 0, 0, 0, ""),
       (4, 1, [float("nan"), 1.0], 0, 0, 0, ""), (5, 1, [float("inf")], 0, 0, 0, ""), (None, None, None, None, None, None, None)]


def negatives_by_hand(rows, step, positives, negatives, low, high, scale):
    ok = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v, *_ in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in sorted(ok):
        if i % step == 0:
            anchors.setdefault(i, (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        s = sorted((-sum(p * q for p, q in zip(v, w)), i, other) for i, other, w in ok)
        for ps, p, _ in [x for x in s if x[2] == lab and x[1] != a][:positives]:
            got = [x for x in s if x[2] != lab and low * -ps <= 100 * -x[0] <= high * -ps][:negatives]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(got)]
    return out


def test_negatives_by_hand(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(3)), [float(x) for x in rng.normal(size=rng.integers(1, 5)).round(1)], 0, 0, 0, "") for i in range(150)]
    rows += [(i, i % 2, [0.5, 0.5], 0, 0, 0, "") for i in range(200, 260)]  # one vector for many rows
    rows += [rows[10], rows[10], rows[20], (30, 2, [1.0, 1.0], 0, 0, 0, ""), (400, 0, [], 0, 0, 0, ""), (402, 1, [0.0], 0, 0, 0, ""), *BAD]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    want = Counter(negatives_by_hand(rows, 10, 4, 6, 30, 90, 256))
    assert len(want) > 100
    for block, anchors, scores in ((8192, 256, 1 << 20), (16, 3, 50)):
        monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
        monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
        monkeypatch.setattr(hard_negatives, "TILE_BLOCKS", 2)
        got = hard_negatives.mine_hard_negatives(df, F.col("id") % 10 == 0, 4, 6)
        assert Counter(tuple(r) for r in got.collect()) == want


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame(BAD, ROWS)
    for rows in (df, df.limit(0), spark.createDataFrame([(7, 1, [1.0], 0, 0, 0, "")], ROWS)):
        assert hard_negatives.mine_hard_negatives(rows, F.col("id") % 10 == 0).collect() == []


def test_windows_continue_over_batches():
    import pyarrow as pa
    rows = [(1, 100, 0, 5), (1, 90, 1, 6), (1, 90, 1, 7), (1, 60, 0, 8), (1, 54, 1, 9), (1, 31, 1, 10), (1, 29, 1, 11), (1, 18, 1, 12), (2, 17, 1, 3)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("anchor", "score", "kind", "id"), r))]) for r in rows]
    for given in (batches, [pa.Table.from_batches(batches).combine_chunks().to_batches()[0]]):
        got = [tuple(r.values()) for b in hard_negatives._open_windows(3, 30, 90)(iter(given)) for r in b.to_pylist()]
        assert sorted(got) == [(1, 5, 1, 6, 100, 90), (1, 5, 2, 7, 100, 90), (1, 5, 3, 9, 100, 54),
                               (1, 8, 1, 9, 60, 54), (1, 8, 2, 10, 60, 31), (1, 8, 3, 11, 60, 29)]


def test_large_scores_stay_exact():
    a = np.array([[1 << 26, 3]], np.int32)
    assert hard_negatives._scores(a, a)[0, 0] == (1 << 52) + 9
    b = np.array([[(1 << 27) - 1] * 3], np.int32)
    assert hard_negatives._scores(b, b)[0, 0] == 3 * ((1 << 27) - 1) ** 2
    with pytest.raises(ValueError):
        hard_negatives._scores(np.repeat(b, 3, axis=1), np.repeat(b, 3, axis=1))


# url filters -----------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http:///only/path", "HTTP://Example.ORG/es/a", "https://www.example.org/es/", "https://example.org/es",
        "https://example.org", "https://example.org?x=/es/", "https://example.org#/es/", "https://a.b.example.org/en/1", "https://notexample.org/es/x",
        "https://example.org./es/x", "https://.org/x", "https://org/", "http://exämple.com/fr/ü", "http://x.com/de/1?u=http://y.org/", "ÄHTTP://EXÄMPLE.COM/x",
        "a://b://c/d", "http://user@example.org:80/es/", "http://example.org/es/\nline", "http://example.org/es/" + "long/" * 40_000,
        "http://" + "sub." * 3000 + "example.org/es/1", "http://deep.example.org/es/x/y/z", "http://example.net/é/1", "http://example.net/éa", "file:///etc", "http://a..org//x"]
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
             ("Deep.example.org", "/es/x", "allow"), ("deep.example.org", "/es/x/y", "block"), ("example.org", "/es/x/y/", "allow"), ("org", "/es/x/y/z", "allow"),
             ("example.net", "/é", "block"), ("example.net", None, "allow"), ("net", "", "block"), ("", "", "block"), ("example.org", "es", "allow"),
             ("org", "/", "block"), (None, "/", "block"), ("example.org", "/", None), ("com", "/fr/", "allow")]


def judged_by_hand(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, v in rules:
        if h is None or v is None:
            continue
        h, p = h.lower(), p or ""
        if p and not p.startswith("/"):
            continue
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, v))
    return (host, path, *(best[2:] if best else (None, default)))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_urls_by_hand(spark, partitions):
    rows = [(i, u, "x", "y", 1) for i, u in enumerate([*URLS, *URLS, *[f"http://h{i % 9}.example.org/e{'s' if i % 2 else 'n'}/{i}" for i in range(300)]])]
    df = spark.createDataFrame([*rows, (None, URLS[5], None, None, None), rows[6]], "page_id int, url string, host string, path string, verdict int")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    held, aqe = spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set(aqe, "false")
    try:
        want = Counter((r.page_id, *judged_by_hand(r.url, URL_RULES, "allow")) for r in df.collect())
        assert Counter(tuple(r) for r in url_filter.judge_urls(df, rules).collect()) == want
        for default in ("allow", "block"):
            kept = url_filter.keep_allowed(df, rules, default=default)
            assert kept.columns == df.columns
            assert Counter(tuple(r) for r in kept.collect()) == Counter(
                tuple(r) for r in df.collect() if judged_by_hand(r.url, URL_RULES, default)[3] == "allow")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
        spark.conf.set(aqe, "true")


def test_urls_without_rows_or_rules(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id int, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert url_filter.judge_urls(df.limit(0), rules).collect() == []
    assert sorted(tuple(r) for r in url_filter.judge_urls(df, rules.limit(0), default="block").collect()) == [
        (1, "a.org", "/x", None, "block"), (2, "", "", None, "block")]


# clustering ------------------------------------------------------------

def test_search_equals_all_distances():
    rng = np.random.default_rng(5)
    for k, dims, spread in ((1, 3, 5), (2, 1, 2), (12, 2, 4), (40, 8, 9)):
        middles = rng.integers(-spread, spread, (k, dims)) * 20
        x = middles[rng.integers(k, size=500)] + rng.integers(-2, 3, (500, dims))
        x = np.concatenate([x, (middles[rng.integers(k, size=200)] + middles[rng.integers(k, size=200)]) // 2])  # ties
        search = clustering.Orchard(middles)
        now, best = search.search(x, rng.integers(k, size=len(x)))
        d = ((x[:, None] - middles) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (now == d.argmin(axis=1)).all()
        if k == 40:
            assert search.measured < 0.6 * k * len(x)


def clusters_by_hand(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [r for r in kept if r[0] is not None]
    cs = [v for _, v in sorted(named, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((p - q) ** 2 for p, q in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                cs[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    per = Counter()
    for d, j in near:
        per[j] += d
    return Counter((i, j, d, per[j], sum(per.values())) for (i, _), (d, j) in zip(kept, near)), cs


def test_clusters_by_hand(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(size=3) + rng.integers(3)], 1, "x") for i in range(200)]
    rows += [(1000 + i, [0.25, 0.25, -0.25], 1, "x") for i in range(80)]  # a third of all rows equal
    rows += [rows[3], rows[3], (None, [0.5, -1.0, 2.0], 1, "x"), (None, None, None, None), (7000, [1.0, 2.0], 1, ""), (7001, [1.0, None, 2.0], 1, ""),
             (7002, [1.0, float("nan"), 0.0], 1, ""), (7003, [1.0, 2.0, float("-inf")], 1, ""), (7004, [], 1, "")]
    df = spark.createDataFrame(rows, "id long, vector array<double>, cluster int, v string").repartition(5)
    for k, rounds in ((7, 3), (1, 2), (500, 1)):
        got, cs = clustering.cluster(df, "id", "vector", k, rounds, 3)
        want, theirs = clusters_by_hand(rows, k, rounds, 3)
        assert cs == theirs and Counter(tuple(r) for r in got.collect()) == want


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(None, [1.0]), (3, None), (4, [float("nan")])], "id long, vector array<double>")
    for rows in (df, df.limit(0)):
        got, cs = clustering.cluster(rows, "id", "vector", 3, 2, 1)
        assert got.collect() == [] and cs == []
    with pytest.raises(ValueError):
        clustering.cluster(df, "id", "vector", 10_000, 2, 1)


def test_integers_of_lists():
    import pyarrow as pa
    col = pa.array([[0.5, -0.001], None, [], [1.0, None], [float("inf")], [2.0]], pa.list_(pa.float32()))
    for cut in (0, 3):
        x, off, whole = vectors.integers(col.slice(cut), 256)
        got = [x[a:b].tolist() if w else None for a, b, w in zip(off[:-1], off[1:], whole)]
        assert got == [[128, -1], None, [], None, None, [512]][cut:]
    with pytest.raises(ValueError):
        vectors.integers(pa.array([[1e30]]), 256)


def test_tasks_let_go_of_what_other_operators_keep(monkeypatch):
    import pyarrow as pa

    from docweave.llm import common
    gone = []
    monkeypatch.setattr(common, "KEPT", {__name__: lambda: gone.append("own"), "other": lambda: gone.append("other")})

    @common.bounded
    def run(batches):
        yield from batches
    batch = pa.RecordBatch.from_pylist([{"x": 1}])
    assert list(run(iter([batch]))) == [batch] and gone == ["other"]

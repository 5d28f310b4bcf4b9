import random

import pytest

from docweave.operators import long_split as LS
from docweave.operators import markdown as M
from docweave.sinks.files import write_documents


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_pack_as_the_fold_does(spark, seed):
    rng = random.Random(seed)
    rows = []
    for doc in range(12):
        sec = 0
        for i in range(rng.choice([1, 2, 30, 200])):
            sec += rng.random() < 0.4
            big = sec % 4 == 3
            n = rng.choice([1, 3, 10, 39, 40, 41, 90])
            rows.append((doc, sec, i, sec if big else -1, f"{doc}.{i}" + "x" * n, n))
    df = spark.createDataFrame(rows, "doc int, section_no long, para_no long, grp long, text string, n long").repartition(3)
    want = {(r.doc, r.part_no): r.text for r in M.pack_pieces(df, "doc", 10).collect()}
    got = {(r.doc, r.part_no): r.text for r in LS.pack_rows(df, "doc", 10).collect()}
    assert got == want and len(want) > 50


def test_one_long_document(spark):
    lines = spark.range(30_000).selectExpr("1 AS doc", "id AS line_no", "CASE WHEN id % 50 = 0 THEN '# head' WHEN id % 9 = 4 THEN '' ELSE concat('line ', id) END AS line")
    parts = LS.split_lines(lines, "doc", 500)
    assert parts.count() > 100 and parts.selectExpr("max(length(text))").first()[0] <= 2100 + 100
    assert parts.selectExpr("max(part_no) = count(*)").first()[0]


def test_counters_are_observed(spark, tmp_path):
    docs = spark.createDataFrame([("en", "a", "t", 2, 1, 10), ("en", "b", "t", 1, 0, 5), ("es", "a", "t", 2, 0, 7)],
                                 "lang string, rel_path string, text string, n_parts long, n_fallback long, tokens long").repartition(3)
    got = {r.lang: tuple(r)[1:] for r in write_documents(docs, f"{tmp_path}/out", ("en", "es", "zh")).collect()}
    assert got == {"en": (2, 1, 3, 1, 15), "es": (1, 0, 2, 0, 7), "zh": (0, 0, 0, 0, 0)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3

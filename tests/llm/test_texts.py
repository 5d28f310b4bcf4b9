import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import language_id, licenses, packing, quality, sharding
from docweave.llm.chat import ORACLE_OP10, chat_examples, op10_chat_formatting, read_back
from docweave.llm.decontaminate import contamination, drop_contaminated, op7_decontamination
from docweave.session import read_table
from scripts.oracle_check import canon, duck_conn, rows_of_duck
from tests.llm import brute
from tests.llm.conftest import LONG, awkward_rows


def unique_rows():
    return {r[0]: r[1] for r in awkward_rows()}


# packing ---------------------------------------------------------------

def plain_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary())
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def check_pieces(pieces, ids_of):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids_of)
    for doc, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            want = np.array(ids_of[doc][p.start:p.start + p.length], np.uint32)
            assert p.start == at and p.length > 0 and p.ids_crc32 == zlib.crc32(want.tobytes()) and p.doc_tokens == len(ids_of[doc])
            at += p.length
        assert at == len(ids_of[doc])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    return sum(p.length for p in pieces) / (1024 * len(by_seq))


def test_packing_whole_table(spark, small_dir, corpus):
    fill = check_pieces(packing.op1_packing(spark, small_dir).collect(), {k: plain_ids(r.text) for k, r in corpus[1].items()})
    assert fill > 0.95


def test_packing_awkward(awkward, clashing, empty, nameless):
    texts = unique_rows()
    del texts[10]  # its ids are compared by count below
    for df in (awkward, clashing):
        pieces = packing.digest(packing.pack(df.dropDuplicates(["doc_id"]), packing.vocabulary())).collect()
        assert sum(p.length for p in pieces if p.doc_id == 10) == len(plain_ids(LONG))
        check_pieces([p for p in pieces if p.doc_id != 10 and p.sequence_id not in {x.sequence_id for x in pieces if x.doc_id == 10}],
                     {p.doc_id: plain_ids(texts[p.doc_id]) for p in pieces if p.doc_id != 10 and p.sequence_id not in {x.sequence_id for x in pieces if x.doc_id == 10}})
    assert packing.pack(empty, packing.vocabulary()).count() == 0
    assert packing.pack(nameless, packing.vocabulary()).filter("doc_id is null").count() == 3


def test_encoder_equals_whole_texts():
    rng = random.Random(2)
    enc = packing.Encoder(packing.vocabulary())
    parts = ["the", "Thing's", " ", "  ", "\n", "\n\n", " \n", "\t", "é", "über", "12", "...", " ", " ", "\x1f", "<|endoftext|>", "x'll", "'", "日本"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(400)]
    packing.CACHED_WORDS, kept = 5, packing.CACHED_WORDS
    for a in range(0, 400, 10):
        assert enc(texts[a:a + 10]) == [enc.whole(t) for t in texts[a:a + 10]]
    packing.CACHED_WORDS = kept


def test_best_fit_is_tightest():
    window, offset, n = packing.best_fit_decreasing(np.array([600, 400, 500, 524, 24, 1024, 100]), 1024)
    assert n == 4 and window.tolist() == [1, 1, 2, 2, 1, 0, 3] and offset.tolist() == [0, 600, 524, 0, 1000, 0, 0]
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 65, 500)
    window, _, n = packing.best_fit_decreasing(sizes, 64)
    open_ = []
    for s in sorted(sizes.tolist(), reverse=True):
        fits = [c for c in open_ if c >= s]
        if fits:
            open_.remove(min(fits))
            open_.append(min(fits) - s)
        else:
            open_.append(64 - s)
    assert n == len(open_) and sorted(64 - np.bincount(window, sizes, n)) == sorted(open_)


# quality ---------------------------------------------------------------

def check_counts(rows, texts):
    for r in rows:
        want = brute.counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_whole_table(spark, small_dir, corpus):
    rows = quality.op2_quality_rules(spark, small_dir).collect()
    assert {r.doc_id for r in rows} == set(corpus[1]) and len(rows) == len(corpus[1])
    check_counts(rows, {k: r.text for k, r in corpus[1].items()})
    label = {r.doc_id: r.quality for r in read_table(spark, small_dir, "labels").collect()}
    good = [r for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_quality_awkward(spark, awkward, clashing, empty, nameless):
    labels = spark.createDataFrame([(6, 1), (6, 1), (9, 0), (None, 1), (8, None)], "doc_id long, quality int")
    for df in (awkward, clashing):
        rows = quality.quality_rules(df, labels).collect()
        assert len(rows) == len(awkward_rows())
        check_counts(rows, unique_rows())
    assert quality.quality_rules(empty, labels).count() == 0
    rows = quality.quality_rules(nameless, labels.limit(0)).collect()
    assert len(rows) == 4 and sorted(r.kept for r in rows) == [False, True, True, True]


def test_trees_learn_from_every_label(spark):
    rng = np.random.default_rng(5)
    n = 24_000
    x = np.round(rng.normal(size=(n, len(quality.FEATURES))), 3)
    x[:, 3] = -0.0
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(int)
    measured = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "id long, x array<double>").repartition(7)
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(y.tolist())] + [(None, 1), (3, None), (n + 1, 0)], "doc_id long, quality int")
    got = quality.learn(measured, labels)
    want = quality.fit(x, y.astype(float), list(quality.FEATURES.values()))
    assert len(got.roots) == quality.TREES
    assert np.abs(got.score(x) - want.score(x)).max() < 1e-9
    assert abs(got.cut - min(0.5, np.quantile(want.score(x[y == 1]), 0.01))) < 1e-9


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=3000) - 0.6 * x[:, 1] + 0.5 * np.sin(9 * x[:, 2]) > 0.3).astype(float)
    t = quality.fit(x, y, [1, -1, 0])
    assert ((t.score(x) > 0.5) == y).mean() > 0.8
    grid = np.linspace(0, 1, 50)
    for row in x[:100]:
        for f, sign in ((0, 1), (1, -1)):
            line = np.repeat(row[None], 50, axis=0)
            line[:, f] = grid
            assert (sign * np.diff(t.score(line)) >= -1e-12).all()


# sharding --------------------------------------------------------------

def check_shards(rows, shards):
    n = Counter(r.shard for r in rows)
    sizes = [n[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))


def test_sharding_whole_table(spark, small_dir, corpus):
    rows = sharding.op5_sharding(spark, small_dir).collect()
    check_shards(rows, 40)
    for r in rows:
        data = (corpus[1][r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)


def test_sharding_digests_are_of_the_placed_texts(spark, small_dir, corpus, monkeypatch):
    plan = sharding.op5_sharding(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    scan = next(x for x in plan.split("\n") if "Relation [" in x and "_place" in x)
    assert "text#" in scan
    whole = sharding.shard
    monkeypatch.setattr(sharding, "shard", lambda rows, n: whole(rows, n).withColumn("text", F.concat("text", F.lit("!"))))
    for r in sharding.op5_sharding(spark, small_dir).collect():
        data = corpus[1][r.doc_id].text
        assert r.text_crc32 == zlib.crc32(b"" if data is None else (data + "!").encode())


def test_sharding_awkward(awkward, clashing, empty, nameless):
    rows = sharding.shard(awkward, 7, block_rows=2).collect()
    check_shards(rows, 7)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in awkward_rows())
    assert "uid" in sharding.shard(clashing, 3).columns and sharding.shard(clashing, 3).columns.count("shard") == 1
    assert sharding.shard(empty, 3).count() == 0
    check_shards(sharding.shard(nameless, 3).collect(), 3)


def test_communication_matrix_is_exact_and_uniform():
    rows = np.array([5, 0, 17, 3])
    total = np.zeros((4, 4))
    for seed in range(400):
        m = sharding.communication_matrix(rows, 4, seed)
        assert m.sum(axis=1).tolist() == rows.tolist() and set(m.sum(axis=0)) <= {6, 7}
        total += m
    assert np.allclose(total / 400, rows[:, None] / 4, atol=0.3)
    rng = np.random.default_rng(1)
    draws = [sharding._hypergeometric(rng, 2 * 10**9, 6 * 10**9, 1000) for _ in range(300)]
    assert abs(np.mean(draws) - 250) < 4 and 9 < np.std(draws) < 19


# licences --------------------------------------------------------------

def check_licenses(rows, texts):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(texts[r.doc_id], licenses.BASE)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licenses_whole_table(spark, small_dir, corpus):
    rows = licenses.op6_license_scan(spark, small_dir).collect()
    assert len(rows) == len(corpus[1]) and any(r.n_base for r in rows)
    check_licenses(rows, {k: r.text for k, r in corpus[1].items()})


def test_licenses_awkward(awkward, clashing, empty, nameless):
    for df in (awkward, clashing):
        rows = licenses.licenses(df).collect()
        assert len(rows) == len(awkward_rows())
        check_licenses(rows, unique_rows())
    assert licenses.licenses(empty).count() == 0 and licenses.licenses(nameless).count() == 4


@pytest.mark.parametrize("text, labels, permissive, first", [
    ("SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0", "apache-2.0,gpl-2.0-only,mit", True, None),
    ("// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", "gpl-2.0-only", False, None),
    ("SPDX-License-Identifier: MIT AND\nnothing", "mit", True, None),
    ("SPDX-License-Identifier: )", "", None, None),
    ("mit license. The MIT-License, mit  license", "mit", None, 0),
    ("mitlicense mit licenses éMIT License", "", None, None),
    ("GNU Lesser General Public License", "gpl,lgpl", None, 2),
])
def test_license_expressions(text, labels, permissive, first):
    r = licenses.scan_text(text)
    assert (r["labels"], r["permissive"], r["first_word"]) == (labels, permissive, first)


def test_shunting_yard():
    assert licenses.postfix("a or b and c") == ["a", "b", "c", "and", "or"]
    assert licenses.postfix("(a or b) and c with d") == ["a", "b", "or", "c", "d", "with", "and"]
    for bad in ("", "and a", "a b", "(a", "a)", "a or", "()"):
        assert licenses.postfix(bad) is None
    assert licenses.evaluate(licenses.postfix("(a or b) with c")) is None


# decontamination -------------------------------------------------------

def test_decontamination_whole_table(spark, small_dir, corpus):
    items = {r.item_id: r.text for r in read_table(spark, small_dir, "benchmark").collect()}
    rows = op7_decontamination(spark, small_dir).collect()
    exact = {(k, i) for k, r in corpus[1].items() for i, t in items.items() if t in r.text}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        part = corpus[1][r.doc_id].text[r.start:r.end]
        assert brute.best_edits(brute.normal(items[r.item_id]), brute.normal(part)) == r.edits <= brute.budget(items[r.item_id])


def test_decontamination_edits(spark, small_dir):
    """Every document and item against full edit distance, around the budget."""
    rng = random.Random(5)
    items = [(r.item_id, r.text) for r in read_table(spark, small_dir, "benchmark").collect()[:8]] + [(90, "short one"), (91, None), (92, "exactly twelve")]
    docs = []
    for n in range(60):
        s = list(rng.choice(items[:8])[1])
        for _ in range(rng.randint(0, max(1, len(s) * 9 // 100))):
            k = rng.randrange(len(s))
            s[k:k + rng.choice([0, 1, 1])] = rng.choice(["", "a", "è", " ", "\n"])
        docs.append((n, rng.choice(["", "Abc  def ", "x" * 300 + " "]) + "".join(s) + rng.choice(["", " tail of it."])))
    docs += [(70, "EXACTLY\n\ttwelve"), (71, None), (72, "")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for slice_chars in (8_000_000, 300):
        got = {(r.doc_id, r.item_id): r.edits for r in contamination(df, bench, slice_chars=slice_chars).collect()}
        want = {}
        for i, item in items:
            if item and len(brute.normal(item)) >= 12:
                for d, t in docs:
                    e = brute.best_edits(brute.normal(item), brute.normal(t))
                    if e <= brute.budget(item):
                        want[d, i] = e
        assert got == want and (70, 92) in got
    assert sorted(r.doc_id for r in drop_contaminated(df, bench).collect()) == sorted({d for d, _ in docs} - {d for d, _ in want})


def test_decontamination_awkward(spark, awkward, clashing, empty, nameless):
    bench = spark.createDataFrame([(1, unique_rows()[6]), (1, unique_rows()[6]), (None, "zero"), (2, "")], "item_id long, text string")
    hit = {k for k, t in unique_rows().items() if t and unique_rows()[6] in t} | {8}
    for df in (awkward, clashing):
        assert {r.doc_id for r in contamination(df, bench).collect()} == hit
        assert drop_contaminated(df, bench).columns == df.columns
        # an item without a q-gram, as it stands
        assert {r.doc_id for r in contamination(df, bench, short_items=True).collect()} == hit | {17}
    assert contamination(empty, bench).count() == 0 and contamination(awkward, bench.limit(0)).count() == 0
    assert drop_contaminated(nameless, bench).collect() == [(None, None, None, None, None)]


# language --------------------------------------------------------------

def test_language_held_out_accuracy(spark, small_dir, corpus):
    rows = language_id.op9_language_id(spark, small_dir).collect()
    assert len(rows) == len(corpus[1])
    long = [r for r in rows if r.held_out and len(corpus[1][r.doc_id].text) > 100]
    assert sum(r.lang_pred == corpus[1][r.doc_id].lang for r in long) >= 0.97 * len(long) and len(long) > 20
    assert all(r.held_out == brute.is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)


def test_language_by_hand(spark, small_dir, corpus):
    docs = corpus[1]
    profiles = brute.language_profiles([(k, r.text, r.lang) for k, r in docs.items()])
    for r in language_id.op9_language_id(spark, small_dir).collect():
        lang, score = brute.language_of(docs[r.doc_id].text, profiles)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9


def test_sample_is_dealt_per_language(spark):
    rows = spark.range(6000).selectExpr("id", "concat('text ', id) as text", "if(id < 5000, 'xx', if(id < 5999, 'yy', null)) as lang")
    got = {r.lang: r["count"] for r in language_id.sample(rows, 1000).groupBy("lang").count().collect()}
    assert got["yy"] == 999 and 900 < got["xx"] < 1100 and set(got) == {"xx", "yy"}


def test_language_awkward(spark, awkward, clashing, empty, nameless):
    profiles = language_id.learn(awkward)
    for df in (awkward, clashing):
        rows = language_id.identify(df, profiles).collect()
        assert len(rows) == len(awkward_rows())
        for r in rows:
            text = unique_rows()[r.id]
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        kept = language_id.keep_identified(df, profiles)
        assert kept.columns == df.columns and kept.count() == sum(r.lang_pred != "und" for r in rows)
    assert language_id.learn(empty) == []
    assert language_id.identify(empty, profiles).count() == 0
    assert {r.lang_pred for r in language_id.identify(nameless, []).collect()} == {"und"}


def test_ranks_by_definition():
    doc, gram, count, rank = language_id.ranked_grams(["Ab, ab!", None, "é"], 2, None)
    # ab ab: a 2, b 2, _a 2, ab 2, b_ 2
    assert sorted(count[doc == 0]) == [2, 2, 2, 2, 2] and rank[doc == 0].tolist() == [0, 1, 2, 3, 4]
    assert sorted(count[doc == 2]) == [1, 1, 1] and not (doc == 1).any()


# chat ------------------------------------------------------------------

def test_chat_oracle(spark, small_dir):
    df = op10_chat_formatting(spark, small_dir)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert got == canon(*rows_of_duck(duck_conn(small_dir), ORACLE_OP10))


def test_chat_awkward(spark):
    import hashlib
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\b <s> [INST] \\[x <\\/s> </s>"), (1, 2, "user", None), (2, None, None, "[ROLE] \\"), (2, None, None, "[ROLE] \\"),
             (3, 1, "assistant", ""), (None, 0, "assistant", "lost \\\\[/INST] é\n"), (4, 0, "too[INST]l\n", "x" * 50_000), (4, 1, "assistant", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    ex = chat_examples(df.selectExpr("*", "1 as ps", "2 as target"))
    for r in ex.collect():
        if r.target is not None:
            assert r.formatted[r.loss_start - 3:r.loss_start] == "<s>" and r.formatted[r.loss_start + r.loss_chars:] == "</s>"
    got = {r.conv_id: r for r in read_back(ex).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert read_back(chat_examples(df.limit(0))).count() == 0


def test_chat_prefixes(spark):
    df = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(5)], "conv_id long, turn long, role string, text string")
    rows = sorted(chat_examples(df).collect(), key=lambda r: len(r.formatted))
    assert [r.target for r in rows] == [1, 3, None]
    assert rows[0].formatted == "[ROLE]user[INST]t0[/INST]<s>t1</s>" and all(b.formatted.startswith(a.formatted) for a, b in zip(rows, rows[1:]))


# long and repetitive texts ------------------------------------------------

def plain_leading(line):
    """The longest prefix of a line's tokens that is an expression, by trying every one."""
    tokens = licenses._TOKEN.findall(line)
    for n in range(len(tokens), 0, -1):
        steps = licenses.postfix(" ".join(tokens[:n]))
        if steps is not None and licenses.evaluate(steps) is not None:
            return " ".join(tokens[:n])
    return None


def test_leading_expressions_by_trying_all():
    rng = random.Random(3)
    parts = ["mit", "apache-2.0", "gpl", "or", "and", "with", "(", ")", "classpath", "or", "and"]
    for _ in range(4000):
        line = " ".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert licenses.leading_expression(line) == plain_leading(line), line


def test_licences_of_long_lines():
    import time
    began = time.time()
    words = " ".join(f"word{i}" for i in range(130_000))
    r = licenses.scan_text("SPDX-License-Identifier: MIT " + words)
    assert len(words) > 10**6 and r["expressions"] == ["mit"] and r["labels"] == "mit"
    r = licenses.scan_text("license expression: " + " or ".join(f"l{i}" for i in range(90_000)))
    assert len(r["expressions"]) == 1 and r["labels"].count(",") == 89_999
    assert licenses.scan_text("license expression: " + "(" * 500_000)["expressions"] == []
    r = licenses.scan_text("mit license " * 90_000)
    assert (r["n_base"], r["first_word"], r["last_word"], r["n_words"]) == (90_000, 0, 179_998, 180_000)
    assert time.time() - began < 60


def test_decontamination_of_repetitive_texts():
    import time

    import pyarrow as pa

    from docweave.llm import decontaminate

    class Shared:
        value = (decontaminate.Items(["a" * (100 + i) for i in range(200)] + ["short one", "ab"], 12, 6), [[i] for i in range(202)])
    texts = ["a" * 100_000, "b" * 50_000 + "a" * 130, "a short  ONE, abab", "a" * 99]
    began = time.time()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(texts)], ["id", "text"])
    rows = [r for b in decontaminate._scan(Shared, 1 << 20)(iter([batch])) for r in b.to_pylist()]
    assert time.time() - began < 100
    first = [r for r in rows if r["doc_id"] == 1 and r["item_id"] == 0]
    assert [r["start"] for r in sorted(first, key=lambda r: r["start"])] == list(range(0, 100_000, 100)) and all(r["edits"] == 0 for r in first)
    assert {r["item_id"] for r in rows if r["doc_id"] == 2} >= set(range(31))
    assert sorted((r["item_id"], r["start"], r["end"]) for r in rows if r["doc_id"] == 3) == [(200, 2, 12), (201, 14, 16), (201, 16, 18)]
    # one letter less than the shortest item is an edit
    assert sorted((r["item_id"], r["edits"]) for r in rows if r["doc_id"] == 4)[0] == (0, 1)


def test_candidates_in_chunks_are_the_same(monkeypatch, corpus):
    from docweave.llm import decontaminate
    texts = [r.text for r in list(corpus[1].values())[:40]]
    items = decontaminate.Items([t[20:200] for t in texts[:15] if t and len(t) > 200], 12, 6)
    points, off, _ = decontaminate.normal(*decontaminate.code_points(texts))
    want = items.candidates(points, off)
    monkeypatch.setattr(decontaminate, "POSTINGS", 50)
    got = items.candidates(points, off)
    rows = [set(zip(*(x.tolist() for x in c))) for c in (want, got)]
    assert rows[0] <= rows[1] and len(rows[0]) >= 10
    # all bands of crowded pairs
    monkeypatch.setattr(decontaminate, "CROWDED", 30)
    more = set(zip(*(x.tolist() for x in items.candidates(points, off))))
    bands = {(t, i, d) for t, i, low in more for d in range(low, low + 2 * (int(items.k[i]) + 1))}
    assert len(more) > len(rows[0]) and all((t, i, d) in bands for t, i, low in rows[0] for d in range(max(low, 0), low + int(items.k[i]) + 1))

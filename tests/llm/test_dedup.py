import itertools
import random

import pytest

from docweave.llm import common as C
from docweave.llm import minhash as M
from docweave.llm.components import components
from docweave.llm.near_dedup import drop_near_duplicates, near_duplicates, op8_minhash_near_dedup, text_sets
from docweave.llm.paragraph_dedup import MIN_WORDS, drop_repeated_paragraphs, op3_paragraph_dedup, repeated_paragraphs
from docweave.llm.substring_dedup import longest_previous, merge_spans, op4_suffix_array_dedup, remove_repeats
from tests.llm import brute
from tests.llm.conftest import SHARED, awkward_rows

import numpy as np


def unique_rows():
    return {r[0]: r[1] for r in awkward_rows()}


def near_brute(texts):
    sets = {k: brute.shingle_set(t) for k, t in texts.items()}
    root = brute.groups(sets)
    return {k: (len(sets[k]), root[k], root[k] == k) for k in texts}


def got_near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_near_whole_table(spark, small_dir, corpus):
    assert got_near(op8_minhash_near_dedup(spark, small_dir)) == near_brute({k: r.text for k, r in corpus[1].items()})


def test_near_awkward(awkward, clashing, empty, nameless):
    want = near_brute(unique_rows())
    assert got_near(near_duplicates(awkward)) == want
    assert near_duplicates(awkward).count() == len(awkward_rows())
    assert got_near(near_duplicates(clashing)) == want
    assert near_duplicates(empty).count() == 0
    rows = near_duplicates(nameless).collect()
    assert len(rows) == 4 and all(r.kept for r in rows) and {r.component_id for r in rows} == {None, 1}
    kept = drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in want.items() if v[2])
    assert drop_near_duplicates(nameless).count() == 4


def test_near_many_pivots(spark):
    """A hot group of edited copies, and hot buckets of texts under the threshold."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(60)] = f"x{rng.randrange(400)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got_near(near_duplicates(df)) == near_brute(texts)


def test_rows_that_share_an_id_are_one_vertex(spark):
    a, b = SHARED, " ".join(f"other{i}" for i in range(60))
    df = spark.createDataFrame([(5, a), (5, b), (7, a), (9, b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(5, 5), (7, 5), (9, 5)}


def test_components(spark):
    scratch = C.Scratch(spark, "test")
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 3), (200, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), scratch, "t").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90, 95: 90}
    assert components(spark.createDataFrame([], "u long, v long"), scratch, "e").count() == 0


def test_circulant_estimate():
    """The share of equal coordinates estimates the Jaccard similarity."""
    words = [f"t{i}" for i in range(1000)]
    a, b = " ".join(words[:800]), " ".join(words[:700] + [f"u{i}" for i in range(100)])
    buf = np.frombuffer((a + b).encode(), np.uint8)
    values, first = text_sets(buf, np.array([0, len(a), len(a) + len(b)]), 5)
    sig = M.circulant_signatures(values, first, 512)
    x, y = brute.shingle_set(a), brute.shingle_set(b)
    assert abs((sig[:, 0] == sig[:, 1]).mean() - len(x & y) / len(x | y)) < 0.07


def paragraphs_brute(texts, min_words=MIN_WORDS):
    sets = {(k, n): s for k, t in texts.items() for n, s in brute.paragraphs(t, min_words).items()}
    root = brute.groups(sets)
    size = {r: list(root.values()).count(r) for r in set(root.values())}
    return {k: (r, r != k) for k, r in root.items() if size[r] > 1}


def got_paragraphs(df):
    return {(r.doc_id, r.paragraph): ((r.cluster_doc_id, r.cluster_paragraph), r.removed) for r in df.collect()}


def test_paragraphs_whole_table(spark, small_dir, corpus):
    assert got_paragraphs(op3_paragraph_dedup(spark, small_dir)) == paragraphs_brute({k: r.text for k, r in corpus[1].items()})


def test_paragraphs_awkward(awkward, clashing, empty, nameless):
    want = paragraphs_brute(unique_rows())
    assert got_paragraphs(repeated_paragraphs(awkward)) == want and want
    assert got_paragraphs(repeated_paragraphs(clashing)) == want
    assert repeated_paragraphs(empty).count() == 0
    assert repeated_paragraphs(nameless).count() == 0
    texts = unique_rows()
    for r in repeated_paragraphs(awkward).collect():
        assert texts[r.doc_id].encode()[r.start:r.end].decode() == texts[r.doc_id].split("\n")[r.paragraph].strip()
    left = {r.doc_id: r.text for r in drop_repeated_paragraphs(awkward).collect()}
    assert left[6] == SHARED and left[7] == "" and left[9] == "end of it è é" and left[0] is None


def got_cut(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_substrings_whole_table(spark, small_dir, corpus):
    want = brute.without_repeats(sorted((k, r.text) for k, r in corpus[1].items()))
    assert got_cut(op4_suffix_array_dedup(spark, small_dir)) == want


def test_substrings_awkward(awkward, clashing, empty, nameless):
    want = brute.without_repeats(sorted(unique_rows().items()))
    assert got_cut(remove_repeats(awkward)) == want
    assert remove_repeats(awkward).count() == len(awkward_rows())
    assert got_cut(remove_repeats(clashing)) == want
    assert remove_repeats(empty).count() == 0
    rows = remove_repeats(nameless).collect()
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0]
    assert sorted(r.n_removed for r in rows if r.doc_id is None) == [0, len(SHARED), len(SHARED)]
    texts = {r.doc_id: r.text for r in remove_repeats(awkward).collect()}
    assert texts[0] is None and "�" not in "".join(t for t in texts.values() if t)


def test_substrings_hot_and_periodic(spark, monkeypatch):
    """Passages in unlike surroundings, periodic texts, and suffix arrays beyond their size."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    noise = lambda n: " ".join(word() for _ in range(n))
    hot = noise(40)
    texts = [(i, noise(rng.randrange(30)) + hot[rng.randrange(60):rng.randrange(150, len(hot))] + noise(rng.randrange(30))) for i in range(120)]
    texts += [(200 + i, ("xyz" * 100)[:rng.randrange(300)] + "q" * rng.randrange(300)) for i in range(20)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    want = brute.without_repeats(sorted(texts))
    assert got_cut(remove_repeats(df)) == want
    from docweave.llm import substring_dedup as S
    # in this process: contexts of one bucket, beyond a suffix array's size
    found = {}
    for limit in (1 << 19, 500):
        monkeypatch.setattr(S, "SUFFIX_BYTES", limit)
        found[limit] = solved_here(S, texts)
    assert found[500] == found[1 << 19] == {k: v[1] for k, v in want.items()}


def solved_here(S, texts):
    """All steps in this process, without a prior count of anchors."""
    import pyarrow as pa
    gone = {k: np.zeros(len(t.encode()), bool) for k, t in texts}
    spots = {}
    for k, t in texts:
        buf = np.frombuffer(t.encode(), np.uint8)
        first, last, at, _ = S.anchors(buf, np.array([0, len(buf)]), S.LENGTH, S.GRAM)
        spots[k] = ((first << 16) | ((at - first) << 8) | (last - first)).astype(np.int64)
    rows = [(k, 0, t, [spots[k].tobytes()]) for k, t in texts if len(spots[k])]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()), pa.array([r[2] for r in rows]),
                                        pa.array([r[3] for r in rows], pa.list_(pa.binary()))], ["id", "uid", "text", "spots"])
    contexts = pa.Table.from_batches(list(S._emit_contexts(S.LENGTH, S.GRAM, 3)([batch]))).sort_by("bucket").to_batches()
    for out in S._solve_buckets(S.LENGTH, S.GRAM)(contexts):
        for doc, spans in zip(out.column(0).to_pylist(), out.column(2).to_pylist()):
            for a, b in merge_spans([spans]).tolist():
                gone[doc][a:b] = True
    return {k: int(g.sum()) for k, g in gone.items()}


def test_longest_previous_factor():
    """Against the definition, on every suffix of small strings."""
    rng = random.Random(9)
    for _ in range(30):
        s = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 40)))
        order = sorted(range(len(s)), key=lambda i: s[i:])
        common = lambda a, b: len([1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(s[a:], s[b:]))])
        lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
        cap = 3
        got = dict(zip(order, longest_previous(np.array(order), np.minimum(lcp, cap), cap) >= cap))
        assert got == {i: any(common(i, j) >= cap for j in range(i)) for i in range(len(s))}


def test_merge_spans():
    pack = lambda *p: np.array(p, np.int64).tobytes()
    assert merge_spans([pack(5, 9, 0, 2), pack(9, 12), pack(1, 3)]).tolist() == [[0, 3], [5, 12]]
    assert merge_spans(None).tolist() == []


@pytest.mark.parametrize("width", [1, 3, 5])
def test_word_sets_match_strings(width):
    texts = ["", "One two  THREE\tfour five\nsix", "é È a b c d", "a a a a a a a", "\x1c x\x85y z"]
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(data), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    _, first = text_sets(buf, off, width)
    assert np.diff(first).tolist() == [len(brute.shingle_set(t, width)) for t in texts]
